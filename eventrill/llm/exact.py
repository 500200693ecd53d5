"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after all ASCII white space is deleted. The full
text is hashed only where another text shares both its length and its first characters.
DataFrame functions only.

A row is told from others by its id and a hash of its text, as ids may be null or repeat.

Defined results: a null text counts as empty, and empty texts are copies of each other; a
null ``doc_id`` comes after every other id; every row is returned and counts in
``group_size``, and of a group exactly one row has ``kept``: ties in length go to the smallest
id, then to the smallest hash of the text, and of rows equal in both to any one; an empty
table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import SPACES, is_small, shared_table

PREFIX_CHARS = 64
SMALL_KEYS = 1_000_000  # 8 bytes each: at most 8 MB are broadcast
SMALL_GROUPS = 100_000  # some 100 bytes each


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def text_hash() -> Column:
    return F.xxhash64("text")


def exact_dedup(
    docs: DataFrame, prefix_chars: int = PREFIX_CHARS, small_keys: int = SMALL_KEYS, digests: bool = False
) -> DataFrame:
    """Per row ``doc_id, text_hash, keep_id, group_size, kept``, and ``text_sha256`` with ``digests``.

    Of equal texts the one with the most code points before normalisation stays, then the
    one with the smallest id. ``digests`` asks for every text's digest, which hashes the texts
    that are alone as well, in the pass that hashes the others.
    """
    texts = docs.select(
        F.col("doc_id"),
        text_hash().alias("text_hash"),
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"),
        normalised(F.col("text")).alias("body"),
    )
    size, start = F.octet_length("body"), F.xxhash64(F.octet_length("body"), F.substring("body", 1, prefix_chars))
    rows = shared_table(texts.select("doc_id", "text_hash", "n_chars", size.alias("size"), start.alias("start")), "exact")

    # 1: lengths that occur more than once; 2: of those, prefixes that do
    lengths = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("size")
    starts = rows.join(lengths, "size", "left_semi").groupBy("start").agg(F.count(F.lit(1)).alias("n"))
    shared = shared_table(starts.where("n > 1").select("start"), "exact")
    if is_small(shared, small_keys):
        shared = F.broadcast(shared)

    # 3: full hashes of the texts that are left
    known = texts.withColumn("start", start)
    if digests:
        marked = known.join(shared.withColumn("met", F.lit(True)), "start", "left")
    else:
        marked = known.join(shared, "start", "left_semi").withColumn("met", F.lit(True))
    hashed = marked.select("doc_id", "text_hash", "n_chars", "met", F.sha2("body", 256).alias("hash"))
    hashed = shared_table(hashed, "exact")
    met = hashed.where("met")
    order = F.struct((-F.col("n_chars")).alias("longest"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = met.groupBy("hash").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    best = shared_table(best.where("group_size > 1"), "exact")
    # written on both sides: a group that is in very many rows is split where the join is not broadcast
    joined = met.join(F.broadcast(best) if is_small(best, SMALL_GROUPS) else best, "hash", "left")
    chosen = (
        F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
        & (F.col("text_hash") == F.col("best.text_hash")) & (-F.col("n_chars") == F.col("best.longest"))
    )
    own = F.col("best").isNull()
    columns = [
        "doc_id", "text_hash", F.when(own, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"), (own | chosen).alias("kept"), "hash",
    ]
    grouped = _one_kept(joined.select(*columns))
    alone = hashed.where("met IS NULL") if digests else rows.join(shared, "start", "left_anti").withColumn("hash", F.lit(""))
    alone = alone.select(
        "doc_id", "text_hash", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "hash",
    )
    out = grouped.unionByName(alone)
    return out.withColumnRenamed("hash", "text_sha256") if digests else out.drop("hash")


def _one_kept(rows: DataFrame) -> DataFrame:
    """``rows`` with ``kept`` once per group: rows that repeat what stays are counted, and told apart by number."""
    kept = rows.where("kept").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    numbered = kept.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    once = numbered.withColumn("kept", F.col("copy") == 1).select(*rows.columns)
    return rows.where("NOT kept").unionByName(once)


def keep_one(docs: DataFrame, verdict: DataFrame, small_keys: int = SMALL_KEYS) -> DataFrame:
    """The rows of ``docs`` that ``verdict(doc_id, text_hash, kept)`` keeps, columns as they were.

    The verdict has a row for each row of ``docs``. A row stays if any verdict on its id and text
    keeps it; of several rows equal in both, the one whose columns have the smallest hash.
    What is dropped, and what repeats, is less than what stays; where it is little it is
    broadcast, so the texts are not shuffled.
    """
    keys = verdict.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = shared_table(keys.where("NOT kept OR n > 1"), "dropped")
    keyed = docs.withColumn("_text_hash", text_hash())

    def side(which: str) -> tuple[DataFrame, Column]:
        some = keys.where(which).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
        return (F.broadcast(some) if is_small(some, small_keys) else some), match

    left = keyed.join(*side("NOT kept"), "left_anti")
    repeated = side("kept AND n > 1")
    once = left.join(*repeated, "left_anti").select(*docs.columns)
    row = F.struct(*docs.columns)
    more = left.join(*repeated, "left_semi").groupBy("doc_id", "_text_hash")
    more = more.agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("_row")).select("_row.*")
    return once.unionByName(more)
