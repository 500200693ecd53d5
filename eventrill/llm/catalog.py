"""The registered queries of the text operators, with the SQL they must agree with."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.llm import (
    bestfit, chat, decontam, exact, hardneg, langid, packing, periods, quality, simhash, substring, suffix, tokenfile,
)
from eventrill.llm.common import table

KEEP_SCORE = 0.3


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def learned_quality():
    """Rows that quality labels are learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learned_quality())
    scored = quality.score_quality(docs, model)
    return scored.select(
        "doc_id", (~learned_quality()).alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted")
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact.exact_dedup(docs, digests=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), said
    )
    out = chat.read_back(chat.formatted(chat.reply_chain(turns.union(extra))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


# What the template adds: 13 signs before the role, a line end after it, and 11 signs after the text.
OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + 1 + 11 + length(regexp_replace(role, '[&<\[\n]', 'xx', 'g'))
                + length(regexp_replace(text, '[&<\[]', 'xx', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontam.hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


def learned_language():
    """Rows that languages are learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 != 2


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict_language(docs, langid.fit(docs, learned_language()))
    return found.select("doc_id", (~learned_language()).alias("held_out"), "lang_pred", "score")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.best_fit_packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def looped_words(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text; in every tenth document (by a hash of its id) they go in a circle from some word on."""
    words = periods.split_words(doc_id, text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    circle = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (circle * ((n - a) // len(circle) + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(table(spark, sf_dir, "documents"), looped_words)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    length, period = F.col("greatest.length"), F.col("greatest.period")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("greatest.start").alias("start"),
        length.alias("length"), period.alias("period"),
        F.expr("greatest.length * 1000 div greatest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardneg.scaled(table(spark, sf_dir, "embeddings"), label)
    return hardneg.mined(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_suffix_array": op4_suffix_array,
    "op5_decontamination": op5_decontamination,
    "op6_substring": op6_substring,
    "op7_language_id": op7_language_id,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_bestfit_packing": op11_bestfit_packing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES = {"op2_exact_dedup": OP2_SQL, "op3_chat_format": OP3_SQL, "op13_hard_negatives": OP13_SQL}
