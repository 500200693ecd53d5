"""Packing token sequences by cutting-stock column generation.

A document's ids, with the end id, are cut into full sequences and one rest. Rests are
counted by length class (``WIDTH`` ids wide); the histogram alone decides the packing. A
linear program over patterns (how many rests of each class share one sequence) is solved by
column generation: the duals of the rows price lengths, and a knapsack by dynamic
programming finds the pattern that the present duals miss most. Pattern counts are rounded
down, what is left over is packed first-fit by class, and documents, ranked within their
class, take the patterns' places in turn.

Only the histogram (at most ``length / WIDTH`` numbers) and the patterns pass through the
driver. Ranks come from counts per class and bucket of ids, so no class meets in one task.

Sequences shorter than ``length`` are to be padded to it by the reader, but not those whose
length is a power of two. Padding comes from rests rounded up to their class and from the
few sequences of the last, rounded patterns.

Defined results: a null or empty text is its end id alone; repeated ids are packed as
separate documents; a null id is packed like others; an empty table gives no pieces; other
columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow, shared_table
from eventrill.llm.tokens import encoder

LENGTH = 2_048
END_ID = 1
WIDTH = 8
BUCKET_ROWS = 20_000  # pieces that are ranked in one task, about
MAX_COLUMNS = 4_000
GAP = 1e-3  # the linear program ends within this share of its bound

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: full pieces of ``length`` ids and the rest."""

    def work(batches):
        encode = encoder(tokenizer, spaced=False).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, length):
                    piece = ids[4 * at : 4 * (at + length)]
                    rows.append((doc_id, at, len(piece) // 4, zlib.crc32(piece), n))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return in_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, PIECES)


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The dearest multiset of classes ``1..capacity`` whose sizes sum to ``capacity`` at most."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth = prices[:room] + best[room - 1 :: -1][:room]
        k = int(np.argmax(worth))
        if worth[k] > best[room - 1] + 1e-12:
            best[room], taken[room] = worth[k], k + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(capacity, np.int64), capacity
    while room:
        if taken[room]:
            pattern[taken[room] - 1] += 1
            room -= taken[room]
        else:
            room -= 1
    return best[capacity], pattern


def first_fit(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """``(pattern, times)`` that packs all ``counts``: largest classes first, the same pattern as often as it fits."""
    left, out = counts.copy(), []
    while left.any():
        pattern, room = np.zeros(capacity, np.int64), capacity
        for k in np.nonzero(left)[0][::-1]:
            n = min(left[k], room // (k + 1))
            pattern[k], room = n, room - n * (k + 1)
        used = pattern > 0
        times = int(np.min(left[used] // pattern[used]))
        out.append((pattern, times))
        left = left - times * pattern
    return out


def solve(counts: np.ndarray, capacity: int, max_columns: int = MAX_COLUMNS) -> list[tuple[np.ndarray, int]]:
    """``(pattern, times)`` covering ``counts[k]`` pieces of class ``k + 1`` exactly.

    Revised simplex on the rows of the classes that occur, from the basis in which every
    class fills sequences alone; then rounding down and first fit of what is left.
    """
    rows = np.nonzero(counts)[0]
    if len(rows) == 0:
        return []
    demand = counts[rows].astype(float)
    patterns = [np.where(np.arange(capacity) == k, capacity // (k + 1), 0) for k in rows]
    inverse = np.diag([1 / (capacity // (k + 1)) for k in rows])
    times = inverse @ demand
    for _ in range(max_columns):
        duals = inverse.sum(axis=0)
        prices = np.zeros(capacity)
        prices[rows] = np.maximum(duals, 0)
        worth, pattern = best_pattern(prices, capacity)
        if worth <= 1 + GAP:  # the program's value over ``worth`` is a bound from below
            break
        direction = inverse @ pattern[rows]
        usable = direction > 1e-9
        ratio = np.full(len(rows), np.inf)
        ratio[usable] = times[usable] / direction[usable]
        out = int(np.argmin(ratio))
        step = ratio[out]
        times = np.maximum(times - step * direction, 0)
        times[out] = step
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
        patterns[out] = pattern
    plan, left = [], counts.astype(np.int64).copy()
    whole = [int(np.floor(x + 1e-6)) for x in times]
    by_rest = sorted(range(len(rows)), key=lambda i: whole[i] - times[i])
    for more in (0, 1):  # whole counts first; then once more where the most was cut off, if enough is left
        for i in by_rest:
            pattern, used = patterns[i], patterns[i] > 0
            n = int(min(1 if more else whole[i], np.min(left[used] // pattern[used])))
            if n > 0:
                plan.append((pattern, n))
                left -= n * pattern
    return plan + first_fit(left, capacity)


def _places(plan: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Per pattern and class: class, first and last rank, places a sequence has, first sequence, first slot."""
    out, taken, sequence = [], {}, 0
    for pattern, n in plan:
        slot = 0
        for k in np.nonzero(pattern)[0]:
            each, size = int(pattern[k]), int(k) + 1
            start = taken.get(size, 0)
            out.append((size, start, start + each * n, each, sequence, slot))
            taken[size] = start + each * n
            slot += each
        sequence += n
    return out


def pack(pieces: DataFrame, length: int = LENGTH, width: int = WIDTH, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a written table."""
    spark = pieces.sparkSession
    size = F.ceil(F.col("length") / width).cast("int")
    buckets = max(1, pieces.count() // bucket_rows)
    keyed = pieces.withColumn("size", size).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = shared_table(keyed.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n")), "packing")
    histogram = np.zeros(length // width, np.int64)
    for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect():  # a row per class
        histogram[r["size"] - 1] = r["n"]
    places = _places(solve(histogram, length // width))
    before = F.sum("n").over(Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("size", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("size", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = keyed.join(offsets, ["size", "bucket"]).withColumn("rank", F.row_number().over(order) - 1 + F.col("before"))
    schema = "size int, first bigint, last bigint, each bigint, sequence bigint, slot bigint"
    # at most ``length / width`` patterns of the basis, and as many of the first fit, per class
    table = F.broadcast(spark.createDataFrame(places, schema))
    placed = ranked.join(table, "size").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    at = F.col("rank") - F.col("first")
    placed = placed.withColumn("sequence_id", F.col("sequence") + F.floor(at / F.col("each")))
    placed = placed.withColumn("place", F.col("slot") + at % F.col("each"))
    within = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(within), F.lit(0)).alias("offset"),
    )


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """All documents, tokenised and packed: one row per piece."""
    return pack(shared_table(cut_documents(docs, tokenizer, length, end_id), "packing"), length)
