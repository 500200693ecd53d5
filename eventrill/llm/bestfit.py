"""Packing whole documents into few sequences: linear grouping, then best fit.

A document's ids, with the end id, are one piece, or if they are too many several full pieces
after a first one that takes the rest. The number of pieces of each length decides everything:

1. *Large* pieces (above a share of ``capacity``) are ranked by length and dealt into
   ``GROUPS`` groups of equal size; within a group every length counts as the group's
   greatest.
2. For these few sizes a linear program over configurations (how many pieces of each group
   share a sequence) is solved by column generation. A configuration holds few large pieces,
   so the best one for given prices is found in as many steps.
3. Whole parts of the solution become sequences. The actual pieces take the places of their
   group, longest first, which leaves room in most sequences.
4. What the rounding left over, then the small pieces, go by decreasing length into the
   sequence with the least sufficient room, or into a new one.

The scheme leaves open what is large: much rounding is repaid only if there are enough small
pieces to fill the room it leaves. So a plan is made for each share in ``LARGE_ABOVE``, and the
one of fewest sequences is taken.

All steps work on numbers of alike sequences, not on single ones, so their cost and the
plan's size depend on ``capacity`` and ``GROUPS`` alone; only the counts per length (at most
``capacity`` numbers) reach the driver, and the plan (some thousand rows) is broadcast. Spark
ranks the pieces of a length, by buckets of bounded size, and each takes the place of its rank.

Defined results: a null or empty text is its end id alone; repeated ids are separate
documents; a null id is packed like others; pieces of the same length are dealt in the order
of a hash, so the plan says who shares a sequence, not their order in the table; an empty
table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow, shared_table
from eventrill.llm.tokens import encoder

CAPACITY = 1_024
END_ID = 2
GROUPS = 64
LARGE_ABOVE = (2, 3, 4)  # large is above capacity / 2, / 3, / 4
GAP = 1e-4  # the linear program ends within this share of its bound ...
ROUNDS_PER_GROUP = 40  # ... or after so many configurations for each group; the plan is whole either way
BUCKET_ROWS = 1_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def whole_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece; a document above ``capacity`` begins with what full pieces leave over."""

    def work(batches):
        encode = encoder(tokenizer, spaced=True).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                n, at = len(ids) // 4, 0
                size = n % capacity or capacity
                piece = 0
                while at < n:
                    rows.append((doc_id, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at, size, piece = at + size, capacity, piece + 1
            columns = zip(*rows) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return in_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, PIECES)


# -- the plan: counts per length in, alike sequences out -------------------------------------


def linear_groups(counts: np.ndarray, least: int, groups: int) -> list[list[tuple[int, int]]]:
    """``(length, pieces)`` of the lengths from ``least`` on, longest first, in groups of equal cardinality."""
    lengths = np.nonzero(counts)[0][::-1]
    lengths = lengths[lengths >= least]
    total = int(counts[lengths].sum())
    edges = [total * k // groups for k in range(1, groups + 1)]
    out, group, done = [], [], 0
    for length in lengths.tolist():
        left = int(counts[length])
        while left:
            take = min(left, edges[0] - done)
            if take:
                group.append((length, take))
            done, left = done + take, left - take
            if done == edges[0]:
                edges.pop(0)
                if group:
                    out.append(group)
                group = []
    return out


def dearest_configuration(prices: np.ndarray, sizes: np.ndarray, capacity: int, most: int) -> tuple[float, np.ndarray]:
    """The configuration of at most ``most`` pieces that is worth most, and its worth."""
    room = np.arange(capacity + 1)[None, :] - sizes[:, None]
    fits, at = room >= 0, np.maximum(room, 0)
    best, chosen = [np.zeros(capacity + 1)], []
    for _ in range(most):
        worth = np.where(fits, prices[:, None] + best[-1][at], -1.0)
        k = np.argmax(worth, axis=0)
        value = worth[k, np.arange(capacity + 1)]
        more = value > best[-1] + 1e-12
        chosen.append(np.where(more, k, -1))
        best.append(np.where(more, value, best[-1]))
    out, left = np.zeros(len(sizes), np.int64), capacity
    for k in reversed(chosen):
        if k[left] >= 0:
            out[k[left]] += 1
            left -= int(sizes[k[left]])
    return float(best[-1][capacity]), out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, most: int) -> list[tuple[np.ndarray, int]]:
    """``(pieces of each size, sequences)``: the whole parts of the cheapest fractional solution."""
    m = len(sizes)
    alone = np.minimum(capacity // sizes, most)
    columns, inverse = [np.where(np.arange(m) == k, alone[k], 0) for k in range(m)], np.diag(1 / alone)
    level = inverse @ (demand * (1 + 1e-7 * np.arange(m)))  # a trifle more, so that no two rows tie
    for _ in range(ROUNDS_PER_GROUP * m):
        worth, column = dearest_configuration(np.maximum(inverse.sum(axis=0), 0), sizes, capacity, most)
        if worth <= 1 + GAP:
            break
        direction = inverse @ column
        rising = np.nonzero(direction > 1e-9)[0]
        leaves = rising[np.argmin(level[rising] / direction[rising])]
        step = level[leaves] / direction[leaves]
        level = np.maximum(level - step * direction, 0)
        level[leaves] = step
        pivot = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, pivot)
        inverse[leaves] = pivot
        columns[leaves] = column
    left, out = demand.copy(), []
    for column, x in zip(columns, level):
        used = column > 0
        n = int(min(np.floor(x + 1e-6), np.min(left[used] // column[used])))
        if n > 0:
            out.append((column, n))
            left -= n * column
    return out


Alike = tuple[int, list[tuple[int, int]]]  # sequences, and (length, pieces) of each of them


def substituted(groups: list[list[tuple[int, int]]], plan: list[tuple[np.ndarray, int]]) -> tuple[list[Alike], dict[int, int]]:
    """Sequences with actual lengths in the places of their groups, and the pieces without a place."""
    queues = [list(reversed(g)) for g in groups]
    out: list[Alike] = []
    for column, n in plan:
        places = [int(g) for g in np.nonzero(column)[0] for _ in range(column[g])]
        taken: list[list[tuple[int, int]]] = []
        for g in places:  # the next n of the group, as (length, pieces)
            need, got = n, []
            while need:
                length, have = queues[g].pop()
                take = min(need, have)
                got.append((length, take))
                need -= take
                if have > take:
                    queues[g].append((length, have - take))
            taken.append(got)
        edges = sorted({int(e) for got in taken for e in np.cumsum([k for _, k in got])})
        at, where = 0, [0] * len(taken)
        upto = [np.cumsum([k for _, k in got]).tolist() for got in taken]
        for edge in edges:
            row = []
            for s, got in enumerate(taken):
                while upto[s][where[s]] <= at:
                    where[s] += 1
                row.append(got[where[s]][0])
            out.append((edge - at, [(length, row.count(length)) for length in sorted(set(row), reverse=True)]))
            at = edge
    left: dict[int, int] = {}
    for queue in queues:
        for length, n in queue:
            left[length] = left.get(length, 0) + n
    return out, left


def best_fit(alike: list[Alike], pieces: dict[int, int], capacity: int) -> list[Alike]:
    """``pieces`` by decreasing length into the least sufficient room, or into new sequences."""
    rooms: list[list[Alike]] = [[] for _ in range(capacity + 1)]
    for n, held in alike:
        rooms[capacity - sum(length * k for length, k in held)].append((n, held))
    for size in sorted(pieces, reverse=True):
        left, room = pieces[size], size
        while left:
            while room <= capacity and not rooms[room]:
                room += 1
            n, held = rooms[room].pop() if room <= capacity else (left, [])
            space = min(room, capacity)
            each = space // size  # a piece of the same size finds the least room where the last one went
            full = min(n, left // each)
            if full:
                rooms[space - each * size].append((full, [*held, (size, each)]))
                left, n = left - full * each, n - full
            if left and n:  # fewer are left than one more sequence would take
                rooms[space - left * size].append((1, [*held, (size, left)]))
                left, n = 0, n - 1
            if n and held:
                rooms[space].append((n, held))
    return [a for room in rooms for a in room]


def _planned(counts: np.ndarray, groups: int, parts: int) -> list[Alike]:
    capacity = len(counts) - 1
    least = capacity // parts + 1
    whole: list[Alike] = [(int(counts[capacity]), [(capacity, 1)])] if counts[capacity] else []
    rest = counts.copy()
    rest[capacity] = 0
    dealt = linear_groups(rest, least, groups)
    plan: list[tuple[np.ndarray, int]] = []
    if dealt:
        sizes = np.array([g[0][0] for g in dealt])
        demand = np.array([sum(n for _, n in g) for g in dealt])
        plan = configurations(sizes, demand, capacity, capacity // least)
    alike, left = substituted(dealt, plan)
    left |= {n: int(rest[n]) for n in range(1, min(least, capacity + 1)) if rest[n]}
    return whole + best_fit(alike, left, capacity)


def planned(counts: np.ndarray, groups: int = GROUPS, large_above: Sequence[int] = LARGE_ABOVE) -> list[Alike]:
    """Alike sequences that hold ``counts[n]`` pieces of every length ``n``, as few as any share gives."""
    plans = [_planned(counts, groups, parts) for parts in large_above]
    return min(plans, key=lambda plan: sum(n for n, _ in plan))


# -- the places ---------------------------------------------------------------------------------


def places(alike: list[Alike]) -> list[tuple[int, int, int, int, int, int]]:
    """Per length and kind of sequence: length, first and last rank, pieces in each, first sequence, offset."""
    out, taken, sequence = [], {}, 0
    for n, held in alike:
        offset = 0
        for length, each in held:
            first = taken.get(length, 0)
            taken[length] = first + n * each
            out.append((length, first, first + n * each, each, sequence, offset))
            offset += length * each
        sequence += n
    return out


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS, **how) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a written table."""
    spark = pieces.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per length
        counts[r["length"]] = r["n"]
    table = spark.createDataFrame(
        places(planned(counts, **how)), "length bigint, first bigint, last bigint, each bigint, sequence bigint, offset bigint"
    )
    # buckets of a length: as many rows in each as there are buckets, where it has very many pieces
    parts = [(int(n), int(-(-counts[n] // max(bucket_rows, int(counts[n] ** 0.5))))) for n in np.nonzero(counts)[0]]
    parts = spark.createDataFrame(parts, "length bigint, parts bigint")
    keyed = pieces.join(F.broadcast(parts), "length")
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), "parts")).drop("parts")
    sizes = shared_table(keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "bestfit")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = keyed.join(starts, ["length", "bucket"]).withColumn("rank", F.row_number().over(order) - 1 + F.col("before"))
    placed = ranked.join(F.broadcast(table.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length"))
                         & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    at = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("offset") + at % F.col("each") * F.col("length")).alias("offset"),
    )


def best_fit_packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents, tokenised and packed: one row per piece."""
    return pack_pieces(shared_table(whole_pieces(docs, tokenizer, capacity, end_id), "bestfit"), capacity)
