"""Passages that occur in several documents: sampled anchors, candidate segments, spans.

What is common to finding long repeats of bytes and of words. A text is a row of units with
64-bit codes. Every window of ``n`` units is led by the smallest of the hashes of its
``gram``-unit pieces: equal windows have equal leads, so a window that occurs in two
documents is led by an *anchor* that occurs in two documents, and neighbouring windows
mostly share their anchor. That gives three jobs:

1. count in how many documents each anchor occurs (aggregate with a map-side part);
2. cut the windows led by a repeated anchor out of the texts, as segments of neighbouring
   windows, and bring the segments of one anchor together, in blocks of bounded size, where
   an operator's own index decides which windows an earlier document has;
3. gather the decided runs per document.

Copies are settled where they are read: a segment that the same task has already met in a
document with a smaller id is decided there and then, and only its place is sent on, as one
run with its neighbours. So a passage of a million documents is sent about once per task.
An anchor in more than ``hot_docs`` documents, a frequent phrase in ever new surroundings,
is not brought together at all: its windows are sent one by one, each to where only equal
windows meet.

Repeated anchors go to the tasks as a sorted array if there are at most ``small_anchors`` of
them (8 bytes each); otherwise they are joined to the documents by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow, is_small, let_go, shared_table

SMALL_ANCHORS = 8_000_000
HOT_DOCS = 10_000
BLOCK_UNITS = 1_500_000
SEEN_SEGMENTS = 200_000  # that a task remembers, by a digest; forgetting some only sends more on
TEXT_BYTES = 1 << 20  # that are worked on at a time: a dozen numbers are made of each unit

_ODD = np.uint64(0x9E3779B97F4A7C15)  # any odd number does
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of polynomial hashes."""
    x = x ^ (x >> np.uint64(31))
    x *= _ODD2
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(codes: np.ndarray, n: int, base: np.uint64 = _ODD) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive codes, from those of half the length."""
    with np.errstate(over="ignore"):
        power, piece, size = base, codes, 1  # of pieces of ``size``
        out, done = None, 0
        while True:
            if n & size:
                if out is None:
                    out = piece
                else:  # the shorter part goes first
                    m = len(codes) - (done + size) + 1
                    out = out[:m] * power + piece[done : done + m]
                done += size
            if done == n:
                return out
            m = len(piece) - size
            piece = piece[:m] * power + piece[size : size + m]
            power = power * power
            size *= 2


def sliding_minimum(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


@dataclass
class Batch:
    """Texts of one Arrow batch laid end to end, and the windows that lie within one text."""

    ids: np.ndarray  # doc_id and text_hash of each text
    hashes: np.ndarray
    begins: np.ndarray  # first unit of each text
    leads: np.ndarray  # of the window at every unit
    first: np.ndarray  # segments: first and last + 1 window, and their text
    last: np.ndarray
    owner: np.ndarray


def segments(ids, hashes, codes: list[np.ndarray], n: int, gram: int) -> tuple[Batch | None, np.ndarray]:
    """Segments of a batch, and all codes in one row."""
    sizes = np.array([len(c) for c in codes], np.int64)
    keep = sizes >= n
    if not keep.any():
        return None, np.zeros(0, np.uint64)
    sizes = sizes[keep]
    row = np.concatenate([c for c, k in zip(codes, keep) if k])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    grams = mix(gram_hashes(row, gram))
    leads = sliding_minimum(grams, n - gram + 1).view(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes - n + 1)
    at = np.arange(len(owner)) + np.repeat(np.arange(len(sizes)) * (n - 1), sizes - n + 1)
    lead = leads[at]
    starts = np.nonzero(np.r_[True, (lead[1:] != lead[:-1]) | (owner[1:] != owner[:-1])])[0]
    first = at[starts]
    last = np.r_[at[starts[1:] - 1], at[-1]] + 1
    return Batch(ids[keep], hashes[keep], begins, leads, first, last, owner[starts]), row


Codes = Callable[[list], list[np.ndarray]]
KEY = "doc_id bigint, text_hash bigint"


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


NO_ID = np.int64(2**63 - 1)  # a null id comes after all others


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def _in_parts(batches):
    """Batches of at most ``TEXT_BYTES`` of text (column 2), a longer text alone."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + TEXT_BYTES, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _anchor_counts(docs: DataFrame, codes: Callable[[], Codes], n: int, gram: int) -> DataFrame:
    def work(batches):
        to_codes = codes()
        for batch in _in_parts(batches):
            cut, _ = segments(_ids(batch.column(0)), _ids(batch.column(1)), to_codes(batch.column(2).to_pylist()), n, gram)
            if cut is None:
                continue
            lead = cut.leads[cut.first]
            order = np.lexsort((cut.owner, lead))
            lead, owner = lead[order], cut.owner[order]
            new = np.r_[True, (lead[1:] != lead[:-1]) | (owner[1:] != owner[:-1])]
            value, docs_with = np.unique(lead[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(docs_with.astype(np.int32))], ["anchor", "n"])

    counted = in_arrow(docs, work, "anchor bigint, n int")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")


def _anchors_of(docs: DataFrame, codes: Callable[[], Codes], n: int, gram: int) -> DataFrame:
    """``doc_id, anchor`` of every segment."""

    def work(batches):
        to_codes = codes()
        for batch in _in_parts(batches):
            cut, _ = segments(_ids(batch.column(0)), _ids(batch.column(1)), to_codes(batch.column(2).to_pylist()), n, gram)
            if cut is not None:
                columns = [pa.array(cut.hashes[cut.owner]), pa.array(cut.leads[cut.first])]
                yield pa.RecordBatch.from_arrays(columns, ["text_hash", "anchor"])

    return in_arrow(docs, work, "text_hash bigint, anchor bigint")


SEGMENTS = f"anchor bigint, {KEY}, start bigint, windows int, payload binary"

# (first, last) windows of the segments in the row, the row of codes, n -> payloads
Payloads = Callable[[np.ndarray, np.ndarray, np.ndarray, int], list[bytes]]


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array."""
    if len(of) == 0:
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _candidates(docs: DataFrame, codes, payloads: Payloads, n: int, gram: int, wanted, hot) -> DataFrame:
    """Segments led by wanted anchors; the windows of hot ones one by one.

    The anchors are sorted arrays, or, if None, columns 3 and 4 of the documents.
    Rows without a payload are runs that are already decided.
    """

    def work(batches):
        to_codes, seen, digest = codes(), {}, xxhash.xxh3_128_digest
        for batch in _in_parts(batches):
            cut, row = segments(_ids(batch.column(0)), _ids(batch.column(1)), to_codes(batch.column(2).to_pylist()), n, gram)
            if cut is None:
                continue
            if wanted is None:
                usual_here, hot_here = (
                    np.unique(batch.column(i).flatten().to_numpy(zero_copy_only=False)) for i in (3, 4)
                )
            else:
                usual_here, hot_here = wanted, hot
            lead = cut.leads[cut.first]
            single = _member(lead, hot_here)
            some = np.nonzero(_member(lead, usual_here) | single)[0]
            if len(some) == 0:
                continue
            first, last, owner, lead, single = cut.first[some], cut.last[some], cut.owner[some], lead[some], single[some]
            if single.any():  # one segment per window of a hot anchor, sent by the hash of the whole window
                sizes = np.where(single, last - first, 1)
                offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first, owner, single = np.repeat(first, sizes) + offset, np.repeat(owner, sizes), np.repeat(single, sizes)
                last = np.where(single, first + 1, np.repeat(last, sizes))
                whole = mix(gram_hashes(row, n)).view(np.int64)
                lead = np.where(single, whole[first], np.repeat(lead, sizes))
            ids, start = cut.ids[owner], first - cut.begins[owner]
            content = payloads(first, last, row, n)
            if len(seen) > SEEN_SEGMENTS:
                seen.clear()
            decided = np.zeros(len(content), bool)
            for i, (piece, doc_id, anchor) in enumerate(zip(content, ids.tolist(), lead.view(np.uint64).tolist())):
                key = digest(piece, anchor)
                least = seen.get(key)
                if least is None or doc_id < least:
                    seen[key] = doc_id
                elif least < doc_id:
                    decided[i] = True
            # decided segments that follow each other in a text are one run
            follows = np.r_[False, (owner[1:] == owner[:-1]) & (first[1:] == last[:-1]) & decided[1:] & decided[:-1]]
            begin = np.nonzero(~follows)[0]
            end = np.r_[begin[1:] - 1, len(first) - 1]
            kept = [None if decided[i] else content[i] for i in begin.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lead[begin]), pa.array(ids[begin]), pa.array(cut.hashes[owner[begin]]), pa.array(start[begin]),
                    pa.array((last[end] - first[begin]).astype(np.int32)), pa.array(kept, pa.binary()),
                ],
                ["anchor", "doc_id", "text_hash", "start", "windows", "payload"],
            )

    return in_arrow(docs, work, SEGMENTS)


RUNS = f"{KEY}, start bigint, end bigint"


def masked_runs(ids, hashes, starts, windows, gone: np.ndarray, n: int) -> pa.RecordBatch:
    """Runs of units covered by windows that are ``gone``; segments come one after another."""
    bounds = np.cumsum(windows)
    edge = np.diff(np.r_[False, gone, False].astype(np.int8))
    # a run ends with its segment
    cut = bounds[:-1][gone[bounds[:-1] - 1] & gone[bounds[:-1]]] if len(bounds) > 1 else np.zeros(0, np.int64)
    begin = np.union1d(np.nonzero(edge == 1)[0], cut)
    end = np.union1d(np.nonzero(edge == -1)[0], cut)
    segment = np.searchsorted(bounds, begin, side="right")
    offset = begin - (bounds[segment] - windows[segment])
    start = starts[segment] + offset
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[segment]), pa.array(hashes[segment]), pa.array(start), pa.array(start + (end - begin) + n - 1)],
        ["doc_id", "text_hash", "start", "end"],
    )


# anchors, ids, windows, payloads of a block (whole anchors) -> for every window, the smallest id that has it
Deciders = Callable[[np.ndarray, np.ndarray, np.ndarray, list], np.ndarray]


def _decide(batches, first_ids: Deciders, n: int, block_units: int):
    """Blocks of whole anchors from rows that come ordered by anchor."""
    held, units = [], 0

    def flush(parts):
        block = pa.Table.from_batches(parts).combine_chunks()
        anchor, ids, hashes, starts, windows = (block.column(i).to_numpy() for i in range(5))
        windows = windows.astype(np.int64)
        first = first_ids(anchor, ids, windows, block.column(5).to_pylist())
        gone = first < np.repeat(ids, windows)
        if gone.any():
            yield masked_runs(ids, hashes, starts, windows, gone, n)

    for batch in batches:
        settled = batch.filter(batch.column(5).is_null())
        if settled.num_rows:
            end = pc.add(settled.column(3), pc.add(pc.cast(settled.column(4), pa.int64()), n - 1))
            yield pa.RecordBatch.from_arrays([*settled.columns[1:4], end], ["doc_id", "text_hash", "start", "end"])
        batch = batch.filter(batch.column(5).is_valid())
        if not batch.num_rows:
            continue
        anchor = batch.column(0).to_numpy()
        cuts = np.r_[0, np.nonzero(np.diff(anchor))[0] + 1]
        if held and units >= block_units and held[-1].column(0)[-1].as_py() != anchor[0]:
            yield from flush(held)
            held, units = [], 0
        sizes = np.cumsum(batch.column(4).to_numpy().astype(np.int64) + n)
        at, base = 0, 0
        for c in cuts[1:]:
            if units + sizes[c - 1] - base >= block_units:
                yield from flush([*held, batch.slice(at, c - at)])
                held, units, at, base = [], 0, int(c), int(sizes[c - 1])
        held.append(batch.slice(at))
        units += int(sizes[-1]) - base
    if held:
        yield from flush(held)


def repeated_runs(
    docs: DataFrame,
    codes: Callable[[], Codes],
    payloads: Payloads,
    first_ids: Deciders,
    n: int,
    gram: int,
    purpose: str,
    hot_docs: int = HOT_DOCS,
    small_anchors: int = SMALL_ANCHORS,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """``doc_id, text_hash, start, end``: runs of units covered by windows that an earlier document has."""
    rows = keyed(docs)
    counts = shared_table(_anchor_counts(rows, codes, n, gram), purpose)
    usual, hot = (counts.where(c).select("anchor") for c in (F.col("n") <= hot_docs, F.col("n") > hot_docs))
    if is_small(counts, small_anchors):
        arrays = (np.sort(part.toArrow().column(0).to_numpy()) for part in (usual, hot))
        found = _candidates(rows, codes, payloads, n, gram, *arrays)
    else:
        held = _anchors_of(rows, codes, n, gram).join(counts, "anchor")
        sides = [F.when(F.col("n") <= hot_docs, F.col("anchor")), F.when(F.col("n") > hot_docs, F.col("anchor"))]
        by_text = held.groupBy("text_hash").agg(*(F.collect_set(c).alias(name) for c, name in zip(sides, ("usual", "hot"))))
        joined = rows.join(by_text, "text_hash").select("doc_id", "text_hash", "text", "usual", "hot")
        found = _candidates(joined, codes, payloads, n, gram, None, None)
    let_go(docs.sparkSession)  # the counts' shuffle, if the last stage still held it
    placed = found.repartition("anchor").sortWithinPartitions("anchor", "doc_id")
    return shared_table(in_arrow(placed, lambda batches: _decide(batches, first_ids, n, block_units), RUNS), purpose)


def with_spans(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``doc_id, text, spans``: the runs of each document, in order, not yet merged; null if it has none."""
    spans = runs.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    left, right = keyed(docs).alias("l"), spans.alias("r")
    same = F.coalesce("l.doc_id", F.lit(int(NO_ID))) == F.col("r.doc_id")
    joined = left.join(right, same & (F.col("l.text_hash") == F.col("r.text_hash")), "left")
    return joined.select("l.doc_id", "l.text", "r.spans")


def merged(spans) -> list[tuple[int, int]]:
    """Sorted runs as maximal ones."""
    out: list[list[int]] = []
    for s in spans or ():
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [(a, b) for a, b in out]
