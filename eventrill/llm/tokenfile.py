"""Token-id files compressed by a Re-Pair grammar, with random access.

Documents, ordered by id, are encoded and written in blocks. In a block the most frequent
pairs of neighbouring ids are replaced by new symbols (nonterminals), round after round,
``PAIRS_PER_ROUND`` at a time, until no pair is frequent enough to pay for its rule or
``ROUNDS`` are over (on a million ids of the test documents: 1.21 bytes an id after 4 rounds;
1.19 at the end, after 8, in 1.8 times the time; ``rounds=None`` goes on to the end). A
block stores its rules, the number of ids each symbol expands to, the remaining row of
symbols, and an index of its documents; so one document is decoded by expanding only the
symbols that overlap it.

A block is one row of a Parquet table, which any store that Spark reaches can hold: ``shard,
block`` (their order is the order of ids), ``n_docs``, ``n_ids``, ``data``. Layout of
``data``, little-endian: 4 bytes ``RPG1``; five unsigned 32-bit numbers: first nonterminal,
rules, symbols, documents, bytes per symbol (2 or 4); rules (two 32-bit symbols each); their
expansion lengths (32 bits); symbols; ids of documents (64 bits); a byte per document that
says if its id is null; ids per document (64 bits).

Defined results: a null or empty text is the end id alone; rows that repeat an id follow
each other, ordered by a hash of their text; null ids come first; an empty table is a table
without blocks; other columns are not read.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventrill.llm.common import grouped, in_arrow, is_small, shared_table
from eventrill.llm.tokens import encoder
from eventrill.session import shared_dir

END_ID = 2
BLOCK_IDS = 1_000_000
ROUNDS = 4
PAIRS_PER_ROUND = 2_048
SMALL_BLOCKS = 100_000  # 16 bytes each
LEAST_COUNT = 8  # a rule takes 12 bytes and saves 2 at each place: a pair seen less often does not pay

_MAGIC = b"RPG1"
BLOCKS = "shard int, block int, n_docs bigint, n_ids bigint, data binary"


def compress(ids: np.ndarray, rounds: int | None = ROUNDS, pairs: int = PAIRS_PER_ROUND):
    """``(first nonterminal, rules, symbols)`` of a row of ids; without ``rounds``, until no pair repeats often enough.

    Within, the ids that occur are numbered from 0 in their order, and new symbols follow. While
    there are few, a pair is one 32-bit number, which is sorted in half the time.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    known = np.nonzero(np.bincount(ids.astype(np.int64), minlength=base))[0]
    number = np.zeros(base, np.uint32)
    number[known] = np.arange(len(known), dtype=np.uint32)
    row, top = number[ids], len(known)
    rules: list[np.ndarray] = []
    done = 0
    while len(row) > 1 and done != rounds:
        done += 1
        shift, kind = (16, np.uint32) if top <= 1 << 16 else (32, np.uint64)
        codes = (row[:-1].astype(kind) << kind(shift)) | row[1:].astype(kind)
        codes.sort()
        starts = np.nonzero(np.r_[True, codes[1:] != codes[:-1]])[0]
        counts = np.diff(np.r_[starts, len(codes)])
        often = np.nonzero(counts >= LEAST_COUNT)[0]
        if len(often) == 0:
            break
        if len(often) > pairs:
            often = often[np.lexsort((codes[starts[often]], -counts[often]))[:pairs]]
        chosen = np.sort(codes[starts[often]]).astype(np.int64)
        # a table of the chosen pairs by the places of their sides: at most ``pairs`` squared small numbers,
        # and a row and a column for symbols that are no side of any
        a, b = chosen >> shift, chosen & ((1 << shift) - 1)
        lefts, rights = np.unique(a), np.unique(b)
        wide = len(rights) + 1
        left, right = np.full(top, len(lefts) * wide, np.intp), np.full(top, len(rights), np.intp)
        left[lefts], right[rights] = np.arange(len(lefts)) * wide, np.arange(len(rights))
        pair_rule = np.full((len(lefts) + 1) * wide, -1, np.int16 if len(chosen) < 1 << 15 else np.int32)
        pair_rule[left[a] + right[b]] = np.arange(len(chosen))
        places = row.astype(np.intp)
        rule = pair_rule[left[places[:-1]] + right[places[1:]]]
        at = np.flatnonzero(rule >= 0)
        rule = rule[at]
        # of pairs that overlap, every second one, from the left
        begin, turn = np.r_[True, np.diff(at) != 1], np.arange(len(at), dtype=np.int32)
        run = np.maximum.accumulate(np.where(begin, turn, np.int32(0)))
        free = np.flatnonzero(((turn - run) & 1) == 0)
        at, rule = at[free], rule[free]
        row[at] = rule.astype(np.uint32) + np.uint32(top)
        keep = np.ones(len(row), bool)
        keep[at + 1] = False
        row = row[keep]
        rules.append(np.stack([a, b], axis=1))
        top += len(chosen)
    pairs_of = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    symbol = np.concatenate([known, base + np.arange(len(pairs_of))]).astype(np.uint64)
    return base, symbol[pairs_of], symbol[row]


def _lengths(base: int, rules: np.ndarray) -> np.ndarray:
    """How many ids each rule expands to; a rule uses earlier symbols only."""
    out = np.ones(base + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.astype(np.int64).tolist()):
        out[base + k] = out[a] + out[b]
    return out[base:]


def pack_block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, **grammar) -> bytes:
    base, rules, row = compress(ids, **grammar)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    head = np.array([base, len(rules), len(row), len(doc_ids), width], "<u4")
    return b"".join([
        _MAGIC, head.tobytes(), rules.astype("<u4").tobytes(), _lengths(base, rules).astype("<u4").tobytes(),
        row.astype(f"<u{width}").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), counts.astype("<u8").tobytes(),
    ])


class Block:
    """A block read back."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != _MAGIC:
            raise ValueError("not a block of token ids")
        self.base, rules, symbols, docs, width = np.frombuffer(data, "<u4", 5, 4).tolist()
        at = 24

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = take("<u4", rules)
        self.row = take(f"<u{width}", symbols)
        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(ids, null)]
        self.counts = take("<u8", docs).astype(np.int64)

    @functools.cached_property
    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each symbol expands to, one after the other (an id to itself), where each begins, and how long it is."""
        base = self.base
        sizes = np.concatenate([np.ones(base, np.int64), self.lengths.astype(np.int64)])
        begins = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.uint32)
        flat[:base] = np.arange(base, dtype=np.uint32)
        at = begins.tolist()
        size = sizes.tolist()
        for k, (a, b) in enumerate(self.rules.tolist()):  # a rule uses earlier rules only
            start = at[base + k]
            for symbol in (a, b):
                if symbol < base:
                    flat[start] = symbol
                    start += 1
                else:
                    n, source = size[symbol], at[symbol]
                    flat[start : start + n] = flat[source : source + n]
                    start += n
        return flat, begins, sizes

    def _expanded(self, row: np.ndarray) -> np.ndarray:
        flat, begins, sizes = self._expansions
        row = row.astype(np.intp)
        size = sizes[row]
        ends = np.cumsum(size)
        # within a symbol's place, the numbers of its expansion in turn
        source = np.repeat(begins[row] - (ends - size), size)
        source += np.arange(len(source))
        return flat[source]

    def ids(self) -> np.ndarray:
        return self._expanded(self.row)

    def document(self, k: int) -> np.ndarray:
        """Ids of the ``k``-th document, by the symbols that overlap it."""
        start = int(self.counts[:k].sum())
        end = start + int(self.counts[k])
        size = self._expansions[2][self.row]
        upto = np.cumsum(size)
        first, last = np.searchsorted(upto, start, side="right"), np.searchsorted(upto, end, side="left")
        skipped = start - int(upto[first] - size[first])
        return self._expanded(self.row[first : last + 1])[skipped : skipped + end - start]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encodes ``docs`` and writes their ids to ``path``, ordered by ``doc_id``."""

    def work(batches):
        encode, end = encoder(tokenizer, spaced=True).encode_column, np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        shard, block = context.partitionId() if context else 0, 0
        doc_ids, held, n = [], [], 0

        def row():
            counts = np.array([len(h) // 4 for h in held], np.int64)
            data = pack_block(doc_ids, counts, np.frombuffer(b"".join(held), "<u4"))
            columns = [[shard], [block], [len(doc_ids)], [n], [data]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "block", "n_docs", "n_ids", "data"]
            )

        for batch in grouped(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                doc_ids.append(doc_id)
                held.append(ids + end)
                n += len(held[-1]) // 4
                if n >= block_ids:
                    yield row()
                    block, doc_ids, held, n = block + 1, [], [], 0
        if doc_ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    in_arrow(placed, work, BLOCKS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # where a block starts: a row per block, from the small columns alone
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # a row per shard
    whole = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    before = shards.select("shard", F.coalesce(whole, F.lit(0)).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("shard", "block", F.coalesce(within, F.lit(0)).alias("within")).join(before, "shard")
    starts = shared_table(starts.select("shard", "block", (F.col("within") + F.col("before")).alias("start")), "token-ids")

    def work(batches):
        for batch in batches:
            for shard, number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block = Block(data.as_py())
                raw, at, rows = block.ids().astype("<u4").tobytes(), 0, []
                for doc_id, n in zip(block.doc_ids, block.counts.tolist()):
                    rows.append((shard, number, doc_id, at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])))
                    at += n
                kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"]
                )

    # the blocks' bytes stay where they are read; what is joined is a few numbers per document
    found = in_arrow(
        blocks.select("shard", "block", "data"), work,
        "shard int, block int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint",
    )
    placed = found.join(F.broadcast(starts) if is_small(starts, SMALL_BLOCKS) else starts, ["shard", "block"])
    return placed.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    path = shared_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(docs.sparkSession, path)
