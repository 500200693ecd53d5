"""Near-duplicates by SimHash: fingerprints partitioned by vantage-point trees.

A fingerprint has one bit per bit of a 64-bit hash: set if more than half of the hashes of
the document's word shingles have it. Fingerprints with at most ``max_bits`` differing bits
are linked; a component is what links reach.

The search works on distinct fingerprints. A vantage-point tree splits them by their
Hamming distance from a fingerprint drawn from a bounded sample: ``d <= r`` goes inside, the
rest outside. By the triangle inequality a partner of an inside point can lie outside only
if ``d > r - max_bits``, so just those boundary points are copied to the outer shard, and
every linked pair meets in at least one leaf. The tree's top is made in rounds of Spark
jobs: shards that are still too large for a task get a tree of their own from a new sample.
Inside a leaf of a task the same split goes on in numpy, down to a few hundred points that
are compared exactly. A leaf returns a spanning forest of its links, never all pairs.

Defined results: a text without words, or null, has fingerprint 0, linked like any other;
repeated ids give one row each with their fingerprint's component; a null id is ignored
for the smallest id unless all ids of a component are null; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import components, in_arrow, shared_table

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SHARD_POINTS = 100_000  # points that one task searches
FAN_LEVELS = 6  # a large shard is split by a tree of so many levels at a time
SAMPLE_PER_SHARD = 1_024
LEAF_POINTS = 256

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HASH_CHUNK = 1 << 16
_COLUMNS = 8_192


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64 bits of one text, as an unsigned integer."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _HASH_CHUNK):
        part = found[at : at + _HASH_CHUNK + words - 1]
        if len(part) <= words:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(*(part[i:] for i in range(words))))
        hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, bits`` (the fingerprint as a signed 64-bit integer)."""

    def work(batches):
        for batch in batches:
            bits = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(bits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "bits"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return in_arrow(rows, work, "doc_id bigint, text_hash bigint, bits bigint")


def _distance(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def plan_tree(sample: np.ndarray, levels: int, max_bits: int, rng: np.random.Generator):
    """A tree of ``levels`` levels over a sample: ``(vantage, radius, inner, outer)`` or None for a leaf."""
    if levels == 0 or len(sample) < 8:
        return None
    vantage = sample[rng.integers(len(sample))]
    d = _distance(sample, vantage)
    radius = int(np.median(d))
    inside, outside = d <= radius, d > radius - max_bits
    if inside.all() or outside.all():
        return None
    return (
        vantage, radius,
        plan_tree(sample[inside], levels - 1, max_bits, rng), plan_tree(sample[outside], levels - 1, max_bits, rng),
    )


def route(points: np.ndarray, rows: np.ndarray, tree, max_bits: int, path: int = 1):
    """Yields ``(leaf, rows)``: each row in every leaf in which it may meet a partner."""
    if tree is None or not len(rows):
        if len(rows):
            yield path, rows
        return
    vantage, radius, inner, outer = tree
    d = _distance(points[rows], vantage)
    yield from route(points, rows[d <= radius], inner, max_bits, 2 * path)
    yield from route(points, rows[d > radius - max_bits], outer, max_bits, 2 * path + 1)


def leaf_links(points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within one shard, as a spanning forest: every linked point with its root."""
    parent = np.arange(len(points))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rng = np.random.default_rng(len(points))
    todo = [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) > LEAF_POINTS:
            vantage = points[rows[rng.integers(len(rows))]]
            d = _distance(points[rows], vantage)
            radius = int(np.median(d))
            inside, outside = rows[d <= radius], rows[d > radius - max_bits]
            if len(inside) + len(outside) < 1.8 * len(rows) and max(len(inside), len(outside)) < len(rows):
                todo += [inside, outside]
                continue
        for at in range(0, len(rows), LEAF_POINTS):  # points too close to each other to be split further
            block = rows[at : at + LEAF_POINTS]
            for far in range(at, len(rows), _COLUMNS):
                others = rows[far : far + _COLUMNS]
                near = np.bitwise_count(points[block][:, None] ^ points[others][None, :]) <= max_bits
                for i, j in zip(*np.nonzero(near)):
                    a, b = root(block[i]), root(others[j])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(points))], np.int64)
    linked = np.nonzero(roots != np.arange(len(points)))[0]
    return points[linked], points[roots[linked]]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _split_shards(points: DataFrame, trees: dict, max_bits: int) -> DataFrame:
    """Rows ``shard, bits`` dealt to the leaves of their shard's tree."""

    def work(batches):
        for batch in batches:
            shards, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard in np.unique(shards):
                for leaf, rows in route(bits, np.nonzero(shards == shard)[0], trees[int(shard)][1], max_bits):
                    out = np.full(len(rows), trees[int(shard)][0] + leaf, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(out), _signed(bits[rows])], ["shard", "bits"])

    return in_arrow(points, work, "shard bigint, bits bigint")


def _search(batches, max_bits: int):
    """Links of the shards of one partition; its rows come ordered by shard."""

    def links(parts):
        a, b = leaf_links(np.concatenate(parts), max_bits)
        return pa.RecordBatch.from_arrays([_signed(a), _signed(b)], ["a", "b"])

    open_shard, parts = None, []
    for batch in batches:
        shards, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.nonzero(np.diff(shards))[0] + 1
        for piece, shard in zip(np.split(bits, cuts), shards[np.r_[0, cuts]] if len(shards) else []):
            if shard != open_shard and parts:
                yield links(parts)
                parts = []
            open_shard = shard
            parts.append(piece.copy())
    if parts:
        yield links(parts)


def near_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS, levels: int = FAN_LEVELS
) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints ``bits`` within ``max_bits`` of each other.

    Rounds end when no shard has more than ``shard_points`` points or when a large shard
    could not be split (its points lie within a few bits of each other, and there are at
    most a few thousand such).
    """
    points = shared_table(distinct.select(F.lit(0).cast("bigint").alias("shard"), "bits"), "simhash")
    done, base, rng = [], 1, np.random.default_rng(SEED)
    while True:
        sizes = points.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_points)
        large = {r["shard"]: r["n"] for r in sizes.collect()}  # a row per shard of many thousand points
        if not large:
            break
        # about SAMPLE_PER_SHARD points of each, by their hash
        in_sample = F.pmod(F.xxhash64("bits"), F.col("n")) < SAMPLE_PER_SHARD
        picked = points.join(F.broadcast(sizes), "shard").where(in_sample).select("shard", "bits").collect()
        samples = {shard: [] for shard in large}
        for r in sorted(picked):
            samples[r["shard"]].append(r["bits"])
        trees = {}
        for shard in sorted(large):
            tree = plan_tree(np.array(samples[shard], np.int64).view(np.uint64), levels, max_bits, rng)
            if tree is not None:
                trees[shard] = (base, tree)
                base += 2 ** (levels + 1)
        if not trees:
            break
        whole = points.where(~F.col("shard").isin(list(trees)))
        done.append(whole)
        split = _split_shards(points.where(F.col("shard").isin(list(trees))), trees, max_bits)
        points = shared_table(split, "simhash")
    for part in done:
        points = points.unionByName(part)
    placed = points.repartition("shard").sortWithinPartitions("shard")
    return in_arrow(placed, lambda batches: _search(batches, max_bits), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **search) -> DataFrame:
    """Per row ``doc_id, text_hash, bits, component_id, first``.

    ``component_id`` is the smallest id that links reach; ``first`` says whether the row is the one
    of its component with the smallest id, then the smallest hash of its text.
    """
    marked = shared_table(fingerprints(docs, words), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    firsts = shared_table(marked.groupBy("bits").agg(F.min(order).alias("first")), "simhash")
    links = near_links(firsts.select("bits"), max_bits, **search)
    joined = shared_table(components(links, "simhash"), "simhash")  # one row per linked fingerprint
    classes = firsts.join(joined, F.col("bits") == F.col("node"), "left")
    classes = classes.select("bits", F.coalesce("component", "bits").alias("component"), "first")
    least = classes.groupBy("component").agg(F.min("first").alias("least"))
    by_bits = classes.join(least, "component").select("bits", "least")
    row = marked.join(by_bits, "bits")
    is_first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return row.select("doc_id", "text_hash", "bits", F.col("least.doc_id").alias("component_id"), is_first.alias("first"))
