"""Hard negatives by inner product, mined from cover trees over norm-augmented vectors.

A component more, ``sqrt(M^2 - |x|^2)`` with the greatest norm ``M``, puts all vectors of a tree
on one sphere without changing an inner product with an anchor (whose added component is 0).
There the angle between an anchor and a vector lies within the angle of its node's centre, less
or more the angle of the node's *covering radius*, the distance of the farthest vector below
it. So every node bounds the inner products below it from both sides.

Vectors are dealt to shards of bounded size, in the order of their label; each shard grows one
tree: centres are taken from a node's vectors, farthest first, until all are covered within
``SHRINK`` times its radius or there are ``FANOUT`` of them, so that they lie farther apart than
their covering radii; each vector joins its nearest centre; small or single-valued nodes are
leaves. A block of anchors goes down a tree together and skips nodes whose bounds lie outside an
anchor's windows; each then takes its leaves best first by their upper bound, until none can
beat what it has, and compares exact integer products there.

Two searches share this. An anchor's positives: the best rows of its label, from the trees that
hold the label. Its negatives: per positive, the best rows of other labels whose score lies in
a window, from all trees that hold another label. The anchors are the stated query set:
they meet the trees in blocks of bounded size, by a join on block or label, and a tree's answer
for a window is at most ``k`` rows.

Scores are exact: they are integers computed in 64 bits, or in floating point where every
partial sum is known to stay below 2^52.

Defined results: rows with a null label, a null vector, or a null or non-finite component take
no part, nor do rows with a component that is not below 2^24 after scaling, whose products
could leave 64 bits; vectors of different lengths count as padded with zeros; an empty
vector scores 0; a null id is no anchor, keeps its label, and comes after all ids in a tie; rows
equal in id, label and components are one row, rows that only share an id are several; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow, is_small, shared_table

SHARD_ROWS = 4_096
BLOCK_ANCHORS = 512
SMALL_BLOCKS = 64  # of anchors: at most so many blocks are broadcast, some MB
SHRINK = 0.5
FANOUT = 8
LEAF = 256
SCALE = 256
GREATEST = float(1 << 24)
NO_ID = np.int64(2**63 - 1)

ROWS = "row bigint, vec_id bigint, label bigint, vec array<bigint>"


def scaled(table: DataFrame, label: Column, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``row, vec_id, label, vec``: rows that take part, with integer components; ``row`` tells rows apart."""
    rows = table.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.transform(F.col(vector), lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("vec"),
        F.transform(F.col(vector), lambda x: F.lit(SCALE) * x.cast("double")).alias("_raw"),
    )
    sound = F.forall("_raw", lambda x: F.coalesce(F.abs(x) < GREATEST, F.lit(False)))  # not so for null and NaN
    rows = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & sound)
    row = F.xxhash64("vec_id", "label", "vec").alias("row")
    return rows.select(row, "vec_id", "label", "vec").dropDuplicates(["row", "vec_id"])


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of whole numbers, padded with zeros to the longest."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[owner, place] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows and columns; as floats they must stay below 2^52."""
    return (vectors @ queries).astype(np.int64)


class CoverTree:
    """A cover tree over the vectors of a shard, on the sphere that the added component puts them on."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.rows, self.ids, self.labels = rows, ids, labels
        self.vectors = vectors
        as_float = vectors.astype(np.float64)
        square = (as_float**2).sum(axis=1)
        self.norm = float(np.sqrt(square.max(initial=0)))
        self._sphere = np.c_[as_float, np.sqrt(np.maximum(square.max(initial=0) - square, 0))]
        # per node: centre, angle of the covering radius, children (or, of a leaf, its vectors)
        self.centre: list[int] = []
        self.angle: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray | None] = []
        every = np.arange(len(ids))
        self._grow(every, self._distances(0, every))
        self.centre_at, self.angle_at = np.array(self.centre), np.array(self.angle)
        del self._sphere

    def _distances(self, centre: int, some: np.ndarray) -> np.ndarray:
        cosine_part = self._sphere[some] @ self._sphere[centre]
        return np.sqrt(np.maximum(2 * (self.norm**2 - cosine_part), 0))

    def _new(self, centre: int, radius: float, members: np.ndarray) -> int:
        self.centre.append(centre)
        # half the chord over the sphere's radius; a trifle more for what floating point loses
        half = radius / (2 * self.norm) if self.norm else 0.0
        self.angle.append(2 * float(np.arcsin(min(1.0, half))) + 1e-6)
        self.children.append(None)
        self.members.append(members)
        return len(self.centre) - 1

    def _grow(self, members: np.ndarray, far: np.ndarray) -> None:
        root = self._new(int(members[0]), float(far.max()), members)
        open_nodes = [(root, members, far)]
        while open_nodes:
            node, members, far = open_nodes.pop()
            radius = float(far.max())
            if len(members) <= LEAF or radius <= 1e-6 * self.norm:
                continue  # a leaf
            # centres: the node's own, then always the farthest vector, until all are covered
            nearest, owner, centres = far.copy(), np.zeros(len(members), np.int64), [self.centre[node]]
            while nearest.max() > SHRINK * radius and len(centres) < FANOUT:
                centre = int(members[np.argmax(nearest)])
                there = self._distances(centre, members)
                closer = there < nearest
                nearest[closer], owner[closer] = there[closer], len(centres)
                centres.append(centre)
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(centres) + 1))
            children = []
            for k, centre in enumerate(centres):
                mine = order[cuts[k] : cuts[k + 1]]
                child = self._new(centre, float(nearest[mine].max()), members[mine])
                children.append(child)
                open_nodes.append((child, members[mine], nearest[mine]))
            self.children[node], self.members[node] = np.array(children), None

    def prepare(self) -> None:
        """Vectors as floats where that keeps all products with the anchors exact."""
        self._float = self.vectors.astype(np.float64)

    def _bounds(self, nodes: np.ndarray, asked: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest and least product below each node (rows) with each query (columns)."""
        products_here = self._float[self.centre_at[nodes]] @ asked.T
        safe = np.where(reach > 0, reach, 1.0)
        middle = np.arccos(np.clip(products_here / safe, -1, 1))
        angle, slack = self.angle_at[nodes][:, None], 1e-9 * reach + 1
        upper = reach * np.cos(np.maximum(middle - angle, 0)) + slack
        return upper, reach * np.cos(np.minimum(middle + angle, np.pi)) - slack

    def search(
        self, queries: np.ndarray, labels: np.ndarray, same: bool, own: np.ndarray | None, low: np.ndarray, high: np.ndarray, k: int
    ) -> tuple[np.ndarray, ...]:
        """For a block of queries, and their windows ``low`` to ``high`` (a column each), the best ``k`` rows.

        Gives ``query, window, score, id, row`` of rows of the query's label, or of others; the row
        ``own`` of a query never. The queries go down the tree together, each where its windows
        may be met. Then each takes its leaves best first, in rounds of growing numbers; what its
        windows have found raises the score that a later leaf must be able to reach.
        """
        width, n = self.vectors.shape[1], len(queries)
        asked = np.zeros((n, width), np.int64)
        both = min(width, queries.shape[1])
        asked[:, :both] = queries[:, :both]
        as_float = asked.astype(np.float64)
        reach = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)) * self.norm
        exact = bool((reach < 2.0**52).all())
        vectors, factors = (self._float, as_float) if exact else (self.vectors, asked)
        low = low.copy()
        none = np.zeros(0, np.int64)
        best = (none, none, none, none, none)
        if not same and not (self.labels[:, None] != np.unique(labels)).any():
            return best  # one label, that of all queries

        def wanted(upper, lower, who):
            return ((upper[..., None] >= low[who]) & (lower[..., None] <= high[who])).any(axis=-1)

        everyone = np.arange(n)
        upper, lower = self._bounds(np.array([0]), as_float, reach)
        waiting = [(0, everyone, upper[0], lower[0])]
        leaves: list[tuple[np.ndarray, ...]] = []
        while waiting:
            node, who, upper, lower = waiting.pop()
            children = self.children[node]
            if children is None:
                leaves.append((np.full(len(who), node), who, upper, lower))
                continue
            upper, lower = self._bounds(children, as_float[who], reach[who])
            meets = wanted(upper, lower, who)
            for c, child in enumerate(children.tolist()):
                some = meets[c]
                if some.any():
                    waiting.append((child, who[some], upper[c][some], lower[c][some]))
        if not leaves:
            return best
        leaf, who, upper, lower = (np.concatenate(column) for column in zip(*leaves))
        order = np.lexsort((-upper, who))
        leaf, who, upper, lower = leaf[order], who[order], upper[order], lower[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        done, take = 0, 1
        while len(who):
            now = np.nonzero(place < done + take)[0]
            now = now[np.argsort(leaf[now], kind="stable")]
            cuts = np.nonzero(np.diff(leaf[now]))[0] + 1
            found = [best]
            for part in np.split(now, cuts):
                members, asking = self.members[leaf[part[0]]], who[part]
                scores = products(vectors[members], factors[asking].T)
                fits = (self.labels[members][:, None] == labels[asking]) == same
                if own is not None:
                    fits &= self.rows[members][:, None] != own[asking]
                for w in range(low.shape[1]):
                    i, j = np.nonzero(fits & (scores >= low[asking, w]) & (scores <= high[asking, w]))
                    m = members[i]
                    found.append((asking[j], np.full(len(i), w), scores[i, j], self.ids[m], self.rows[m]))
            best = self._first(tuple(np.concatenate(column) for column in zip(*found)), k)
            query, window, score = best[:3]
            last = np.nonzero(np.r_[(np.diff(query) != 0) | (np.diff(window) != 0), True])[0] if len(query) else none
            full = last[np.diff(np.r_[-1, last]) == k]
            # a row of the same score may still win by its id
            low[query[full], window[full]] = np.maximum(low[query[full], window[full]], score[full])
            done, take = done + take, 2 * take
            left = (place >= done) & wanted(upper, lower, who)
            leaf, who, upper, lower, place = leaf[left], who[left], upper[left], lower[left], place[left]
        return best

    @staticmethod
    def _first(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
        """The first ``k`` per query and window, by score, then id, in that order."""
        query, window, score, ids, rows = found
        order = np.lexsort((rows, ids, -score, window, query))
        query, window = query[order], window[order]
        begin = np.r_[True, (np.diff(query) != 0) | (np.diff(window) != 0)] if len(order) else np.zeros(0, bool)
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))
        return tuple(column[order[rank < k]] for column in found)


TREES = "shard bigint, labels array<bigint>, tree binary"


def grown_trees(rows: DataFrame, shard_rows: int | None = None) -> DataFrame:
    """One row per shard: its labels and its tree. ``rows`` must be a written table."""
    shard_rows = shard_rows or SHARD_ROWS
    shards = max(1, -(-rows.count() // shard_rows))

    def work(batches):
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 32
        held, n, shard = [], 0, 0

        def row():
            block = pa.Table.from_batches(held).combine_chunks()
            ids = block.column(1).fill_null(int(NO_ID)).to_numpy()
            labels = block.column(2).to_numpy()
            tree = CoverTree(block.column(0).to_numpy(), ids, labels, _matrix(block.column(3).chunk(0)))
            return pa.RecordBatch.from_arrays(
                [pa.array([first + shard]), pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
                 pa.array([pickle.dumps(tree, protocol=5)], pa.binary())],
                ["shard", "labels", "tree"],
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(shard_rows - n, batch.num_rows - at)
                held.append(batch.slice(at, take))
                at, n = at + take, n + take
                if n == shard_rows:
                    yield row()
                    held, n, shard = [], 0, shard + 1
        if n:
            yield row()

    dealt = rows.repartitionByRange(shards, "label", "row").sortWithinPartitions("label", "row")
    return shared_table(in_arrow(dealt.select("row", "vec_id", "label", "vec"), work, TREES), "trees")


def _blocks(queries: DataFrame, by: list[str], parts: Column) -> DataFrame:
    """``queries`` dealt into ``parts`` rows (per ``by``), as lists of structs, numbered from 0."""
    entry = F.struct(*[c for c in queries.columns if c != "parts"])
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("row"), parts))
    return shared_table(numbered.groupBy(*by, "block").agg(F.collect_list(entry).alias("queries")), "anchors")


def _broadcast_few(blocks: DataFrame) -> DataFrame:
    return F.broadcast(blocks) if is_small(blocks, SMALL_BLOCKS) else blocks


FOUND = "row bigint, window int, score bigint, vec_id bigint, found bigint"


def _searched(pairs: DataFrame, same: bool, k: int) -> DataFrame:
    """Answers of each tree to each block of queries; ``pairs`` has ``shard, tree, queries``."""

    def work(batches):
        known, tree = None, None
        for batch in batches:
            for shard, data, queries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if shard != known:
                    known, tree = shard, pickle.loads(data.as_py())
                    tree.prepare()
                rows = np.array([q["row"] for q in queries], np.int64)
                labels = np.array([q["label"] for q in queries], np.int64)
                asked = _matrix(pa.array([q["vec"] for q in queries], pa.list_(pa.int64())))
                low = np.ones((len(queries), max(len(q["windows"]) for q in queries)), np.int64)
                high = np.zeros_like(low)  # a query with fewer windows: nothing lies in the others
                for i, q in enumerate(queries):
                    for w, window in enumerate(q["windows"]):
                        low[i, w], high[i, w] = window["low"], window["high"]
                query, window, *answer = tree.search(asked, labels, same, rows if same else None, low, high, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[query]), pa.array(window.astype(np.int32)), *map(pa.array, answer)],
                    ["row", "window", "score", "vec_id", "found"],
                )

    return in_arrow(pairs.select("shard", "tree", "queries"), work, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` answers per query and window; each tree sent at most ``k``."""
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id", "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


EVERYTHING = (-(2**62), 2**62)


def mined(rows: DataFrame, anchor: Column, k_positive: int = 5, k_negative: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` as by ``scaled``; ``anchor`` says which are anchors. A negative's score, times 100, lies
    between ``low`` and ``high`` times the positive's.
    """
    rows = shared_table(rows, "vectors")
    trees = grown_trees(rows)
    anchors = rows.where(F.coalesce(anchor, F.lit(False)))
    whole = F.array(F.struct(F.lit(EVERYTHING[0]).alias("low"), F.lit(EVERYTHING[1]).alias("high"))).alias("windows")

    sizes = anchors.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ANCHORS).alias("parts"))
    asked = anchors.select("row", "label", "vec", whole).join(sizes, "label")
    blocks = _broadcast_few(_blocks(asked, ["label"], F.col("parts")))
    pairs = trees.withColumn("label", F.explode("labels")).join(blocks, "label")
    positives = _best(shared_table(_searched(pairs.repartition("shard", "block"), True, k_positive), "positives"), k_positive)
    positives = shared_table(
        positives.select(
            "row", (F.col("rank") - 1).cast("int").alias("window"), F.col("score").alias("positive_score"),
            F.col("vec_id").alias("positive_id"),
        ),
        "positives",
    )

    # whole numbers n with low * p <= 100 n <= high * p
    p = F.col("positive_score")
    span = F.struct("window", (-_hundredths(-low * p)).alias("low"), _hundredths(high * p).alias("high"))
    spans = positives.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("windows"))  # at most k_positive each
    asked = shared_table(anchors.select("row", "label", "vec").join(spans, "row"), "anchors")
    parts = max(1, -(-asked.count() // BLOCK_ANCHORS))
    blocks = _broadcast_few(_blocks(asked, [], F.lit(parts)))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    pairs = trees.withColumn("block", F.explode(every)).join(blocks, "block").repartition("shard", "block")
    negatives = _best(shared_table(_searched(pairs, False, k_negative), "negatives"), k_negative)
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    out = negatives.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id")
    out = out.join(positives, ["row", "window"]).join(named, "row")
    no_id = F.lit(int(NO_ID))
    return out.select(
        "anchor_id", F.nullif("positive_id", no_id).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.nullif("negative_id", no_id).alias("negative_id"), "positive_score", "negative_score",
    )


def _hundredths(a: Column) -> Column:
    """A hundredth of a whole number, rounded down."""
    return F.floor((a - F.pmod(a, F.lit(100))).cast("decimal(38,0)") / F.lit(100)).cast("bigint")
