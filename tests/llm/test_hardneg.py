"""Hard negatives beside a search over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventrill.llm import catalog, hardneg

VECTORS = "vec_id bigint, embedding array<float>, label int, row string, score int, vec int"


def mined_by_hand(rows, anchor, k=5):
    """``rows``: (vec_id, vector, label)."""
    sound = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) or abs(256 * x) >= 2**24 for x in v):
            continue
        sound.append((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label))
    sound = list(dict.fromkeys(sound))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a in sound:
        if not anchor(a[0]):
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in sound if b is not a]
        for ps, pid, _ in sorted((s for s in scored if s[2] == a[2]), key=key)[:k]:
            within = [s for s in scored if s[2] != a[2] and 80 * ps <= 100 * s[0] <= 100 * ps]
            out += [(a[0], pid, n, nid, ps, ns) for n, (ns, nid, _) in enumerate(sorted(within, key=key)[:k], 1)]
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], VECTORS).repartition(3)


def mined(spark, rows, step=10):
    found = hardneg.mined(hardneg.scaled(table(spark, rows), F.col("label")), F.col("vec_id") % step == 0)
    return sorted((tuple(r) for r in found.collect()), key=str)


def clustered(seed, n, labels=4, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims)).astype(np.float32)
    for i in range(n):
        label = int(rng.integers(labels))
        yield i, (centres[(label + int(rng.integers(2))) % labels] + 0.4 * rng.normal(size=dims)).astype(np.float32).tolist(), label


ODD_ROWS = [
    (1000, None, 1), (1010, [1.0, None], 1), (1020, [float("nan"), 1.0], 2), (1030, [float("inf")], 2), (1040, [1.0, 2.0], None),
    (1050, [], 0), (1060, [0.0] * 6, 0), (1070, [0.5, 0.25], 1), (1080, [1e30, 1.0], 1), (None, [0.5, 0.5, 0.5], 1),
    (None, [0.5, 0.5, 0.5], 2), (1090, [100.0] * 6, 3), (1100, [-1.0] * 6, 3),
]


@pytest.mark.parametrize("shard_rows,leaf,block", [(4_096, 48, 512), (37, 3, 4)])
def test_against_all_rows(spark, monkeypatch, shard_rows, leaf, block):
    monkeypatch.setattr(hardneg, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(hardneg, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(hardneg, "LEAF", leaf)
    rows = list(clustered(1, 400))
    rows += [(500 + i, rows[20][1], i % 3) for i in range(60)]  # one common vector, so ties
    rows += ODD_ROWS + rows[:30]
    rows += [(10, [0.1] * 6, 2)]  # an id again, with other content
    found = mined(spark, rows)
    assert found == mined_by_hand(rows, lambda i: i is not None and i % 10 == 0) and len(found) > 300


def test_trees_bound_and_skip():
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * np.concatenate([rng.normal(c, 0.05, (300, 3)) for c in (-2, 0, 2)])).astype(np.int64)
    rows, labels = np.arange(900), np.repeat([0, 1, 2], 300)
    tree = hardneg.CoverTree(rows, rows + 5, labels, vectors)
    tree.prepare()
    seen = 0
    for node, (members, children) in enumerate(zip(tree.members, tree.children)):
        assert (members is None) != (children is None)
        if members is not None:
            seen += len(members)
            away = np.sqrt(((vectors[members] - vectors[tree.centre[node]]) ** 2).sum(axis=1)).max()
            assert away <= 2 * tree.norm * math.sin(tree.angle[node] / 2) + 1e-3
    assert seen == 900
    looked = []
    products = hardneg.products
    hardneg.products = lambda v, q: looked.append(len(v) * q.shape[1]) or products(v, q)
    asked = np.array([650, 610])
    low, high = (np.full((2, 1), x) for x in hardneg.EVERYTHING)
    try:
        found = tree.search(vectors[asked], labels[asked], True, asked, low, high, 5)
    finally:
        hardneg.products = products
    best = list(zip(*(c.tolist() for c in found)))
    mine = []
    for n, i in enumerate(asked.tolist()):
        scores = vectors @ vectors[i]
        first = sorted((-int(scores[j]), j + 5, j) for j in range(600, 900) if j != i)[:5]
        mine += [(n, 0, -s, a, j) for s, a, j in first]
    assert best == mine and sum(looked) < 2 * 600  # the two other clusters are skipped


def test_large_components_stay_exact(spark):
    rng = random.Random(7)
    rows = [(i, [float(rng.randrange(-60_000, 60_000)) for _ in range(40)], i % 3) for i in range(60)]
    assert mined(spark, rows) == mined_by_hand(rows, lambda i: i % 10 == 0)


def test_empty_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(3, [1.0], 1)]) == [] and mined(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []


def test_query_relabels_every_seventh(spark, tmp_path):
    rows = list(clustered(9, 700, labels=10, dims=8))
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted((tuple(r) for r in catalog.op13_hard_negatives(spark, str(tmp_path)).collect()), key=str)
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert got == mined_by_hand(moved, lambda i: i % 100 == 0)
