"""Exact, SimHash, byte-run and word-run deduplication beside brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventrill.llm import exact, simhash, substring, suffix
from eventrill.llm.common import components
from eventrill.llm.passages import gram_hashes, masked_runs, sliding_minimum
from tests.llm.conftest import DOCS, ODD

SPACE = re.compile(r"[\x20\x09-\x0D]")


def passages(seed, n_docs, words="a b c d e f g h i j".split(), shared=6, length=80):
    """Documents made of passages that several of them share, of parts of passages, and of own words."""
    rng = random.Random(seed)
    pool = [[rng.choice(words) + str(rng.randrange(30)) for _ in range(length)] for _ in range(shared)]
    out = []
    for i in range(n_docs):
        text = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(pool)
            a = rng.randrange(0, length // 2)
            text += rng.choice([p, p[a:], p[: length - a], [rng.choice(words) for _ in range(40)]])
        out.append((i * 3 % n_docs, " ".join(text)))
    return out


def exact_by_hand(rows):
    """One row per input row; of rows equal in id and normalised text as many are kept as the group has to give: one."""
    groups = {}
    for doc_id, text in rows:
        key = SPACE.sub("", text or "")
        groups.setdefault(key, []).append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for key, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(key.encode()).hexdigest()
        rest = list(members)
        rest.remove(best)
        out += [(best[2], best[2], len(members), True, digest)]
        out += [(m[2], best[2], len(members), False, digest) for m in rest]
    return sorted(out, key=str)


COLUMNS = ["doc_id", "keep_id", "group_size", "kept"]
REPEATS = [
    (None, "same  text"), (4, "sametext"), (None, "other"), (None, "third"), (6, "x y"), (6, "x y"), (6, "x y"), (6, "else"),
    (7, "a b"), (7, " ab"), (8, "ab"), (None, None), (None, ""), (9, "x" * 100_000), (9, "x" * 100_000 + " "),
]


@pytest.mark.parametrize("limits", [{}, {"small_keys": 0}, {"prefix_chars": 3}])
@pytest.mark.parametrize("rows", [ODD, REPEATS])
def test_exact(make_docs, rows, limits, monkeypatch):
    if limits.get("small_keys") == 0:
        monkeypatch.setattr(exact, "SMALL_GROUPS", 0)
    found = exact.exact_dedup(make_docs(rows), digests=True, **limits).select(*COLUMNS, "text_sha256")
    assert sorted((tuple(r) for r in found.collect()), key=str) == exact_by_hand(rows)
    plain = exact.exact_dedup(make_docs(rows), **limits).select(*COLUMNS)
    assert sorted((tuple(r) for r in plain.collect()), key=str) == sorted((r[:4] for r in exact_by_hand(rows)), key=str)


def test_exact_of_an_empty_table(make_docs):
    assert exact.exact_dedup(make_docs([])).count() == 0
    assert exact.keep_one(make_docs([]), exact.exact_dedup(make_docs([]))).count() == 0


@pytest.mark.parametrize("small_keys", [100, 0])
def test_no_text_is_lost(make_docs, small_keys):
    docs = make_docs(REPEATS)
    kept = exact.keep_one(docs, exact.exact_dedup(docs), small_keys)
    assert kept.columns == docs.columns
    bodies = [SPACE.sub("", r["text"] or "") for r in kept.collect()]
    assert sorted(bodies) == sorted({SPACE.sub("", t or "") for _, t in REPEATS})
    again = exact.keep_one(docs, exact.exact_dedup(docs), small_keys)
    assert sorted(map(str, kept.collect())) == sorted(map(str, again.collect()))


def test_a_copy_that_shares_the_id_of_a_unique_text(make_docs):
    docs = make_docs([(1, "copy"), (6, "copy"), (6, "unique"), (None, "u1"), (None, "u2"), (0, "copy")])
    kept = exact.keep_one(docs, exact.exact_dedup(docs)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("0", "copy"), ("6", "unique"), ("None", "u1"), ("None", "u2")]


def test_near_duplicates_leave_one_row_of_each_group(make_docs):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(None, base), (None, base + " "), (None, "alone one two"), (3, "not at all like it"), (3, base), (5, base), (5, base), (9, None), (8, "")]
    docs = make_docs(rows)
    found = simhash.near_duplicates(docs)
    assert found.count() == len(rows)
    kept = exact.keep_one(docs, found.select("doc_id", "text_hash", F.col("first").alias("kept"))).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted(
        [("3", base), ("3", "not at all like it"), ("None", "alone one two"), ("8", "")]
    )
    assert simhash.near_duplicates(make_docs([])).count() == 0


def fingerprint_by_hand(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def components_by_hand(points, max_bits):
    points = np.array(points, np.uint64)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= max_bits
    label = np.arange(len(points))
    while True:
        new = np.where(near, label[None, :], len(points)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_simhash_documents(odd_docs):
    ids = [d for d, _ in ODD]
    prints = [fingerprint_by_hand(t) for _, t in ODD]
    label = components_by_hand(prints, 2)
    smallest = {c: min(d for d, x in zip(ids, label) if x == c) for c in set(label)}
    want = {(d, p, smallest[c]) for d, p, c in zip(ids, prints, label)}
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == len(ODD)
    assert {(r["doc_id"], r["bits"] % 2**64, r["component_id"]) for r in rows} == want


@pytest.mark.parametrize("shard_points", [10**6, 300])
def test_simhash_search_loses_no_link(spark, shard_points):
    rng = random.Random(4)
    points = {rng.getrandbits(64) for _ in range(1_500)}
    for p in list(points)[:150]:  # chains of near points, and a dense ball
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(64)
            p ^= rng.choice([0, 1 << rng.randrange(64)])
            points.add(p)
    centre = rng.getrandbits(64)
    points |= {centre ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(i)}
    points = sorted(points)
    label = components_by_hand(points, 2)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "bits bigint")
    links = simhash.near_links(df, 2, shard_points=shard_points, levels=3).collect()
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in links:
        a, b = root(r["a"] % 2**64), root(r["b"] % 2**64)
        parent[max(a, b)] = min(a, b)
    assert [root(p) for p in points] == [points[c] for c in label]


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    links += [(500, 500), (900, 200), (200, 900)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent if x != 500}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def removed_by_hand(rows, units, n):
    """Units of each row that a window also found in a document with a smaller id covers."""
    first = {}
    cut = [(d, units(t)) for d, t in rows]
    order = lambda d: float("inf") if d is None else d
    for d, u in cut:
        for i in range(len(u) - n + 1):
            w = tuple(u[i : i + n])
            first[w] = min(first.get(w, float("inf")), order(d))
    out = []
    for d, u in cut:
        gone = set()
        for i in range(len(u) - n + 1):
            if first[tuple(u[i : i + n])] < order(d):
                gone.update(range(i, i + n))
        out.append((d, u, gone))
    return out


def test_texts_are_taken_in_parts(monkeypatch):
    import pyarrow as pa

    from eventrill.llm import passages as module

    monkeypatch.setattr(module, "TEXT_BYTES", 10)
    texts = ["a" * 4, "b" * 4, "", None, "c" * 50, "d" * 10, "é" * 3, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(range(8)), pa.array(texts)], ["doc_id", "text_hash", "text"])
    parts = [p.column(2).to_pylist() for p in module._in_parts([batch])]
    assert parts == [["a" * 4, "b" * 4, "", None], ["c" * 50], ["d" * 10], ["é" * 3, "e"]]


CASES = {
    "usual": {}, "hot": {"hot_docs": 3}, "joined": {"small_anchors": 0}, "small blocks": {"block_units": 50},
}


@pytest.mark.parametrize("case", CASES)
def test_bytes(make_docs, case):
    rows = passages(1, 40) + [(None, passages(1, 1)[0][1]), (100, None), (101, "")] + [(3, passages(1, 40)[5][1])]
    got = suffix.deduplicated(make_docs(rows), **CASES[case]).collect()
    want = []
    for d, u, gone in removed_by_hand(rows, lambda t: (t or "").encode(), 50):
        kept = bytes(x for i, x in enumerate(u) if i not in gone)
        spans = sum(1 for i in gone if i - 1 not in gone)
        want.append((d, len(u), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("case", CASES)
def test_words(make_docs, case):
    rows = passages(2, 40) + [(None, passages(2, 1)[0][1]), (100, None), (101, " ")] + [(3, passages(2, 40)[5][1])]
    got = substring.deduplicated(make_docs(rows), **CASES[case]).collect()
    want = []
    for d, u, gone in removed_by_hand(rows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""), 50):
        kept = " ".join(x for i, x in enumerate(u) if i not in gone)
        want.append((d, len(u), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("module", [suffix, substring])
def test_runs_of_odd_documents(module, odd_docs, make_docs, spark):
    rows = module.deduplicated(odd_docs).collect()
    assert len(rows) == len(ODD)
    gone = {r["doc_id"]: r["n_removed"] for r in rows}
    assert gone[8] == 0 and gone[10] > 0 and gone[9] > 0 and gone[5] == gone[3] == 0
    assert module.deduplicated(spark.createDataFrame([], DOCS)).count() == 0


def test_run_index_against_every_window():
    rng = random.Random(1)
    for n in (9, 12, 16, 20, 50):
        base = bytes(rng.choice(b"ab") for _ in range(200))
        texts, ids = [], []
        for _ in range(25):
            a = rng.randrange(0, 200 - n)
            s = bytearray(base[a : a + rng.randrange(n, n + 40)])
            s[rng.randrange(len(s))] = rng.choice(b"abc")
            if len(s) >= n:
                texts.append(bytes(s))
                ids.append(rng.randrange(20))
        windows = np.array([len(t) - n + 1 for t in texts])
        first = {}
        for t, d in zip(texts, ids):
            for i in range(len(t) - n + 1):
                first[t[i : i + n]] = min(first.get(t[i : i + n], 99), d)
        want = [first[t[i : i + n]] for t in texts for i in range(len(t) - n + 1)]
        one = np.zeros(len(texts), np.int64)  # all of one anchor
        assert suffix._first_ids(one, np.array(ids), windows, texts, n).tolist() == want
        # a second anchor's segments are all alike: its smallest document, without an index
        more, far = [texts[0]] * 3, [7, 5, 9]
        both = suffix._first_ids(
            np.r_[one, 1, 1, 1], np.r_[ids, far], np.r_[windows, [windows[0]] * 3], texts + more, n
        )
        assert both.tolist() == want + [5] * (3 * int(windows[0]))


def test_repetitive_text_has_few_runs():
    text = (b"the same passage again and again, " * 40)[:1_200] + b"\xff"
    index = suffix.RunIndex(np.frombuffer(text, np.uint8), np.zeros(len(text), np.int64), 50)
    assert index.runs < 100


def test_hashes_and_minima():
    codes = np.array([random.Random(i).getrandbits(64) for i in range(90)], np.uint64)
    base = 0x9E3779B97F4A7C15
    for n in (1, 2, 3, 16, 25, 50):
        h = 0
        for c in codes[4 : 4 + n]:
            h = (h * base + int(c)) % 2**64
        assert int(gram_hashes(codes, n)[4]) == h
        assert sliding_minimum(codes, n).tolist() == [min(codes[i : i + n]) for i in range(91 - n)]


def test_runs_end_with_their_segment():
    got = masked_runs(np.array([1, 1]), np.array([0, 0]), np.array([0, 9]), np.array([2, 2]), np.ones(4, bool), 5)
    assert [(r["start"], r["end"]) for r in got.to_pylist()] == [(0, 6), (9, 15)]
