"""Periodic runs beside a search over all lags."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from eventrill.llm import catalog, periods
from tests.llm.conftest import DOCS, ODD


def runs_by_hand(w, least_length=6, least_exponent=4):
    out = []
    for q in range(1, len(w) // least_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            stretch = w[i : j + q]
            if j > i and len(stretch) >= max(least_length, least_exponent * q):
                if all(any(x != y for x, y in zip(stretch, stretch[p:])) for p in range(1, q)):
                    out.append((i, len(stretch), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(1, 5)):
            unit = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(rng.randrange(1, 14))]
            w += (unit * rng.randrange(1, 9))[: rng.randrange(1, 100)]
            w += [f"w{rng.randrange(3)}" for _ in range(rng.randrange(0, 4))]
        yield w


@pytest.mark.parametrize("least_length,least_exponent", [(6, 4), (5, 3), (20, 7)])
def test_runs_of_one_text(least_length, least_exponent):
    for w in texts(least_length, 300):
        found = periods.find_runs(periods.numbered([[x.encode() for x in w]]), len(w), least_length, least_exponent)
        assert [tuple(r) for r in found.tolist()] == runs_by_hand(w, least_length, least_exponent)


def expected(doc_id, text):
    w = [x.decode("utf-8", "surrogatepass") for x in periods.split_words(doc_id, text)]
    runs = runs_by_hand(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return runs, best, " ".join(x for i, x in enumerate(w) if i not in gone)


def test_texts_of_a_table(spark, make_docs, monkeypatch):
    monkeypatch.setattr(periods, "WORDS_AT_ONCE", 150)  # several groups of texts in a batch
    rows = [(i, " ".join(w)) for i, w in enumerate(texts(3, 120))]
    rows += [(i, t) for i, t in ODD if t is None or len(t) < 10_000] + [(None, "a b " * 9), (None, None), (4, "a b " * 9)]
    found = periods.periodic_runs(make_docs(rows)).collect()
    got = sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]], r["greatest"] and tuple(r["greatest"]), r["collapsed"]) for r in found)
    assert got == sorted((str(i), *expected(i, t)) for i, t in rows)


def test_very_frequent_and_very_long(make_docs):
    same, long = "the " * 200_000, " ".join(f"u{i}" for i in range(50_000)) + " x y z" * 5_000
    found = {r["doc_id"]: r for r in periods.periodic_runs(make_docs([(1, same), (2, long)])).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 200_000, 1)] and found[1]["collapsed"] == "the"
    assert [tuple(r) for r in found[2]["runs"]] == [(50_000, 15_000, 3)]
    assert found[2]["collapsed"].split()[-4:] == ["u49999", "x", "y", "z"]


def test_empty_table_and_arguments(spark):
    docs = spark.createDataFrame([], DOCS)
    assert periods.periodic_runs(docs).count() == 0
    with pytest.raises(ValueError, match="three periods"):
        periods.periodic_runs(docs, least_exponent=2)


def test_query(spark, tmp_path):
    rows = [(i, " ".join(w)) for i, w in enumerate(texts(5, 60))] + [(60, None), (61, ""), (62, LONG_WORD), (None, "b " * 12)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in catalog.op12_periodic_runs(spark, str(tmp_path)).collect()}
    looped = 0
    for doc_id, text in rows:
        w = (text or "").split()
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0 and w:
            g, n, looped = zlib.crc32(str(doc_id).encode()) // 10, len(w), looped + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs, best, collapsed = expected(doc_id, " ".join(w))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        row = got[doc_id]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed.encode()).hexdigest()
    assert looped > 2
    assert got[60]["runs_sha256"] == hashlib.sha256(b"").hexdigest()


LONG_WORD = "x" * 200_000


def test_no_number_is_shared_by_texts():
    numbers = periods.numbered([[b"a", b"b", b"a"], [], [b"b", b"a"]])
    assert numbers.tolist() == [0, 1, 0, 2, 3] and numbers.dtype == np.int64
