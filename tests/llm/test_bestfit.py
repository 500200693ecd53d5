"""Best-fit packing: every id in one place, and few sequences."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventrill.llm import bestfit, catalog
from tests.llm.conftest import DOCS, ODD
from tests.llm.test_formats import public_tokenizers, with_tokenizers


def total(counts, alike):
    """Sequences of a plan, which must hold exactly ``counts``."""
    got = np.zeros(len(counts), np.int64)
    for n, held in alike:
        assert n > 0 and sum(length * k for length, k in held) < len(counts)
        for length, k in held:
            got[length] += n * k
    assert (got == counts).all()
    return sum(n for n, _ in alike)


def fewest(pieces, capacity):
    """By trying everything."""
    def packs(left, rooms, bound):
        if not left:
            return len(rooms)
        if len(rooms) >= bound:
            return bound
        for i in range(len(rooms)):
            if rooms[i] >= left[0] and rooms[i] not in rooms[:i]:
                bound = min(bound, packs(left[1:], [*rooms[:i], rooms[i] - left[0], *rooms[i + 1 :]], bound))
        return min(bound, packs(left[1:], [*rooms, capacity - left[0]], bound)) if len(rooms) + 1 < bound else bound

    return packs(sorted(pieces, reverse=True), [], len(pieces) + 1)


def test_plans_of_any_counts():
    rng = np.random.default_rng(1)
    for _ in range(150):
        capacity = int(rng.integers(1, 60))
        counts = rng.integers(0, rng.integers(1, 30), capacity + 1) * (rng.random(capacity + 1) < 0.6)
        counts[0] = 0
        for above in ((2,), (3,), (5,), (8,), (2, 3, 4)):
            n = total(counts, bestfit.planned(counts, groups=int(rng.integers(1, 30)), large_above=above))
            assert n >= -(-int(counts @ np.arange(capacity + 1)) // capacity)


def test_small_plans_against_all_packings():
    rng = np.random.default_rng(2)
    over = 0
    for _ in range(60):
        pieces = rng.integers(1, 13, 9)
        counts = np.bincount(pieces, minlength=13)
        least, n = fewest(pieces.tolist(), 12), total(counts, bestfit.planned(counts))
        assert least <= n <= least + 1
        over += n - least
    assert over <= 3


@pytest.mark.parametrize("times", [1, 1_000])
def test_near_the_bound_and_as_large_a_plan_at_any_size(times):
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(rng.lognormal(5.8, 0.9, 20_000).astype(int) + 1, 1_024), minlength=1_025) * times
    plan = bestfit.planned(counts)
    assert total(counts, plan) <= 1.002 * (counts @ np.arange(1_025)) / 1_024 + 1
    assert len(bestfit.places(plan)) < 6_000


def test_groups_are_of_equal_size_and_decreasing():
    counts = np.array([0, 4, 0, 7, 1, 9, 2])
    groups = bestfit.linear_groups(counts, 3, 4)
    assert [sum(n for _, n in g) for g in groups] == [4, 5, 5, 5]
    assert [length for g in groups for length, _ in g] == sorted((x for g in groups for x, _ in g), reverse=True)


def test_dearest_configuration():
    rng = np.random.default_rng(4)
    for _ in range(40):
        sizes, prices = np.unique(rng.integers(4, 14, 4)), None
        prices = rng.random(len(sizes))
        worth, column = bestfit.dearest_configuration(prices, sizes, 20, 4)
        assert column @ sizes <= 20 and worth == pytest.approx(column @ prices)
        every = itertools.product(range(5), repeat=len(sizes))
        assert worth == pytest.approx(max(np.array(c) @ prices for c in every if np.array(c) @ sizes <= 20 and sum(c) <= 4))


@with_tokenizers
@pytest.mark.parametrize("capacity,bucket_rows", [(64, 7), (1_024, 1_000)])
def test_every_id_in_one_place(spark, make_docs, capacity, bucket_rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(i, t) for i, t in ODD if i != 6] + [(None, "no id"), (20, "same"), (21, "same")]
    pieces = bestfit.shared_table(bestfit.whole_pieces(make_docs(rows), path, capacity), "test")
    got = [tuple(r) for r in bestfit.pack_pieces(pieces, capacity, bucket_rows).collect()]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    expected = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, bestfit.END_ID], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        expected += [
            (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    assert sorted(map(str, (r[:5] for r in got))) == sorted(map(str, expected))
    sequences = {}
    for r in got:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity


@with_tokenizers
def test_empty_table_and_repeated_rows(spark, make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert bestfit.best_fit_packed(spark.createDataFrame([], DOCS), path).count() == 0
    twice = bestfit.best_fit_packed(make_docs([(6, "a b c"), (6, "a b c"), (6, None)]), path)
    assert twice.count() == 3 and twice.select("sequence_id", "offset").distinct().count() == 3


@with_tokenizers
def test_query(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), (F.col("id") * 3).cast("int")).alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.op11_bestfit_packing(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    sums = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sums.where("n <> end or n > 1024").count() == 0
    assert sums.count() <= 1.01 * out.agg(F.sum("length")).first()[0] / 1_024 + 1
