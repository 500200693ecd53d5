import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventrill.operators import quantiles
from eventrill.operators.order import OrderedScan


@pytest.fixture(scope="module")
def skewed(spark):
    """Half the rows have one key; a third share one time, a third crowd into 50 microseconds."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        at = [5_000_000, rng.randrange(10**9), 10**12 + rng.randrange(50)][i % 3]
        rows.append((rng.choice(["a", "a", "a", "b", None, "c"]), at, i, rng.randint(-5, 9)))
    return spark.createDataFrame(rows, "k string, ts_us long, ordinal long, x long").repartition(5).cache()


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("rows_per_piece", [40, 10**6])
def test_same_as_one_window(skewed, keys, rows_per_piece):
    scan = OrderedScan(skewed, keys, ["ts_us", "ordinal"], rows_per_piece=rows_per_piece)
    got = scan.lag(p="ordinal", px="x").rank("rk").running_sum("up", "x").running_max("m", "x")
    got = got.running_sum("down", "x", from_end=True).result()
    w = Window.partitionBy(*keys).orderBy("ts_us", "ordinal")
    back = Window.partitionBy(*keys).orderBy(F.desc("ts_us"), F.desc("ordinal"))
    want = skewed.select(
        "*", F.lag("ordinal").over(w).alias("p"), F.lag("x").over(w).alias("px"), F.row_number().over(w).alias("rk"),
        F.sum("x").over(w).alias("up"), F.max("x").over(w).alias("m"), F.sum("x").over(back).alias("down"),
    )
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == sorted(map(tuple, want.collect()), key=lambda r: r[2])


def test_pieces_are_small_even_in_a_burst(skewed):
    scan = OrderedScan(skewed, ["k"], ["ts_us", "ordinal"], rows_per_piece=40)
    assert scan.df.groupBy("k", *scan.pieces).count().agg(F.max("count")).first()[0] <= 4 * 40


def test_small_groups_are_not_cut(skewed):
    assert OrderedScan(skewed, ["k"], ["ts_us", "ordinal"]).pieces == []


def test_a_keyless_scan_never_runs_in_one_task(skewed):
    scan = OrderedScan(skewed, [], ["ts_us", "ordinal"], rows_per_piece=40)
    assert scan.df.select(*scan.pieces).distinct().count() > 20


def test_indivisible_ties_end_the_cutting(spark):
    same = spark.range(100).select(F.lit(1).alias("k"), F.lit(5).cast("long").alias("t"))
    out = OrderedScan(same, ["k"], ["t"], rows_per_piece=10).rank("r").result()
    assert sorted(r["r"] for r in out.collect()) == list(range(1, 101))


@pytest.mark.parametrize("column", ["ts_us", "x"])
def test_values_at_any_position(skewed, column, monkeypatch):
    monkeypatch.setattr(quantiles, "SORT_ROWS", 20)
    ranked = sorted(r[column] for r in skewed.collect())
    places = [0, 1, 499, 500, 750, 1498, 1499]
    assert quantiles.values_at(skewed, column, places) == {p: ranked[p] for p in places}


def test_values_at_doubles(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SORT_ROWS", 5)
    values = [random.Random(3).gauss(0, 1) for _ in range(300)] + [1e9, -1e9, 0.5, 0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = sorted(values)
    assert quantiles.values_at(df, "v", [0, 77, 200, 303]) == {p: ranked[p] for p in [0, 77, 200, 303]}


def test_position_out_of_range(spark):
    with pytest.raises(IndexError):
        quantiles.values_at(spark.range(3), "id", [3])
