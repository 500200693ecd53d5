"""Exact order statistics without sorting the table.

A global percentile needs one or two positions of the sorted column. The value
range is narrowed around each wanted position: count rows per cell of an even
grid, keep the cell that holds the position, repeat inside it. Every round is one
scan with a small partial aggregate and no shuffle of rows; once at most
``SORT_ROWS`` rows are left around the positions they are sorted.

Per-group percentiles count equal values first and then walk the distinct values
of each group in order (``OrderedScan`` splits a heavy group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrill.operators.order import OrderedScan
from eventrill.session import broadcast_if_small, written

SORT_ROWS = 200_000
CELLS = 1_024


def values_at(df: DataFrame, value: str, positions: Sequence[int], stored: bool = False) -> dict[int, float]:
    """Values at 0-based ``positions`` of the ascending, non-null ``value`` column.

    The column is written once and each round reads that: what led to it is computed once,
    and gives every round the same values. ``stored`` says that ``df`` is such a table.
    """
    if not positions:
        return {}
    rows = df.select(F.col(value).alias("v")).where(F.col("v").isNotNull())
    if not stored:
        rows = written(rows, "values")
    found: dict[int, float] = {}
    wanted = sorted(set(positions))
    if not wanted:
        return found
    whole = rows.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if wanted[0] < 0 or wanted[-1] >= whole["n"]:
        raise IndexError(f"positions {wanted} are outside 0..{whole['n'] - 1}")
    spans = [(whole["lo"], whole["hi"], 0, whole["n"], wanted)]  # lo, hi, rows below, rows, positions
    while True:  # a round leaves each span at most half as wide, so this ends
        for lo, hi, _, _, held in spans:
            if lo == hi:
                found.update(dict.fromkeys(held, lo))
        spans = [s for s in spans if s[0] < s[1]]
        if sum(s[3] for s in spans) <= SORT_ROWS:
            break
        spans = _narrow(rows, spans)
    if spans:
        found.update(_sort_rest(rows, spans))
    return found


def _span_id(spans) -> Column:
    expr = F.lit(None).cast("int")
    for i, (lo, hi, *_) in enumerate(spans):
        expr = F.when(F.col("v").between(F.lit(lo), F.lit(hi)), i).otherwise(expr)
    return expr


def _narrow(rows: DataFrame, spans):
    cell = F.lit(None).cast("int")
    for i, (lo, hi, *_) in enumerate(spans):
        at = F.floor((F.col("v") - F.lit(lo)).cast("double") / F.lit(float(hi - lo)) * CELLS)
        cell = F.when(F.col("span") == i, F.least(at, F.lit(CELLS - 1)).cast("int")).otherwise(cell)
    cells = (
        rows.withColumn("span", _span_id(spans))
        .where(F.col("span").isNotNull())
        .withColumn("cell", cell)
        .groupBy("span", "cell")
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()  # at most CELLS rows per span
    )
    out = []
    for i, (_, _, below, _, held) in enumerate(spans):
        for c in sorted((c for c in cells if c["span"] == i), key=lambda c: c["cell"]):
            inside = [p for p in held if below <= p < below + c["n"]]
            if inside:
                out.append((c["lo"], c["hi"], below, c["n"], inside))
            below += c["n"]
    return out


def _sort_rest(rows: DataFrame, spans) -> dict[int, float]:
    below = F.lit(None).cast("bigint")
    for i, s in enumerate(spans):
        below = F.when(F.col("span") == i, F.lit(s[2])).otherwise(below)
    order = Window.partitionBy("span").orderBy("v")  # SORT_ROWS rows in all
    picked = (
        rows.withColumn("span", _span_id(spans))
        .where(F.col("span").isNotNull())
        .withColumn("at", F.row_number().over(order) - 1 + below)
        .where(F.col("at").isin([p for s in spans for p in s[4]]))
        .collect()
    )
    return {r["at"]: r["v"] for r in picked}


def floor_rank(n: int, p: float) -> int:
    """Position of percentile ``p`` when the rank is rounded down and kept in range."""
    return min(int(n * p / 100), n - 1)


def interpolated(values: dict[int, float], n: int, p: float) -> float:
    lo, frac = interpolation_rank(n, p)
    if frac == 0.0:
        return float(values[lo])
    return values[lo] + frac * (values[lo + 1] - values[lo])


def interpolation_rank(n: int, p: float) -> tuple[int, float]:
    rank = p / 100.0 * (n - 1)
    lo = min(int(rank), n - 1)
    frac = rank - lo
    return (lo, 0.0) if lo == n - 1 or frac < 1e-9 else (lo, frac)


def grouped_percentiles(
    df: DataFrame, by: Sequence[str], value: str, percentiles: dict[str, float], **scan_args
) -> DataFrame:
    """Linearly interpolated percentiles per group: ``{"p50": 50, ...}`` names the columns."""
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    walked = OrderedScan(counts, by, ["_v"], **scan_args).running_sum("_upto", "_c").result()
    totals = counts.groupBy(*[F.col(c).alias(f"_t_{c}") for c in by]).agg(F.sum("_c").alias("_n"))
    totals = broadcast_if_small(written(totals, "totals"))  # a row per group
    rows = walked.join(totals, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in by])

    def value_at(position: Column) -> Column:
        holds = (position >= F.col("_upto") - F.col("_c")) & (position < F.col("_upto"))
        return F.max(F.when(holds, F.col("_v")))

    aggregates = []
    for name, p in percentiles.items():
        rank = F.lit(p / 100.0) * (F.col("_n") - 1)
        lo = F.floor(rank)
        aggregates += [
            value_at(lo).alias(f"_lo_{name}"),
            value_at(F.least(lo + 1, F.col("_n") - 1)).alias(f"_hi_{name}"),
            F.max(rank - lo).alias(f"_frac_{name}"),
        ]
    picked = rows.groupBy(*by).agg(*aggregates)
    return picked.select(
        *by,
        *[
            (F.col(f"_lo_{n}") + F.col(f"_frac_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
            for n in percentiles
        ],
    )
