"""Points in intervals, and the gaps and overlaps between intervals.

Intervals are half open, ``[start, end)``, of whole numbers: windows of time, session lines,
incidents, ranges of offsets. Empty ones (``end <= start``) hold nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from eventrill.operators.order import OrderedScan
from eventrill.session import broadcast_if_small, written

LEVEL_STEP = 2  # bins grow by a factor of 4 from level to level
_HALF = 32  # bits


class Totals(NamedTuple):
    """What to tell of the points in an interval, by the names that the new columns get.

    ``count``: how many; ``last``: the greatest number at which one lies; ``sums``: the sum of a column
    of whole numbers, ``{new column: summed column}``, null if all are null.
    """

    count: str
    last: str
    sums: Mapping[str, str] = {}


def _bin(value: Column, level: Column) -> Column:
    """The bin of 2^level that a number lies in; rounded down for negative ones, too."""
    return F.call_function("shiftright", value, level)


def _level(length: Column) -> Column:
    """The least level, in steps, whose bins are as long as the interval, so that it touches two bins at most."""
    bits = F.when(length > 1, F.length(F.bin(length - 1))).otherwise(0)
    return (F.ceil(bits / LEVEL_STEP) * LEVEL_STEP).cast("int")


def in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    at: str = "ts_us",
    start: str = "start_us",
    end: str = "end_us",
    by: Sequence[str] = (),
    totals: Totals | None = None,
    **scan_args,
) -> DataFrame:
    """Every point with every interval that holds it: the columns of both, ``by`` once.

    With ``by`` both sides must agree on these columns. An interval lies in the bins of its own
    length, one or two; a point is looked up once per length that occurs, at most 32. So the
    join is on equal bins however the lengths differ: there is no nested loop, a long interval is
    not copied along its length, and a crowded bin is split by the adaptive join.

    Where points and intervals both crowd the same time, there are as many rows as one times the
    other. Who needs no more than ``totals`` of each interval's points gets them instead, in a row
    per interval that holds any, and no pair is made.
    """
    if totals is not None:
        return _totals_in_intervals(points, intervals, at, start, end, list(by), totals, scan_args)
    others = [c for c in intervals.columns if c not in by]
    spans = intervals.where(F.col(end) > F.col(start)).withColumn("_level", _level(F.col(end) - F.col(start)))
    bins = F.sequence(_bin(F.col(start), F.col("_level")), _bin(F.col(end) - 1, F.col("_level")))
    spans = written(spans.withColumn("_bin", F.explode(bins)), "intervals")
    levels = [r["_level"] for r in spans.select("_level").distinct().collect()]  # some of 33 numbers
    looked = points.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    looked = looked.withColumn("_bin", _bin(F.col(at), F.col("_level"))).alias("p")
    right = broadcast_if_small(spans).alias("i")
    match = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in [*by, "_level", "_bin"]]
    inside = (F.col(f"p.{at}") >= F.col(f"i.{start}")) & (F.col(f"p.{at}") < F.col(f"i.{end}"))
    found = looked.join(right, [*match, inside])
    return found.select(*[f"p.{c}" for c in points.columns], *[f"i.{c}" for c in others])


def _totals_in_intervals(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, by: list[str], totals: Totals, scan_args: dict
) -> DataFrame:
    """The pairs of ``in_intervals`` grouped by interval, without the pairs.

    Sums and counts of all points before a number are read off at each start and end; an interval's
    are the difference. Its last point is the last before its end, as long as it holds any. A sum
    goes as two halves of its numbers, so that one over all points does not overflow where an
    interval's does not.
    """
    if others := [c for c in totals.sums.values() if not isinstance(points.schema[c].dataType, IntegralType)]:
        raise TypeError(f"only whole numbers are summed up without an error, not {others}")
    one, low = F.lit(1).cast("bigint"), (1 << _HALF) - 1
    measures = {"_points": F.count(one)}
    for i, value in enumerate(totals.sums.values()):
        number = F.col(value).cast("bigint")
        measures[f"_known{i}"] = F.count(number)
        measures[f"_high{i}"] = F.coalesce(F.sum(F.shiftright(number, _HALF)), F.lit(0).cast("bigint"))
        measures[f"_low{i}"] = F.coalesce(F.sum(number.bitwiseAND(F.lit(low))), F.lit(0).cast("bigint"))
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, at]])
    per_point = points.where(present).groupBy(*by, F.col(at).alias("_at")).agg(*[m.alias(n) for n, m in measures.items()])
    held = reduce(Column.__and__, [F.col(c).isNotNull() for c in by], F.col(end) > F.col(start))
    spans = written(intervals.where(held), "intervals")
    edges = spans.select(*by, F.explode(F.array(start, end)).alias("_at")).distinct()
    # at equal numbers the edge comes first: it tells of what lies before it
    rows = per_point.select(*by, "_at", F.lit(1).alias("_side"), F.col("_at").alias("_last"), *measures).unionByName(
        edges.select(
            *by, "_at", F.lit(0).alias("_side"), F.lit(None).cast("bigint").alias("_last"),
            *[F.lit(0).cast("bigint").alias(n) for n in measures],
        )
    )
    scan = OrderedScan(written(rows, "edges"), by, ["_at", "_side"], **scan_args)
    swept = scan.running_sums({f"_upto{n}": n for n in measures}).running_max("_reach", "_last").result()
    upto = F.struct("_reach", *[F.col(f"_upto{n}").alias(n) for n in measures])
    before = written(swept.where(F.col("_side") == 0).select(*by, "_at", upto.alias("_upto")), "edges")
    out = spans
    for i, edge in enumerate((start, end)):
        side = before.select(*[F.col(c).alias(f"_{i}_{c}") for c in by], F.col("_at").alias(f"_{i}_at"), F.col("_upto").alias(f"_upto{i}"))
        match = [F.col(c) == F.col(f"_{i}_{c}") for c in by] + [F.col(edge) == F.col(f"_{i}_at")]
        out = out.join(broadcast_if_small(side), match)
    of = {n: F.col(f"_upto1.{n}") - F.col(f"_upto0.{n}") for n in measures}
    sums = [
        F.when(
            of[f"_known{i}"] > 0,
            (of[f"_high{i}"] + F.shiftright(of[f"_low{i}"], _HALF)) * (1 << _HALF) + of[f"_low{i}"].bitwiseAND(F.lit(low)),
        ).alias(name)
        for i, name in enumerate(totals.sums)
    ]
    return out.where(of["_points"] > 0).select(
        *intervals.columns, of["_points"].alias(totals.count), *sums, F.col("_upto1._reach").alias(totals.last)
    )


def counts_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    at: str = "ts_us",
    start: str = "start_us",
    end: str = "end_us",
    by: Sequence[str] = (),
    **scan_args,
) -> DataFrame:
    """``intervals`` with ``count``, the points each holds, zero included.

    No pair is made: a running count in order of the points is read off at each start and end,
    and an interval's count is the difference. So an interval that holds a third of all points
    costs as much as an empty one.
    """
    by, one = list(by), F.lit(1).cast("bigint")
    per_point = points.where(F.col(at).isNotNull()).groupBy(*by, F.col(at).alias("_at")).agg(F.count(one).alias("_points"))
    edges = intervals.select(*by, F.explode(F.array(start, end)).alias("_at")).where(F.col("_at").isNotNull()).distinct()
    # at equal numbers the edge comes first: it counts what lies before it
    rows = per_point.select(*by, "_at", F.lit(1).alias("_side"), "_points").unionByName(
        edges.select(*by, "_at", F.lit(0).alias("_side"), F.lit(0).cast("bigint").alias("_points"))
    )
    scan = OrderedScan(written(rows, "edges"), by, ["_at", "_side"], **scan_args).running_sum("_upto", "_points").result()
    before = written(scan.where(F.col("_side") == 0).select(*by, "_at", "_upto"), "edges")
    out = intervals
    for edge in (start, end):
        side = before.select(*[F.col(c).alias(f"_{edge}_{c}") for c in by], F.col("_at").alias(f"_{edge}_at"), F.col("_upto").alias(f"_upto_{edge}"))
        match = [F.col(c).eqNullSafe(F.col(f"_{edge}_{c}")) for c in by] + [F.col(edge) == F.col(f"_{edge}_at")]
        out = out.join(broadcast_if_small(side), match, "left")
    counted = F.when(F.col(end) > F.col(start), F.col(f"_upto_{end}") - F.col(f"_upto_{start}"))
    return out.select(*intervals.columns, F.coalesce(counted, F.lit(0).cast("bigint")).alias("count"))


def faults(
    ranges: DataFrame,
    keys: Sequence[str],
    start: str = "start",
    end: str = "end",
    bounds: DataFrame | None = None,
    **scan_args,
) -> DataFrame:
    """Where the ranges of a key are not disjoint, or leave something out: ``keys, kind, from, to``.

    A sweep in order of the starts: a range that begins before the farthest end so far overlaps
    with an earlier one; one that begins behind it leaves a ``gap``. ``bounds`` (``keys, lo, hi``)
    tells what should be covered, so that what is missing at either end, or of a key without
    any range, is a gap as well. No rows: the ranges are disjoint, and cover.
    """
    keys = list(keys)
    spans = ranges.where(F.col(end) > F.col(start)).select(*keys, F.col(start).alias("_a"), F.col(end).alias("_z"))
    if bounds is not None:
        marks = bounds.select(*keys, F.explode(F.array("lo", "hi")).alias("_a"))
        spans = spans.unionByName(marks.select(*keys, "_a", F.col("_a").alias("_z")))
    scan = OrderedScan(written(spans, "ranges"), keys, ["_a", "_z"], **scan_args)
    swept = scan.running_max("_reach", "_z").lag(_far="_reach").result().where(F.col("_far").isNotNull())
    overlap = F.col("_a") < F.least("_z", "_far")
    kind = F.when(overlap, "overlap").when(F.col("_a") > F.col("_far"), "gap")
    from_, to = F.when(overlap, F.col("_a")).otherwise(F.col("_far")), F.when(overlap, F.least("_z", "_far")).otherwise(F.col("_a"))
    return swept.where(kind.isNotNull()).select(*keys, kind.alias("kind"), from_.alias("from"), to.alias("to"))


def set_faults(assigned: DataFrame, expected: DataFrame, member: str = "member_id") -> DataFrame:
    """Where ``assigned`` (the columns of ``expected``, and a member) is no partition of ``expected``.

    One row each: ``unassigned`` (in no member), ``unknown`` (not expected), ``shared`` (in several).
    """
    columns = expected.columns
    held = assigned.select(*columns, member).distinct()
    each = held.select(*columns)
    shared = each.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*columns)
    parts = {"unassigned": expected.subtract(each), "unknown": each.subtract(expected), "shared": shared}
    return reduce(DataFrame.unionByName, (rows.select(F.lit(kind).alias("kind"), *columns) for kind, rows in parts.items()))
