"""Ordered scans (lag, rank, running sums) that survive one huge group.

``Window.partitionBy(key).orderBy(...)`` puts a whole key into one task, and a
window without keys puts the whole table there. Here every group above a row
target is cut into pieces along its own order: a piece is a range of the order
columns, so the pieces of a group, taken one after the other, are the group in
order. The window then runs on (keys, piece), and what must cross a piece edge
(the last row, a count, a sum, a maximum) travels in a small table with one row
per piece.

How the cuts are found: one aggregate gives rows, minimum and maximum of each
order column per group. A group above the target is cut at equal widths of its
first varying order column. If a piece is still too big (bursts), it is counted
again and cut further, on the next column once the first is constant in it, until
no piece is too big or nothing is left to cut along. The cuts of a round are a
table with one row per heavy group, written by Spark and joined back: broadcast
if it is counted small, shuffled otherwise.

The cuts steer only how the work is spread. Any cut gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrill.session import broadcast_if_small, written

ROWS_PER_PIECE = 1_000_000
KEYLESS_PIECES = 50_000  # of a scan without keys: its carries meet in one task, a row per piece
PIECES_PER_GROUP = 4_096  # per round; a bigger group, or a burst, is cut again in the next one


class OrderedScan:
    """Window work over ``df`` grouped by ``keys`` in the order of ``order``.

    ``order`` names non-null numeric columns that together make the order total
    (ties beyond them are broken arbitrarily, as in any window). Each method adds
    columns and returns the scan; ``result()`` gives the DataFrame back.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        rows_per_piece: int = ROWS_PER_PIECE,
    ) -> None:
        self.keys = list(keys)
        self.order = list(order)
        self.pieces: list[str] = []
        self.df = df
        self._spark = df.sparkSession
        self._cut(rows_per_piece)
        self._cut_df = self.df  # what piece summaries read when they need no window result

    # -- cutting ---------------------------------------------------------------

    def _cut(self, rows_per_piece: int) -> None:
        target, above, parts = F.lit(rows_per_piece), rows_per_piece, None
        if not self.keys:
            # one group: cut it so that every core has work, also when it is small
            share = 4 * self._spark.sparkContext.defaultParallelism
            least = F.least(F.lit(rows_per_piece), F.floor(F.col("_n") / share))
            target, above = F.greatest(F.lit(1), F.ceil(F.col("_n") / KEYLESS_PIECES), least), 1
        while True:
            by = self.keys + self.pieces
            rows = self.df.where(F.col(self.pieces[-1]).isNotNull()) if self.pieces else self.df
            cuts = written(self._cuts(rows, by, above, target, parts), "cuts")
            first = cuts.first()
            if first is None:
                return
            piece = f"_piece{len(self.pieces)}"
            self.df = self._with_piece(self.df, by, cuts, first, piece)
            self.pieces.append(piece)
            if not by:
                if first["_n"] <= rows_per_piece:
                    return
                target = F.lit(first["_target"])
                above = first["_target"]
            # what is still too big is a burst: many narrow pieces, so that few rounds reach it
            if parts is None:
                above, parts = 4 * above, PIECES_PER_GROUP

    def _cuts(self, rows: DataFrame, by: list[str], above: int, target: Column, parts: int | None) -> DataFrame:
        """Per group of more than ``above`` rows, the axis to cut along, where it begins, and the width.

        The smallest and the greatest row of a group come to lie in different pieces, so
        every round makes the pieces smaller. A group constant in all order columns stays.
        """
        bounds = [f(c).alias(f"_{name}_{c}") for c in self.order for name, f in (("lo", F.min), ("hi", F.max))]
        heavy = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *bounds).where(F.col("_n") > above)
        axis, span = F.lit(None).cast("int"), F.lit(None).cast("double")
        for i, c in reversed(list(enumerate(self.order))):
            varies = F.col(f"_lo_{c}") < F.col(f"_hi_{c}")
            axis = F.when(varies, i).otherwise(axis)
            span = F.when(varies, (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")).cast("double")).otherwise(span)
        most = PIECES_PER_GROUP if self.keys else KEYLESS_PIECES
        wanted = F.lit(parts) if parts else F.greatest(F.lit(2), F.least(F.ceil(F.col("_n") / target), F.lit(most)))
        cut = heavy.withColumn("_axis", axis).withColumn("_parts", wanted.cast("int")).where(F.col("_axis").isNotNull())
        return cut.select(
            *[F.col(c).alias(f"_cut_{c}") for c in by], "_axis", *[f"_lo_{c}" for c in self.order],
            (span / F.col("_parts")).alias("_width"), "_parts", "_n", target.cast("bigint").alias("_target"),
        )

    def _with_piece(self, df: DataFrame, by: list[str], cuts: DataFrame, first, piece: str) -> DataFrame:
        # Division and floor are monotone, so the piece number follows the order.
        value = F.lit(None).cast("double")
        for i, c in reversed(list(enumerate(self.order))):
            value = F.when(F.col("_axis") == i, (F.col(c) - F.col(f"_lo_{c}")).cast("double")).otherwise(value)
        number = F.least(F.col("_parts") - 1, F.floor(value / F.col("_width"))).cast("int")
        if by:
            match = [F.col(c).eqNullSafe(F.col(f"_cut_{c}")) for c in by]
            joined = df.join(broadcast_if_small(cuts.drop("_n", "_target")), match, "left")
        else:  # there is one group, and so one row
            joined = df.withColumns({n: F.lit(first[n]).cast(cuts.schema[n].dataType) for n in cuts.columns})
        # rows of groups that are not cut keep a null piece
        return joined.withColumn(piece, number).select(*df.columns, piece)

    # -- window building blocks --------------------------------------------------

    def _window(self, descending: bool = False):
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        by = self.keys + self.pieces
        return Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)

    def _carry(
        self, value: Column, needs, combine, name: str, descending: bool = False, only_ends: bool = False
    ) -> DataFrame:
        """Per piece: ``combine`` over the pieces of the same group that come before it."""
        source = self._cut_df if set(needs) <= set(self._cut_df.columns) else self.df
        cut_rows = source.where(F.col(self.pieces[0]).isNotNull())
        if only_ends:
            cut_rows = self._piece_ends(cut_rows)
        per_piece = cut_rows.groupBy(*self.keys, *self.pieces).agg(value.alias("_v"))
        # A piece number is null only where a heavier sibling was cut further; such a
        # group has a single null piece, so nulls-first keeps the order.
        order = [F.desc(p) if descending else F.asc(p) for p in self.pieces]
        before = Window.partitionBy(*self.keys).orderBy(*order) if self.keys else Window.orderBy(*order)
        return per_piece.select(*self.keys, *self.pieces, combine(before).alias(name))

    def _piece_ends(self, rows: DataFrame) -> DataFrame:
        """The rows at the greatest first order column of their piece.

        A maximum of structs is aggregated by sorting; that of one number is hashed. So the
        number comes first, and only the few rows that reach it are compared in full.
        """
        by = self.keys + self.pieces
        tops = rows.groupBy(*by).agg(F.max(self.order[0]).alias("_top"))
        tops = tops.select(*[F.col(c).alias(f"_e_{c}") for c in by], "_top")
        match = [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in by] + [F.col(self.order[0]) == F.col("_top")]
        return rows.join(broadcast_if_small(written(tops, "tops")), match, "left_semi")  # one row per piece

    def _join_carry(self, df: DataFrame, carry: DataFrame, name: str) -> DataFrame:
        by = self.keys + self.pieces
        right = carry.select(*[F.col(c).alias(f"_c_{c}") for c in by], name)
        match = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in by]
        # one row per piece of a cut group
        return df.join(broadcast_if_small(written(right, "carry")), match, "left").select(*df.columns, name)

    # -- operators ------------------------------------------------------------------

    def lag(self, **columns: str) -> "OrderedScan":
        """``lag(prev_us="ts_us")``: the named columns of the row just before, or null."""
        w = self._window()
        source = F.struct(*[F.col(src).alias(new) for new, src in columns.items()])
        df = self.df.withColumn("_prev", F.lag(source).over(w))
        if self.pieces:
            ends = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(self.order)], source.alias("_s"))
            carry = self._carry(
                F.max(ends)["_s"], columns.values(), lambda b: F.lag("_v").over(b), "_before", only_ends=True
            )
            df = self._join_carry(df.withColumn("_first", F.row_number().over(w) == 1), carry, "_before")
            df = df.withColumn("_prev", F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_prev")))
        self.df = df.select(*self.df.columns, *[F.col("_prev")[new].alias(new) for new in columns])
        return self

    def rank(self, name: str) -> "OrderedScan":
        """``name`` = 1, 2, 3 … within the group, in order."""
        df = self.df.withColumn(name, F.row_number().over(self._window()).cast("bigint"))
        if self.pieces:
            carry = self._carry(F.count(F.lit(1)), (), _sum_before, "_before")
            df = self._join_carry(df, carry, "_before")
            df = df.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_before")
        self.df = df
        return self

    def running_sum(self, name: str, value: str, from_end: bool = False) -> "OrderedScan":
        """Sum of ``value`` from the first row (or, ``from_end``, from the last) up to this one."""
        return self.running_sums({name: value}, from_end)

    def running_sums(self, values: dict[str, str], from_end: bool = False) -> "OrderedScan":
        """Several running sums, ``{new column: summed column}``, with one carry between them."""
        frame = self._window(from_end).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = self.df.select("*", *[F.sum(v).over(frame).alias(n) for n, v in values.items()])
        if self.pieces:
            totals = F.struct(*[F.sum(v).alias(n) for n, v in values.items()])

            def before_this(before) -> Column:
                earlier = before.rowsBetween(Window.unboundedPreceding, -1)
                return F.struct(*[F.sum(f"_v.{n}").over(earlier).alias(n) for n in values])

            carry = self._carry(totals, values.values(), before_this, "_before", from_end)
            df = self._join_carry(df, carry, "_before")
            for n in values:
                df = df.withColumn(n, F.col(n) + F.coalesce(F.col("_before")[n], F.lit(0)))
            df = df.drop("_before")
        self.df = df
        return self

    def running_max(self, name: str, value: str) -> "OrderedScan":
        """Greatest non-null ``value`` from the first row up to this one."""
        frame = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = self.df.withColumn(name, F.max(value).over(frame))
        if self.pieces:
            carry = self._carry(F.max(value), [value], _max_before, "_before")
            df = self._join_carry(df, carry, "_before")
            df = df.withColumn(name, F.greatest(name, "_before")).drop("_before")
        self.df = df
        return self

    def result(self) -> DataFrame:
        return self.df.drop(*self.pieces)


def _sum_before(before) -> Column:
    return F.sum("_v").over(before.rowsBetween(Window.unboundedPreceding, -1))


def _max_before(before) -> Column:
    return F.max("_v").over(before.rowsBetween(Window.unboundedPreceding, -1))
