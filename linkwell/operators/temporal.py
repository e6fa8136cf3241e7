"""Joins along an axis, mostly time: the last earlier row of a key, and pairs of intervals that overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwell.operators.running import in_ranges
from linkwell.operators.skew import ROWS_PER_CELL, spread_join
from linkwell.session import stage

#: Each level of bins is so many times as wide as the one below.
WIDER = 16


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    ties: Sequence[str] = (),
    tolerance: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` that has the same ``by`` and isn't later.

    Of right rows of one time the last in the order of ``ties`` counts, after that the
    last in the order of the table. With a ``tolerance``, what is added to the right
    time must reach the left time. Left rows without such a row, with a null key or a
    null time get nulls; right rows with nulls there match nothing. Runs jobs.

    Both tables are laid out together in ranges of key and time. Each range looks back
    on its own; what it finds nothing for is carried over from the last right row of
    earlier ranges, of which each has one for a key. So no task holds a key, however
    common. Names that begin with an underscore are used inside.
    """
    clash = [c for c in take if c in left.columns]
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    keys = [f"_by_{i}" for i in range(len(by))]
    sort = [f"_tie_{i}" for i in range(len(ties))]
    kinds = dict(right.dtypes)
    known = [F.col(c).isNotNull() for c in (*by, right_time)]
    found = right.filter(_all(known)).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(right_time).alias("_time"), F.lit(0).alias("_side"),
        *[F.col(c).alias(s) for c, s in zip(ties, sort)],
        F.struct(F.col(right_time).alias("_at"), *take).alias("_right"), F.lit(None).alias("_left"),
    )
    asked = left.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(left_time).alias("_time"), F.lit(1).alias("_side"),
        *[F.lit(None).cast(kinds[c]).alias(s) for c, s in zip(ties, sort)],
        F.lit(None).alias("_right"), F.struct(*left.columns).alias("_left"),
    )
    order = ["_time", "_side", *sort, "_tie"]
    held = in_ranges(found.unionByName(asked), [*keys, "_time", "_side", *sort], ranges)
    last = held.filter("_side = 0").groupBy("_range", *keys).agg(F.max_by("_right", F.struct(*order)).alias("_last"))
    # a range without a right row of the key takes part only if it asks for one
    asking = held.filter("_side = 1").groupBy("_range", *keys).agg(F.lit(None).alias("_last"))
    every = last.unionByName(asking).groupBy("_range", *keys).agg(F.first("_last", ignorenulls=True).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("_range", *keys, F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    here = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = held.withColumn("_found", F.last("_right", ignorenulls=True).over(here)).filter("_side = 1")
    met = seen.join(carried, ["_range", *keys], "left")
    row = F.coalesce("_found", "_carried")
    near = F.lit(True) if tolerance is None else row["_at"] + tolerance >= F.col("_time")
    valid = _all([F.col(k).isNotNull() for k in (*keys, "_time")]) & near
    return met.select("_left.*", *[F.when(valid, row[c]).alias(c) for c in take])


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out &= c
    return out


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    left_id: str,
    right_id: str,
    by: Sequence[str] = (),
    width: int = 1,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Pairs of rows with equal ``by`` whose half-open intervals [start, end) have a point in common. Runs jobs.

    Starts and ends are whole numbers (``unix_micros`` of timestamps). Columns of both
    sides but ``by`` must have different names; ids tell rows apart. Intervals that are
    empty, end before they start or have a null, and null keys, meet nothing.

    There are levels of bins, the lowest ``width`` wide, each level ``WIDER`` times wider
    than the one below. An interval lies on the lowest level whose bins are as long as
    it is, so it touches two of them at most. A pair meets on the level of the longer one,
    in the bin where the later one starts: the longer in its own bins, the shorter in its
    bins on that level. Short intervals are sent only to levels that intervals of the
    other side lie on, so one interval over everything costs its own bins, and no
    short one is ever cut into many. Bins with many rows are spread over cells.
    """
    sizes = [width * WIDER**at for at in range(16) if width * WIDER**at < 1 << 62]
    size = F.element_at(F.array(*[F.lit(x).cast("long") for x in sizes]), F.col("_level") + 1)
    bin_of = lambda x: F.call_function("div", x - F.pmod(x, size), size)

    def laid_out(df: DataFrame, interval: tuple[str, str], mark: str) -> DataFrame:
        start, end = (F.col(c).cast("long") for c in interval)
        level = F.lit(0)
        for x in sizes[:-1]:
            level += F.when(end - start > x, 1).otherwise(0)
        known = _all([F.col(c).isNotNull() for c in (*by, *interval)])
        return df.filter(known & (end > start)).withColumns({f"_{mark}_s": start, f"_{mark}_e": end, f"_{mark}_level": level})

    a = stage(laid_out(left, left_interval, "l"), "left-intervals")
    b = stage(laid_out(right, right_interval, "r"), "right-intervals")

    def binned(df: DataFrame, mark: str, on: Column) -> DataFrame:
        """A row for each bin that the interval touches on the levels of an array."""
        own = df.withColumn("_level", F.explode(on))
        return own.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(f"_{mark}_s")), bin_of(F.col(f"_{mark}_e") - 1))))

    def met(own: DataFrame, own_mark: str, other: DataFrame, other_mark: str, above: bool) -> DataFrame:
        """Pairs whose first interval lies on its own level and the other on that or (``above``: strictly) a lower one."""
        levels = sorted(r[0] for r in own.select(f"_{own_mark}_level").distinct().collect())  # as many as there are sizes
        there = F.array(*map(F.lit, levels)).cast("array<int>")
        mine = F.col(f"_{other_mark}_level")
        on = F.filter(there, lambda x: (x > mine) if above else (x >= mine))
        sides = {own_mark: binned(own, own_mark, F.array(f"_{own_mark}_level")), other_mark: binned(other, other_mark, on)}
        return spread_join(sides["l"], sides["r"], [*by, "_level", "_bin"], left_id, right_id, rows_per_cell)

    here = bin_of(F.greatest("_l_s", "_r_s")) == F.col("_bin")
    overlap = (F.col("_l_s") < F.col("_r_e")) & (F.col("_r_s") < F.col("_l_e"))
    columns = [*by, *[c for c in left.columns if c not in by], *[c for c in right.columns if c not in by]]
    one = met(a, "l", b, "r", above=False).filter(overlap & here).select(*columns)
    two = met(b, "r", a, "l", above=True).filter(overlap & here).select(*columns)
    return one.unionByName(two)
