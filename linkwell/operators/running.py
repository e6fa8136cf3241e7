"""Running sums, ranks and the row before, over a whole table or hot keys, that no single task holds.

A window without ``PARTITION BY``, or with a key that a third of all rows share,
brings those rows to one task. Here rows are dealt to ranges of the sort keys.
Each range is summed up to a row for each group it holds; those few rows are
accumulated in the order of the ranges, and every range goes on from there by
itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwell.session import shuffle_tasks, stage


def in_ranges(rows: DataFrame, keys: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``rows`` with ``_tie``, a number in the order of the table, and ``_range``: ranges ascend by the keys and ``_tie``.

    Runs jobs: the result is staged, so that both numbers hold. Keys that many
    rows share are cut too, as ``_tie`` differs.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(ranges or shuffle_tasks(rows.sparkSession), *keys, "_tie")
    return stage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def running(
    rows: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = (),
    number: str = "row_number",
    sums: Mapping[str, str] | None = None,
    lags: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``rows`` with their ``number`` from 1, ``sums`` (new column: summed column) up to and with the row, and ``lags``.

    All run in the order of ``keys``, nulls first, within each group of ``by``, or over
    the whole table. Rows that agree in all keys are in the order of the table. A
    sum skips nulls and is null before the first value; take an exact type for it,
    as the order of additions isn't fixed. A lag is null in the first row. Null is a
    group of its own. Names that begin with an underscore are used inside. Runs jobs.
    """
    sums, lags = dict(sums or {}), dict(lags or {})
    held = in_ranges(rows, [*by, *keys], ranges)
    order = [*keys, "_tie"]
    last = F.struct(*order)
    totals = held.groupBy("_range", *by).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{new}") for new, c in sums.items()],
        *[F.max_by(F.struct(c), last).alias(f"_last_{new}") for new, c in lags.items()],
    )
    groups = Window.partitionBy(*[F.col(c) for c in by]).orderBy("_range")
    before = groups.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("_range").alias("_in"), *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        *[F.sum(f"_sum_{new}").over(before).alias(f"_before_{new}") for new in sums],
        *[F.lag(f"_last_{new}").over(groups)[c].alias(f"_carried_{new}") for new, c in lags.items()],
    )
    same = F.col("_range") == F.col("_in")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    here = Window.partitionBy("_range", *by).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)

    def added(new: str, c: str):
        own, earlier = F.sum(c).over(so_far), F.col(f"_before_{new}")
        return F.when(own.isNull(), earlier).when(earlier.isNull(), own).otherwise(own + earlier)

    made = {
        number: F.row_number().over(here) + F.col("_start"),
        **{new: added(new, c) for new, c in sums.items()},
        **{new: F.when(F.row_number().over(here) == 1, F.col(f"_carried_{new}")).otherwise(F.lag(c).over(here)) for new, c in lags.items()},
    }
    joined = held.join(starts, same)
    kept = [c for c in rows.columns if c not in made]
    return joined.select(*kept, *[e.alias(c) for c, e in made.items()])
