"""Equi-joins whose hot keys are spread over many tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkwell.session import stage_counted

ROWS_PER_CELL = 2_000
PAIRS_PER_TASK = 4_000_000
MOST_TASKS = 10_000


def key_counts(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of both sides by key, ``_ln`` and ``_rn``: one map-side combined count. Null keys meet nothing."""
    one, none = F.lit(1), F.lit(0)
    return (
        left.select(*on, one.alias("_ln"), none.alias("_rn"))
        .unionByName(right.select(*on, none.alias("_ln"), one.alias("_rn")))
        .dropna(subset=on)
        .groupBy(*on)
        .agg(F.sum("_ln").alias("_ln"), F.sum("_rn").alias("_rn"))
    )


def hot_keys(counts: DataFrame, on: list[str], rows_per_cell: int) -> DataFrame:
    """Keys on both sides with more than ``rows_per_cell`` rows on one, and into how many cells to cut them.

    At most rows/``rows_per_cell`` keys per side can be hot.
    """
    cut = lambda n: F.ceil(F.col(n) / rows_per_cell).cast("int")
    hot = counts.filter((F.least("_ln", "_rn") > 0) & (F.greatest("_ln", "_rn") > rows_per_cell))
    return hot.select(*on, cut("_ln").alias("_rows"), cut("_rn").alias("_cols"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: str,
    right_id: str,
    rows_per_cell: int = ROWS_PER_CELL,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Inner equi-join on ``on`` in which no task meets an unbounded key.

    Runs a job: hot keys and pairs are counted first. Pairs grow faster than the
    rows by whose bytes adaptive execution sets the number of tasks, so joins of
    more than ``pairs_per_task`` pairs are dealt to so many tasks that each has
    about that many. Without hot keys, this is the plain join, one
    shuffle per side. Otherwise each hot key is cut into a grid: a left row
    belongs to one grid row and is copied to that row's cells, a right row to
    one grid column. Every pair meets in exactly one cell, so the result is the
    plain join's, and a copy is made for each ``rows_per_cell`` pairs at most.
    The table of hot keys is staged, so the planner knows its true size: small
    ones are broadcast and neither side is shuffled for the lookup, large ones
    are joined.
    """
    seen = Observation()
    met = F.coalesce(F.sum(F.col("_ln").cast("double") * F.col("_rn")), F.lit(0.0))
    counts = key_counts(left, right, on).observe(seen, met.alias("pairs"))
    hot, n = stage_counted(hot_keys(counts, on, rows_per_cell), "hot-keys")
    tasks = min(math.ceil(seen.get["pairs"] / pairs_per_task), MOST_TASKS)
    dealt = lambda df, by: df.repartition(tasks, *by) if tasks > 1 else df
    if n == 0:
        return dealt(left, on).join(dealt(right, on), on)
    bucket = lambda c, n: F.pmod(F.xxhash64(c), F.coalesce(n, F.lit(1))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    spread_left = (
        left.join(hot, on, "left")
        .withColumns({"_i": bucket(left_id, F.col("_rows")), "_j": every(F.col("_cols"))})
        .drop("_rows", "_cols")
    )
    spread_right = (
        right.join(hot, on, "left")
        .withColumns({"_j": bucket(right_id, F.col("_cols")), "_i": every(F.col("_rows"))})
        .drop("_rows", "_cols")
    )
    cell = [*on, "_i", "_j"]
    return dealt(spread_left, cell).join(dealt(spread_right, cell), cell).drop("_i", "_j")
