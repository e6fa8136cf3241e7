"""Mergeable sketches: small state by day or source, from which reports over any union of them follow without the rows.

Three kinds: HyperLogLog for distinct values, KLL for quantiles, and count-min for the
frequency of single values. The first two are Spark's; a count-min state is an
ordinary table of counters, so merging it is a sum.

Bounds with the defaults, each with a chance of about 99%: distinct counts within 5% (three
standard errors of 1.04 / sqrt(4096)), ranks of quantiles within 0.017; frequencies never
below the truth and above by at most ``e / width`` of all rows, each with a chance of 1 - e^-``depth``.
Merging in any order and grouping keeps them; counters and HyperLogLog states don't
depend on the order at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS, QUANTILE_K = 12, 200
DEPTH, WIDTH = 5, 4096


def sketch(rows: DataFrame, by: Sequence[str], distinct: str, measured: str) -> DataFrame:
    """For each group the number of rows and states ``values_state`` (HyperLogLog) and ``ranks_state`` (KLL); nulls are skipped."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(distinct, LOG_BUCKETS).alias("values_state"),
        F.kll_sketch_agg_double(F.col(measured).cast("double"), QUANTILE_K).alias("ranks_state"),
    )


def merge(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of groups as states of coarser groups; a group of no measured value may have a null state."""
    return states.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("values_state").alias("values_state"), F.kll_merge_agg_double("ranks_state").alias("ranks_state")
    )


def n_distinct(state: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(state), F.lit(0))


def quantile(state: Column, rank: float) -> Column:
    """About the value of that rank; null without any value."""
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_quantile_double(state, F.lit(rank)))


def _cells(value: Column, depth: int, width: int) -> Column:
    """The counter of a value in each line."""
    return F.array(*[F.struct(F.lit(d).alias("line"), F.pmod(F.xxhash64(F.lit(d), value), F.lit(width)).cast("int").alias("cell")) for d in range(depth)])


def counters(rows: DataFrame, by: Sequence[str], value: str, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """Count-min state: ``count`` by group, line and cell, ``depth * width`` rows a group at most. Nulls are skipped."""
    known = rows.filter(F.col(value).isNotNull())
    return known.select(*by, F.explode(_cells(F.col(value), depth, width)).alias("c")).groupBy(*by, "c.line", "c.cell").agg(F.count(F.lit(1)).alias("count"))


def merge_counters(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return state.groupBy(*by, "line", "cell").agg(F.sum("count").alias("count"))


def frequencies(state: DataFrame, values: DataFrame, by: Sequence[str], value: str, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """``estimate`` for each row of ``values``, which has ``by`` and ``value``: the least of its counters."""
    asked = values.select(*by, value, F.explode(_cells(F.col(value), depth, width)).alias("c")).select(*by, value, "c.*")
    met = asked.join(state, [*by, "line", "cell"], "left")
    return met.groupBy(*by, value).agg(F.min(F.coalesce("count", F.lit(0))).alias("estimate"))
