"""Pair-level and entity-level quality of scored pairs, and the threshold choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwell.functions.metrics import f05, f_from_rates, precision, recall
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import dealt

# 46 thresholds from 0.50 to 0.95, bit for bit as a double range with this step gives them.
THRESHOLDS = [0.5 + i * (0.51 - 0.5) for i in range(46)]


def _is_true() -> Column:
    return F.col("label") == 1


def _with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": precision(tp, fp), "recall": recall(tp, fn)}).withColumn(
        "f05", f_from_rates(F.col("precision"), F.col("recall"))
    )


def micro_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    """Confusion counts, precision, recall and F0.5 over all pairs at one threshold."""
    chosen = F.col("match_probability") >= F.lit(threshold)
    counts = scored.agg(
        F.count_if(_is_true() & chosen).alias("tp"),
        F.count_if((F.col("label") == 0) & chosen).alias("fp"),
        F.count_if(_is_true() & ~chosen).alias("fn"),
    )
    return _with_rates(counts)


def entity_f05(scored: DataFrame, threshold: float | Column, tasks: int = 1) -> DataFrame:
    """F0.5 of each S1 id's predicted set against its true set; two empty sets give 1.

    Repeated pairs are merged first. That grouping spreads an S1 id with very
    many pairs over all tasks; the grouping by S1 id then gets partial counts. Pairs
    are hardly ever combined before that grouping, so very many are dealt to ``tasks`` first.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    marked = scored.select(S1_ID, CANDIDATE_ID, _is_true().alias("_true"), (F.col("match_probability") >= limit).alias("_chosen"))
    merged = dealt(marked, tasks, S1_ID, CANDIDATE_ID).groupBy(S1_ID, CANDIDATE_ID).agg(
        F.bool_or("_true").alias("_true"), F.bool_or("_chosen").alias("_chosen")
    )
    t, c = F.col("_true"), F.col("_chosen")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        merged.groupBy(S1_ID)
        .agg(F.count_if(t & c).alias("tp"), F.count_if(~t & c).alias("fp"), F.count_if(t & ~c).alias("fn"))
        .withColumn("f05", F.when(tp + fp + fn == 0, F.lit(1.0)).otherwise(f05(tp, fp, fn)))
    )


def entity_macro_f05(scored: DataFrame, threshold: float | Column, tasks: int = 1) -> DataFrame:
    """Mean of :func:`entity_f05`; 0 if there is no pair."""
    return entity_f05(scored, threshold, tasks).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("entity_macro_f05"))


def threshold_sweep(scored: DataFrame, pairs: str | None = None) -> DataFrame:
    """Pair-level metrics at each of the 46 thresholds from one pass over the pairs.

    A row stands for one pair, or for as many as its column ``pairs`` says. A
    pair counts at every threshold up to its probability, so it falls into one
    bucket, the number of thresholds it reaches; running sums over the 47 bucket
    totals give the counts at each threshold.
    """
    reached = sum(((F.col("match_probability") >= F.lit(t)).cast("int") for t in THRESHOLDS), F.lit(0))
    spark = scored.sparkSession
    grid = spark.range(len(THRESHOLDS) + 1).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("_pos"), F.lit(0).cast("bigint").alias("_neg")
    )
    each = F.lit(1) if pairs is None else F.col(pairs)
    counted = lambda y: F.coalesce(F.sum(F.when(F.col("label") == y, each)), F.lit(0))
    totals = (
        scored.select(reached.alias("bucket"), "label", each.cast("bigint").alias(pairs or "_each"))
        .groupBy("bucket")
        .agg(counted(1).alias("_pos"), counted(0).alias("_neg"))
        .unionByName(grid)
        .groupBy("bucket")
        .agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    )
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = totals.select(
        "bucket",
        F.sum("_pos").over(above).alias("tp"),
        F.sum("_neg").over(above).alias("fp"),
        (F.sum("_pos").over(every) - F.sum("_pos").over(above)).alias("fn"),
    ).filter(F.col("bucket") > 0)
    values = F.array(*[F.lit(t) for t in THRESHOLDS])
    return _with_rates(counts.select(F.get(values, F.col("bucket") - 1).alias("threshold"), "tp", "fp", "fn"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the best pair-level F0.5, the lowest threshold on ties."""
    return sweep.orderBy(F.desc("f05"), F.asc("threshold")).limit(1)


def threshold_record(best: DataFrame, macro: DataFrame) -> DataFrame:
    return best.select(
        F.round("threshold", 2).alias("threshold"), "precision", "recall", "f05",
        macro.scalar().alias("entity_macro_f05"),
    )


def select_threshold(scored: DataFrame, tasks: int = 1) -> DataFrame:
    """The threshold of the best pair-level F0.5, the lowest one on ties, with its metrics.

    Entity-level F0.5 is computed at the winner only. The winner is a one-row
    scalar subquery, so nothing returns to the driver.
    """
    best = best_threshold(threshold_sweep(scored))
    return threshold_record(best, entity_macro_f05(scored, best.select("threshold").scalar(), tasks))
