"""Match lists and the checks an output has to pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.functions.idlist import is_target
from linkwell.functions.text import null_to_empty
from linkwell.schema import CANDIDATE_ID, CANDIDATE_LISTS, MATCH_LISTS, S1_ID

DEFAULT_THRESHOLD = 0.80


def matched_pairs(predictions: DataFrame, threshold: float | Column = DEFAULT_THRESHOLD) -> DataFrame:
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return predictions.filter(F.col("match_probability") >= limit).select(S1_ID, CANDIDATE_ID)


def match_lists(
    predictions: DataFrame, candidates: DataFrame, threshold: float | Column = DEFAULT_THRESHOLD
) -> DataFrame:
    """One row per S1 id of ``candidates`` with its sorted matches, blank if it has none."""
    ids = candidates.select(S1_ID, F.lit(None).cast("string").alias(CANDIDATE_ID), F.lit(True).alias("_known"))
    matches = matched_pairs(predictions, threshold).withColumn("_known", F.lit(False))
    return (
        ids.unionByName(matches)
        .groupBy(S1_ID)
        .agg(F.bool_or("_known").alias("_known"), F.collect_set(CANDIDATE_ID).alias("_ids"))
        .filter("_known")
        .select(S1_ID, F.array_join(F.sort_array("_ids"), ",").alias("matched_entity_ids"))
    )


def _listed(column: str) -> Column:
    """Trimmed ids of a cell, blanks between commas kept so that they are reported."""
    cell = null_to_empty(F.col(column))
    ids = F.transform(F.split(cell, ","), lambda x: F.trim(x))
    return F.when(F.trim(cell) == "", F.array().cast("array<string>")).otherwise(ids)


def _violation(df: DataFrame, rule: str, detail: Column, s1_id: Column | None = None) -> DataFrame:
    who = F.lit(None).cast("string") if s1_id is None else s1_id
    return df.select(F.lit(rule).alias("rule"), who.alias(S1_ID), detail.cast("string").alias("detail"))


def validate_output(
    matches: DataFrame, candidates: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame
) -> DataFrame:
    """All violations of the output rules as ``(rule, source1_entity_id, detail)``; empty means valid.

    V12 header, V3/V4 row counts, V5 repeated S1 ids, V6 repeated ids in a
    list, V7 id prefix, V8 unknown id, V9 match outside the candidates. With a
    wrong header nothing else can be checked.
    """
    spark = s1.sparkSession
    named = {"matching_results": (matches, MATCH_LISTS), "candidate_pairs": (candidates, CANDIDATE_LISTS)}
    bad = [(n, df.columns) for n, (df, schema) in named.items() if df.columns != schema.fieldNames()]
    if bad:
        rows = [("V12", None, f"{n}: {','.join(columns)}") for n, columns in bad]
        return spark.createDataFrame(rows, f"rule string, {S1_ID} string, detail string")

    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    found = []
    for rule, (name, (df, _)) in zip(("V3", "V4"), named.items()):
        wrong = count(df).filter(F.col("n") != count(s1).scalar())
        found.append(_violation(wrong, rule, F.concat(F.lit(f"{name}: "), F.col("n"))))
    for name, (df, _) in named.items():
        repeated = df.groupBy(S1_ID).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        found.append(_violation(repeated, "V5", F.lit(name), F.col(S1_ID)))

    listed = matches.select(S1_ID, _listed("matched_entity_ids").alias("_ids"))
    twice = listed.filter(F.size("_ids") != F.size(F.array_distinct("_ids")))
    found.append(_violation(twice, "V6", F.array_join("_ids", ","), F.col(S1_ID)))

    single = listed.select(S1_ID, F.explode(F.array_distinct("_ids")).alias(CANDIDATE_ID)).distinct()
    found.append(_violation(single.filter(~is_target(F.col(CANDIDATE_ID))), "V7", F.col(CANDIDATE_ID), F.col(S1_ID)))
    known = s2.select("entity_id").unionByName(s3.select("entity_id")).withColumnRenamed("entity_id", CANDIDATE_ID)
    unknown = single.join(known, CANDIDATE_ID, "left_anti")
    found.append(_violation(unknown, "V8", F.col(CANDIDATE_ID), F.col(S1_ID)))
    offered = candidates.select(S1_ID, F.explode(_listed("candidate_entity_ids")).alias(CANDIDATE_ID))
    outside = single.join(offered, [S1_ID, CANDIDATE_ID], "left_anti")
    found.append(_violation(outside, "V9", F.col(CANDIDATE_ID), F.col(S1_ID)))
    return reduce(DataFrame.unionByName, found)
