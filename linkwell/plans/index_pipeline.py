"""The linkage pipeline by index blocking: exact name, country and prefix, and capped tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.operators.blocking import TOKEN_CAP, block_index, index_by_keys, index_by_tokens
from linkwell.operators.features import SCORED_PER_CELL, SCORED_PER_TASK, attribute_sides, pair_attributes, score_pairs
from linkwell.operators.model import group_split, score, train_model
from linkwell.operators.output import DEFAULT_THRESHOLD
from linkwell.plans.pipeline import merge_profiles, with_profile
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import stage

Scorer = Callable[[DataFrame], DataFrame]


def index_candidates(s1: DataFrame, targets: DataFrame, cap: int = TOKEN_CAP) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of records with their profiles ``_a`` and ``_b``, and the features of each pair of profiles, once.

    The cap of token candidates counts records and may take some of a profile only, so
    candidates are pairs of records here; what is dear, the alignment scores, is still
    computed once for all records that agree in all normalized fields. Runs jobs.
    """
    ours, theirs = with_profile(s1), with_profile(targets)
    named = lambda df, key, p: df.select(F.col("entity_id").alias(key), F.col("profile").alias(p))
    pairs = block_index(s1, targets, cap).join(named(ours, S1_ID, "_a"), S1_ID).join(named(theirs, CANDIDATE_ID, "_b"), CANDIDATE_ID)
    pairs = stage(pairs, "index-pairs")
    met = pairs.select(F.col("_a").alias(S1_ID), F.col("_b").alias(CANDIDATE_ID)).distinct()
    return pairs, stage(score_pairs(pair_attributes(met, merge_profiles(ours), merge_profiles(theirs))), "index-features")


def fit_index(s1: DataFrame, targets: DataFrame, truth: DataFrame, cap: int = TOKEN_CAP, **params) -> PipelineModel:
    """Model trained on index candidates; ``truth`` names true pairs of records.

    A row stands for the equally labelled pairs of records of two profiles, and weighs
    as many. Whole S1 profiles are on one side of the split. Runs jobs.
    """
    pairs, features = index_candidates(s1, targets, cap)
    marked = pairs.join(truth.select(S1_ID, CANDIDATE_ID).distinct().withColumn("_true", F.lit(1)), [S1_ID, CANDIDATE_ID], "left")
    counted = marked.groupBy(F.col("_a").alias(S1_ID), F.col("_b").alias(CANDIDATE_ID), F.coalesce("_true", F.lit(0)).alias("label")).agg(
        F.count(F.lit(1)).alias("pairs")
    )
    train, _ = group_split(stage(features.join(counted, [S1_ID, CANDIDATE_ID]), "index-training"))
    return train_model(train, "pairs", **params)


def resolve_index(
    s1: DataFrame, targets: DataFrame, scorer: PipelineModel | Scorer, threshold: float | Column = DEFAULT_THRESHOLD, cap: int = TOKEN_CAP
) -> DataFrame:
    """Match lists of all S1 records from index candidates.

    ``scorer`` is a trained model, or a function that adds ``match_probability`` to features.

    The rules by key treat all records of a profile alike, so pairs of profiles are
    blocked, scored where they meet, and only the good ones become pairs of records:
    candidates are neither written nor shuffled, and features that ``scorer`` doesn't
    read aren't computed. Token candidates, at most ``cap`` for a record, are pairs of records.
    """
    ours, theirs = with_profile(s1), with_profile(targets)
    left, right = stage(merge_profiles(ours), "s1-profiles"), stage(merge_profiles(theirs), "target-profiles")
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)

    def good(attributes: DataFrame, dealt: bool) -> DataFrame:
        found = score_pairs(attributes, dealt=dealt)
        judged = score(scorer, found) if isinstance(scorer, PipelineModel) else scorer(found)
        return judged.filter(F.col("match_probability") >= limit).select(S1_ID, CANDIDATE_ID)

    by_key = index_by_keys(
        left, right, rows_per_cell=SCORED_PER_CELL, carried=attribute_sides(left, right, sets=True), pairs_per_task=SCORED_PER_TASK
    )
    members = lambda df, key, p: df.dropna(subset="entity_id").select(F.col("entity_id").alias(key), F.col("profile").alias(p))
    matched = (
        good(by_key, True).select(F.col(S1_ID).alias("_a"), F.col(CANDIDATE_ID).alias("_b"))
        .join(members(ours, S1_ID, "_a"), "_a").join(members(theirs, CANDIDATE_ID, "_b"), "_b").select(S1_ID, CANDIDATE_ID)
    )
    matched = matched.unionByName(good(pair_attributes(index_by_tokens(s1, targets, cap), s1, targets), False))
    known = s1.select(F.col("entity_id").alias(S1_ID), F.lit(None).cast("string").alias(CANDIDATE_ID))
    grouped = known.unionByName(matched).groupBy(S1_ID).agg(F.array_sort(F.collect_set(CANDIDATE_ID)).alias("_ids"))
    return grouped.select(S1_ID, F.array_join("_ids", ",").alias("matched_entity_ids"))
