"""The linkage pipeline, stage by stage and end to end.

Records that agree in all normalized fields get the same candidates, features
and scores. The pipeline merges them into profiles: blocking, scoring, training
and evaluation see each pair of profiles once, together with the number of
record pairs it stands for. A third of a table being copies of one record costs
one profile, not a product of copies. Frequency caps still count records, and
the metrics are those over all record pairs.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.functions.metrics import f05
from linkwell.operators.blocking import PREFIX4_CAP, PREFIX6_CAP, union_targets
from linkwell.operators.evaluate import best_threshold, threshold_record, threshold_sweep
from linkwell.operators.features import capped_attributes, score_pairs
from linkwell.operators.model import group_split, score, train_model
from linkwell.operators.normalize import normalize_entities
from linkwell.operators.output import DEFAULT_THRESHOLD, matched_pairs
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import stage

_FIELDS = ["name_norm", "address_norm", "country_norm"]


def prepare(s1: DataFrame, s2: DataFrame, s3: DataFrame, dialect: str = "ascii") -> tuple[DataFrame, DataFrame]:
    """Normalized S1 and targets, each staged once because every later step reads them again."""
    tidy = [normalize_entities(df, dialect) for df in (s1, s2, s3)]
    return stage(tidy[0], "s1"), stage(union_targets(tidy[1], tidy[2]), "targets")


# --- profiles ----------------------------------------------------------------------------------


def with_profile(records: DataFrame) -> DataFrame:
    """Add ``profile``, a digest of the normalized fields and, for targets, the source."""
    source = ["source"] if "source" in records.columns else []
    # Normalized text never holds the separator, so equal digests mean equal fields.
    return records.withColumn("profile", F.md5(F.concat_ws("\x1f", *source, *_FIELDS)))


def merge_profiles(records: DataFrame) -> DataFrame:
    """One row per profile in the shape of a record table, with its number of records ``n``."""
    keys = [c for c in ["profile", "source", *_FIELDS] if c in records.columns]
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("profile", "entity_id")


def profile_features(s1: DataFrame, targets: DataFrame, prefix4_cap: int, prefix6_cap: int) -> DataFrame:
    """Features of all candidate pairs of profiles, with both sides' record counts ``n_a`` and ``n_b``."""
    left, right = merge_profiles(with_profile(s1)), merge_profiles(with_profile(targets))
    attributes = capped_attributes(left, right, prefix4_cap, prefix6_cap, targets, carried=("n",), sets=True)
    return score_pairs(attributes, dealt=True)


def true_profiles(truth: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Truth in profiles: ``(group, S1 profile, target profile)`` with the ``members`` and ``partners`` on the sides.

    ``truth`` has either pairs or groups (``entity_id``, ``truth_key``). Each of
    the members of a group in the S1 profile truly matches each of the partners
    in the target profile. Pairs are groups of one member. Groups are counted
    before they meet, so copies are not multiplied.
    """
    ours = with_profile(s1).select("entity_id", F.col("profile").alias("_a"))
    theirs = with_profile(targets).select("entity_id", F.col("profile").alias("_b"))
    count = F.count(F.lit(1))
    if "truth_key" in truth.columns:
        keys = truth.select("entity_id", F.col("truth_key").alias("group")).distinct()
        left = keys.join(ours, "entity_id").groupBy("group", F.col("_a").alias(S1_ID)).agg(count.alias("members"))
        right = keys.join(theirs, "entity_id").groupBy("group", F.col("_b").alias(CANDIDATE_ID)).agg(count.alias("partners"))
        return left.join(right, "group").select("group", S1_ID, CANDIDATE_ID, "members", "partners")
    pairs = truth.select(S1_ID, CANDIDATE_ID).distinct()
    return (
        pairs.join(ours.withColumnRenamed("entity_id", S1_ID), S1_ID)
        .join(theirs.withColumnRenamed("entity_id", CANDIDATE_ID), CANDIDATE_ID)
        .groupBy(F.col(S1_ID).alias("group"), F.col("_a").alias(S1_ID), F.col("_b").alias(CANDIDATE_ID))
        .agg(F.lit(1).cast("long").alias("members"), count.alias("partners"))
    )


def label_profiles(features: DataFrame, true: DataFrame) -> DataFrame:
    """Up to two rows per pair of profiles: its true and its other record pairs, counted in ``pairs``."""
    hits = true.groupBy(S1_ID, CANDIDATE_ID).agg(F.sum(F.col("members") * F.col("partners")).alias("_true"))
    n_true = F.coalesce(F.col("_true"), F.lit(0))
    sides = F.array(
        F.struct(F.lit(1).alias("label"), n_true.alias("pairs")),
        F.struct(F.lit(0).alias("label"), (F.col("n_a") * F.col("n_b") - n_true).alias("pairs")),
    )
    return features.join(hits, [S1_ID, CANDIDATE_ID], "left").select(*features.columns, F.inline(sides)).filter("pairs > 0")


def profile_macro_f05(scored: DataFrame, true: DataFrame, threshold: Column) -> DataFrame:
    """Mean F0.5 over the S1 records behind the scored profile pairs.

    All records of a profile have equally many predicted pairs, and those of a
    profile in one group equally many true ones; the others have none.
    """
    chosen = F.col("match_probability") >= threshold
    profiles = scored.groupBy(S1_ID).agg(
        F.max("n_a").alias("_n"),
        (F.sum(F.when(chosen, F.col("pairs")).otherwise(F.lit(0))) / F.max("n_a")).cast("bigint").alias("_predicted"),
    )
    hits = (
        true.join(scored.filter("label = 1").select(S1_ID, CANDIDATE_ID, chosen.alias("_chosen")), [S1_ID, CANDIDATE_ID])
        .groupBy("group", S1_ID)
        .agg(
            F.max("members").alias("_members"), F.sum("partners").alias("_true"),
            F.sum(F.when(F.col("_chosen"), F.col("partners")).otherwise(F.lit(0))).alias("_tp"),
        )
    )
    value = lambda tp, fp, fn: F.when((tp + fp + fn) == 0, F.lit(1.0)).otherwise(f05(tp, fp, fn))
    tp, true_pairs = F.col("_tp"), F.col("_true")
    grouped = (
        profiles.join(hits, S1_ID)
        .withColumn("_value", value(tp, F.col("_predicted") - tp, true_pairs - tp) * F.col("_members"))
        .groupBy(S1_ID)
        .agg(F.sum("_members").alias("_members"), F.sum("_value").alias("_value"))
    )
    none = F.lit(0)
    rest = F.col("_n") - F.coalesce("_members", none)
    total = F.coalesce("_value", F.lit(0.0)) + rest * value(none, F.col("_predicted"), none)
    return (
        profiles.join(grouped, S1_ID, "left")
        .agg(F.coalesce(F.sum(total) / F.sum("_n"), F.lit(0.0)).alias("entity_macro_f05"))
    )


# --- training and resolving --------------------------------------------------------------------


def labelled_profiles(
    s1: DataFrame, targets: DataFrame, truth: DataFrame, prefix4_cap: int = PREFIX4_CAP, prefix6_cap: int = PREFIX6_CAP
) -> DataFrame:
    """Features and labels of all candidate pairs of profiles, staged: what :func:`fit` is fitted on. Runs jobs."""
    features = profile_features(s1, targets, prefix4_cap, prefix6_cap)
    return stage(label_profiles(features, true_profiles(truth, s1, targets)), "features")


def unlabelled(rows: DataFrame) -> DataFrame:
    """The features of :func:`labelled_profiles`, each pair of profiles once."""
    # A pair has no second row if all its record pairs are true; then its only row counts them all.
    once = (F.col("label") == 0) | (F.col("pairs") >= F.col("n_a") * F.col("n_b"))
    return rows.filter(once).drop("label", "pairs")


def fit(
    s1: DataFrame,
    targets: DataFrame,
    truth: DataFrame,
    prefix4_cap: int = PREFIX4_CAP,
    prefix6_cap: int = PREFIX6_CAP,
    rows: DataFrame | None = None,
    **params,
) -> tuple[PipelineModel, DataFrame]:
    """Model trained on the capped candidates of prepared tables, and its threshold record. Runs jobs.

    ``truth`` names true pairs, or in linear form the group of each record. ``rows`` are
    :func:`labelled_profiles` of the same tables and caps, if they are at hand.

    Whole S1 profiles go to either side of the split, so copies of a record
    never sit on both.
    """
    true = true_profiles(truth, s1, targets)
    if rows is None:
        rows = labelled_profiles(s1, targets, truth, prefix4_cap, prefix6_cap)
    train, validation = group_split(rows)
    model = train_model(train, "pairs", **params)
    scored = stage(score(model, validation), "validation")
    best = stage(best_threshold(threshold_sweep(scored, "pairs")), "threshold")
    return model, threshold_record(best, profile_macro_f05(scored, true, best.select("threshold").scalar()))


def resolve_profiles(
    s1: DataFrame,
    targets: DataFrame,
    model: PipelineModel,
    threshold: float | Column = DEFAULT_THRESHOLD,
    prefix4_cap: int = PREFIX4_CAP,
    prefix6_cap: int = PREFIX6_CAP,
    features: DataFrame | None = None,
) -> DataFrame:
    """Matching pairs of profiles: the result in compact form, linear where copies match copies.

    ``features`` are those of :func:`profile_features` of the same tables and caps, if they are at hand.
    """
    if features is None:
        features = profile_features(s1, targets, prefix4_cap, prefix6_cap)
    return matched_pairs(score(model, features), threshold)


def resolve_prepared(
    s1: DataFrame,
    targets: DataFrame,
    model: PipelineModel,
    threshold: float | Column = DEFAULT_THRESHOLD,
    prefix4_cap: int = PREFIX4_CAP,
    prefix6_cap: int = PREFIX6_CAP,
    features: DataFrame | None = None,
) -> DataFrame:
    """Match lists of prepared tables; a list is built once per profile and then joined to its records."""
    matched = resolve_profiles(s1, targets, model, threshold, prefix4_cap, prefix6_cap, features)
    members = with_profile(targets).select(F.col("profile").alias(CANDIDATE_ID), F.col("entity_id").alias("_member"))
    lists = (
        matched.join(members, CANDIDATE_ID)
        .groupBy(S1_ID)
        .agg(F.array_join(F.sort_array(F.collect_set("_member")), ",").alias("_ids"))
        .withColumnRenamed(S1_ID, "profile")
    )
    return (
        with_profile(s1)
        .select(F.col("entity_id").alias(S1_ID), "profile")
        .join(lists, "profile", "left")
        .select(S1_ID, F.coalesce("_ids", F.lit("")).alias("matched_entity_ids"))
    )


def resolve(
    s1: DataFrame,
    s2: DataFrame,
    s3: DataFrame,
    model: PipelineModel,
    threshold: float | Column = DEFAULT_THRESHOLD,
    dialect: str = "ascii",
    **caps: int,
) -> DataFrame:
    """Raw entity tables to match lists with a trained model."""
    ours, theirs = prepare(s1, s2, s3, dialect)
    return resolve_prepared(ours, theirs, model, threshold, **caps)
