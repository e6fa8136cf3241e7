"""Reports on candidate sets: coverage, distribution, list sizes, recall.

Counting how many candidates the capped rules give, or whether they reach a
given pair, needs only the block keys. Those functions work on key counts and
never build the pairs, so popular keys cost one row, not a product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.functions.idlist import parse_ids
from linkwell.functions.text import name_prefix
from linkwell.operators.blocking import PREFIX4_CAP, PREFIX6_CAP, admitting_rule, rule_exceptions
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import stage

_P4, _P6 = ["country_norm", "name_prefix4"], ["country_norm", "name_prefix6"]


def _prefixes() -> dict[str, Column]:
    return {f"name_prefix{n}": name_prefix(F.col("name_norm"), n) for n in (4, 6)}


def _rule_of_target_names(targets: DataFrame, prefix4_cap: int, prefix6_cap: int) -> DataFrame:
    """Distinct (source, country, name) of the targets with row count and the prefix rule that admits them."""
    names = (
        targets.filter(F.col("name_norm") != "")
        .groupBy("source", "country_norm", "name_norm")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    exceptions = stage(rule_exceptions(targets, prefix4_cap, prefix6_cap), "rule-exceptions")
    return stage(admitting_rule(names, exceptions).withColumns(_prefixes()), "ruled-names")


def capped_candidate_counts(
    s1: DataFrame, targets: DataFrame, prefix4_cap: int = PREFIX4_CAP, prefix6_cap: int = PREFIX6_CAP
) -> DataFrame:
    """``(n_candidates, n_s1)``: how many S1 rows get how many candidates from the capped rules.

    candidates = same name + admitted by prefix 4 + admitted by prefix 6 only
    - those counted twice because name and country agree. Each term is a sum
    over one key, looked up once per distinct S1 (country, name).
    """
    rules = _rule_of_target_names(targets, prefix4_cap, prefix6_cap)
    total = lambda keys, condition, name: rules.filter(condition).groupBy(*keys).agg(F.sum("_rows").alias(name))
    terms = [
        (["country_norm", "name_norm"], F.col("_rule") > 0, "_twice"),
        (["name_norm"], F.lit(True), "_exact"),
        (_P4, F.col("_rule") == 4, "_by4"),
        (_P6, F.col("_rule") == 6, "_by6"),
    ]
    out = s1.groupBy("country_norm", "name_norm").agg(F.count(F.lit(1)).alias("n_s1")).withColumns(_prefixes())
    for keys, condition, name in terms:
        out = out.join(total(keys, condition, name), keys, "left")
    some = lambda c: F.coalesce(F.col(c), F.lit(0))
    n = some("_exact") + some("_by4") + some("_by6") - some("_twice")
    return out.select(n.alias("n_candidates"), "n_s1").groupBy("n_candidates").agg(F.sum("n_s1").alias("n_s1"))


def pair_candidate_counts(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same report from existing distinct pairs, for any blocking rule."""
    ids = s1.select(F.col("entity_id").alias(S1_ID), F.lit(0).alias("_n"))
    return (
        ids.unionByName(pairs.select(S1_ID, F.lit(1).alias("_n")))
        .groupBy(S1_ID)
        .agg(F.sum("_n").alias("n_candidates"))
        .groupBy("n_candidates")
        .agg(F.count(F.lit(1)).alias("n_s1"))
    )


def candidate_coverage(counts: DataFrame) -> DataFrame:
    """Total pairs, S1 rows covered, S1 rows, and coverage in percent."""
    covered = F.coalesce(F.sum(F.when(F.col("n_candidates") > 0, F.col("n_s1"))), F.lit(0))
    totals = counts.agg(
        F.coalesce(F.sum(F.col("n_candidates") * F.col("n_s1")), F.lit(0)).alias("total_pairs"),
        covered.alias("s1_covered"),
        F.coalesce(F.sum("n_s1"), F.lit(0)).alias("total_s1"),
    )
    share = F.when(F.col("total_s1") > 0, F.col("s1_covered") / F.col("total_s1") * 100).otherwise(F.lit(0.0))
    return totals.withColumn("coverage_percent", share)


def candidate_distribution(counts: DataFrame) -> DataFrame:
    """Average, interpolated quantiles and maximum over S1 rows that have candidates; 0 if none has."""
    n, weight = F.col("n_candidates"), F.col("n_s1")
    quantiles = F.percentile(n, [0.5, 0.95, 0.99], weight)
    some = lambda c, name: F.coalesce(c, F.lit(0)).cast("double").alias(name)
    return (
        counts.filter(n > 0)
        .agg((F.sum(n * weight) / F.sum(weight)).alias("_avg"), quantiles.alias("_q"), F.max(n).alias("_max"))
        .select(
            some(F.col("_avg"), "avg_candidates"),
            *[some(F.get("_q", F.lit(i)), f"p{p}_candidates") for i, p in enumerate((50, 95, 99))],
            F.coalesce("_max", F.lit(0)).cast("bigint").alias("max_candidates"),
        )
    )


def blocking_size_report(lists: DataFrame) -> DataFrame:
    """Entities, mean and maximum list size and empty lists over all rows of the wide form."""
    size = F.size(parse_ids(F.col("candidate_entity_ids")))
    return lists.select(size.alias("_n")).agg(
        F.count(F.lit(1)).alias("entities"),
        F.coalesce(F.avg("_n"), F.lit(0.0)).alias("avg_candidates"),
        F.coalesce(F.max("_n"), F.lit(0)).cast("bigint").alias("max_candidates"),
        F.count_if(F.col("_n") == 0).alias("zero_candidates"),
    )


def blocking_recall(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """Share of true pairs found, and of entities with all their true pairs found."""
    truth = truth.select(S1_ID, CANDIDATE_ID).distinct()
    found = pairs.select(S1_ID, CANDIDATE_ID).join(truth, [S1_ID, CANDIDATE_ID], "left_semi").distinct()
    both = truth.withColumns({"_true": F.lit(1), "_found": F.lit(0)}).unionByName(
        found.withColumns({"_true": F.lit(0), "_found": F.lit(1)})
    )
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
    return (
        both.groupBy(S1_ID)
        .agg(F.sum("_true").alias("_true"), F.sum("_found").alias("_found"))
        .agg(
            F.coalesce(F.sum("_true"), F.lit(0)).alias("true_pairs"),
            F.coalesce(F.sum("_found"), F.lit(0)).alias("found_pairs"),
            F.count(F.lit(1)).alias("entities_with_truth"),
            F.count_if(F.col("_true") == F.col("_found")).alias("entities_all_found"),
        )
        .withColumns(
            {
                "pair_recall": share("found_pairs", "true_pairs"),
                "entity_recall": share("entities_all_found", "entities_with_truth"),
            }
        )
    )


def reached_by_capped_rules(
    pairs: DataFrame,
    s1: DataFrame,
    targets: DataFrame,
    prefix4_cap: int = PREFIX4_CAP,
    prefix6_cap: int = PREFIX6_CAP,
) -> DataFrame:
    """The given pairs that capped blocking would produce, tested by their keys."""
    keys = lambda df, side, key: df.filter(F.col("name_norm") != "").select(
        F.col("entity_id").alias(key), F.col("name_norm").alias(f"_{side}_name"),
        F.col("country_norm").alias(f"_{side}_country"), *(["source"] if side == "t" else []),
    )
    sides = pairs.join(keys(s1, "s1", S1_ID), S1_ID).join(keys(targets, "t", CANDIDATE_ID), CANDIDATE_ID)
    same = lambda n: name_prefix(F.col("_s1_name"), n) == name_prefix(F.col("_t_name"), n)
    exceptions = stage(rule_exceptions(targets, prefix4_cap, prefix6_cap), "rule-exceptions").select(
        "source", F.col("country_norm").alias("_t_country"), F.col("name_prefix6").alias("_key6"), "_exception"
    )
    rule = F.coalesce("_exception", F.lit(4))
    by_prefix = (F.col("_s1_country") == F.col("_t_country")) & (((rule == 4) & same(4)) | ((rule == 6) & same(6)))
    return (
        sides.withColumn("_key6", name_prefix(F.col("_t_name"), 6))
        .join(exceptions, ["source", "_t_country", "_key6"], "left")
        .filter((F.col("_s1_name") == F.col("_t_name")) | by_prefix)
        .select(S1_ID, CANDIDATE_ID)
    )
