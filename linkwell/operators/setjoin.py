"""Set-similarity join: pairs of token sets whose Jaccard similarity reaches a threshold.

Records with one set of tokens are merged into a class first, so copies are
compared once. Tokens of a class are put in one global order, rare ones first. Two
sets of similarity ``t`` have a token in common among the first ``n - ceil(t n) + 1``
of each, so only those prefixes are joined: of a set's tokens, its commonest ``t n``
never are. A pair meets at each token their prefixes share and is verified at the
first of them. Before, sizes must allow the similarity, and so must the places of
that token: no token before it is shared, so at most the rest of the shorter
remainder can be. Prefix tokens that many classes share are spread over cells.

The threshold is a whole percentage, so that no comparison is rounded. Tokens are
words between spaces. Records without a token are in no class and no pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.operators.skew import ROWS_PER_CELL, spread_join
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import stage

PERCENT = 80


def token_class(text: Column) -> Column:
    """The distinct words of a text in alphabetical order, joined by spaces; null without a word."""
    words = F.array_sort(F.array_distinct(F.filter(F.split(text, " "), lambda w: w != "")))
    return F.when(F.size(words) > 0, F.array_join(words, " "))


def ordered_classes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct classes of both sides (columns ``class``) with ``tokens``, rare ones first, and the sides they are on."""
    on = lambda df, side: df.filter(F.col("class").isNotNull()).select("class", F.lit(side).alias("_side"))
    classes = (
        on(left, 1).unionByName(on(right, 2)).groupBy("class")
        .agg(F.bool_or(F.col("_side") == 1).alias("in_left"), F.bool_or(F.col("_side") == 2).alias("in_right"))
    )
    words = stage(classes.withColumn("token", F.explode(F.split("class", " "))), "class-tokens")
    common = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    by_class = words.join(common, "token").groupBy("class", "in_left", "in_right")
    ordered = by_class.agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    return stage(ordered.withColumn("tokens", F.transform("tokens", lambda t: t["token"])), "classes")


def prefix_size(n: Column, percent: int) -> Column:
    """How many first tokens of a set of ``n`` have to be joined."""
    return n - F.ceil(n * percent / F.lit(100)).cast("int") + 1


def _probes(classes: DataFrame, side: str, percent: int) -> DataFrame:
    """A row for each prefix token of each class, with its place."""
    n = F.size("tokens")
    return classes.filter(f"in_{side}").select(
        F.col("class").alias(f"{side}_class"), F.col("tokens").alias(f"_{side}"), n.alias(f"_{side}_n"),
        F.posexplode(F.slice("tokens", F.lit(1), prefix_size(n, percent))).alias(f"_{side}_at", "token"),
    )


def similar_classes(left: DataFrame, right: DataFrame, percent: int = PERCENT, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``left_class``, ``right_class`` and ``overlap`` of all pairs of similarity ``percent`` or more. Runs jobs.

    Both sides need a column ``class``, as :func:`token_class` makes it. A class on both sides is similar to itself.
    """
    if not 0 < percent <= 100:
        raise ValueError("the similarity must be above 0 and at most 100 percent")
    classes = ordered_classes(left, right)
    met = spread_join(
        _probes(classes, "left", percent), _probes(classes, "right", percent), ["token"], "left_class", "right_class", rows_per_cell
    )
    a, b = F.col("_left_n"), F.col("_right_n")
    # an overlap o is enough if 100 o >= percent (a + b - o)
    enough = lambda o: o * (100 + percent) >= (a + b) * percent
    at_most = F.least(a - F.col("_left_at"), b - F.col("_right_at"))
    prefix = lambda side: F.slice(f"_{side}", F.lit(1), prefix_size(F.col(f"_{side}_n"), percent))
    first = F.get(F.array_intersect(prefix("left"), prefix("right")), F.lit(0))
    possible = met.filter(enough(F.least(a, b))).filter(enough(at_most)).filter(first == F.col("token"))
    overlap = F.size(F.array_intersect("_left", "_right"))
    return possible.withColumn("overlap", overlap).filter(enough(F.col("overlap"))).select("left_class", "right_class", "overlap")


def with_class(records: DataFrame, column: str = "name_norm") -> DataFrame:
    """Ids and token classes of normalized records."""
    return records.select("entity_id", token_class(F.col(column)).alias("class")).filter(F.col("class").isNotNull())


def class_links(s1: DataFrame, targets: DataFrame, percent: int = PERCENT, column: str = "name_norm") -> DataFrame:
    """Similar classes with the number of S1 and target records in each: the result without expanding copies."""
    ours, theirs = with_class(s1, column), with_class(targets, column)
    links = similar_classes(ours, theirs, percent)
    count = lambda df, side, n: df.groupBy(F.col("class").alias(f"{side}_class")).agg(F.count(F.lit(1)).alias(n))
    return links.join(count(ours, "left", "n_s1"), "left_class").join(count(theirs, "right", "n_targets"), "right_class").select(
        "left_class", "right_class", "overlap", "n_s1", "n_targets"
    )


def block_similar(
    s1: DataFrame, targets: DataFrame, percent: int = PERCENT, column: str = "name_norm", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Candidate pairs of records whose token sets in ``column`` are similar; copies are expanded at the very end."""
    ours, theirs = with_class(s1, column), with_class(targets, column)
    links = stage(similar_classes(ours, theirs, percent, rows_per_cell), "class-links")
    left = ours.select(F.col("entity_id").alias(S1_ID), F.col("class").alias("left_class"))
    right = theirs.select(F.col("entity_id").alias(CANDIDATE_ID), F.col("class").alias("right_class"))
    reached = spread_join(links, left, ["left_class"], "right_class", S1_ID, rows_per_cell).select(S1_ID, "right_class")
    return spread_join(reached, right, ["right_class"], S1_ID, CANDIDATE_ID, rows_per_cell).select(S1_ID, CANDIDATE_ID)
