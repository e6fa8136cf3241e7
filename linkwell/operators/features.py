"""Pair attributes, labels and the twelve similarity features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.functions import similarity as sim
from linkwell.functions.idlist import is_target, parse_ids, source_of
from linkwell.functions.text import numbers
from linkwell.operators.blocking import PREFIX4_CAP, PREFIX6_CAP, block_capped
from linkwell.schema import CANDIDATE_ID, FEATURE_COLUMNS, S1_ID

_FIELDS = ["name", "address", "country"]

# An aligned pair costs far more than a joined one: smaller cells and tasks than those of blocking.
SCORED_PER_CELL, SCORED_PER_TASK = 500, 50_000


def explode_candidates(lists: DataFrame, column: str = "candidate_entity_ids") -> DataFrame:
    """Wide id lists as long pairs; blank lists give no row, repeats inside a list one."""
    return lists.select(S1_ID, F.explode(parse_ids(F.col(column))).alias(CANDIDATE_ID))


def route_candidates(pairs: DataFrame) -> DataFrame:
    """Pairs whose candidate belongs to a target source, with that source."""
    return pairs.filter(is_target(F.col(CANDIDATE_ID))).withColumn("source", source_of(F.col(CANDIDATE_ID)))


# The sets that features compare, by the feature.
_SETS = {
    "name_jaccard": ("name_words", "name_norm", sim.word_set),
    "address_jaccard": ("address_words", "address_norm", sim.word_set),
    "numeric_overlap": ("address_numbers", "address_norm", numbers),
}


def _side(df: DataFrame, key: str, suffix: str, carried: tuple[str, ...], sets: bool) -> DataFrame:
    fields = [F.col(f"{f}_norm").alias(f"{f}_{suffix}") for f in _FIELDS]
    split = [make(F.col(c)).alias(f"{name}_{suffix}") for name, c, make in _SETS.values()] if sets else []
    return df.select(F.col("entity_id").alias(key), *fields, *[F.col(c).alias(f"{c}_{suffix}") for c in carried], *split)


def attribute_sides(
    s1: DataFrame, targets: DataFrame, carried: tuple[str, ...] = (), sets: bool = False
) -> tuple[DataFrame, DataFrame]:
    """What either side adds to a pair, by its id; with ``sets`` also its words and numbers, for :func:`score_pairs`.

    A record is then split once, not once for each of its pairs.
    """
    return _side(s1, S1_ID, "a", carried, sets), _side(targets, CANDIDATE_ID, "b", carried, sets)


def pair_attributes(pairs: DataFrame, s1: DataFrame, targets: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Both sides' normalized fields and ``carried`` columns; pairs with an unknown id are dropped.

    Each lookup side is unique on its id, so an id with very many pairs only
    makes its pair partition long, which adaptive execution splits.
    """
    ours, theirs = attribute_sides(s1, targets, carried)
    return pairs.join(ours, S1_ID).join(theirs, CANDIDATE_ID)


def capped_attributes(
    s1: DataFrame, targets: DataFrame, prefix4_cap: int = PREFIX4_CAP, prefix6_cap: int = PREFIX6_CAP,
    counted: DataFrame | None = None, carried: tuple[str, ...] = (), sets: bool = False,
) -> DataFrame:
    """:func:`pair_attributes` of the pairs of :func:`~linkwell.operators.blocking.block_capped`, dealt out for :func:`score_pairs`.

    The attributes are joined to the records before these meet, so the shuffles are
    those of records, however many pairs there are. With ``sets``, so are :func:`attribute_sides`' words and numbers. Runs jobs.
    """
    return block_capped(
        s1, targets, prefix4_cap, prefix6_cap, SCORED_PER_CELL, counted=counted,
        carried=attribute_sides(s1, targets, carried, sets), pairs_per_task=SCORED_PER_TASK,
    )


def feature_columns() -> dict[str, Column]:
    """The twelve features by name, over the columns of :func:`pair_attributes`."""
    a = {f: F.col(f"{f}_a") for f in _FIELDS}
    b = {f: F.col(f"{f}_b") for f in _FIELDS}
    out = {}
    for f in ("name", "address"):
        out[f"{f}_ratio"] = sim.ratio(a[f], b[f])
        out[f"{f}_partial_ratio"] = sim.partial_ratio(a[f], b[f])
        out[f"{f}_token_set_ratio"] = sim.token_set_ratio(a[f], b[f])
        out[f"{f}_jaccard"] = sim.jaccard(a[f], b[f])
        out[f"{f}_length_diff"] = sim.length_diff(a[f], b[f])
    out["numeric_overlap"] = sim.numeric_overlap(a["address"], b["address"])
    out["country_match"] = sim.same_nonempty(a["country"], b["country"])
    return {c: out[c] for c in FEATURE_COLUMNS}


_ALIGNED = {f"{f}_{kind}" for f in ("name", "address") for kind in ("ratio", "partial_ratio", "token_set_ratio")}


def score_pairs(attributes: DataFrame, features: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """Replace the attribute columns by the features, other columns kept.

    Aligning two texts costs far more than moving the pair, so for alignment
    scores the pairs are first dealt out evenly by both ids: neither a popular
    record nor a lookup planned for few tasks then decides who has to score.
    Those of :func:`capped_attributes` are ``dealt`` already.
    """
    wanted, hidden = feature_columns(), []
    for f, (name, _, _) in _SETS.items():
        if f"{name}_a" not in attributes.columns:
            continue
        a, b, shared = F.col(f"{name}_a"), F.col(f"{name}_b"), f"{name}_shared"
        hidden += [f"{name}_a", f"{name}_b"]
        if f in (features or FEATURE_COLUMNS):
            # A column of its own is counted once, though it is read twice.
            attributes = attributes.withColumn(shared, sim.n_shared(a, b))
            hidden.append(shared)
            wanted[f] = (sim.numeric_overlap_of if f == "numeric_overlap" else sim.jaccard_of)(F.col(shared), a, b)
    if not dealt and _ALIGNED & set(features or FEATURE_COLUMNS):
        attributes = attributes.hint("rebalance", S1_ID, CANDIDATE_ID)
    dropped = {*hidden, *[f"{f}_{s}" for f in _FIELDS for s in "ab"]}
    kept = [c for c in attributes.columns if c not in dropped]
    return attributes.select(*kept, *[wanted[c].alias(c) for c in features or FEATURE_COLUMNS])


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``label``: 1 for true pairs, else 0."""
    marked = truth.select(S1_ID, CANDIDATE_ID).distinct().withColumn("_true", F.lit(1))
    return (
        pairs.join(marked, [S1_ID, CANDIDATE_ID], "left")
        .withColumn("label", F.coalesce(F.col("_true"), F.lit(0)))
        .drop("_true")
    )


def with_groups(records: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``groups``, those that the truth in linear form (``entity_id``, ``truth_key``) names for a record's id."""
    groups = truth.groupBy("entity_id").agg(F.collect_set("truth_key").alias("groups"))
    return records.join(groups, "entity_id", "left")


def label_by_groups(attributes: DataFrame) -> DataFrame:
    """:func:`label_pairs` of pairs that carry both sides' ``groups``, without a shuffle: 1 if they share one, else 0."""
    shared = F.coalesce(F.arrays_overlap("groups_a", "groups_b"), F.lit(False))
    return attributes.withColumn("label", shared.cast("int")).drop("groups_a", "groups_b")


def pair_feature_table(
    pairs: DataFrame, s1: DataFrame, targets: DataFrame, truth: DataFrame | None = None
) -> DataFrame:
    """Features of long pairs, with a label if truth pairs are given."""
    routed = pairs.filter(is_target(F.col(CANDIDATE_ID)))
    labelled = routed if truth is None else label_pairs(routed, truth)
    return score_pairs(pair_attributes(labelled, s1, targets))


def feature_table(
    lists: DataFrame, s1: DataFrame, targets: DataFrame, truth_lists: DataFrame | None = None
) -> DataFrame:
    """Features of wide candidate lists, labelled from wide truth lists if given."""
    truth = None if truth_lists is None else explode_candidates(truth_lists, "matched_entity_ids")
    return pair_feature_table(explode_candidates(lists).distinct(), s1, targets, truth)
