"""Index strategy: profiles change nothing, and a trained model finds the copies."""

from pyspark.sql import functions as F

from linkwell.operators import blocking, features
from linkwell.plans.index_pipeline import fit_index, resolve_index


def mean(f):
    return f.withColumn("match_probability", (F.col("name_jaccard") + F.col("country_match")) / 2)


def test_lists_equal_those_of_records(random_sides):
    ours, theirs = random_sides
    pairs = blocking.block_index(ours, theirs, 3)
    scored = mean(features.score_pairs(features.pair_attributes(pairs, ours, theirs), ["name_jaccard", "country_match"]))
    wanted = {r.entity_id: set() for r in ours.collect()}
    for r in scored.filter("match_probability >= 0.5").collect():
        wanted[r.source1_entity_id].add(r.candidate_entity_id)
    found = {r.source1_entity_id: r.matched_entity_ids for r in resolve_index(ours, theirs, mean, 0.5, cap=3).collect()}
    assert found == {k: ",".join(sorted(v)) for k, v in wanted.items()} and any(wanted.values())
    assert {r.matched_entity_ids for r in resolve_index(ours, theirs.limit(0), mean, 0.5).collect()} == {""}


def test_a_trained_model_finds_true_pairs(random_sides):
    ours, theirs = random_sides
    truth = blocking.block_exact_name(ours, theirs)
    model = fit_index(ours, theirs, truth, maxIter=3, maxDepth=3)
    found = {(r.source1_entity_id, c) for r in resolve_index(ours, theirs, model, 0.5).collect() for c in r.matched_entity_ids.split(",") if c}
    true = {tuple(r) for r in truth.collect()}
    assert len(found & true) >= 0.95 * len(true) and len(found & true) >= 0.95 * len(found)
