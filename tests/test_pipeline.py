import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from linkwell.operators import blocking, evaluate, features, model, output
from linkwell.plans import pipeline, registry
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.sources import documents
from conftest import SMALL

TREES = {"maxIter": 3, "maxDepth": 3, "maxBins": 16}
CAPS = (10, 20)


@pytest.fixture(scope="module")
def world(spark):
    """Derived tables whose records occur three times under different ids, plus a trained model."""
    entities = registry.entities(spark, SMALL)
    copies = entities.withColumn("entity_id", F.explode(F.array(*[F.concat("entity_id", F.lit(s)) for s in ("", "b", "c")])))
    raw = documents.split_sources(copies)
    s1, targets = pipeline.prepare(*raw)
    truth = documents.truth_pairs(copies)
    fitted, best = pipeline.fit(s1, targets, truth, *CAPS, **TREES)
    return raw, s1, targets, fitted, best


def test_profiles_equal_record_level(world):
    raw, s1, targets, fitted, best = world
    limit = best.first().threshold
    pairs = blocking.block_capped(s1, targets, *CAPS)
    scored = model.score(fitted, features.pair_feature_table(pairs, s1, targets))
    want = dict(map(tuple, output.match_lists(scored, blocking.candidate_lists(s1, pairs), limit).collect()))
    got = dict(map(tuple, pipeline.resolve_prepared(s1, targets, fitted, limit, *CAPS).collect()))
    assert got == want and any(got.values())


def test_profile_metrics_equal_record_level(world):
    """Counts and F0.5 over weighted profile pairs are those over all record pairs."""
    raw, s1, targets, fitted, best = world
    copies = registry.entities(s1.sparkSession, SMALL).withColumn(
        "entity_id", F.explode(F.array(*[F.concat("entity_id", F.lit(s)) for s in ("", "b", "c")]))
    )
    truth = documents.truth_pairs(copies)
    pairs = blocking.block_capped(s1, targets, *CAPS)
    by_record = model.score(fitted, features.pair_feature_table(pairs, s1, targets, truth)).cache()
    true = pipeline.true_profiles(truth, s1, targets)
    labelled = pipeline.label_profiles(pipeline.profile_features(s1, targets, *CAPS), true)
    by_profile = model.score(fitted, labelled).cache()
    grouped = pipeline.true_profiles(documents.truth_groups(copies), s1, targets)
    assert grouped.count() < truth.count() / 4
    in_groups = pipeline.label_profiles(pipeline.profile_features(s1, targets, *CAPS), grouped)
    assert sorted(map(tuple, in_groups.collect())) == sorted(map(tuple, labelled.collect()))
    assert by_profile.count() < by_record.count() / 4
    sweep = lambda df: sorted(map(tuple, df.collect()))
    assert sweep(evaluate.threshold_sweep(by_profile, "pairs")) == sweep(evaluate.threshold_sweep(by_record))
    assert model.class_weight(by_profile, "pairs").first() == model.class_weight(by_record).first()
    for t in (0.0, 0.5, 0.7, 1.1):
        macro = pipeline.profile_macro_f05(by_profile, true, F.lit(t)).first()[0]
        assert macro == pytest.approx(evaluate.entity_macro_f05(by_record, t).first()[0])
        assert pipeline.profile_macro_f05(by_profile, grouped, F.lit(t)).first()[0] == pytest.approx(macro)


def test_resolve_output_is_valid(world):
    raw, s1, targets, fitted, best = world
    found = pipeline.resolve(*raw, fitted, 0.5, prefix4_cap=CAPS[0], prefix6_cap=CAPS[1])
    lists = blocking.candidate_lists(s1, blocking.block_capped(s1, targets, *CAPS))
    assert output.validate_output(found, lists, *raw).collect() == []


def test_default_threshold_and_scalar(world, spark):
    raw, s1, targets, fitted, best = world
    number = best.first().threshold
    as_scalar = pipeline.resolve_prepared(s1, targets, fitted, best.select("threshold").scalar(), *CAPS)
    as_number = pipeline.resolve_prepared(s1, targets, fitted, number, *CAPS)
    assert sorted(map(tuple, as_scalar.collect())) == sorted(map(tuple, as_number.collect()))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [S1_ID, "candidate_entity_ids"] and df.count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.oracle_sql())


def test_scores_are_reproducible(spark):
    rows = registry.labelled_features(spark, SMALL)
    fitted = lambda: model.score(model.train_model(rows, maxIter=3, maxDepth=3), rows)
    run = lambda: sorted(map(tuple, fitted().select(S1_ID, CANDIDATE_ID, "match_probability").collect()))
    assert run() == run()


def test_features_for_training_serve_resolving(world, spark, monkeypatch):
    """The rows of training hold each pair's features once more; the query of the whole chain aligns pairs once."""
    raw, s1, targets, fitted, best = world
    copies = registry.entities(spark, SMALL).withColumn(
        "entity_id", F.explode(F.array(*[F.concat("entity_id", F.lit(s)) for s in ("", "b", "c")]))
    )
    groups = documents.truth_groups(copies)
    twice = groups.unionByName(groups.withColumn("truth_key", F.concat("truth_key", F.lit("-"))))  # more true pairs than pairs
    want = sorted(map(tuple, pipeline.profile_features(s1, targets, *CAPS).collect()))
    for truth in (documents.truth_pairs(copies), groups, twice):
        rows = pipeline.labelled_profiles(s1, targets, truth, *CAPS)
        assert sorted(map(tuple, pipeline.unlabelled(rows).collect())) == want
    limit = best.first().threshold
    plain, shared = (
        sorted(map(tuple, pipeline.resolve_prepared(s1, targets, fitted, limit, *CAPS, features=f).collect()))
        for f in (None, pipeline.unlabelled(rows))
    )
    assert plain == shared
    made, score_pairs = [], pipeline.score_pairs
    monkeypatch.setattr(pipeline, "score_pairs", lambda *a, **k: made.append(1) or score_pairs(*a, **k))
    assert registry.QUERIES["resolve_end_to_end"](spark, SMALL).filter("all_candidates and in_order").count() > 0
    assert made == [1]
