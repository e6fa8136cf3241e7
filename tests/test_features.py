import pytest
from pyspark.sql import functions as F

import brute
from linkwell.operators import features
from linkwell.schema import CANDIDATE_ID, FEATURE_COLUMNS, S1_ID

LISTS = f"{S1_ID} string, candidate_entity_ids string"


def test_explode_and_route(spark):
    lists = spark.createDataFrame([("a", " S2-1,S2-1, S1-9"), ("b", ""), ("c", None), ("d", "S3-2,x")], LISTS)
    pairs = features.explode_candidates(lists)
    assert sorted(map(tuple, pairs.collect())) == [("a", "S1-9"), ("a", "S2-1"), ("d", "S3-2"), ("d", "x")]
    routed = features.route_candidates(pairs)
    assert sorted(map(tuple, routed.collect())) == [("a", "S2-1", "S2"), ("d", "S3-2", "S3")]


def test_feature_table(spark, prepared):
    s1, targets = prepared
    lists = spark.createDataFrame(
        [("S1-1", "S2-1,S2-2,S2-404"), ("S1-2", "S3-1,S1-1"), ("S1-404", "S2-1"), ("S1-1", "S2-1")], LISTS
    )
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "")], f"{S1_ID} string, matched_entity_ids string")
    table = features.feature_table(lists, s1, targets, truth)
    assert table.columns == [S1_ID, CANDIDATE_ID, "label", *FEATURE_COLUMNS] or set(table.columns) == {
        S1_ID, CANDIDATE_ID, "label", *FEATURE_COLUMNS
    }
    got = {(r[S1_ID], r[CANDIDATE_ID]): r for r in table.collect()}
    assert {k: r.label for k, r in got.items()} == {("S1-1", "S2-1"): 1, ("S1-1", "S2-2"): 0, ("S1-2", "S3-1"): 0}
    r = got["S1-1", "S2-1"]
    assert (r.name_ratio, r.address_ratio, r.country_match, r.numeric_overlap, r.address_length_diff) == (1, 1, 1, 1, 0)
    r = got["S1-1", "S2-2"]
    assert r.name_ratio == pytest.approx(brute.ratio("acme", "umbrella"))
    assert r.name_partial_ratio == pytest.approx(brute.partial_ratio("acme", "umbrella"))
    assert r.address_token_set_ratio == pytest.approx(brute.token_set_ratio("123 main st", "999 zombie ln"))
    assert dict(table.dtypes) == {
        **{c: "double" for c in FEATURE_COLUMNS}, "country_match": "int", "name_length_diff": "int",
        "address_length_diff": "int", S1_ID: "string", CANDIDATE_ID: "string", "label": "int",
    }
    assert "label" not in features.feature_table(lists, s1, targets).columns


def test_empty_truth_gives_zero_labels(spark, prepared):
    s1, targets = prepared
    pairs = spark.createDataFrame([("S1-1", "S2-1")], f"{S1_ID} string, {CANDIDATE_ID} string")
    labelled = features.label_pairs(pairs, pairs.limit(0))
    assert [r.label for r in labelled.collect()] == [0]


def test_one_python_step(spark, prepared):
    """All alignment scores of a pair go through a single Arrow exchange."""
    s1, targets = prepared
    pairs = s1.select(F.col("entity_id").alias(S1_ID), F.lit("S2-1").alias(CANDIDATE_ID))
    scored = features.score_pairs(features.pair_attributes(pairs, s1, targets))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_records_are_split_before_they_meet(spark):
    """Words and numbers are taken once from each record; what comes of it is the same, also for nulls, blanks and repeats."""
    schema = "entity_id string, name_norm string, address_norm string, country_norm string, source string"
    texts = [("a b b", "1 elm 1 2", "us"), ("a b b", None, None), ("a  b", "", "us"), (" ", "7", ""), ("a b c", "2 elm", "us"), ("a b", " 12 é ", "us")]
    ours = spark.createDataFrame([(f"S1-{i}", *t, "S1") for i, t in enumerate(texts)], schema)
    theirs = spark.createDataFrame([(f"S2-{i}", *t, "S2") for i, t in enumerate(texts * 2)], schema)
    parts = ["name_jaccard", "address_jaccard", "numeric_overlap", "country_match"]
    scored = [features.score_pairs(features.capped_attributes(ours, theirs, sets=s), parts, dealt=True) for s in (True, False)]
    once, often = (sorted(map(tuple, df.collect())) for df in scored)
    assert once == often and len(once) == 20
    plan = scored[0]._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join")[0]
    assert "split(" not in above and "regexp_extract_all" not in above and "array_intersect" in above
