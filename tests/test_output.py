import pytest

from linkwell.operators import output
from linkwell.schema import CANDIDATE_ID, S1_ID

SCORED = f"{S1_ID} string, {CANDIDATE_ID} string, match_probability double"
MATCHES = f"{S1_ID} string, matched_entity_ids string"
CANDIDATES = f"{S1_ID} string, candidate_entity_ids string"


def test_match_lists(spark):
    scored = spark.createDataFrame(
        [("a", "S3-1", 0.9), ("a", "S2-1", 0.8), ("a", "S2-1", 0.85), ("a", "S2-2", 0.79), ("z", "S2-9", 1.0)], SCORED
    )
    candidates = spark.createDataFrame([("a", "S2-1"), ("b", None), ("a", "S2-2")], CANDIDATES)
    assert dict(map(tuple, output.match_lists(scored, candidates).collect())) == {"a": "S2-1,S3-1", "b": ""}
    assert dict(map(tuple, output.match_lists(scored, candidates, 0.9).collect())) == {"a": "S3-1", "b": ""}


def check(spark, sample, matches, candidates):
    s1, s2, s3 = sample
    got = output.validate_output(
        spark.createDataFrame(matches, MATCHES), spark.createDataFrame(candidates, CANDIDATES), s1, s2, s3
    )
    return sorted(map(tuple, got.collect()), key=str)


GOOD = [("S1-1", "S2-1"), ("S1-2", "S3-1, S2-2"), ("S1-3", None)]
OFFERED = [("S1-1", "S2-1,S2-2"), ("S1-2", "S2-2,S3-1"), ("S1-3", "")]


def test_valid_output(spark, sample):
    assert check(spark, sample, GOOD, OFFERED) == []


@pytest.mark.parametrize("matches,candidates,expected", [
    (GOOD[:2], OFFERED, [("V3", None, "matching_results: 2")]),
    (GOOD, OFFERED[:2], [("V4", None, "candidate_pairs: 2")]),
    (GOOD[:2] + GOOD[:1], OFFERED, [("V5", "S1-1", "matching_results")]),
    ([("S1-1", "S2-1,S2-1")] + GOOD[1:], OFFERED, [("V6", "S1-1", "S2-1,S2-1")]),
    ([("S1-1", "S2-404")] + GOOD[1:], OFFERED, [("V8", "S1-1", "S2-404"), ("V9", "S1-1", "S2-404")]),
    ([("S1-1", "S3-2")] + GOOD[1:], OFFERED, [("V9", "S1-1", "S3-2")]),
    ([("S1-1", "X-1")] + GOOD[1:], OFFERED, [("V7", "S1-1", "X-1"), ("V8", "S1-1", "X-1"), ("V9", "S1-1", "X-1")]),
    ([("S1-1", "S2-1,")] + GOOD[1:], OFFERED, [("V7", "S1-1", ""), ("V8", "S1-1", ""), ("V9", "S1-1", "")]),
])
def test_violations(spark, sample, matches, candidates, expected):
    assert check(spark, sample, matches, candidates) == expected


def test_header(spark, sample):
    s1, s2, s3 = sample
    wrong = spark.createDataFrame(GOOD, f"id string, matched_entity_ids string")
    right = spark.createDataFrame(OFFERED, CANDIDATES)
    assert [tuple(r) for r in output.validate_output(wrong, right, s1, s2, s3).collect()] == [
        ("V12", None, "matching_results: id,matched_entity_ids")
    ]
