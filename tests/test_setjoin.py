"""Set-similarity join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from linkwell.operators import setjoin

SCHEMA = "entity_id string, name_norm string, _left string, token string"


def sides(spark, hot=0, n=70):
    rng = random.Random(13)
    words = [f"w{int(rng.paretovariate(0.7)) % 25}" for _ in range(400)]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 7)))
    make = lambda s: (
        [(f"{s}{i}", name(), "x", "y") for i in range(n)]
        + [(f"{s}c{i}", "same old name", "x", "y") for i in range(15)]  # copies
        + [(f"{s}h{i}", f"hot r{i}", "x", "y") for i in range(hot)]  # a token of all
        + [(f"{s}r{i}", "  name same   old old", None, None) for i in range(3)]
        + [(f"{s}n", None, "x", "y"), (f"{s}e", "", "x", "y"), (f"{s}b", "   ", "x", "y"), (f"{s}l", " ".join(f"v{i}" for i in range(200)), "x", "y")]
    )
    return make("a"), make("b")


def similar(a, b, percent):
    a, b = set((a or "").split(" ")) - {""}, set((b or "").split(" ")) - {""}
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


@pytest.mark.parametrize("percent,cells", [(30, 10_000), (50, 4), (80, 10_000), (80, 4), (100, 10_000)])
def test_pairs_equal_brute_force(spark, percent, cells):
    ours, theirs = sides(spark, hot=40)
    made = setjoin.block_similar(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(theirs, SCHEMA), percent, rows_per_cell=cells)
    found = [tuple(r) for r in made.collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(x[0], y[0]) for x in ours for y in theirs if similar(x[1], y[1], percent)}


def test_only_rare_tokens_are_joined(spark):
    """Of ten tokens three are joined at 80 percent, the rare ones; a token of all classes is not."""
    rows = [(f"a{i}", "hot " + " ".join(f"t{i}x{j}" for j in range(9)), "x", "y") for i in range(20)]
    frame = setjoin.with_class(spark.createDataFrame(rows, SCHEMA))
    probes = setjoin._probes(setjoin.ordered_classes(frame, frame), "left", 80).collect()
    assert len(probes) == 20 * 3 and "hot" not in {r.token for r in probes}


def test_links_of_classes_count_their_records(spark):
    ours, theirs = sides(spark)
    links = setjoin.class_links(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(theirs, SCHEMA), 80).collect()
    pairs = sum(similar(x[1], y[1], 80) for x in ours for y in theirs)
    assert sum(r.n_s1 * r.n_targets for r in links) == pairs
    assert [r.n_s1 for r in links if r.left_class == r.right_class == "name old same"] == [18]


def test_empty_sides_and_wrong_thresholds(spark):
    ours, theirs = (spark.createDataFrame(s, SCHEMA) for s in sides(spark, n=3))
    assert setjoin.block_similar(ours.limit(0), theirs).count() == 0
    assert setjoin.block_similar(ours, theirs.limit(0)).count() == 0
    for bad in (0, 101):
        with pytest.raises(ValueError):
            setjoin.similar_classes(setjoin.with_class(ours), setjoin.with_class(theirs), bad)


def test_plan_has_no_product(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ours, theirs = (setjoin.with_class(spark.createDataFrame(s, SCHEMA)) for s in sides(spark, n=3))
    text = setjoin.similar_classes(ours, theirs).filter(F.col("overlap") > 0)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text and text.count("SortMergeJoin") == 1
