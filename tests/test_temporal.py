"""As-of and overlap joins against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from linkwell.operators import temporal

LEFT = "id int, k string, at int, _time string"
RIGHT = "rk string, rat int, rid int, value string, _left string"


def as_of_by_force(left, right, tolerance):
    out = []
    for row in left:
        _, k, at, *_ = row
        fits = [r for r in right if k is not None and at is not None and r[0] == k and r[1] is not None and r[1] <= at]
        best = max(fits, key=lambda r: (r[1], r[2] is not None, r[2] or 0), default=None)
        if best is not None and tolerance is not None and best[1] + tolerance < at:
            best = None
        out.append((row[0], best and best[2], best and best[3]))
    return sorted(out, key=repr)


def temporal_rows():
    rng = random.Random(14)
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
    time = lambda: None if rng.random() < 0.05 else rng.randint(0, 300)
    left = [(i, key(), time(), "x") for i in range(500)] + [(1000, "alone", 5, "x"), (1001, "hot", -5, "x")]
    right = [(key(), time(), i, f"v{i}" if i % 7 else None, "x") for i in range(200)]
    right += [("hot", 150, None, "tie", "x"), ("hot", 151, 900, "tie", "x"), ("hot", 151, 901, "tie", "x")]
    return left + left[:3], right  # repeated rows stay


@pytest.mark.parametrize("ranges", [1, 9])
@pytest.mark.parametrize("tolerance", [None, 0, 12])
def test_as_of_equals_a_loop(spark, ranges, tolerance):
    left, right = temporal_rows()
    made = temporal.as_of_join(
        spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).withColumnRenamed("rk", "k"),
        by=["k"], left_time="at", right_time="rat", take=["rid", "value"], ties=["rid"],
        tolerance=None if tolerance is None else F.lit(tolerance), ranges=ranges,
    )
    assert made.columns == ["id", "k", "at", "_time", "rid", "value"]
    found = sorted(((r.id, r.rid, r.value) for r in made.collect()), key=repr)
    assert found == as_of_by_force(left, right, tolerance)


def test_as_of_of_empty_tables_and_clashes(spark):
    left, right = temporal_rows()
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT).withColumnRenamed("rk", "k")
    how = {"by": ["k"], "left_time": "at", "right_time": "rat", "take": ["rid"]}
    assert temporal.as_of_join(a.limit(0), b, **how).count() == 0
    assert temporal.as_of_join(a, b.limit(0), **how).filter("rid is not null").count() == 0
    with pytest.raises(ValueError):
        temporal.as_of_join(a, b, **{**how, "take": ["k"]})


def test_as_of_takes_hot_keys_apart(spark):
    """All rows of one key: ranges hold parts of them, and windows run within ranges."""
    a = spark.createDataFrame([(i, "hot", i, "x") for i in range(1000)], LEFT)
    b = spark.createDataFrame([("hot", 0, 7, "v", "x")], RIGHT).withColumnRenamed("rk", "k")
    made = temporal.as_of_join(a, b, ["k"], "at", "rat", ["rid"], ranges=6)
    assert made.filter("rid = 7").count() == 1000
    text = made._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_range" in text


INTERVALS = "id int, k string, s bigint, e bigint, note string"


def overlaps_by_force(left, right, keyed):
    out = []
    for i, k, s, e, _ in left:
        for j, l, t, f, _ in right:
            if None not in (s, e, t, f) and s < e and t < f and s < f and t < e and (not keyed or (k is not None and k == l)):
                out.append((i, j))
    return sorted(out)


def interval_rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(150):
        length = int(rng.paretovariate(0.4)) % 5000
        s = rng.randint(-2000, 2000)
        out.append((i, rng.choice(["hot", "hot", "a", None]), s, s + length, "x"))
    return out + [(500, "hot", -(10**15), 10**15, "x"), (501, "a", 5, 5, "x"), (502, "a", 9, 2, "x"), (503, "a", None, 4, "x"), (504, "hot", 1, None, "x"), (505, "hot", -1, 0, "x"), (506, "hot", 0, 1, "x")]


@pytest.mark.parametrize("width,cells", [(1, 10_000), (64, 3), (10**6, 5)])
@pytest.mark.parametrize("keyed", [True, False])
def test_overlaps_equal_all_pairs(spark, width, cells, keyed):
    left, right = interval_rows(1), interval_rows(2)
    a = spark.createDataFrame(left, INTERVALS)
    b = spark.createDataFrame(right, INTERVALS)
    b = b.select(F.col("id").alias("rid"), *([] if not keyed else ["k"]), F.col("s").alias("t"), F.col("e").alias("f"))
    a = a.drop("note") if keyed else a.drop("k")
    made = temporal.overlap_join(a, b, ("s", "e"), ("t", "f"), "id", "rid", by=["k"] if keyed else [], width=width, rows_per_cell=cells)
    found = sorted((r.id, r.rid) for r in made.collect())
    assert found == overlaps_by_force(left, right, keyed)
    assert temporal.overlap_join(a.limit(0), b, ("s", "e"), ("t", "f"), "id", "rid").count() == 0 if not keyed else True


def test_a_long_interval_costs_its_own_bins(spark, monkeypatch):
    """One interval over everything: it is laid into two bins at most, and short ones into theirs on two levels."""
    sent = []
    real = temporal.spread_join

    def counted(left, right, *rest, **more):
        sent.append((left.count(), right.count()))
        return real(left, right, *rest, **more)

    monkeypatch.setattr(temporal, "spread_join", counted)
    short = [(i, "k", 10 * i, 10 * i + 1, "x") for i in range(1000)]
    a = spark.createDataFrame([*short, (5000, "k", -(10**12), 10**12, "x")], INTERVALS).drop("k", "note")
    b = spark.createDataFrame(short, INTERVALS).select(F.col("id").alias("rid"), F.col("s").alias("t"), F.col("e").alias("f"))
    assert temporal.overlap_join(a, b, ("s", "e"), ("t", "f"), "id", "rid").count() == 2000
    assert sent[0][0] <= 1002 and sent[0][1] <= 2000 and sent[1][1] == 1000
