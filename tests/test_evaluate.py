import random

import pytest
from pyspark.sql import functions as F

from linkwell.functions import metrics
from linkwell.operators import evaluate
from linkwell.schema import CANDIDATE_ID, S1_ID

SCHEMA = f"{S1_ID} string, {CANDIDATE_ID} string, label int, match_probability double"


@pytest.mark.parametrize("tp,fp,fn,p,r,f", [
    (10, 0, 10, 1.0, 0.5, 0.8333), (10, 10, 0, 0.5, 1.0, 0.5556), (0, 10, 5, 0.0, 0.0, 0.0), (0, 0, 0, 0.0, 0.0, 0.0),
])
def test_rates(spark, tp, fp, fn, p, r, f):
    a, b, c = F.lit(tp), F.lit(fp), F.lit(fn)
    row = spark.range(1).select(metrics.precision(a, b), metrics.recall(a, c), metrics.f05(a, b, c)).first()
    assert tuple(row) == pytest.approx((p, r, f), abs=1e-4)


def f05(tp, fp, fn):
    p = tp / (tp + fp) if tp + fp else 0.0
    r = tp / (tp + fn) if tp + fn else 0.0
    return 1.25 * p * r / (0.25 * p + r) if p + r else 0.0


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    grid = evaluate.THRESHOLDS + [0.0, 1.0, 0.499, 0.951, 0.7300000001]
    rows = [(f"S1-{rng.randint(0, 40)}", f"S2-{i}", int(rng.random() < 0.4), rng.choice(grid)) for i in range(600)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def at(rows, t):
    tp = sum(1 for r in rows if r[2] == 1 and r[3] >= t)
    fp = sum(1 for r in rows if r[2] == 0 and r[3] >= t)
    return tp, fp, sum(1 for r in rows if r[2] == 1) - tp


def macro(rows, t):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    scores = []
    for g in groups.values():
        true, chosen = {r[1] for r in g if r[2] == 1}, {r[1] for r in g if r[3] >= t}
        scores.append(f05(len(true & chosen), len(chosen - true), len(true - chosen)) if true | chosen else 1.0)
    return sum(scores) / len(scores)


def test_sweep_equals_single_counts(data):
    rows, df = data
    got = {r.threshold: (r.tp, r.fp, r.fn) for r in evaluate.threshold_sweep(df).collect()}
    assert got == {t: at(rows, t) for t in evaluate.THRESHOLDS}
    assert len(got) == 46


def test_micro_and_macro(data):
    rows, df = data
    for t in (0.5, evaluate.THRESHOLDS[17], 2.0):
        r = evaluate.micro_metrics(df, t).first()
        assert (r.tp, r.fp, r.fn) == at(rows, t) and r.f05 == pytest.approx(f05(*at(rows, t)))
        assert evaluate.entity_macro_f05(df, t).first()[0] == pytest.approx(macro(rows, t))


def test_select(data):
    rows, df = data
    best = max(evaluate.THRESHOLDS, key=lambda t: (f05(*at(rows, t)), -t))
    r = evaluate.select_threshold(df).first()
    assert (r.threshold, r.f05) == (round(best, 2), pytest.approx(f05(*at(rows, best))))
    assert r.entity_macro_f05 == pytest.approx(macro(rows, best))


def test_ties_take_the_lowest(spark):
    df = spark.createDataFrame([("a", "x", 1, 0.99), ("a", "y", 0, 0.1)], SCHEMA)
    assert tuple(evaluate.select_threshold(df).first()) == (0.5, 1.0, 1.0, 1.0, 1.0)


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([("a", "x", 1, 0.9), ("a", "x", 1, 0.2), ("b", "y", 0, 0.1)], SCHEMA)
    assert evaluate.entity_macro_f05(df, 0.5).first()[0] == 1.0
    assert evaluate.entity_macro_f05(df.limit(0), 0.5).first()[0] == 0.0
    assert evaluate.threshold_sweep(df.limit(0)).count() == 46
    assert evaluate.select_threshold(df.limit(0)).first().threshold == 0.5
