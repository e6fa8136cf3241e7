"""Exact search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwell.llm import topk

VECTORS = "vec_id bigint, embedding array<float>, label int, row string, id string, v string, score string, size string, part string"


def best_by_force(given, k=5, every=50):
    """(query id, rank, id, score) of all pairs of rows, scored one by one."""
    whole = [
        (key, [math.floor(256 * float(np.float32(x))) for x in e])
        for key, e in given
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, (key, e) in enumerate(whole):
        if key is None or key % every:
            continue
        found = [(-sum(a * b for a, b in zip(e, c)), other is None, other or 0) for j, (other, c) in enumerate(whole) if j != i]
        out += [(key, r + 1, None if none else other, -score) for r, (score, none, other) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found_by(spark, given, every=50, **how):
    frame = spark.createDataFrame([(k, e, 1, *["x"] * 6) for k, e in given], VECTORS)
    return sorted((tuple(r) for r in topk.top_k(frame, F.col("id") % every == 0, **how).collect()), key=repr)


def odd_vectors():
    rng = random.Random(4)
    some = lambda n, scale=0.2: [rng.gauss(0, scale) for _ in range(n)]
    given = [(i, some(40)) for i in range(300)]
    same = some(40)
    given += [(i, same) for i in range(300, 420)]  # ties beyond k
    given += [(50, same), (50, same), (50, some(40)), (-50, some(40)), (None, same), (None, some(40)), (None, None)]
    given += [(500, None), (550, [None] * 40), (600, [float("nan")] + same[1:]), (650, [float("-inf")] + same[1:])]
    given += [(700, []), (750, some(3)), (800, some(200)), (850, [0.0] * 40), (900, some(40, 40.0)), (950, some(40, 90_000.0)), (951, some(1))]
    rng.shuffle(given)
    return given


def test_top_k_of_odd_vectors(spark):
    given = odd_vectors()
    wanted = best_by_force(given)
    assert found_by(spark, given) == wanted
    assert found_by(spark, given, group_cells=1500, least_group_cells=100) == wanted  # many groups and parts of the queries
    assert found_by(spark, given[:3], every=1) == best_by_force(given[:3], every=1)
    assert found_by(spark, []) == []


def test_bounds_leave_few_pairs_and_change_nothing(monkeypatch):
    """Clusters: after the first steps almost no pair is left, and the result is that of all pairs."""
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 60, (40, 96))
    values = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 4, (4000, 96))).astype(np.int64)
    ids = np.arange(4000)
    make = lambda lo, hi: topk.Block(values[lo:hi].ravel(), np.full(hi - lo, 96), ids[lo:hi], ids[lo:hi], np.zeros(hi - lo, bool))
    blocks = [make(lo, lo + 1000) for lo in range(0, 4000, 1000)]
    queries, own = values[::50], ids[::50]
    at, found, _, score = topk.best_of(blocks, queries, own, 5)
    every = queries @ values.T
    every[np.arange(len(own)), own] = -(10**9)
    order = np.lexsort((np.broadcast_to(ids, every.shape), -every), axis=1)[:, :5]
    assert found.reshape(-1, 5).tolist() == order.tolist() and at.tolist() == np.repeat(np.arange(len(own)), 5).tolist()
    assert score.reshape(-1, 5).tolist() == np.take_along_axis(every, order, 1).tolist()
    least = score.reshape(-1, 5)[:, -1]
    got = blocks[0].search(queries, own, least, 5)
    assert len(got[0]) < 0.01 * len(queries) * 1000
    # the same where numbers are so large that floats don't hold the scores
    large = topk.Block((values[:1000] << 22).ravel(), np.full(1000, 96), ids[:1000], ids[:1000], np.zeros(1000, bool))
    at, found, _, score = topk.best_of([large], queries << 10, own, 5)
    exact = [[sum(int(a) * int(b) for a, b in zip(q, c)) << 32 for c in values[:1000]] for q in queries[:3]]
    for i, row in enumerate(exact):
        row[own[i]] = -(1 << 62)
        wanted = sorted(range(1000), key=lambda j: (-row[j], j))[:5]
        assert found[at == i].tolist() == wanted and score[at == i].tolist() == [row[j] for j in wanted]
    with pytest.raises(OverflowError):
        topk.best_of([large], queries << 30, own, 5)


def test_search_sends_queries_to_all_groups_and_joins_no_rows(spark):
    frame = spark.createDataFrame([(i, [float(i), 1.0], 1, *["x"] * 6) for i in range(100)], VECTORS)
    plan = topk.top_k(frame, F.col("id") % 50 == 0, group_cells=64)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan and "WindowGroupLimit" in plan
