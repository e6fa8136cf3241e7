"""Running sums, ranks and lags over ranges, against a plain loop."""

import random

import pytest

from linkwell.operators.running import running

SCHEMA = "g string, k int, v bigint, row_number string, note string"


def by_force(rows, grouped):
    """(group, key, value, number, sum, value before) of each row, in the order of key; rows are told apart by value."""
    out, state = [], {}
    for g, k, v, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0)):
        n, total, last = state.get(g if grouped else 0, (0, None, None))
        total = total if v is None else v + (total or 0)
        out.append((g, k, v, n + 1, total, last))
        state[g if grouped else 0] = (n + 1, total, v)
    return sorted(out, key=repr)


def some_rows(n=400):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.randint(0, 6), rng.randint(-50, 50)) for _ in range(n)]
    rows += [(None, None, 5), ("a", None, None), ("single", 3, None), rows[0], rows[0]]
    return [(*r, "x", "y") for r in rows]


@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("ranges", [1, 7])
def test_running_equals_a_loop(spark, grouped, ranges):
    rows = some_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = running(
        frame, ["k", "v"], by=["g"] if grouped else [], sums={"total": "v"}, lags={"last": "v"}, ranges=ranges
    )
    assert made.columns == ["g", "k", "v", "note", "row_number", "total", "last"]
    found, wanted = [tuple(r) for r in made.drop("note").collect()], by_force(rows, grouped)
    if not grouped:  # rows of several groups agree in both keys
        found, wanted = [r[1:] for r in found], [r[1:] for r in wanted]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_a_key_of_all_rows_is_cut(spark):
    """All rows agree in all keys: still no range holds them all, and numbers have no gap."""
    frame = spark.createDataFrame([("hot", 1, 1, "x", "y")] * 1000, SCHEMA)
    made = running(frame, ["k"], by=["g"], sums={"total": "v"}, ranges=8)
    assert sorted(r.row_number for r in made.collect()) == list(range(1, 1001))
    assert all(r.total == r.row_number for r in made.collect())
    held = made._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_range" in held


def test_running_over_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert running(frame, ["k"], sums={"total": "v"}, lags={"last": "v"}).count() == 0
