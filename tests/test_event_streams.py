"""Sessions and interval joins of streams against the batch form, late rows, the size of the state."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linkwell.session import scratch_path
from linkwell.streaming import events as streams

SCHEMA = "k string, ts timestamp, v double, kind string"
START = datetime(2024, 1, 1)


def some_events(n=240):
    rng = random.Random(19)
    at = lambda: START + timedelta(minutes=rng.randint(0, 4000))
    rows = [(rng.choice(["hot", "hot", "a", "b", "c"]), at(), rng.random(), rng.choice(["x", "y"])) for _ in range(n)]
    return sorted(rows, key=lambda r: r[1])


def closing(kind):
    return (f"_{kind}", START + timedelta(days=30), None, kind)


def written(spark, parts):
    raw = scratch_path(spark, "events")
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(raw)
    return raw


def run_sessions(spark, parts, delay="3 hours"):
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    schema = spark.createDataFrame([], SCHEMA).schema
    query = streams.session_files(spark, written(spark, parts), out, state, schema, ["k"], "ts", "90 minutes", delay, "v", files_per_batch=1)
    query.awaitTermination()
    return {tuple(r) for r in spark.read.parquet(out).collect()}, query


@pytest.fixture(scope="module")
def batch(spark):
    return {tuple(r) for r in streams.sessions(spark.createDataFrame(some_events(), SCHEMA), ["k"], "ts", "90 minutes", "v").collect()}


def by_force(rows):
    out, open_ = [], {}
    for k, ts, v, _ in rows:
        first, end, n, most = open_.get(k, (None, None, 0, None))
        if end is not None and ts > end:
            out.append((k, first, end, n, most))
            first, n, most = None, 0, None
        open_[k] = (first or ts, ts + timedelta(minutes=90), n + 1, v if most is None else max(most, v))
    return {*out, *((k, *s) for k, s in open_.items())}


def test_sessions_in_any_order_within_the_delay(spark, batch):
    rows = some_events()
    assert batch == by_force(rows)
    # each file spans more than the delay, but none comes later than that behind the file before
    rng = random.Random(20)
    cuts = [rows[i : i + 60] for i in range(0, len(rows), 60)]
    for a, b in zip(cuts, cuts[1:]):
        last = max(r[1] for r in a)
        late = [r for r in a if last - r[1] <= timedelta(hours=2) and rng.random() < 0.5]
        for r in late:
            a.remove(r)
            b.append(r)
        rng.shuffle(b)
    found, query = run_sessions(spark, [*cuts, [closing("x")]])
    assert found == batch and streams.late_rows(query) == 0
    assert streams.state_rows(query)[-1] == 1  # the one that closed the others


def test_rows_behind_the_watermark_are_counted(spark, batch):
    rows = some_events()
    lost = ("a", START - timedelta(days=1), 1.0, "x")
    found, query = run_sessions(spark, [rows, [closing("x")], [lost]])
    assert found == batch and streams.late_rows(query) == 1


def test_followed_by_equals_the_batch_and_forgets(spark):
    rows = some_events()
    raw = written(spark, [*[rows[i : i + 60] for i in range(0, len(rows), 60)], [closing("x"), closing("y")]])
    schema = spark.createDataFrame([], SCHEMA).schema

    def sides(df):
        return (
            df.filter("kind = 'x'").select("k", F.col("ts").alias("a"), F.col("v").alias("av")),
            df.filter("kind = 'y'").select("k", F.col("ts").alias("b"), F.col("v").alias("bv")),
        )

    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    stream = lambda: streams.read_events(spark, raw, schema, "ts", "3 hours", 1)
    met = streams.followed_by(sides(stream())[0], sides(stream())[1], ["k"], "a", "b", "45 MINUTES")
    query = streams.append(met, out, state)
    query.awaitTermination()
    again = streams.followed_by(*sides(spark.createDataFrame(rows, SCHEMA)), ["k"], "a", "b", "45 MINUTES")
    found, wanted = (sorted(map(tuple, df.collect()), key=repr) for df in (spark.read.parquet(out), again))
    assert found == wanted and any(r[-1] is None for r in found)
    span = [(k, ts) for k, ts, _, kind in rows if kind == "x"]
    count = sum(max(1, sum(q[3] == "y" and q[0] == k and timedelta() <= q[1] - ts <= timedelta(minutes=45) for q in rows)) for k, ts in span)
    assert len(found) == count
    assert max(streams.state_rows(query)) < len(rows) and streams.state_rows(query)[-1] <= 2
