"""Incremental linkage: any cut of the input, and a restart, give the pairs of the batch rules."""

import random

from pyspark.sql import functions as F

import brute
from linkwell.session import scratch_path
from linkwell.streaming.linkage import link_files

SCHEMA = "entity_id string, name_norm string, country_norm string, source string"


def run(spark, parts, restart=False, **how):
    raw, out, state = (scratch_path(spark, n) for n in ("raw", "pairs", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(raw)
        if restart or i == len(parts) - 1:
            query = link_files(spark, raw, out, state, schema, **how)
            query.awaitTermination()
            assert query.exception() is None
    found = [tuple(r) for r in spark.read.schema("source1_entity_id string, candidate_entity_id string").parquet(out).collect()]
    assert len(found) == len(set(found)), "pairs repeat"
    return set(found)


def records(random_sides):
    rows = [tuple(r) for side in random_sides for r in side.select("entity_id", "name_norm", "country_norm", "source").collect()]
    return rows[::3] + rows[1::9]


def wanted(rows):
    dicts = [dict(zip(("entity_id", "name_norm", "country_norm", "source"), r)) for r in rows]
    ours, theirs = ([d for d in dicts if (d["source"] == "S1") == s] for s in (True, False))
    return brute.exact(ours, theirs) | brute.prefix(ours, theirs, 4)


def test_any_split_gives_the_pairs_of_the_batch(spark, random_sides):
    rows = records(random_sides)
    every = wanted(rows)
    assert every and run(spark, [rows]) == every
    random.Random(3).shuffle(rows)
    n = len(rows) // 3
    again = rows[:5] + [("S1-none", None, "us", "S1"), (None, "acme", "us", "S2"), ("S2-empty", "", "us", "S2")]
    assert run(spark, [rows[:n], rows[n : 2 * n] + again, rows[2 * n :]], restart=True, cells=2, files_per_batch=1) == every


def test_keys_are_cut_into_cells(spark, random_sides):
    from linkwell.streaming.linkage import block_keys

    frame = spark.createDataFrame(records(random_sides), SCHEMA)
    keyed = block_keys(frame, cells=3)
    ours, theirs = keyed.filter("ours"), keyed.filter("not ours")
    key = ["by", "country", "key", "cell"]
    met = ours.join(theirs.select(*key, F.col("entity_id").alias("other")), key).groupBy("by", "entity_id", "other").count()
    assert met.filter("count != 1").count() == 0 and met.count() > 0
