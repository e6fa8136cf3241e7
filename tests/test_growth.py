"""What must not grow with the pairs: work of the alignment, rows held for a key, shuffles of pairs, rows of a task."""

from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from linkwell.functions import similarity as sim
from linkwell.operators import blocking, counted, evaluate, features, reports
from linkwell.operators.counted import profiles
from linkwell.operators.skew import spread_join
from linkwell.plans.index_pipeline import resolve_index
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import scratch_mark, scratch_since
from linkwell.streaming import linkage

RECORD = "entity_id string, name_norm string, address_norm string, country_norm string, source string"


@pytest.fixture(scope="module")
def odd_sides(spark):
    """Ids that come twice, with the same and with other fields, and null ids."""
    s1 = [("S1-1", "acme north", "1 elm st", "us", "S1"), ("S1-1", "acme north", "1 elm st", "us", "S1"),
          ("S1-2", "acme south", "", "us", "S1"), ("S1-2", "globe", "2 elm", "fr", "S1"), (None, "acme north", "3 elm", "us", "S1")]
    targets = [("S2-1", "acme north", "1 elm st", "us", "S2"), ("S2-1", "acme", "4 elm st", "us", "S2"),
               ("S3-1", "globe", "2 elm", "fr", "S3"), ("S3-1", "globe", "2 elm", "fr", "S3"), (None, "globe", "2 elm", "fr", "S3")]
    return spark.createDataFrame(s1, RECORD), spark.createDataFrame(targets, RECORD)


def rows(df):
    columns = sorted(df.columns)
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_windows_of_like_lengths_are_few(monkeypatch):
    """two names of 60 characters have one whole window, not a state for each start."""
    cells, real = [], sim._step
    monkeypatch.setattr(sim, "_step", lambda state, hits: (cells.append(sum(s.size for s in state)), real(state, hits)))
    sim.best_windows(["ab" * 30], ["ba" * 30])
    assert sum(cells) <= 10 * 60


def test_attributes_come_with_the_pairs(odd_sides):
    """the same rows as a join of the pairs, for repeated and null ids too, and no shuffle after the rules met."""
    got = features.capped_attributes(*odd_sides)
    want = features.pair_attributes(blocking.block_capped(*odd_sides), *odd_sides)
    assert rows(got) == rows(want) and sum(rows(got).values()) > 0
    assert set(got.columns) == set(want.columns)


def test_labels_by_groups(spark, odd_sides):
    groups = spark.createDataFrame(
        [("S1-1", "x"), ("S1-2", "y"), ("S1-2", "z"), ("S2-1", "x"), ("S3-1", "z"), ("S3-1", None), (None, "x")], "entity_id string, truth_key string")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S3-1")], f"{S1_ID} string, {CANDIDATE_ID} string")
    got = features.label_by_groups(features.capped_attributes(*[features.with_groups(side, groups) for side in odd_sides], carried=("groups",)))
    want = features.label_pairs(features.pair_attributes(blocking.block_capped(*odd_sides), *odd_sides), pairs)
    assert rows(got) == rows(want) and {r.label for r in got.collect()} == {0, 1}


def test_joins_of_many_pairs_have_many_tasks(spark):
    """tasks follow the pairs, not the bytes of the records."""
    left = spark.range(40).select(F.col("id").cast("string").alias("l"), (F.col("id") % 5).alias("k"))
    right = spark.range(40).select(F.col("id").cast("string").alias("r"), (F.col("id") % 5).alias("k"))
    for cells in (1_000, 4):
        got = spread_join(left, right, ["k"], "l", "r", rows_per_cell=cells, pairs_per_task=32)
        assert got.rdd.getNumPartitions() == 10
        assert rows(got) == rows(left.join(right, "k"))


@pytest.mark.parametrize("tasks", [1, 5])
def test_groupings_of_pairs_in_tasks(spark, tasks):
    """pairs are dealt out before they are combined."""
    scored = spark.createDataFrame(
        [("a", "x", 1, 0.9), ("a", "x", 0, 0.1), ("a", "y", 0, 0.9), ("b", "x", 1, 0.2)], f"{S1_ID} string, {CANDIDATE_ID} string, label int, match_probability double")
    found = evaluate.entity_f05(scored, 0.5, tasks)
    assert {(r[0], r.tp, r.fp, r.fn) for r in found.collect()} == {("a", 1, 1, 0), ("b", 0, 0, 1)}
    diff = reports.multiset_diff(scored.select(S1_ID), scored.filter("label = 1").select(S1_ID), tasks)
    assert {(r[0], r.n_old, r.n_new, r.status) for r in diff.collect()} == {("a", 3, 1, "fewer"), ("b", 1, 1, "same")}
    for df in (found, diff):
        assert ("REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()) == (tasks > 1)


class State(dict):
    containsKey = dict.__contains__  # noqa: N815
    updateValue = dict.__setitem__  # noqa: N815

    def iterator(self):
        return iter(list(self.items()))


def test_a_key_holds_rows_of_records_not_of_pairs():
    """Spark holds all rows of a key until its last one."""
    meeting = linkage._meeting()
    meeting.ours, meeting.theirs = State(), State()
    came = lambda ours, ids: [SimpleNamespace(ours=ours, entity_id=i, name_norm=f"n{i[1:]}") for i in ids]
    met = lambda *new: list(meeting.handleInputRows((4, "us", "name", 0), iter([r for some in new for r in some]), None))
    ids = lambda p, n, m: [f"{p}{i}" for i in range(n, m)]
    out = met(came(True, ids("a", 0, 300)), came(False, ids("b", 0, 300)))
    out += met(came(True, ids("a", 300, 400)), came(False, ids("b", 200, 500)))
    assert len(out) < 10
    pairs = Counter((x["id"], y["id"]) for r in out for x in r.ones for y in r.others if r.by_name or x["name"] != y["name"])
    assert pairs == Counter((a, b) for a in ids("a", 0, 400) for b in ids("b", 0, 500) if a[1:] != b[1:])


def test_resolving_by_index_writes_no_pairs(random_sides):
    """only records and counts of keys are written."""
    at = scratch_mark()
    lists = resolve_index(*random_sides, lambda f: f.withColumn("match_probability", F.col("name_jaccard")), 0.6)
    assert any(r.matched_entity_ids for r in lists.collect())
    assert not [p for p in scratch_since(at) if "/index-" in p]


@pytest.mark.parametrize("most", [2, 10])
def test_totals_of_tokens_without_pairs(spark, random_sides, monkeypatch, most):
    """the same totals as of the pairs, also for ids that come twice and null ones; short names aren't paired."""
    repeated = [
        spark.createDataFrame([("x", "a bcd efg efg", "", "us", s), ("x", "bcd hij", "", "us", s), ("x", "bcd hij", "", None, s), ("y", "efg bcd hij klm", "", "us", s),
                               ("y", "", "", "us", s), ("z", None, "", "us", s), ("w", "alone" + s, "", "us", s)], RECORD) for s in ("S1", "S2")]
    for sides in [repeated] if most == 2 else [random_sides, repeated, [df.limit(0) for df in repeated]]:
        want = counted.candidate_totals(counted.counted_pairs(blocking.block_token, *sides))
        got = counted.token_totals(*sides, most_tokens=most)
        assert got.dtypes == want.dtypes and got.collect() == want.collect()
    if most == 10:
        monkeypatch.setattr(counted, "block_token", None)
        assert counted.token_totals(*random_sides).first().record_pairs > 0


@pytest.mark.parametrize("rule", [blocking.block_token, blocking.block_exact_name, lambda a, b: blocking.block_prefix(a, b, 4)])
def test_sizes_come_with_the_pairs(spark, random_sides, odd_sides, rule):
    """F8: the same rows as a join of the pairs with the sizes, for repeated and null ids too, and no such join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for sides in (random_sides, odd_sides):
            left, right = (profiles(side) for side in sides)
            sizes = [side.select(F.col("entity_id").alias(key), F.col("n").alias(n)) for side, key, n in ((left, S1_ID, "n_s1"), (right, CANDIDATE_ID, "n_targets"))]
            got = counted.counted_pairs(rule, *sides)
            assert rows(got) == rows(rule(left, right).join(sizes[0], S1_ID).join(sizes[1], CANDIDATE_ID)) and not got.isEmpty()
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert f"SortMergeJoin [{S1_ID}" not in plan and f"SortMergeJoin [{CANDIDATE_ID}" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_of_many_tokens_meet_once(spark):
    """tokens are compared only where bits of earlier ones agree, as they do by chance among names of very many tokens."""
    names = [" ".join(f"t{i * k % 997:03d}" for i in range(1, 40)) for k in range(1, 30)] + ["", "ab", "t001 t001", "zzz aaa"]
    side = lambda p: spark.createDataFrame([(f"{p}-{i}", n, "", "us", p) for i, n in enumerate(names)], RECORD)
    got = blocking.block_token(side("S1"), side("S2"))
    tokens = [{t for t in n.split() if len(t) >= 3} for n in names]
    want = Counter((f"S2-{j}", f"S1-{i}") for i, a in enumerate(tokens) for j, b in enumerate(tokens) if a & b)
    assert rows(got) == want
    assert "array_intersect" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("per_task", [blocking.PAIRS_PER_TASK, 50])
def test_lists_without_pairs(spark, random_sides, odd_sides, per_task):
    """the same lists as of the pairs, for repeated and null ids and countries too; no pair by prefix is shuffled."""
    nulls = [df.withColumn("country_norm", F.when(F.col("country_norm") != "fr", F.col("country_norm"))) for df in random_sides]
    copies = [df.unionByName(df.filter("entity_id like '%7'").withColumn("name_norm", F.lit("globe inn"))) for df in random_sides]
    for sides in (random_sides, odd_sides, nulls, copies, [df.limit(0) for df in random_sides]):
        pairs = blocking.block_index(*sides, max_token_candidates=3)
        listed = blocking.block_index(*sides, max_token_candidates=3, listed=True, pairs_per_task=per_task)
        assert rows(blocking.candidate_lists(sides[0], listed)) == rows(blocking.candidate_lists(sides[0], pairs))
    met = [blocking.block_index(*random_sides, max_token_candidates=3, listed=l) for l in (False, True)]
    assert rows(met[0]) == rows(met[1].withColumn(CANDIDATE_ID, F.explode(CANDIDATE_ID)))
