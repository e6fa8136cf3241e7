import pytest
from pyspark.sql import functions as F

import brute
from linkwell.operators import blocking, coverage
from linkwell.operators.skew import spread_join
from linkwell.schema import CANDIDATE_ID, S1_ID


def rows(df):
    return [r.asDict() for r in df.collect()]


def as_set(pairs):
    out = [tuple(r) for r in pairs.collect()]
    assert len(out) == len(set(out)), "pairs repeat"
    return set(out)


@pytest.fixture(scope="module")
def plain(random_sides):
    return tuple(rows(df) for df in random_sides)


# Cells of 3 rows cut nearly every key into a grid; the default cuts none.
CELLS = [3, 10_000]


@pytest.mark.parametrize("cells", CELLS)
def test_single_rules(random_sides, plain, cells):
    assert as_set(blocking.block_exact_name(*random_sides, rows_per_cell=cells)) == brute.exact(*plain)
    assert as_set(blocking.block_prefix(*random_sides, 4, rows_per_cell=cells)) == brute.prefix(*plain, 4)
    assert as_set(blocking.block_token(*random_sides, rows_per_cell=cells)) == brute.token(*plain)


@pytest.mark.parametrize("length,cap", [(4, 10), (4, 26), (6, 12), (6, 1000), (4, 0)])
def test_caps(random_sides, plain, length, cap):
    assert as_set(blocking.block_prefix(*random_sides, length, cap)) == brute.prefix(*plain, length, cap)


def test_cap_is_inclusive(random_sides, plain):
    counts = {(r.source, r.country_norm, r.name_prefix4): r.frequency for r in
              blocking.prefix_key_counts(random_sides[1], 4).collect()}
    top = max(counts.values())
    assert len(rows(blocking.eligible_prefix_keys(random_sides[1], 4, top))) == len(counts)
    assert len(rows(blocking.eligible_prefix_keys(random_sides[1], 4, top - 1))) == sum(
        1 for n in counts.values() if n < top
    )


@pytest.mark.parametrize("cells", CELLS)
@pytest.mark.parametrize("cap", [1, 4, 200])
def test_token_cap(random_sides, plain, cap, cells):
    got = as_set(blocking.token_cap(*random_sides, cap=cap, rows_per_cell=cells))
    assert got == brute.token_cap(*plain, cap)


@pytest.mark.parametrize("cells", CELLS)
def test_combinations(random_sides, plain, cells):
    index = as_set(blocking.block_index(*random_sides, 4, rows_per_cell=cells))
    assert index == brute.exact(*plain) | brute.prefix(*plain, 4) | brute.token_cap(*plain, 4)
    for caps in ((10, 12), (0, 5), (500, 1000)):
        assert as_set(blocking.block_capped(*random_sides, *caps, rows_per_cell=cells)) == brute.capped(*plain, *caps)


def test_sample(prepared):
    found = as_set(blocking.block_index(*prepared))
    assert {("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-3", "S3-2")} <= found


def test_spread_join_grid(spark):
    left = spark.range(40).select(F.col("id").cast("string").alias("l"), (F.col("id") % 2).alias("k"))
    right = spark.range(30).select(F.col("id").cast("string").alias("r"), (F.col("id") % 3).alias("k"))
    got = spread_join(left, right, ["k"], "l", "r", rows_per_cell=4)
    want = left.join(right, "k")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_key_stats(random_sides):
    stats = {(r.source, r.prefix_length): r for r in blocking.blocking_key_stats(random_sides[1], {4: 10, 6: 12}).collect()}
    counts = [r.frequency for r in blocking.prefix_key_counts(random_sides[1], 6).filter("source = 'S3'").collect()]
    r = stats["S3", 6]
    assert (r.total_keys, r.max_frequency, r.eligible_keys) == (len(counts), max(counts), sum(c <= 12 for c in counts))
    assert r.avg_frequency == pytest.approx(sum(counts) / len(counts))


def test_candidate_lists(random_sides, plain):
    s1, targets = random_sides
    pairs = blocking.block_capped(s1, targets, 10, 12)
    stranger = pairs.limit(1).select(F.lit("S1-none").alias(S1_ID), CANDIDATE_ID)
    got = {r[0]: r[1] for r in blocking.candidate_lists(s1, pairs.unionByName(pairs).unionByName(stranger)).collect()}
    want = {r["entity_id"]: [] for r in plain[0]}
    for a, b in brute.capped(*plain, 10, 12):
        want[a].append(b)
    assert got == {a: ",".join(sorted(b)) for a, b in want.items()}


@pytest.mark.parametrize("caps", [(10, 12), (0, 5), (500, 1000), (0, 0)])
def test_counts_without_pairs(random_sides, caps):
    s1, targets = random_sides
    by_keys = coverage.capped_candidate_counts(s1, targets, *caps)
    by_pairs = coverage.pair_candidate_counts(s1, blocking.block_capped(s1, targets, *caps))
    assert sorted(map(tuple, by_keys.collect())) == sorted(map(tuple, by_pairs.collect()))


def test_coverage_and_distribution(spark):
    counts = spark.createDataFrame([(0, 4), (1, 1), (2, 1), (3, 1), (10, 1)], "n_candidates bigint, n_s1 bigint")
    assert tuple(coverage.candidate_coverage(counts).first()) == (16, 4, 8, 50.0)
    r = coverage.candidate_distribution(counts).first()
    assert tuple(r) == pytest.approx((4.0, 2.5, 8.95, 9.79, 10))
    assert tuple(coverage.candidate_coverage(counts.limit(0)).first()) == (0, 0, 0, 0.0)
    assert tuple(coverage.candidate_distribution(counts.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_size_report(spark):
    lists = spark.createDataFrame([("a", "x, y,x"), ("b", None), ("c", " ,"), ("d", "z")], f"{S1_ID} string, candidate_entity_ids string")
    assert tuple(coverage.blocking_size_report(lists).first()) == (4, 0.75, 2, 2)


def test_recall(spark):
    truth = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("b", "z")], f"{S1_ID} string, {CANDIDATE_ID} string")
    found = spark.createDataFrame([("a", "x"), ("b", "z"), ("b", "z"), ("b", "q")], truth.schema)
    assert tuple(coverage.blocking_recall(truth, found).first()) == (3, 2, 2, 1, 2 / 3, 1 / 2)
    assert tuple(coverage.blocking_recall(truth.limit(0), found).first()) == (0, 0, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("caps", [(10, 12), (0, 5), (500, 1000)])
def test_reached_by_keys(random_sides, plain, caps):
    s1, targets = random_sides
    every = s1.select(F.col("entity_id").alias(S1_ID)).join(
        targets.select(F.col("entity_id").alias(CANDIDATE_ID)), F.lit(True)
    )
    assert as_set(coverage.reached_by_capped_rules(every, s1, targets, *caps)) == brute.capped(*plain, *caps)


def test_empty_sides(random_sides):
    s1, targets = random_sides
    for a, b in ((s1.limit(0), targets), (s1, targets.filter(F.lit(False))), (s1.filter(F.lit(False)), targets.limit(0))):
        assert blocking.block_index(a, b).count() == 0
        assert blocking.block_capped(a, b, 1, 1).count() == 0
        assert coverage.candidate_coverage(coverage.capped_candidate_counts(a, b)).first().total_pairs == 0
