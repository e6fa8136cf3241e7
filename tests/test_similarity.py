import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from linkwell.functions import similarity as sim

SHORT = st.text(alphabet="abé 1", max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(SHORT, SHORT), min_size=1, max_size=8))
def test_batches_equal_definitions(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert list(sim.lcs_lengths(a, b)) == [brute.lcs(x, y) for x, y in pairs]
    assert all(abs(g - brute.partial_ratio(x, y)) < 1e-12 for g, (x, y) in zip(sim.best_windows(a, b), pairs))


def test_long_texts():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    sizes = [(63, 64), (64, 64), (64, 65), (65, 65), (70, 90), (3, 120), (66, 64)]
    a, b = [text(m) for m, _ in sizes], [text(n) for _, n in sizes]
    assert list(sim.lcs_lengths(a, b)) == [brute.lcs(x, y) for x, y in zip(a, b)]
    assert [round(v, 12) for v in sim.best_windows(a, b)] == [round(brute.partial_ratio(x, y), 12) for x, y in zip(a, b)]


def score(spark, make, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    return [r.x for r in df.select("i", make(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]


def test_fuzzy_columns(spark):
    rng = random.Random(5)
    words = ["acme", "acm", "north", "nord", "x", "1"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
    pairs = [(text(), text()) for _ in range(120)] + [("", ""), ("a", ""), ("kitten", "sitting")]
    for column, definition in (
        (sim.ratio, brute.ratio), (sim.partial_ratio, brute.partial_ratio), (sim.token_set_ratio, brute.token_set_ratio)
    ):
        got = score(spark, column, pairs)
        assert all(abs(g - definition(a, b)) < 1e-12 for g, (a, b) in zip(got, pairs)), column


def test_set_columns(spark):
    pairs = [("", ""), ("a", ""), (None, None), ("a b", "b c c"), ("a 1 22", "22 x 3 1")]
    assert score(spark, sim.jaccard, pairs) == [1.0, 0.0, 1.0, 1 / 3, 2 / 5]
    assert score(spark, sim.numeric_overlap, pairs) == [0.0, 0.0, 0.0, 0.0, 2 / 3]
    assert score(spark, sim.same_nonempty, [("", ""), ("us", "us"), ("us", "fr"), (None, None)]) == [0, 1, 0, 0]
    assert score(spark, sim.length_diff, [("", "abc"), (None, "é"), ("ab", "ab")]) == [3, 1, 0]
