"""Quality rules, toxicity, near duplicates."""

import math
import random
import zlib

import numpy as np
import pytest
from corpus_cases import CLASHES, SCHEMA, base_counts, linked_components, odd_rows, rows, sentence

from linkwell.llm import minhash, quality, queries, toxicity
from linkwell.llm.common import table
from linkwell.session import scratch_mark, scratch_since

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_against_brute_force(spark):
    texts = texts_of(spark, SMALL)
    found = queries.QUERIES["op6_distribution_divergence"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in BASE) == base_counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_quality_verdicts_follow_the_labels(spark):
    labels = {r.doc_id: r.quality for r in table(spark, MIDDLE, "labels").collect()}
    found = queries.QUERIES["op6_distribution_divergence"](spark, MIDDLE).collect()
    judged = [(labels[r.doc_id], r.kept) for r in found if r.doc_id in labels and not r.base_failed]
    good = [k for y, k in judged if y == 1]
    bad = [k for y, k in judged if y == 0]
    assert sum(good) / len(good) >= 0.98 and sum(bad) / len(bad) <= 0.4


def test_repeated_windows_when_hashes_collide(spark, monkeypatch):
    """With all position bits and few hash bits, neighbours are told apart by their words."""
    monkeypatch.setattr(quality, "INDEX_BITS", 60)
    texts = ["a b c d e f g h i a b c x y z x y z", "a b c d e f", "a a a a a", "p q r s p q r t p q r"]
    frame = spark.createDataFrame(rows(texts), SCHEMA)
    found = {r.text: r.n_repeat_words for r in quality.quality(frame, ["text"]).collect()}
    assert found == {t: base_counts(t)[4] for t in texts}


def test_quality_of_odd_rows(spark, odd):
    made = quality.quality(odd)
    assert made.count() == odd.count()
    # names of results replace columns of the input, all others stay
    assert set(CLASHES) - {"kept", "n_words"} <= set(made.columns)
    for r in made.select("text", *BASE).collect():
        assert tuple(r[c] for c in BASE) == base_counts(r.text)
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() < odd.count()
    assert quality.keep_good(odd.limit(0)).count() == 0


def test_js_distance(spark):
    frame = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.0, 0.0], [1.0, 0.0]), ([0.25, 0.75], [0.5, 0.5])], "p array<double>, q array<double>")
    far, same, empty, some = (r[0] for r in frame.select(quality.js_distance(frame.p, frame.q)).collect())
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x)
    m = [0.375, 0.625]
    assert (far, same, empty) == (1.0, 0.0, 0.0)
    assert some == pytest.approx(math.sqrt((kl([0.25, 0.75], m) + kl([0.5, 0.5], m)) / 2))


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    found = queries.QUERIES["op1_factorization_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert len(found) == len({r.doc_id for r in found}) == 10_000
    for r in found[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    judged = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    caught = sum(p for y, p in judged if y) / sum(y for y, _ in judged)
    wrong = sum(p for y, p in judged if not y) / sum(1 - y for y, _ in judged)
    assert caught >= 0.75 and wrong <= 0.01


def test_pairs_of_terms_are_learnt():
    """A text is toxic only if two words meet, which no sum of single weights can tell."""
    rng = np.random.default_rng(1)
    a, b = rng.random((2, 3000)) < 0.5
    noise = rng.integers(10, 200, (3000, 5))
    texts = [np.unique(np.concatenate([[1] * int(x), [2] * int(y), n]).astype(np.int64)) for x, y, n in zip(a, b, noise)]
    labels = (a == b).astype(int)
    m = toxicity.fit_machine(texts, labels)
    keep = np.full(toxicity.FEATURES, -1)
    keep[m.features] = np.arange(len(m.features))
    found = [keep[t] for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in found])])
    right = ((m.margins(np.concatenate(found), offsets) >= 0) == labels.astype(bool)).mean()
    assert right > 0.95


def test_pairs_of_rare_terms_are_learnt():
    """Hundreds of terms are more common than two that are toxic together and clean alone, so have no weight."""

    def drawn(seed, n=6000):
        rng = np.random.default_rng(seed)
        kind = rng.choice(4, n, p=[0.98, 0.005, 0.005, 0.01])
        toxic = rng.random(n) < 0.5
        own = [[], [1], [2], [1, 2]]
        texts = [np.unique([*own[k], *[3] * int(t), *(10 + rng.choice(600, 10, replace=False))]) for k, t in zip(kind, toxic)]
        return texts, np.where(kind == 3, 1, np.where(kind > 0, 0, toxic)).astype(int), kind

    texts, labels, _ = drawn(1)
    count = np.bincount(np.concatenate(texts))
    assert min((count > count[k]).sum() for k in (1, 2)) > 400
    m = toxicity.fit_machine(texts, labels)
    texts, labels, kind = drawn(2)
    keep = np.full(toxicity.FEATURES, -1)
    keep[m.features] = np.arange(len(m.features))
    found = [k[k >= 0] for k in (keep[t] for t in texts)]
    right = (m.margins(np.concatenate(found), np.concatenate([[0], np.cumsum([len(t) for t in found])])) >= 0) == labels
    assert right[kind == 3].mean() > 0.95 and right[(kind == 1) | (kind == 2)].mean() > 0.95


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(0, 1), (2, 0), (None, 1), (9, None), (999, 1), (2, 0)], "doc_id bigint, toxic int")
    made = toxicity.score(odd, toxicity.train(odd, labels))
    assert made.count() == odd.count() and "score" in made.columns and made.filter("score is null").count() == 0
    nothing = toxicity.train(odd, labels.limit(0))
    assert all(r.score == pytest.approx(0, abs=1e-6) for r in toxicity.score(odd, nothing).collect())
    assert toxicity.score(odd.limit(0), nothing).count() == 0


def test_near_duplicates_against_brute_force(spark):
    texts = texts_of(spark, SMALL)
    component, sizes = linked_components(texts)
    found = queries.QUERIES["op9_minhash_odd_sketch"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        d: (sizes[d], component[d], component[d] == d) for d in texts
    }


def test_a_large_group_of_near_copies(spark):
    """Copies of one text, each with an edit of its own, and a chain whose ends aren't linked."""
    import random

    rng = random.Random(3)
    base = sentence(rng, 120).split(" ")
    texts = []
    for i in range(60):
        edited = list(base)
        edited[rng.randrange(120)] = f"edit{i}"
        texts.append(" ".join(edited))
    chain = list(base)
    for i in range(0, 30):
        chain[4 * i] = f"step{i}"
        texts.append(" ".join(chain))
    frame = spark.createDataFrame(rows(texts), SCHEMA)
    component, _ = linked_components(dict(enumerate(texts)))
    assert {r.doc_id: r.component_id for r in minhash.components(frame).collect()} == component


@pytest.mark.parametrize("broadcast", [True, False])
def test_buckets_without_links_end_in_three_rounds(spark, monkeypatch, broadcast):
    """op9: texts of similarity 0.7, which share buckets by the dozen, beside linked ones; the same with and without broadcasts."""
    if not broadcast:
        for name in ("BROADCAST_IDS", "BROADCAST_ROWS", "BROADCAST_WIDE"):
            monkeypatch.setattr(minhash, name, -1)
    rng = random.Random(11)
    base = sentence(rng, 120).split(" ")
    texts = []
    for i in range(150):
        edited = list(base)
        edited[10 + rng.randrange(50)], edited[65 + rng.randrange(50)] = f"one{i}", f"two{i}"
        texts.append(" ".join(edited))
        if i % 10 == 0:
            texts += [" ".join(edited[:-j]) for j in range(1, 1 + i % 4)]
    texts += texts[:5]
    mark = scratch_mark()
    found = minhash.components(spark.createDataFrame(rows(texts), SCHEMA))
    component, sizes = linked_components(dict(enumerate(texts)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == {d: (sizes[d], component[d]) for d in component}
    assert len(set(component.values())) == 150
    assert len([x for x in scratch_since(mark) if "/live-" in x]) <= 4  # the first, and one after each round


@pytest.mark.parametrize("broadcast", [True, False])
def test_connected_components_of_chains_and_stars(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(minhash, "BROADCAST_ROWS", -1)
    rng = random.Random(2)
    chain, star = [(i, i + 1) for i in range(100, 140)], [(200, 200 + i) for i in range(1, 20)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in chain + star + star[:3] + [(300, 300), (310, 305), (310, 307)]]
    for some in (edges, star, []):
        least = {x: x for e in some for x in e}
        for _ in some:
            for a, b in some:
                least[a] = least[b] = min(least[a], least[b])
        found, count = minhash.connected_components(spark.createDataFrame(some, "a bigint, b bigint"), len(some))
        got = [(r.node, r.component) for r in found.collect()]
        assert sorted(got) == sorted((x, y) for x, y in least.items() if x != y) and count == len(got)


def test_near_duplicates_of_odd_rows(spark, odd):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.components(odd).collect()}
    assert found[(3, 0)] == (3, True) and found[(None, 0)] == (None, True)
    assert found[(1, 196)] == (0, False) and found[(2, 196)] == (0, False)  # an exact and a near copy
    assert found[(7, 1)] == found[(12, 1)] == (6, False)  # one short text in two spellings
    assert minhash.components(odd.limit(0)).count() == 0
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    # of the copies of the first text, the row with a null id comes first and stays
    assert {r.doc_id for r in kept.collect()} == {None, 2, 3, 4, 5, 6, 8, 9, 10, 13, 14}
    assert minhash.keep_one(odd.limit(0)).count() == 0


def test_odd_sketch_estimates_high_similarities():
    rng = np.random.default_rng(9)
    for similarity in (0.85, 0.95):
        n = 2000
        shared = round(2 * n * similarity / (1 + similarity))
        every = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = every[:n], np.concatenate([every[:shared], every[n : 2 * n - shared]])
        x, y = (minhash.odd_sketch(minhash.samples(s)) for s in (a, b))
        differ = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
        assert differ <= minhash.most_odd_bits(0.85)
        assert 1 + np.log(1 - 2 * differ / 1024) * 1024 / 4 / minhash.SAMPLES == pytest.approx(similarity, abs=0.08)


def test_repeated_ids_and_labels_do_not_multiply_the_sample(spark):
    """Each id once, whatever its rows and labels; the least text hash and the toxic label count."""
    rng = random.Random(5)
    texts = {i: sentence(rng, 8) + " awful" * (i % 4 == 0 or i % 5 == 0) for i in range(200)}
    docs = [(i, t) for i, t in texts.items() for _ in range(25)] + [(i, sentence(rng, 8)) for i in range(200)]
    labels = [(i, int(i % 4 == 0)) for i in range(200)] + [(i, 1 - int(i % 4 == 0)) for i in range(0, 200, 5)] + [(1, None), (None, 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    once = toxicity.train(frame, marks)
    clean = spark.createDataFrame([(i, int(i % 4 == 0 or i % 5 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    again = toxicity.train(frame.unionByName(frame).repartition(5), clean)
    for a, b in zip((once.features, once.weight, once.vector), (again.features, again.weight, again.vector)):
        assert np.array_equal(a, b)
    assert once.bias == again.bias and len(once.features)
    untold = toxicity.train(frame, spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id bigint, toxic int"))
    assert not untold.weight.any() and not untold.vector.any()


def test_scores_follow_from_the_model_pair_by_pair(spark):
    """Scores of the whole small table, recomputed from weights and all pairs of vectors."""
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, SMALL, "labels"))
    place = {int(f): i for i, f in enumerate(machine.features)}
    found = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    terms = toxicity.Terms()
    for r in docs.collect():
        at = [place[f] for f in sorted(terms.of(r.text)) if f in place]
        total = float(machine.bias) + sum(float(machine.weight[i]) for i in at)
        vectors = machine.vector[at].astype(np.float64)
        total += sum(float(vectors[i] @ vectors[j]) for i in range(len(at)) for j in range(i) if vectors[i].any() and vectors[j].any())
        assert found[r.doc_id] == pytest.approx(1 / (1 + math.exp(-total)), abs=2e-3)
