"""Line and substring removal, exact duplicates, suffix arrays."""

import hashlib
import os
import random
import time

import pytest
from corpus_cases import CLASHES, SCHEMA, odd_rows, sentence, without_repeated_lines, without_repeats
from pyspark.sql import functions as F

from linkwell.llm import exact_dedup, line_dedup, queries, suffix_dedup
from linkwell.llm.common import table
from linkwell.llm.suffix_array import suffix_array
from linkwell.session import scratch_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).coalesce(1)


def in_order(rows):
    """Rows by id, null first, then in the order of the table."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_line_dedup_against_brute_force(spark):
    texts = sorted(table(spark, SMALL, "documents").select("doc_id", "text").collect())
    wanted = without_repeated_lines([r.text for r in texts])
    found = {r.doc_id: r for r in queries.QUERIES["op4_winnowed_line_dedup"](spark, SMALL).collect()}
    for r, (left, n, gone) in zip(texts, wanted):
        f = found[r.doc_id]
        assert (f.n_lines, f.n_removed, f.kept_sha256) == (n, gone, sha(left))


@pytest.mark.parametrize("run", [1, 3])
def test_line_runs_of_other_lengths(spark, run):
    rng = random.Random(run)
    texts = ["\n".join(rng.choice(["aa", "bb", "cc", "dd", "", " "]) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(frame, run).collect()}
    assert found == dict(enumerate(without_repeated_lines(texts, run)))


def test_lines_that_are_runs_by_themselves(spark):
    """A paragraph of one line, copies of one line, a line of a third of all texts, and short lines beside long ones."""
    rng = random.Random(21)
    paragraph = sentence(rng, 60)
    texts = [sentence(rng, 20) + "\n" + paragraph + "\n" + sentence(rng, 20) for _ in range(5)]
    texts += [sentence(rng, 15)] * 2 + ["too short"] * 2
    texts += [sentence(rng, 12) + "\nfooter of nine words " + "that all the third have\n" + paragraph for _ in range(4)]
    pool = [sentence(rng, n) for n in (1, 2, 3, 12, 12, 30)]
    texts += ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts += [f"{sentence(rng, 3)}\nread more\n{sentence(rng, 3)}" for _ in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for alone in (10, 1000):
        found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(frame, alone_words=alone).collect()}
        assert found == dict(enumerate(without_repeated_lines(texts, alone=alone)))
    assert paragraph not in "".join(t for t, *_ in list(without_repeated_lines(texts))[1:5])


def test_line_dedup_of_odd_rows(spark, odd):
    made = line_dedup.dedup_lines(odd)
    assert set(odd.columns) <= set(made.columns)
    order = in_order(odd_rows())
    wanted = sorted((str(r[0]), left) for r, (left, _, _) in zip(order, without_repeated_lines([r[1] for r in order])))
    assert sorted((str(r.doc_id), r.text or "") for r in made.collect()) == wanted
    assert made.filter("text is null").count() == odd.filter("text is null").count()
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_suffix_array():
    rng = random.Random(4)
    for _ in range(3000):
        symbols = [rng.randint(0, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 16))]
        assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_substring_dedup_against_brute_force(spark):
    texts = sorted(table(spark, SMALL, "documents").select("doc_id", "text").collect())
    found = {r.doc_id: r for r in queries.QUERIES["op10_suffix_array_dedup"](spark, SMALL).collect()}
    for r, (left, gone, spans) in zip(texts, without_repeats([r.text for r in texts])):
        f = found[r.doc_id]
        assert (f.n_bytes, f.n_removed, f.n_spans, f.kept_sha256) == (len(r.text.encode()), gone, spans, sha(left))


def _entangled(rng):
    """Texts that share passages with varied surroundings, so that few matches are those of a first place."""
    parts = [sentence(rng, 12) for _ in range(5)]
    return ["".join(rng.choice(parts)[rng.randint(0, 6) : -rng.randint(1, 6)] for _ in range(rng.randint(0, 7))) for _ in range(50)]


@pytest.mark.parametrize("seed", [1, 2])
def test_entangled_passages(spark, seed, monkeypatch):
    asked = []
    by_suffixes = suffix_dedup._by_suffixes
    monkeypatch.setattr(suffix_dedup, "_by_suffixes", lambda first, length: asked.append(len(first)) or by_suffixes(first, length))
    texts = _entangled(random.Random(seed))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for bits, length, gram in ((10, 40, 16), (1, 30, 8)):
        found = suffix_dedup.dedup_substrings(frame, length, gram, bits).collect()
        wanted = without_repeats(texts, length)
        assert {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in found} == dict(enumerate(wanted))


def test_pool_is_decided_by_the_suffix_array():
    rng = random.Random(8)
    shared = [sentence(rng, 8).encode() for _ in range(3)]
    runs = [((0, i), 10 * i, rng.choice(shared)[rng.randint(0, 4) :] + sentence(rng, 3).encode()) for i in range(40)]
    length = 20
    first, wanted = {}, set()
    for place, number, data in runs:
        for i in range(len(data) - length + 1):
            if data[i : i + length] in first:
                wanted.add((place, number + i))
            first.setdefault(data[i : i + length], place)
    rng.shuffle(runs)
    found = suffix_dedup._windows(runs, length)
    assert {(place, w) for place, lo, hi in found for w in range(lo, hi + 1)} == wanted


def test_long_texts_are_cut_at_any_place(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 57)
    rng = random.Random(2)
    a = sentence(rng, 200)
    texts = [a, a[37:900], "x" * 400, "y" * 30 + a[200:420]]
    import numpy as np

    data = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    with np.errstate(over="ignore"):
        _, anchor, first, last = suffix_dedup.segments(np.frombuffer(data, np.uint8), offsets)
    covered = [w for lo, hi in zip(first, last) for w in range(lo, hi + 1)]
    whole = [w for lo, hi in zip(offsets, offsets[1:]) for w in range(lo, hi - 99)]
    assert sorted(covered) == whole and all(f <= p <= f + 100 - 32 for p, f in zip(anchor, first))


def test_substring_dedup_of_odd_rows(spark, odd):
    made = suffix_dedup.dedup_substrings(odd)
    assert set(odd.columns) - {"text", "kept"} <= set(made.columns)
    order = in_order(odd_rows())
    wanted = sorted((str(r[0]), left) for r, (left, _, _) in zip(order, without_repeats([r[1] for r in order])))
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in made.select("doc_id", "kept").collect()) == wanted
    assert suffix_dedup.dedup_substrings(odd.limit(0)).count() == 0


def _files(spark, rows, n=4):
    path = scratch_path(spark, "stream")
    frame = spark.createDataFrame(rows, SCHEMA)
    for i in range(n):
        frame.filter(F.pmod(F.xxhash64(*frame.columns), F.lit(n)) == i).coalesce(1).write.mode("append").parquet(path)
    return path


def _groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1] or "", []).append(r[0])
    return sorted(
        (str(d), str(max((x for x in ids if x is not None), default=None)), len(ids), sha(t)) for t, ids in out.items() for d in ids
    )


def test_exact_dedup_over_batches(spark):
    """State of earlier batches meets copies in later ones; odd rows included."""
    rows = odd_rows()
    path = _files(spark, rows)
    found = exact_dedup.deduplicate(spark, path, files_per_batch=1).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.digest) for r in found) == _groups(rows)
    assert sum(r.kept for r in found) == len({r[1] or "" for r in rows})


def test_exact_dedup_compares_whole_texts(spark):
    """A digest that most texts share must not merge them."""
    rows = odd_rows()
    weak = lambda text: F.concat(F.lit("d"), F.length(text) % 2)
    found = exact_dedup.deduplicate(spark, _files(spark, rows), digest=weak).collect()
    wanted = [(d, k, n) for d, k, n, _ in _groups(rows)]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == wanted
    assert sum(r.kept for r in found) == len({r[1] or "" for r in rows})


def test_exact_dedup_state_outlives_a_run(spark):
    path, home = scratch_path(spark, "stream"), scratch_path(spark, "state")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    frame.coalesce(1).write.parquet(path)
    exact_dedup.deduplicate(spark, path, checkpoint=home).collect()
    spark.createDataFrame([(5, "a"), (4, "c")], "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(path)
    found = exact_dedup.deduplicate(spark, path, checkpoint=home).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {(1, 5, 2, False), (5, 5, 2, True), (2, 2, 1, True), (4, 4, 1, True)}
    frame.limit(0).write.parquet(empty := scratch_path(spark, "none"))
    assert exact_dedup.deduplicate(spark, empty).count() == 0
    slashed = exact_dedup.deduplicate(spark, path + "/").collect()
    assert len(slashed) == spark.read.parquet(path).count()


def test_exact_dedup_takes_late_files_of_any_age(spark):
    path, home = scratch_path(spark, "stream"), scratch_path(spark, "state")
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string").coalesce(1).write.parquet(path)
    exact_dedup.deduplicate(spark, path, checkpoint=home).collect()
    known = set(os.listdir(path))
    spark.createDataFrame([(5, "a"), (4, "c")], "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(path)
    long_ago = time.time() - 400 * 86_400
    for name in set(os.listdir(path)) - known:
        os.utime(os.path.join(path, name), (long_ago, long_ago))
    found = exact_dedup.deduplicate(spark, path, checkpoint=home).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {(1, 5, 2, False), (5, 5, 2, True), (2, 2, 1, True), (4, 4, 1, True)}


def test_clashing_names_cover_the_operators():
    assert {"row", "batch", "doc", "kept", "c0"} <= set(CLASHES)


def test_a_hot_anchor_is_not_brought_together(spark, monkeypatch):
    """A phrase of 60 bytes in all texts, between shared and unshared surroundings: windows are decided apart, and right."""
    together = []
    match = suffix_dedup._match
    monkeypatch.setattr(suffix_dedup, "_match", lambda items, *rest: together.append(len(items)) or match(items, *rest))
    rng = random.Random(15)
    phrase = sentence(rng, 30)[:60]
    edges = [sentence(rng, 12) for _ in range(4)]
    texts = [(rng.choice(edges) if rng.random() < 0.4 else sentence(rng, 12)) + phrase + (rng.choice(edges) if rng.random() < 0.4 else sentence(rng, 12)) for _ in range(120)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for hot in (5, 10_000):
        found = suffix_dedup.dedup_substrings(frame, batch_bits=2, hot_segments=hot).collect()
        assert {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in found} == dict(enumerate(without_repeats(texts)))


def test_batches_are_bounded_by_bytes(spark):
    sizes = [0, 10, 16_384, 16_385, 131_072, 131_073, 1 << 20, 1 << 21, 1 << 24, 1 << 26]
    rows_ = [(i, sizes[i % len(sizes)]) for i in range(4000)]
    frame = spark.createDataFrame(rows_, "row bigint, size bigint")
    made = frame.withColumn("batch", suffix_dedup.batch_of(F.col("row"), F.col("size"), 10, 1 << 24))
    for r in made.groupBy("batch").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("row").alias("hi"), F.min("row").alias("lo")).collect():
        assert r.n <= 1024 and (r.bytes <= 1 << 24 or r.n == 1) and r.hi - r.lo < 1024


def test_texts_of_many_megabytes(spark):
    rng = random.Random(16)
    part = sentence(rng, 300_000)
    texts = ["short " + part[5_000:5_300], part * 6, part[7:1000], part]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in suffix_dedup.dedup_substrings(frame).collect()}
    n = len(part)
    assert len(texts[1]) > 7_000_000 and found[1].n_bytes == 6 * n
    # the second has the passage of the first, and all but its own first turn again
    assert found[0].n_removed == 0 and found[1].n_removed == 300 + 5 * n and found[2].n_removed == 993 and found[3].n_removed == n
