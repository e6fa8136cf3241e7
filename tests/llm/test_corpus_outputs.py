"""Packing, subword pieces, shards, archives, the pipeline."""

import gzip
import hashlib
import math
import random
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus_cases import SCHEMA, odd_rows, rows, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from linkwell.llm import packing, pieces, queries, sharding, warc
from linkwell.llm.common import table
from linkwell.session import scratch_path, stage

SMALL = "/root/testdata/sf0.001"
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def packed_right(found, texts, window=4096):
    """Each id of each text in exactly one piece, sequences gapless and full but for powers of two."""
    tokenizer = Tokenizer.from_file(WORDS)
    wanted = sorted((str(d), tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in texts)
    by_doc, by_sequence = {}, {}
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)
    assert sum(len(i) for p in by_doc.values() for _, i in p) == sum(len(i) for _, i in wanted)
    for d, ids in wanted:
        have = by_doc[d, len(ids)]
        assert all(any(s == at and i == ids[s : s + len(i)] for at, i in have) for s, i in have if i == ids[s : s + len(i)])
        covered = {k for s, i in have if i == ids[s : s + len(i)] for k in range(s, s + len(i))}
        assert covered == set(range(len(ids)))


def test_packing_of_whole_table(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    found = queries.QUERIES["op2_bm25_packing"](spark, SMALL).collect()
    assert {r.doc_id for r in found} == {d for d, _ in texts}
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {d: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4") for d, t in texts}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in found) == sum(map(len, ids.values()))


def test_packing_in_many_blocks_and_of_odd_rows(spark, odd):
    tokens = packing.tokenize(odd, WORDS)
    for size in (1_000, 2_000_000):
        packed_right(packing.pack(tokens, tokens_per_shard=size).collect(), [(r[0], r[1]) for r in odd_rows()])
    packed_right(packing.pack(tokens, window=64, tokens_per_shard=700).collect(), [(r[0], r[1]) for r in odd_rows()], 64)
    assert packing.pack(tokens.limit(0)).count() == 0


def test_neighbours_are_those_of_bm25():
    rng = np.random.default_rng(2)
    units = [rng.integers(0, 40, rng.integers(3, 30)) for _ in range(30)]
    index = packing.Index(units)
    df = {t: sum(t in u for u in units) for t in range(40)}
    mean = np.mean([len(u) for u in units])

    def score(q, d):
        total = 0.0
        for t in set(units[q].tolist()):
            tf = (units[d] == t).sum()
            if tf and df[t] > 1:
                idf = np.log1p((30 - df[t] + 0.5) / (df[t] + 0.5))
                total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(units[d]) / mean))
        return total

    free = np.ones(30, bool)
    free[[0, 7]] = False
    found = index.neighbours(0, free).tolist()
    scores = [score(0, d) for d in found]
    assert 7 not in found and scores == sorted(scores, reverse=True)
    assert set(found) == {d for d in range(30) if free[d] and score(0, d) > 0}


def test_statistics_cover_all_documents(spark):
    rng = np.random.default_rng(4)
    units = [rng.integers(0, 50, rng.integers(0, 30)).tolist() for _ in range(40)] + [[]]
    held = spark.createDataFrame([(i, u) for i, u in enumerate(units)], "doc_id bigint, ids array<int>").repartition(4)
    found = packing.statistics(held)
    assert found.n == 41 and found.mean == pytest.approx(sum(map(len, units)) / 41)
    assert found.df.tolist() == [sum(t in u for u in units) for t in range(len(found.df))]
    own = packing.Index([np.array(u, np.int32) for u in units], found)
    free = np.ones(41, bool)
    free[3] = False
    assert own.neighbours(3, free).tolist() == packing.Index([np.array(u, np.int32) for u in units]).neighbours(3, free).tolist()
    # of a part of the documents, terms weigh as they do in all
    few = packing.Index([np.array(u, np.int32) for u in units[:6]], found)
    idf = lambda t: math.log1p((41 - found.df[t] + 0.5) / (found.df[t] + 0.5))
    at = few.first[1]
    t, n = int(few.terms[at]), len(units[1])
    tf = units[1].count(t)
    assert few.weight[few.begin[t] : few.end[t]][few.unit[few.begin[t] : few.end[t]] == 1][0] == pytest.approx(
        idf(t) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / found.mean)))
    assert packing.statistics(held.limit(0)).n == 0


def test_related_documents_share_windows():
    rng = np.random.default_rng(3)
    docs = [(i, 60, 0, rng.integers(100 * (i % 5), 100 * (i % 5) + 100, 60)) for i in range(50)]
    done, left = packing.pack_shard(docs, 240, True)
    topics = [{key % 5 for key, *_ in s} for s in done if sum(len(p[3]) for p in s) == 240]
    assert not left and sum(len(t) == 1 for t in topics) >= 8


ODD_TEXTS = ["", " ", "  ", "   a", "a  b ", "\n ", "▁", "▁▁x ▁", "日本 テスト", "\0a", "😀 x", "é é", "<s> </s> <0x41>", "a　b", "a" * 300]


def test_pieces_equal_the_library():
    rng = random.Random(6)
    model = pieces.MergeModel(open(PIECES, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ODD_TEXTS + ["".join(rng.choice(" ▁ab\né<s>") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    texts += [sentence(rng, 50) for _ in range(20)]
    wanted = library.encode(texts, add_bos=True, add_eos=True)
    assert model.encode(texts) == wanted
    assert [model.decode(i) for i in wanted] == [library.decode(i) for i in wanted]
    ids = [[rng.randint(0, 400) for _ in range(rng.randint(0, 9))] for _ in range(500)]
    assert [model.decode(i) for i in ids] == [library.decode(i) for i in ids]


def test_both_agendas_agree(monkeypatch):
    rng = random.Random(7)
    model = pieces.MergeModel(open(PIECES, "rb").read())
    parts = ["▁" + sentence(rng, 3).replace(" ", "") for _ in range(200)]
    short = [model.merge(p) for p in parts]
    monkeypatch.setattr(pieces, "SHORT_PART", 0)
    assert [model.merge(p) for p in parts] == short


def test_a_cache_that_is_too_small():
    model = pieces.MergeModel(open(PIECES, "rb").read(), cached=10)
    text = "the quick brown fox jumps over the lazy dog and some more words than the cache holds"
    assert model.encode([text, text]) == [model.encode([text])[0]] * 2


def test_pieces_of_whole_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    found = queries.QUERIES["op7_sentencepiece_agenda"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_rows(spark, odd):
    made = pieces.encode_decode(odd, PIECES)
    found = made.select("doc_id", "decoded").collect()
    assert sorted((str(r.doc_id), r.decoded) for r in found) == sorted((str(r[0]), (r[1] or "").replace("▁", " ")) for r in odd_rows())
    assert pieces.encode_decode(odd.limit(0), PIECES).count() == 0


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def shard_right(found, texts):
    key = lambda d: int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:16], 16)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts
    )
    slots = {}
    for r in found:
        assert r.shard == jump(key(r.doc_id), 8) and r.grown_shard == jump(key(r.doc_id), 9) and r.law == "key"
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(spark, odd):
    shard_right(queries.QUERIES["op5_jump_hash_shards"](spark, SMALL).collect(), [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()])
    shard_right(sharding.shard_documents(odd).collect(), [(r[0], r[1]) for r in odd_rows()])
    assert sharding.shard_documents(odd.limit(0)).count() == 0


def test_slots_in_many_cells(spark, monkeypatch):
    """Ranks over many cells, and a row that occurs more often than a piece of an array may hold."""
    monkeypatch.setattr(sharding, "COPIES_PER_ROW", 7)
    many = rows([f"text {i % 50}" for i in range(300)]) + rows(["twin"])[:1] * 40
    frame = spark.createDataFrame(many, SCHEMA).select("doc_id", F.col("text"))
    narrow = frame.select("doc_id", sharding.key_of(F.col("doc_id")).alias("key"), F.lit(0).alias("shard"), "text")
    found = sharding.assign_slots(narrow, "shard", "key", ["doc_id", "text"], rows_per_cell=20).collect()
    assert sorted(r.slot for r in found) == list(range(340))
    unsigned = [(r.key % 2**64, r.doc_id) for r in sorted(found, key=lambda r: r.slot)]
    assert unsigned == sorted(unsigned)


PAGES = "page_id bigint, url string, html string, archive string, ordinal string, digest string"


def pages(rows_):
    return [(*r, "x", "x", "x") for r in rows_]


def test_archives_of_odd_pages(spark):
    big, other = "<p>" + "é" * 80 + "</p>", "<b>" + "x" * 200
    given = [
        (5, "http://a/ b\r\nX: y", big), (3, None, big), (9, "u", other), (1, "u", "short"), (2, "u", "short"), (7, "u", None),
        (None, "u", other), (8, "u", ""), (9, "u", other), (4, "u", "WARC/1.1\r\n\r\n" * 20),
    ]
    folder = scratch_path(spark, "archives")
    made = warc.archive_pages(spark, spark.createDataFrame(pages(given), PAGES).repartition(3), folder, archive_bytes=900)
    found = warc.read_back(made).collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in found) == sorted(
        (str(p), len((t or "").encode()), digest(t)) for p, _, t in given
    )
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in found)
    assert kinds == sorted([
        ("5", "revisit", 3), ("3", "response", None), ("9", "response", None), ("9", "revisit", 9), ("None", "revisit", 9),
        ("1", "response", None), ("2", "response", None), ("7", "response", None), ("8", "response", None), ("4", "response", None),
    ])
    # an archive is plain gzip of one member for each record, which the index points at
    for name in {r.archive for r in found}:
        data = open(name.removeprefix("file:"), "rb").read()
        records = list(warc.read_records(iter([gzip.decompress(data)])))
        offsets = sorted(r.offset for r in found if r.archive == name)
        assert len(records) == len(offsets) and all(data[o : o + 2] == b"\x1f\x8b" for o in offsets)
    none = spark.createDataFrame([], PAGES)
    assert warc.read_back(warc.archive_pages(spark, none)).count() == 0


def test_records_in_small_blocks():
    records = [warc.response(i, "http://x/", bytes([65 + i]) * 50 * i) for i in range(5)]
    data = b"".join(r.to_bytes() for r in records)
    stream = gzip.compress(data[:200]) + gzip.compress(data[200:])

    class Source:
        at = 0

        def read(self, n):
            self.at += 13
            return stream[self.at - 13 : self.at]

    assert [r.block for r in warc.read_records(warc.inflate(Source()))] == [r.block for r in records]
    with pytest.raises(ValueError):
        list(warc.read_records(iter([data[:-3]])))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_against_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    cursor = con.execute(queries.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in found.select(*columns).collect())


def test_pipeline_hands_on_documents(spark, odd):
    """Odd rows pass all stages; each but the last keeps the columns, and none adds rows."""
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "row", "c0", "kept")
    for name, step in corpus_pipeline.STAGES[:-1]:
        made = stage(step(spark, docs, SMALL), name)  # as written and read again
        assert made.schema.names == docs.schema.names and made.count() <= docs.count(), name
        docs = made
    name, last = corpus_pipeline.STAGES[-1]
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    packed_right(last(spark, docs, SMALL).collect(), texts)
    empty = odd.select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, empty, SMALL).count() == 0


def test_pipeline_stages_take_effect(spark):
    """The whole run equals its stages done by brute force on their own inputs."""
    from corpus_cases import base_counts, linked_components, without_repeated_lines, without_repeats

    docs = table(spark, SMALL, "documents")
    steps = dict(corpus_pipeline.STAGES)
    good = stage(steps["quality_rules"](spark, docs, SMALL), "good")
    assert not any(base_counts(r.text)[5] for r in good.collect())
    lined = {r.doc_id: r.text for r in steps["repeated_lines"](spark, good, SMALL).collect()}
    before = sorted((r.doc_id, r.text) for r in good.collect())
    assert lined == {d: left for (d, _), (left, _, _) in zip(before, without_repeated_lines([t for _, t in before]))}
    frame = spark.createDataFrame(sorted(lined.items()), "doc_id bigint, text string")
    single = {r.doc_id: r.text for r in steps["near_duplicates"](spark, frame, SMALL).collect()}
    component, sizes = linked_components(lined)
    assert single == {d: t for d, t in lined.items() if component[d] == d}
    frame = spark.createDataFrame(sorted(single.items()), "doc_id bigint, text string")
    cut = {r.doc_id: r.text for r in steps["repeated_substrings"](spark, frame, SMALL).collect()}
    wanted = without_repeats([t for _, t in sorted(single.items())])
    assert cut == {d: left.decode("utf-8", "replace") for (d, _), (left, _, _) in zip(sorted(single.items()), wanted)}
    ran = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in ran.select("doc_id").distinct().collect()} == set(cut)
    packed_right(ran.collect(), list(cut.items()))
