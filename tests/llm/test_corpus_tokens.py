"""Token ids put together from words."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_cases import odd_rows
from tokenizers import Tokenizer

from linkwell.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def texts_to_try():
    rng = random.Random(8)
    letters = "abzABZ .,'.\n\t\r  0189éÉßſŉİıΣσς日本é 　😀<|endoftext|>Ǆǅ𝔸ªº²½_"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += ["Straße. ÉCOLE, d'été... ΟΔΟΣ. ΟΔΟΣ, ΣΑΣ Σ. İstanbul, I. ı. <|endoftext|>. x<|endoftext|>y ..", "", " ", ".", ",", "a.", "A..", "9.", "x" * 3000 + "."]
    return texts + [t or "" for t in (r[1] for r in odd_rows())]


@pytest.mark.parametrize("most", [packing.CACHED_BYTES, 2_000])
def test_ids_equal_the_tokenizer(most):
    content = open(WORDS, encoding="utf-8").read()
    words, tokenizer = packing.Words(content, most), Tokenizer.from_str(content)
    assert words.by_words
    texts = texts_to_try()
    wanted = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        for lo in range(0, len(texts), 100):
            ids, size = words.encode(pa.array(["skipped", *texts[lo : lo + 100]], pa.string()).slice(1))
            assert [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])] == wanted[lo : lo + 100]
    words.known.age()
    assert words.known.ids.nbytes + 29 * len(words.known.first) <= most


def test_a_tokenizer_of_another_kind_gets_whole_texts():
    content = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    words, tokenizer = packing.Words(content), Tokenizer.from_str(content)
    assert not words.by_words
    texts = texts_to_try()[:200]
    ids, size = words.encode(pa.array(texts, pa.string()))
    assert [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_long_texts_in_pieces(spark, monkeypatch):
    """Texts over the bytes of a batch are cut before spaces, whatever stands there."""
    monkeypatch.setattr(packing, "BATCH_BYTES", 50)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Word.", "of", "a", "tale,", "", "\n"]) for _ in range(rng.randint(0, 90))) for _ in range(20)]
    texts += ["x" * 200, " " * 200, "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    tokenizer = Tokenizer.from_file(WORDS)
    found = {r.doc_id: r.ids for r in packing.tokenize(frame, WORDS).collect()}
    assert found == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}


def test_tokens_as_bytes(spark, monkeypatch):
    """op2: ids are staged and shuffled as bytes, two for each where they do, and counted while they are made."""
    monkeypatch.setattr(packing, "COUNTED_TOKENS", 100)
    texts = {i: t for i, t in enumerate([*texts_to_try()[:60], None])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    tokenizer = Tokenizer.from_file(WORDS)
    wanted = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts.items()}
    plain = packing.tokenize(frame, WORDS)
    wide = plain.selectExpr("doc_id", "transform(ids, x -> int(if(doc_id % 2 = 0, x + 70000, x))) as ids")
    for tokens, more, width in ((packing.tokenize(frame, WORDS, compact=True), 0, 2), (packing.compacted(plain), 0, 2), (packing.compacted(wide), 70_000, 4)):
        true = {i: [x + more * (i % 2 == 0) for x in ids] for i, ids in wanted.items()}
        rows = [r for r in tokens.collect() if r.size is not None]
        assert max(len(r.ids) / r.size for r in rows) == width
        assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u2" if len(r.ids) == 2 * r.size else "<u4").tolist() for r in rows} == true
        found = packing.statistics(tokens)
        assert found.n == len(true) and found.mean == pytest.approx(sum(map(len, true.values())) / len(true))
        assert found.df.tolist() == [sum(t in ids for ids in map(set, true.values())) for t in range(len(found.df))]
        whole = {}
        for r in packing.pack(tokens, window=64, tokens_per_shard=700).collect():
            whole.setdefault(r.doc_id, []).append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()))
        assert {i: [x for _, p in sorted(parts) for x in p] for i, parts in whole.items()} == true


def test_sketches_of_many_documents():
    """One pass over all ids gives what each document gives by itself."""
    rng = np.random.default_rng(5)
    size = np.array([0, 3, 1, 2, 0, 40, 4, 2, 1, 0, 7, 1])
    flat = rng.integers(0, 60_000, size.sum()).astype(np.int32)
    alone = [int(packing.sketches_of(x, np.array([len(x)]))[0]) for x in np.split(flat, np.cumsum(size)[:-1])]
    assert packing.sketches_of(flat, size).tolist() == alone
    assert [s == 0 for s in alone] == (size < 3).tolist()
