"""Packing documents into training sequences with lexically related neighbours.

Documents are tokenized and dealt to shards by a sketch of their token runs, so
related ones tend to meet; ids break ties, so no group of copies is too large for
the ranges. The number of shards follows the number of tokens. Each shard holds a
BM25 inverted index of its documents, weighted by the statistics of all documents. The next unused document seeds a window; the
index returns its unused neighbours by score, which fill the window one after
another, and where none is left the next unused document goes on. A document
that doesn't fit is cut, and its rest stays in the index. So every window of a
shard is full but for the last tokens, which are cut at powers of two and need
no padding either.

Words are tokenized once by each worker while a cache of bounded bytes holds them. That
is the tokenizer's own result, because its file says that it cuts at white space and
around runs of letters; a tokenizer of another kind is called with whole texts.

Defined cases: a null text is empty and has the end id only. Repeated rows and ids
are packed like others, each row's tokens once. A document longer than a window
fills windows of its own; its rest is packed like others, and found by the whole text. No rows give no
sequences. Other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwell.llm.common import text_of
from linkwell.session import stage

WINDOW, END_ID = 4096, 2
TOKENS_PER_SHARD = 2_000_000
K1, B = 1.2, 0.75
CACHED_BYTES, BATCH_BYTES, COUNTED_TOKENS = 48_000_000, 2_000_000, 1 << 18
#: Words whose letters have one lower case each, whatever stands beside them, and no other composition.
LATIN = r"^[\x00-\x{12F}\x{131}-\x{17F}]*$"
WORD_END = "</w>"
# The steps of a tokenizer file for which words may be tokenized by themselves and in lower case.
LOWERING = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
RUNS = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class Known:
    """Token ids of words in few bytes: keyed by two hashes of 64 bits, in the order of the first.

    The multipliers of the hashes are drawn anew by each process. Words that weren't
    met since the last time go when there is more than ``most`` bytes.
    """

    LONGEST = 1024

    def __init__(self, kind: type, most: int):
        self.most = most
        self.factors = np.frombuffer(os.urandom(16 * self.LONGEST), np.uint64).reshape(2, -1)
        self.first, self.second = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.start, self.size, self.met = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool)
        self.ids = np.empty(0, kind)

    def hashes(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each word, from up to ``LONGEST`` of its bytes."""
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        size = np.diff(ends)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
        place = (np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], size)) % self.LONGEST
        some = np.flatnonzero(size)
        out = np.zeros((2, len(words)), np.uint64)
        for i in (0, 1):
            if len(some):
                out[i, some] = np.add.reduceat(self.factors[i][place] * data, (ends[:-1] - ends[0])[some])
        return out[0], out[1]

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Where words are held, -1 if they aren't."""
        if not len(self.first):
            return np.full(len(first), -1)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return np.where((self.first[at] == first) & (self.second[at] == second), at, -1)

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        start = len(self.ids) + np.cumsum(size) - size
        order = np.argsort(first, kind="stable")
        at = np.searchsorted(self.first, first[order])
        for name, values in (("first", first), ("second", second), ("start", start), ("size", size)):
            held = getattr(self, name)
            setattr(self, name, np.insert(held, at, values[order].astype(held.dtype)))
        self.met = np.insert(self.met, at, True)
        self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])

    def age(self) -> None:
        for _ in range(2):
            if self.ids.nbytes + 29 * len(self.first) <= self.most:
                return
            keep = self.met
            self.ids = self.ids[_places(self.start[keep], self.size[keep].astype(np.int64))]
            self.first, self.second, self.size = self.first[keep], self.second[keep], self.size[keep]
            self.start = np.cumsum(self.size.astype(np.int64)) - self.size
            self.met = np.zeros(len(self.first), bool)


class Words:
    """Token ids of texts, put together from those of their words.

    Words of some texts are dictionary-encoded in Arrow, and only distinct ones that
    aren't known are tokenized. For a tokenizer that lowers letters and never joins
    runs of letters with anything else, words are looked up in lower case and without a
    last stop or comma (Latin ones), and runs of letters are tokenized many to a call. Other
    tokenizers get the whole texts.
    """

    def __init__(self, content: str, most: int = CACHED_BYTES):
        from tokenizers import Tokenizer

        spec = json.loads(content)
        self.tokenizer = Tokenizer.from_str(content)
        split = spec["pre_tokenizer"]
        self.by_words = bool(
            spec["normalizer"] == LOWERING and split and split.get("pretokenizers") == RUNS and spec["model"].get("end_of_word_suffix") == WORD_END
            and not any(" " in t["content"] or t["content"].isalpha() for t in spec["added_tokens"])
        )
        if not self.by_words:
            return
        # small Latin letters stay as they are under all steps but the last, which spells bytes, so the model alone does
        plain = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.stops = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.int32) for t in ".,"]
        self.known = Known(np.uint16 if len(self.ends) <= 1 << 16 else np.int32, most)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after another, and how many each has."""
        plain, latin, other, rest = [], [], [], []
        for i, w in enumerate(words):
            if not w.isalpha():
                rest.append(i)
            elif w.isascii():
                plain.append(i)
            else:
                (latin if max(w) < "\u0180" and w.islower() else other).append(i)
        order, parts, sizes = [], [], []
        for some, tokenizer in ((plain, self.plain), (latin, self.plain), (other, self.tokenizer)):
            cut = [some[i : i + 1000] for i in range(0, len(some), 1000)]
            texts = [" ".join([words[i] for i in c]) for c in cut]
            if some is latin:
                texts = [t.translate(_SPELLED) for t in texts]
            for own, done in zip(cut, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(done.ids, np.int32)
                ends = np.flatnonzero(self.ends[ids])
                if len(ends) == len(own):  # each word has one end at least, so each has just one
                    order.append(own)
                    parts.append(ids)
                    sizes.append(np.diff(ends, prepend=-1))
                else:
                    rest.extend(own)
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)]
        order.append(rest)
        parts.append(np.array(list(chain.from_iterable(alone)), np.int32))
        sizes.append(np.array(list(map(len, alone)), np.int64))
        back = np.argsort(np.concatenate(order).astype(np.int64), kind="stable")
        return _take(np.concatenate(parts), np.concatenate(sizes), back)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and how many each has."""
        if not self.by_words:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array(list(chain.from_iterable(found)), np.int32), np.array(list(map(len, found)), np.int64)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = cut.offsets.to_numpy()
        words = cut.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        raw = words.dictionary
        latin = pc.match_substring_regex(raw, LATIN)
        low = pc.if_else(latin, pc.utf8_lower(raw), raw)
        stopped = pc.and_(latin, pc.match_substring_regex(raw, r"\p{L}[.,]$"))
        bases = pc.if_else(stopped, pc.utf8_slice_codeunits(low, 0, -1), low).dictionary_encode()
        known, stopped = self.known, stopped.to_numpy(zero_copy_only=False)
        known.age()
        first, second = known.hashes(bases.dictionary)
        at = known.find(first, second)
        new = np.flatnonzero((at < 0) | (pc.binary_length(bases.dictionary).to_numpy() > Known.LONGEST))
        start, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        if len(known.first):
            start, size = known.start[at], known.size[at].astype(np.int64)
            known.met[at[at >= 0]] = True
        if len(new):
            ids, own = self._learn(bases.dictionary.take(pa.array(new)).to_numpy(zero_copy_only=False).tolist())
            start[new], size[new] = len(known.ids) + np.cumsum(own) - own, own
            known.add(first[new], second[new], ids, own)

        base = bases.indices.to_numpy()
        own = size[base]
        ids = known.ids[_places(start[base], own)].astype(np.int32)
        if stopped.any():
            comma = pc.match_substring_regex(raw, ",$").to_numpy(zero_copy_only=False)[stopped].astype(int)
            values, more = _take(np.concatenate(self.stops), np.array(list(map(len, self.stops))), comma)
            ids = np.insert(ids, np.repeat(np.cumsum(own)[stopped], more), values)
            own[stopped] += more
        ids, own = _take(ids, own, words.indices.to_numpy())
        return ids, np.diff(np.concatenate([[0], np.cumsum(own)])[offsets - offsets[0]])


_NONE = np.empty(0, np.int32)


def _spelled() -> dict[int, str]:
    """Latin letters beyond ASCII as byte-level tokenizers spell their bytes: printable bytes as themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    of = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(of[b] for b in chr(c).encode()) for c in range(128, 0x180)}


_SPELLED = _spelled()


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _take(store: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values, of their sizes one after another, taken in the order of ``which``."""
    own = size[which]
    return store[_places((np.cumsum(size) - size)[which], own)], own


def _by_bytes(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold so many bytes at most, or one text."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to


def _segments(text: str, most: int) -> Iterator[str]:
    """A text cut before spaces into pieces of about so many characters."""
    at = 0
    while at < len(text):
        to = text.find(" ", at + most)
        to = len(text) if to < 0 else to
        yield text[at:to]
        at = to


_words: dict[int, Words] = {}


def _words_of(content: str) -> Words:
    """The words of a tokenizer, kept from task to task by a worker process."""
    key = hash(content)
    if key not in _words:
        _words.clear()
        _words[key] = Words(content)
    return _words[key]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def sketches_of(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least hash of runs of three ids of each document, which texts with much in common tend to share; 0 below three ids."""
    out = np.zeros(len(size), np.int64)
    start, some = np.cumsum(size) - size, np.flatnonzero(size >= 3)
    if len(some):
        x = flat.astype(np.uint64)
        runs = _mix((x[:-2] << np.uint64(42)) ^ (x[1:-1] << np.uint64(21)) ^ x[2:]) >> np.uint64(1)
        ends = (start + size)[size > 0]
        for beyond in (ends - 1, ends - 2):  # runs that reach into the next document
            runs[beyond[(beyond >= 0) & (beyond < len(runs))]] = ~np.uint64(0)
        # from the first run of a document to that of the next one
        out[some] = np.minimum.reduceat(runs, start[some]).astype(np.int64)
    return out


def _some_at_a_time(flat: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Ranges of documents of ``COUNTED_TOKENS`` at most, or of one document, with their ids."""
    ends, at = np.concatenate([[0], np.cumsum(size)]), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + COUNTED_TOKENS, side="right")) - 1)
        yield at, to, flat[ends[at] : ends[to]]
        at = to


class Counted:
    """In how many documents each token is."""

    def __init__(self):
        self.total = np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        for lo, hi, some in _some_at_a_time(flat, size):
            if len(some):
                width = int(some.max()) + 1
                cells = np.repeat(np.arange(hi - lo) * width, size[lo:hi]) + some
                cells.sort()  # far less work than np.unique's hashing
                held_in = np.bincount(cells[np.diff(cells, prepend=-1) > 0] % width, minlength=len(self.total))
                held_in[: len(self.total)] += self.total
                self.total = held_in

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        some = np.flatnonzero(self.total)
        return some, self.total[some]


# Token lists as bytes: little-endian, 16 bits for each id where those of a batch need no more, else 32. Spark moves them as
# they are, where it would copy and encode an array id by id. A task's last row has no document, but the tokens it met (``df``).
COMPACT = "ids binary, size long, sketch long, df array<struct<token: long, n: long>>"


def _compact(keys: pa.Array, flat: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    narrow = not len(flat) or int(flat.max()) < 1 << 16
    ends = (np.concatenate([[0], np.cumsum(size)]) * (2 if narrow else 4)).astype(np.int32)
    ids = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype("<u2" if narrow else "<u4"))])
    columns = [keys, ids, pa.array(size, pa.int64()), pa.array(sketches_of(flat, size)), pa.nulls(len(size), _DF)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *_COMPACT])


_COMPACT = ["ids", "size", "sketch", "df"]
_DF = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))


def _counts(key_type: pa.DataType, counted: Counted) -> pa.RecordBatch:
    token, n = counted.found()
    df = pa.ListArray.from_arrays(pa.array([0, len(token)], pa.int32()), pa.StructArray.from_arrays([pa.array(token), pa.array(n)], ["token", "n"]))
    columns = [pa.nulls(1, key_type), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64())] * 2, df]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *_COMPACT])


def _wide(ids: pa.Array, size: np.ndarray) -> Iterator[np.ndarray]:
    """The token ids of each row of the compact form."""
    data, ends = np.frombuffer(ids.buffers()[2] or b"", np.uint8), np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
    for lo, hi, n in zip(ends[:-1].tolist(), ends[1:].tolist(), size.tolist()):
        yield data[lo:hi].view("<u2" if hi - lo == 2 * n else "<u4").astype(np.int32)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID, compact: bool = False) -> DataFrame:
    """doc_id, ``ids`` with the end id last, and ``sketch`` of each row. The tokenizer file is read on the driver.

    In the ``compact`` form the columns are those of ``COMPACT``, for :func:`pack`.
    """
    with open(tokenizer, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    tail = np.array([] if end_id is None else [end_id], np.int32)

    def encoded(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        words = _words_of(content.value.decode("utf-8"))
        for lo, hi in _by_bytes(batch.column(1), BATCH_BYTES):
            part = batch.slice(lo, hi - lo)
            if hi - lo == 1 and words.by_words:
                found = [words.encode(pa.array([x]))[0] for x in _segments(part.column(1)[0].as_py(), BATCH_BYTES)]
                flat, size = np.concatenate([_NONE, *found]), np.array([sum(map(len, found))])
            else:
                flat, size = words.encode(part.column(1))
            yield part.column(0), np.insert(flat, np.repeat(np.cumsum(size), len(tail)), np.tile(tail, len(size))), size + len(tail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counted, key_type = Counted(), None
        for batch in batches:
            key_type = batch.column(0).type
            for keys, flat, size in encoded(batch):
                if compact:
                    counted.add(flat, size)
                    yield _compact(keys, flat, size)
                    continue
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys, lists, pa.array(sketches_of(flat, size))], ["doc_id", "ids", "sketch"])
        if compact and key_type is not None:
            yield _counts(key_type, counted)

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = COMPACT if compact else "ids array<int>, sketch long"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, {columns}")


def compacted(tokens: DataFrame) -> DataFrame:
    """Lists ``ids`` in the compact form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, key_type = Counted(), None
        for batch in batches:
            key_type, lists = batch.column(0).type, batch.column(1)
            flat, size = lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy().astype(np.int64)
            counted.add(flat, size)
            for lo, hi, some in _some_at_a_time(flat, size):
                yield _compact(batch.column(0).slice(lo, hi - lo), some, size[lo:hi])
        if key_type is not None:
            yield _counts(key_type, counted)

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, {COMPACT}")


class Statistics(NamedTuple):
    """Documents, their mean length, and how many hold each token, over a whole corpus."""

    n: int
    mean: float
    df: np.ndarray


def statistics(held: DataFrame) -> Statistics:
    """Of the lists ``ids``, or of their compact form. What comes to the driver is a number for each token of the vocabulary at most."""
    if "df" not in held.columns:
        held = compacted(held.select(F.lit(0).alias("doc_id"), "ids"))
    n, tokens = held.agg(F.count("size"), F.sum("size")).first()
    rows = held.select(F.inline("df")).groupBy("token").agg(F.sum("n").alias("df")).collect()
    df = np.zeros(max((r.token for r in rows), default=0) + 1, np.int64)
    df[[r.token for r in rows]] = [r.df for r in rows]
    return Statistics(n, (tokens or 0) / max(n, 1), df)


class Index:
    """BM25 postings of the units of a shard, weighted by the statistics of a corpus, or of the units themselves."""

    def __init__(self, units: list[np.ndarray], corpus: Statistics | None = None):
        self.n = len(units)
        lengths = np.array([len(u) for u in units], np.int64)
        tokens = np.concatenate(units) if units else np.empty(0, np.int32)
        width = int(tokens.max()) + 1 if len(tokens) else 1
        cells = np.repeat(np.arange(len(units), dtype=np.int64) * width, lengths)
        cells += tokens
        del tokens
        cells.sort()
        first = np.flatnonzero(np.diff(cells, prepend=-1) > 0)
        cells, tf = cells[first], np.diff(first, append=len(cells))
        unit, term = (cells // width).astype(np.int32), (cells % width).astype(np.int32)
        del cells
        df = np.bincount(term, minlength=width)
        shared = df[term] > 1
        unit, term, tf = unit[shared], term[shared], tf[shared].astype(np.float64)
        n, mean, df = corpus or (len(units), lengths.mean() if len(units) else 1.0, df)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths[unit] / mean)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        order = np.argsort(term, kind="stable")
        self.unit, self.weight = unit[order], weight[order]
        ends = np.cumsum(np.bincount(term, minlength=width))
        self.begin, self.end = ends - np.bincount(term, minlength=width), ends
        self.terms, self.first = term, np.searchsorted(unit, np.arange(len(units) + 1))

    def neighbours(self, seed: int, free: np.ndarray) -> np.ndarray:
        """Unused units that share a term with the seed, best first, ties by number."""
        terms = self.terms[self.first[seed] : self.first[seed + 1]]
        if not len(terms):
            return terms
        lo, hi = self.begin[terms], self.end[terms]
        size = hi - lo
        at = np.arange(size.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        score = np.bincount(self.unit[at], self.weight[at], self.n)
        score[~free] = 0
        found = np.flatnonzero(score > 0)
        return found[np.argsort(-score[found], kind="stable")]


def pack_shard(docs: list[tuple], window: int, last: bool, corpus: Statistics | None = None) -> tuple[list[list[tuple]], list[tuple]]:
    """Sequences, each a list of pieces (id, document length, start, ids), and the tokens left for the next block.

    A document is (id, document length, start, ids): what is left of it. All of that is indexed.
    """
    done, units, indexed = [], [], []
    for key, total, start, ids in docs:
        whole = len(ids) - len(ids) % window
        done.extend([(key, total, start + lo, ids[lo : lo + window])] for lo in range(0, whole, window))
        if whole < len(ids):
            units.append((key, total, start + whole, ids[whole:]))
            indexed.append(ids)
    index = Index(indexed, corpus)
    free = np.ones(len(units), bool)
    taken = [0] * len(units)
    seed, room, held = 0, window, []

    def place(i: int) -> None:
        """Put the unit into the open window, as far as there is room."""
        nonlocal room, held
        key, total, start, ids = units[i]
        piece = ids[taken[i] : taken[i] + room]
        held.append((key, total, start + taken[i], piece))
        taken[i] += len(piece)
        room -= len(piece)
        if taken[i] == len(ids):
            free[i] = False
        if not room:
            done.append(held)
            room, held = window, []

    while seed < len(units):
        if not free[seed]:
            seed += 1
            continue
        place(seed)
        if not held:
            continue
        free_now = free.copy()
        free_now[seed] = False
        for i in index.neighbours(seed, free_now):
            place(int(i))
            if not held:
                break
    if not last:
        return done, held
    done.extend(_at_powers_of_two(held))
    return done, []


def _at_powers_of_two(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """The pieces cut into sequences of lengths that are powers of two, the longest first."""
    left = sum(len(p[3]) for p in pieces)
    pieces = pieces[::-1]
    while left:
        room = size = 1 << (left.bit_length() - 1)
        out = []
        while room:
            key, total, start, ids = pieces.pop()
            out.append((key, total, start, ids[:room]))
            if len(ids) > room:
                pieces.append((key, total, start + room, ids[room:]))
            room -= min(room, len(ids))
        yield out
        left -= size


PIECE = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(tokens: DataFrame, window: int = WINDOW, tokens_per_shard: int = TOKENS_PER_SHARD) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence and its ids (little-endian, 32-bit).

    Runs jobs: ``tokens``, of either form, are staged and counted.
    """
    if "df" not in tokens.columns:
        tokens = compacted(tokens)
    held = stage(tokens.withColumn("tie", F.xxhash64("ids")), "tokens")
    counted = statistics(held)
    shards = max(1, -(-round(counted.n * counted.mean) // tokens_per_shard))
    corpus = held.sparkSession.sparkContext.broadcast(counted)
    kind = held.schema["doc_id"].dataType.simpleString()
    order = ["sketch", "doc_id", "tie"]
    lists = held.filter("size is not null").select("doc_id", "ids", "size", "sketch", "tie")
    dealt = lists.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs, size, carried = [], 0, 0
        empty = True

        def packed(last: bool) -> pa.RecordBatch:
            nonlocal docs, size, number, carried
            done, left = pack_shard(docs, window, last, corpus.value)
            rows = []
            for sequence in done:
                at = 0
                for key, whole, start, ids in sequence:
                    rows.append((key, start, len(ids), whole, number, at, ids.astype("<u4").tobytes()))
                    at += len(ids)
                number += 1
            docs = left
            size = carried = sum(len(p[3]) for p in left)
            columns = list(zip(*rows)) or [()] * 7
            kinds = [key_type, *[pa.int64()] * 5, pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            key_type = batch.column(0).type
            for key, ids in zip(batch.column(0).to_pylist(), _wide(batch.column(1), batch.column(2).to_numpy())):
                empty = False
                docs.append((key, len(ids), 0, ids))
                size += len(ids)
                if size - carried >= tokens_per_shard:
                    yield packed(last=False)
        if not empty:
            yield packed(last=True)

    return dealt.select("doc_id", "ids", "size").mapInArrow(run, f"doc_id {kind}, {PIECE}")
