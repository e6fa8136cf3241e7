"""Subword encoding by a merge-type sentencepiece model, and decoding.

A text is cut where a run of spaces begins. No piece of such a model holds a
space after another character (checked when the model is read), so no merge
crosses a cut and each part is encoded by itself. Within a part, adjacent pairs
that form a piece wait in an agenda in the order of score, leftmost first. The
best pair is merged, and the pairs it forms with its neighbours are added.
Characters without a piece become byte pieces.

Parts that a worker meets for the first time are encoded by the agenda and, batch
by batch, compared with the sentencepiece library; a difference is an error.
Known parts are looked up in a cache of bounded size.

Defined cases: null is the empty text, which has only the begin and end ids and
decodes to "". Repeated rows are encoded alike. Other columns are kept.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwell.llm.common import text_of

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
CACHED_PARTS = 500_000
SHORT_PART = 80
NEVER = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif tag & 7 == 5:
            yield tag >> 3, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        else:
            raise ValueError("not a sentencepiece model")


class _Parts(dict):
    """Ids of parts, computed where unknown. The oldest half goes when there are too many."""

    def __init__(self, merge, most: int):
        self.merge, self.most, self.old, self.fresh = merge, most, {}, {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.old.get(part)
        if ids is None:
            self.fresh[part] = ids = self.merge(MARK + part)
        self[part] = ids
        return ids

    def age(self) -> None:
        self.fresh = {}
        if len(self) > self.most // 2:
            self.old = dict(self)
            self.clear()


class MergeModel:
    """Pieces, scores and ids of a model file's content."""

    def __init__(self, content: bytes, cached: int = CACHED_PARTS):
        self.content = content
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.surface: list[bytes] = []
        self.is_byte: list[bool] = []
        self.unknown, self.begin, self.end = 0, 1, 2
        rules = {"charsmap": b"", "prefix": 1, "squeeze": 1}
        for number, value in _fields(content):
            if number == 1:
                self._add(dict(_fields(value)))
            elif number == 2:
                trainer = dict(_fields(value))
                if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
                    raise ValueError("only merge-type models with byte fallback are supported")
                self.unknown, self.begin, self.end = (trainer.get(n, d) for n, d in ((40, 0), (41, 1), (42, 2)))
            elif number == 3:
                found = dict(_fields(value))
                rules = {"charsmap": found.get(2, b""), "prefix": found.get(3, 1), "squeeze": found.get(4, 1)}
        if rules["charsmap"] or rules["squeeze"] or not rules["prefix"]:
            raise ValueError("only models with a space put in front and no other normalization are supported")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece holds a space after another character")
        self.cost = {p: -x for p, x in self.score.items()}.get
        self.cache = _Parts(self.merge, cached)
        self._library = None

    def _add(self, piece: dict) -> None:
        number, text, kind = len(self.surface), piece[1].decode("utf-8"), piece.get(3, NORMAL)
        if kind == NORMAL:
            self.id[text], self.score[text] = number, piece.get(2, 0.0)
            self.surface.append(text.replace(MARK, " ").encode("utf-8"))
        elif kind == BYTE:
            self.byte[int(text[3:5], 16)] = number
            self.surface.append(bytes([int(text[3:5], 16)]))
        elif kind in (UNKNOWN, CONTROL):
            self.surface.append(" ⁇ ".encode() if kind == UNKNOWN else b"")
        else:
            raise ValueError("user-defined and unused pieces are not supported")
        self.is_byte.append(kind == BYTE)

    def merge(self, part: str) -> tuple[int, ...]:
        """Ids of a part by the agenda of adjacent pairs."""
        symbols = self._merge_short(part) if len(part) <= SHORT_PART else self._merge_long(part)
        ids: list[int] = []
        for s in symbols:
            known = self.id.get(s)
            ids.extend([known] if known is not None else (self.byte[b] for b in s.encode("utf-8")))
        return tuple(ids)

    def _merge_short(self, part: str) -> list[str]:
        """The agenda as a list: the cost of each adjacent pair, of which the leftmost least is next."""
        symbols, cost = list(part), self.cost
        agenda = [cost(p, NEVER) for p in map(str.__add__, symbols, symbols[1:])]
        while agenda and (best := min(agenda)) < NEVER:
            i = agenda.index(best)
            symbols[i] = piece = symbols[i] + symbols[i + 1]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = cost(piece + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + piece, NEVER)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        """The agenda as a heap, with pairs that a merge has made stale left in it."""
        symbols, score = list(part), self.score
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(-score[p], i, i + 1, p) for i, p in enumerate(map(str.__add__, symbols, symbols[1:])) if p in score]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, piece = heapq.heappop(agenda)
            if right[i] != j or symbols[i] + symbols[j] != piece or not symbols[i] or not symbols[j]:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = piece, ""
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (p := piece + symbols[k]) in score:
                    heapq.heappush(agenda, (-score[p], i, k, p))
            if (h := left[i]) >= 0 and (p := symbols[h] + piece) in score:
                heapq.heappush(agenda, (-score[p], h, i, p))
        return [s for s in symbols if s]

    @staticmethod
    def parts(text: str) -> list[str]:
        """The text cut before each run of spaces, each part without its first space."""
        if MARK in text:
            text = text.replace(MARK, " ")
        cut = text.split(" ")
        if "" not in cut or not text:
            return cut if text else []
        out, run = [], 0
        for i, word in enumerate(cut):
            if word or i == len(cut) - 1:
                out.append(MARK * run + word)
                run = 0
            else:
                run += 1
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, between the begin and end ids."""
        of = self.cache.__getitem__
        found = [[self.begin, *chain.from_iterable(map(of, self.parts(t))), self.end] for t in texts]
        self._compare(self.cache.fresh)
        self.cache.age()
        return found

    def _compare(self, found: dict[str, tuple[int, ...]]) -> None:
        """Compare parts with the library, which puts the first space in front itself."""
        if self._library is None:
            import sentencepiece

            self._library = sentencepiece.SentencePieceProcessor(model_proto=self.content)
        theirs = self._library.encode([p.replace(MARK, " ") for p in found], num_threads=1)
        for (part, ids), other in zip(found.items(), theirs):
            if part and list(ids) != other:  # the library leaves an empty part without its space
                raise ValueError(f"the library encodes {part!r} as {other}, not as {list(ids)}")

    def decode(self, ids: list[int]) -> str:
        """Text of ids; a byte that is not part of a character becomes U+FFFD."""
        ids = [i for i in ids if self.surface[i]]
        joined = b"".join(map(self.surface.__getitem__, ids))
        try:
            text = joined.decode("utf-8")
        except UnicodeDecodeError:
            text = "".join(self._runs(ids))
        return text[1:] if text.startswith(" ") and ids[0] != self.unknown and not self.is_byte[ids[0]] else text

    def _runs(self, ids: list[int]) -> Iterator[str]:
        run = b""
        for i in [*ids, self.end]:
            if self.is_byte[i]:
                run += self.surface[i]
                continue
            while run:
                width = next((k for k in (1, 2, 3, 4) if _character(run[:k])), 0)
                yield run[:width].decode("utf-8") if width else "�"
                run = run[width or 1 :]
            yield self.surface[i].decode("utf-8")


def _character(b: bytes) -> bool:
    try:
        return len(b.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


_models: dict[int, MergeModel] = {}


def _model_of(content: bytes) -> MergeModel:
    """The model, kept from task to task by a worker process with the parts it knows."""
    key = hash(content)
    if key not in _models:
        _models.clear()
        _models[key] = MergeModel(content)
    return _models[key]


def encode_decode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` without its text, with ``ids`` (packed, little-endian unsigned 32-bit) and ``decoded``.

    ``model`` is the path of a model file, read once on the driver; its size is
    that of a vocabulary, not of the data.
    """
    spark = docs.sparkSession
    with open(model, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())
    kept = [c for c in docs.columns if c not in (text, ids, decoded)]
    rows = docs.select(*kept, text_of(text).alias(text))
    schema = rows.drop(text).selectExpr("*", f"cast(null as binary) `{ids}`", f"cast(null as string) `{decoded}`").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model_of(content.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = pieces.encode(part.column(len(kept)).to_pylist())
                packed = pa.array([np.array(i, "<u4").tobytes() for i in found], pa.binary())
                texts = pa.array([pieces.decode(i) for i in found], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], packed, texts], [*kept, ids, decoded])

    return rows.mapInArrow(run, schema)
