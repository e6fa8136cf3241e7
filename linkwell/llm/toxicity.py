"""Toxicity scores by a factorization machine over hashed terms.

Terms are a text's distinct words and their beginnings, which inflected forms
share, hashed to a fixed number of features. The machine adds a weight for each
feature and, for each pair of features, the product of two short vectors, so a
word that is only toxic together with another is scored by the pair.

It is fitted in one task on a bounded sample of labelled rows, at most
``MOST_TOXIC`` and ``MOST_CLEAN`` of each label, those of the least hash of their
id. Its size is bounded by the number of features. Scoring reads whole texts and
shuffles nothing.

Defined cases: a null or empty text has no terms and gets the score of the bias.
Labels that are null or belong to no document, or whose id is null, are not
learnt from; an id labelled both ways is toxic; of documents that share an id one is
learnt from. Documents without a label are scored like others; repeated rows get
the same score. Without labels of both kinds every score is the share of toxic
ones (0 without any). Other columns are kept unless they are named like a result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.llm.common import text_of

FEATURES, FACTORS = 1 << 18, 4
MOST_TOXIC, MOST_CLEAN = 4_000, 8_000
LEAST_TEXTS = 4
STEMS = (4, 5)
STEPS, RATE, CHANCE = 60, 0.5, 2.5
PAIR_RATE, DECAY, BLOCK = 0.1, 1e-4, 512
CACHED_WORDS = 400_000
_WORD = re.compile(r"[^\W\d_]+")


class Terms(dict):
    """Features of words, computed once each while a bounded cache holds them."""

    def __init__(self, keep: np.ndarray | None = None):
        self.keep = keep  # position of a feature among those that have a weight, or -1

    def __missing__(self, word: str) -> tuple[int, ...]:
        names = [word, *(f"{word[:n]}-" for n in STEMS if len(word) >= n)]
        found = (zlib.crc32(x.encode("utf-8")) % FEATURES for x in names)
        if self.keep is not None:
            found = (k for k in (int(self.keep[i]) for i in found) if k >= 0)
        self[word] = features = tuple(found)
        return features

    def of(self, text: str) -> set[int]:
        return set(chain.from_iterable(map(self.__getitem__, set(_WORD.findall(text.lower())))))

    def trim(self) -> None:
        if len(self) > CACHED_WORDS:
            self.clear()


class Machine:
    """Bias, weights and vectors of features."""

    def __init__(self, features: np.ndarray, bias: float, weight: np.ndarray, vector: np.ndarray):
        self.features, self.bias, self.weight, self.vector = features, bias, weight, vector

    def margins(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log-odds of texts, each a run of positions of features."""
        out = np.full(len(offsets) - 1, self.bias)
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            sums = lambda x: np.add.reduceat(x[flat], offsets[full], axis=0, dtype=np.float64)
            both = sums(self.vector)
            pairs = ((both**2).sum(axis=1) - sums((self.vector**2).sum(axis=1))) / 2
            out[full] += sums(self.weight) + pairs
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_machine(texts: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Machine:
    """Fit by adaptive gradient steps over the whole sample on the logistic loss.

    First the weights: each step draws a weight towards zero by as much as chance
    would move it, ``CHANCE`` standard deviations, so terms that have nothing to
    do with the label stay at zero and don't add up in long texts. Then, with the
    weights, the vectors: of features that have a weight and of those of any pair
    that the weights leave unexplained beyond chance (:func:`telling`). All others'
    stay at zero for the same reason.
    """
    y = labels.astype(np.float64)
    share = float(y.mean()) if len(y) else 0.0
    count = np.bincount(np.concatenate(texts), minlength=FEATURES) if texts else np.zeros(FEATURES, np.int64)
    features = np.flatnonzero(count >= LEAST_TEXTS)
    if not 0 < share < 1 or not len(features):
        bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return Machine(np.empty(0, np.int64), bias, np.empty(0), np.empty((0, FACTORS)))
    flat, offsets = _positions(texts, features)
    n, rows = len(features), len(texts)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    pull = CHANCE * np.sqrt(count[features] * share * (1 - share)) / rows
    machine = Machine(features, float(np.log(share / (1 - share))), np.zeros(n), np.zeros((n, FACTORS)))
    grown, bias_grown = np.full(n, 1e-8), 1e-8

    def step_weights(margins: np.ndarray) -> np.ndarray:
        nonlocal bias_grown
        error = (sigmoid(margins) - y) / rows
        slope = np.bincount(flat, error[owner], n)
        grown[:] += slope**2
        step = RATE / np.sqrt(grown)
        moved = machine.weight - step * slope
        machine.weight = np.sign(moved) * np.maximum(np.abs(moved) - step * pull, 0)
        bias_grown += error.sum() ** 2
        machine.bias -= RATE * error.sum() / np.sqrt(bias_grown)
        return error

    for _ in range(STEPS):
        step_weights(machine.bias + np.bincount(owner, machine.weight[flat], rows))

    margins, shift = np.bincount(owner, machine.weight[flat], rows), machine.bias
    for _ in range(30):  # the bias at which errors add up to nothing
        p = sigmoid(margins + shift)
        shift += np.clip((y - p).sum() / max((p * (1 - p)).sum(), 1e-9), -1, 1)
    chosen = np.union1d(np.flatnonzero(machine.weight), telling(flat, owner, n, y, sigmoid(margins + shift)))
    paired = np.isin(flat, chosen)
    some, some_owner = flat[paired], owner[paired]
    machine.vector[chosen] = np.random.default_rng(seed).normal(0, 0.03, (len(chosen), FACTORS))
    vector_grown = np.full((n, FACTORS), 1e-8)
    for _ in range(STEPS if len(chosen) else 0):
        own = machine.vector[some]
        both = np.stack([np.bincount(some_owner, own[:, f], rows) for f in range(FACTORS)], axis=1)
        pairs = ((both**2).sum(axis=1) - np.bincount(some_owner, (own**2).sum(axis=1), rows)) / 2
        error = step_weights(machine.bias + np.bincount(owner, machine.weight[flat], rows) + pairs)
        each = error[some_owner]
        slope = np.stack([np.bincount(some, each * (both[some_owner, f] - own[:, f]), n) for f in range(FACTORS)], axis=1)
        slope += DECAY * machine.vector
        vector_grown += slope**2
        machine.vector -= PAIR_RATE * slope / np.sqrt(vector_grown)
    used = (machine.weight != 0) | (machine.vector != 0).any(axis=1)
    return Machine(features[used], machine.bias, machine.weight[used], machine.vector[used])


def telling(flat: np.ndarray, owner: np.ndarray, n: int, y: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Features of pairs whose texts' labels are off the chances ``p`` further than chance explains.

    All pairs of the ``n`` features are judged, by Bernstein's bound on the sum of
    the errors of the texts that hold both, at a level that less than one of all
    pairs reaches by chance. Features whose own errors can't add up to the least
    sum that the bound admits are in no such pair and left out before.
    """
    level = 2 * np.log(max(n, 2))
    error, rows = y - p, len(y)
    most = np.maximum(*(np.bincount(flat, np.maximum(e, 0)[owner], n) for e in (error, -error)))
    able = np.flatnonzero(most >= 2 * level / 3)
    place = np.full(n, -1, np.int64)
    place[able] = np.arange(len(able))
    column, row = place[flat], owner
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    begins = range(0, len(able), BLOCK)
    cuts = np.searchsorted(column, [*begins, len(able)])
    found = np.zeros(len(able), bool)
    error, spread = (x.astype(np.float32)[:, None] for x in (error, p * (1 - p)))

    def texts_of(k: int) -> np.ndarray:
        block = np.zeros((rows, min(BLOCK, len(able) - k * BLOCK)), np.float32)
        own = slice(cuts[k], cuts[k + 1])
        block[row[own], column[own] - k * BLOCK] = 1
        return block

    for i in range(len(begins)):
        left = texts_of(i)
        errors, spreads = (left * error).T, (left * spread).T
        for j in range(i, len(begins)):
            right = left if i == j else texts_of(j)
            sums = np.abs(errors @ right)
            beyond = sums**2 >= 2 * level * (spreads @ right + sums / 3)
            if i == j:
                np.fill_diagonal(beyond, False)
            beyond &= sums > 0
            found[i * BLOCK : i * BLOCK + left.shape[1]] |= beyond.any(axis=1)
            found[j * BLOCK : j * BLOCK + right.shape[1]] |= beyond.any(axis=0)
    return able[found]


def _positions(texts: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the texts' features among those given, end to end, and where each text begins (and the end)."""
    keep = np.full(FEATURES, -1, np.int64)
    keep[features] = np.arange(len(features))
    found = [k[k >= 0] for k in (keep[t] for t in texts)]
    return np.concatenate(found), np.concatenate([[0], np.cumsum([len(f) for f in found])])


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Machine:
    """Fit on labelled documents (doc_id, toxic) that aren't held out. Runs a job; returns a bounded model.

    An id labelled both ways is toxic; null labels are none. Of documents of one id one
    is taken, that of the least text hash, so the sample is bounded in rows as well.
    """
    usable = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda y, n: usable.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = F.broadcast(pick(1, most_toxic).unionByName(pick(0, most_clean)))
    rows = docs.select("doc_id", text_of().alias("text")).join(sample, "doc_id")
    single = F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text"), "text")).alias("one")
    rows = rows.groupBy("doc_id").agg(single).select("one.text", F.col("one.toxic").cast("int").alias("toxic"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = [sorted(terms.of(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], ["terms", "toxic"])

    def fitted(table: pa.Table) -> pa.Table:
        texts = [np.array(t, np.int64) for t in table.column("terms").to_pylist()]
        order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), texts[i].tolist()))  # arrival has no order
        y = table.column("toxic").to_numpy()[order]
        m = fit_machine([texts[i] for i in order], y)
        packed = [x.astype(t).tobytes() for x, t in ((m.features, "<i4"), (m.weight, "<f4"), (m.vector, "<f4"))]
        return pa.table({"bias": [float(m.bias)], **{n: pa.array([p], pa.binary()) for n, p in zip("fwv", packed)}})

    model = (
        rows.mapInArrow(features, "terms array<int>, toxic int")
        .groupBy(F.lit(0).alias("all"))
        .applyInArrow(fitted, "bias double, f binary, w binary, v binary")
        .collect()
    )
    if not model:
        return fit_machine([], np.empty(0))
    bias, f, w, v = model[0]
    return Machine(
        np.frombuffer(f, "<i4"), bias, np.frombuffer(w, "<f4"), np.frombuffer(v, "<f4").reshape(-1, FACTORS)
    )


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` without its text, with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kept = [c for c in docs.columns if c not in ("text", "score", "predicted")]
    rows = docs.select(*kept, text_of().alias("text"))
    schema = rows.drop("text").selectExpr("*", "cast(null as double) score").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        keep = np.full(FEATURES, -1, np.int64)
        keep[m.features] = np.arange(len(m.features))
        terms = Terms(keep)
        for batch in batches:
            found = [terms.of(t) for t in batch.column(len(kept)).to_pylist()]
            terms.trim()
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in found])]).astype(np.int64)
            flat = np.fromiter(chain.from_iterable(map(sorted, found)), np.int64, int(offsets[-1]))
            scores = sigmoid(m.margins(flat, offsets))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(scores, pa.float64())], schema.names)

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
