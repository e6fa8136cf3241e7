"""String-similarity scores of two columns.

Set measures are built-in expressions. The three measures that need an alignment
(whole texts, best window, word sets) share one Arrow exchange per pair table: a
batch is scored with array operations over all its pairs at once, 64 characters
of the shorter text per machine word.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwell.functions.text import null_to_empty, numbers, words

# Tasks get these helpers with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = 64
_CELLS = 1 << 17
_LETTERS = 256


# --- helpers that run inside tasks -------------------------------------------------------------


def _codes(texts: list[str], lengths: np.ndarray, filler: int) -> np.ndarray:
    """Code points of each text, one column per text, padded with a value no text contains."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full((len(texts), int(lengths.max())), filler, dtype=np.uint32)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return np.ascontiguousarray(out.T)


def _positions(left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """Per needle word of 64 characters: bit i of cell (j, row) is set where right[j, row] equals the word's character i.

    With few different characters in the needles, the bits are gathered once for each
    character of a needle and looked up, else all places are compared.
    """
    seen = np.zeros(max(int(left.max(where=left < _FILL_LEFT, initial=0)), int(right.max(where=right < _FILL_RIGHT, initial=0))) + 2, dtype=bool)
    last = len(seen) - 1
    left, right = np.minimum(left, last), np.minimum(right, last)
    seen[left] = True
    seen[last] = False
    letters = np.flatnonzero(seen)
    if len(letters) > _LETTERS:
        return _compared(left, right, last)
    number = np.zeros(len(seen), dtype=np.intp)
    number[letters] = np.arange(1, len(letters) + 1)
    rows = np.arange(left.shape[1]) * (len(letters) + 1)
    at, wanted, hits = number[left] + rows, number[right] + rows, []
    for first in range(0, len(left), _WORD):
        bits = np.zeros(len(rows) * (len(letters) + 1), dtype=np.uint64)
        for i, cells in enumerate(at[first : first + _WORD]):
            bits[cells] |= np.uint64(1 << i)
        bits[rows] = 0
        hits.append(bits[wanted])
    return hits


def _compared(left: np.ndarray, right: np.ndarray, filler: int) -> list[np.ndarray]:
    hits = [np.zeros(right.shape, dtype=np.uint64) for _ in range(0, len(left), _WORD)]
    for i, row in enumerate(left):
        into = hits[i // _WORD]
        np.bitwise_or(into, np.uint64(1 << (i % _WORD)), out=into, where=(right == row) & (row != filler))
    return hits


_FILL_LEFT, _FILL_RIGHT = 0xFFFFFFFF, 0xFFFFFFFE


def _ones(hits: list[np.ndarray], shape: tuple[int, ...]) -> list[np.ndarray]:
    return [np.full(shape, ~np.uint64(0), dtype=np.uint64) for _ in hits]


def _step(state: list[np.ndarray], hits: list[np.ndarray]) -> None:
    """One column of the bit-parallel LCS recurrence, carrying from word to word; cleared bits count matches."""
    carry = None
    for w, (s, h) in enumerate(zip(state, hits)):
        both = s & h
        rest = s - both
        total = both + s
        more = w + 1 < len(state)
        over = total < both if more else None
        if carry is not None:
            total += carry
            if more:
                over |= total < carry
        total |= rest
        state[w] = total
        carry = over.astype(np.uint64) if more else None


def _matched(state: list[np.ndarray]) -> np.ndarray:
    counts = [np.bitwise_count(~s) for s in state]
    return counts[0].astype(np.int64) if len(counts) == 1 else sum(c.astype(np.int64) for c in counts)


def _hits(needles: list[str], others: list[str], m: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    return _positions(_codes(needles, m, _FILL_LEFT), _codes(others, n, _FILL_RIGHT))


def _lcs_block(needles: list[str], others: list[str], m: np.ndarray, n: np.ndarray) -> np.ndarray:
    hits = _hits(needles, others, m, n)
    state = _ones(hits, (len(needles),))
    for j in range(int(n.max())):
        _step(state, [h[j] for h in hits])
    return _matched(state)


def _best_beginning(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Best ``2*LCS/(needle+beginning)`` from the matches ``counts`` of beginnings of 1, 2, ... characters, shorter than the needle."""
    sizes = np.arange(1, len(counts) + 1)[:, None]
    return np.where(sizes < m, 2.0 * counts / (m + sizes), 0.0).max(axis=0, initial=0.0)


def _window_block(needles: list[str], others: list[str], m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Best ``2*LCS/(needle+window)`` over every window of each other text, which is no shorter than its needle.

    A window at an end may be shorter than the needle: one pass over the other text
    gives all of those at its beginning, one over both texts turned round those at its
    end. Windows as long as the needle are few where the lengths are alike; all of them
    advance together, one character per step.
    """
    longest, starts = int(m.max()), int((n - m).max()) + 1
    turned = _hits([t[::-1] for t in needles], [t[::-1] for t in others], m, n)
    hits = _hits(needles, others, m, n)
    short = max(starts + longest - 1 - len(hits[0]), 0)
    # The first row of the state is the other text turned round, the rest are the starts.
    state = _ones(hits, (starts + 1, len(needles)))
    hits = [np.concatenate([h, np.zeros((short, h.shape[1]), dtype=np.uint64)]) for h in hits]
    best, counts = np.zeros(len(needles)), np.zeros((2, longest, len(needles)), dtype=np.int64)
    for k in range(longest):
        _step(state, [np.concatenate([t[k : k + 1], h[k : k + starts]]) for t, h in zip(turned, hits)])
        counts[:, k] = _matched([s[:2] for s in state])
        full = np.flatnonzero(m == k + 1)
        if full.size:
            inside = np.arange(starts)[:, None] <= (n - m)[full]
            most = np.where(inside, _matched([s[1:, full] for s in state]), 0).max(axis=0)
            best[full] = 2.0 * most / (m[full] + (k + 1))
    return np.maximum(best, np.maximum(_best_beginning(counts[0], m), _best_beginning(counts[1], m)))


def _in_blocks(needles: list[str], others: list[str], block, out: np.ndarray, windows: bool = False) -> None:
    """Score rows in blocks of similar length so that padding and memory stay small."""
    m, n = (np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) for texts in (needles, others))
    parts = -(-m // _WORD)
    starts = n - m if windows else np.zeros_like(n)
    order = np.lexsort((m, n, starts, parts))
    cells = (parts * (2 * n + starts))[order]
    limit = np.append(np.flatnonzero(np.diff(parts[order])) + 1, len(order))
    at = 0
    while at < len(order):
        stop = int(limit[np.searchsorted(limit, at, side="right")])
        stop = min(stop, at + max(1, _CELLS // int(cells[at])))
        while stop > at + 1 and (stop - at) * int(cells[at:stop].max()) > _CELLS:
            stop = at + max(1, min(_CELLS // int(cells[at:stop].max()), stop - at - 1))
        some = order[at:stop]
        rows = some.tolist()
        out[some] = block([needles[r] for r in rows], [others[r] for r in rows], m[some], n[some])
        at = stop


def _by_length(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    shorter = [x if len(x) <= len(y) else y for x, y in zip(a, b)]
    return shorter, [y if len(x) <= len(y) else x for x, y in zip(a, b)]


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    out = np.array([len(x) if x == y else 0 for x, y in zip(a, b)], dtype=np.int64)
    rows = [r for r, (x, y) in enumerate(zip(a, b)) if x and y and x != y]
    shorter, longer = _by_length([a[r] for r in rows], [b[r] for r in rows])
    found = np.zeros(len(rows), dtype=np.int64)
    _in_blocks(shorter, longer, _lcs_block, found)
    out[rows] = found
    return out


def best_windows(a: list[str], b: list[str]) -> np.ndarray:
    """Best alignment of the shorter text inside the longer one, 0..1 per pair."""
    out = np.array([1.0 if x == y else 0.0 for x, y in zip(a, b)])
    owner = [r for r, (x, y) in enumerate(zip(a, b)) if x and y and x != y]
    shorter, longer = _by_length([a[r] for r in owner], [b[r] for r in owner])
    # Texts of equal length also swap roles: their prefixes and suffixes differ.
    alike = [i for i, (x, y) in enumerate(zip(shorter, longer)) if len(x) == len(y)]
    scores = np.zeros(len(owner) + len(alike))
    _in_blocks(shorter + [longer[i] for i in alike], longer + [shorter[i] for i in alike], _window_block, scores, windows=True)
    np.maximum.at(out, np.array(owner + [owner[i] for i in alike], dtype=np.int64), scores)
    return out


def token_set_scores(a: list[str], b: list[str]) -> np.ndarray:
    """Token-set ratio of each pair; 0 where a side has no word.

    With ``i`` the length of the shared words, ``g`` the space behind them and
    ``x``, ``y`` what only one side has, the three candidates compare
    shared+x with shared+y, shared with shared+x, and shared with shared+y.
    """
    out = np.zeros(len(a))
    rows, rest_a, rest_b, shared = [], [], [], []
    split = {t: set(t.split()) for t in {*a, *b}}
    for r, (s, t) in enumerate(zip(a, b)):
        left, right = split[s], split[t]
        if not left or not right:
            continue
        both = left & right
        if both and (len(both) == len(left) or len(both) == len(right)):
            out[r] = 1.0
            continue
        rows.append(r)
        rest_a.append(" ".join(sorted(left - both)))
        rest_b.append(" ".join(sorted(right - both)))
        shared.append(sum(map(len, both)) + max(len(both) - 1, 0))
    if rows:
        i = np.array(shared)
        g = (i > 0).astype(np.int64)
        x, y = (np.array([len(t) for t in rest]) for rest in (rest_a, rest_b))
        edits = x + y - 2 * lcs_lengths(rest_a, rest_b)
        best = 1.0 - edits / (2 * (i + g) + x + y)
        only = np.maximum(1.0 - (g + x) / (2 * i + g + x), 1.0 - (g + y) / (2 * i + g + y))
        out[rows] = np.where(i > 0, np.maximum(best, only), best)
    return out


@F.pandas_udf(T.DoubleType())
def _token_sets(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(token_set_scores(a.tolist(), b.tolist()))


@F.pandas_udf(T.LongType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(lcs_lengths(a.tolist(), b.tolist()))


@F.pandas_udf(T.DoubleType())
def _best_window(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(best_windows(a.tolist(), b.tolist()))


# --- column functions --------------------------------------------------------------------------


def _ratio(lcs: Column, size: Column) -> Column:
    return F.when(size == 0, F.lit(1.0)).otherwise(F.lit(2.0) * lcs / size)


def ratio(a: Column, b: Column) -> Column:
    """Normalized insert/delete similarity ``2*LCS/(|a|+|b|)``; two empty texts give 1."""
    a, b = null_to_empty(a), null_to_empty(b)
    return _ratio(_lcs(a, b), F.length(a) + F.length(b))


def partial_ratio(a: Column, b: Column) -> Column:
    """Best ``ratio`` of the shorter text with any window, prefix or suffix of the longer one."""
    return _best_window(null_to_empty(a), null_to_empty(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    """Best ratio among shared words, shared plus one side's rest, and both rests."""
    return _token_sets(null_to_empty(a), null_to_empty(b))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct words; two empty texts give 1, one empty text gives 0."""
    ta, tb = word_set(a), word_set(b)
    return jaccard_of(n_shared(ta, tb), ta, tb)


def numeric_overlap(a: Column, b: Column) -> Column:
    """Shared over all distinct digit runs; 0 when either side has none."""
    na, nb = numbers(a), numbers(b)
    return numeric_overlap_of(n_shared(na, nb), na, nb)


def word_set(c: Column) -> Column:
    return F.array_distinct(words(c))


def n_shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard_of(shared: Column, a: Column, b: Column) -> Column:
    """:func:`jaccard` of word sets that share so many."""
    every = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / every)


def numeric_overlap_of(shared: Column, a: Column, b: Column) -> Column:
    every = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / every)


def same_nonempty(a: Column, b: Column) -> Column:
    a, b = null_to_empty(a), null_to_empty(b)
    return ((a != "") & (a == b)).cast("int")


def length_diff(a: Column, b: Column) -> Column:
    return F.abs(F.length(null_to_empty(a)) - F.length(null_to_empty(b)))
