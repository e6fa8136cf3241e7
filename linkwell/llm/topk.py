"""Exact top-k search by inner product: columnar branch-and-bound over vertical blocks.

Components are turned into integers, so scores are exact. Candidates are dealt to
groups by a hash of their row, and each group is asked by every query, in blocks
of queries against blocks of candidates. A block of candidates lies vertically, a
dimension after the other, those with the most mass first. Scores are accumulated
for a few dimensions at a time. After each step what is still missing is at most
the product of the two remaining lengths (Cauchy-Schwarz); a pair that can't
reach the query's k-th best score so far is out, and once few pairs are left they
are compacted and go on by themselves. The best of the groups are merged by rank.

A task holds one group, at most ``GROUP_CELLS`` components and their padding;
queries stream past it. Where there are few groups, they are made smaller, as long
as queries sent to all groups don't outweigh the candidates.

Defined cases: vectors that are null or hold a null, NaN or infinite component take
no part. Vectors of different lengths are compared as if the shorter went on with
zeros, so an empty vector scores 0 with all. A null id is never a query; as a
candidate it is last among ties. Rows of one id are candidates of each other, and
each is a query; a row is never its own candidate. Scores beyond 64 bits are an
error, like other overflows in Spark. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwell.session import stage

SCALE, K = 256.0, 5
GROUP_CELLS, LEAST_GROUP_CELLS = 1 << 24, 1 << 19
BLOCK_CELLS, QUERY_BLOCK, DIMENSIONS = 1 << 20, 256, 16
#: Share of live pairs below which they are compacted.
COMPACT = 1 / 50
LARGEST = 1.7976931348623157e308
_NONE = np.iinfo(np.int64).min


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``row``, ``id`` and integer components ``v`` of the vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & x.between(-LARGEST, LARGEST))
    return vectors.filter(F.col(vector).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )


def _exact_type(bound: float) -> tuple[type, float]:
    """The fastest number type that holds scores up to the bound exactly, and what its comparisons may be off by."""
    for kind, limit, slack in ((np.float32, 2.0**24, 4.0), (np.float64, 2.0**53, 4.0), (np.int64, 2.0**63, 4096.0)):
        if bound < limit:
            return kind, slack
    raise OverflowError("an inner product may exceed 64 bits")


def _padded(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of their sizes as a matrix, filled up with zeros."""
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _remaining(square: np.ndarray) -> np.ndarray:
    """For each step of dimensions (rows of ``square``), the length of what comes after it."""
    steps = [square[at:].sum(axis=0) for at in range(DIMENSIONS, len(square) + DIMENSIONS, DIMENSIONS)]
    return np.sqrt(np.array(steps).reshape(len(steps), square.shape[1])) * (1 + 1e-5)


class Block:
    """Candidates in vertical layout."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray, ids: np.ndarray, no_id: np.ndarray):
        self.rows, self.ids, self.no_id = rows, ids, no_id
        values = _padded(flat, sizes)
        square = values.astype(np.float64) ** 2
        self.order = np.argsort(-square.sum(axis=0), kind="stable")
        small = not flat.size or np.abs(flat.astype(np.float64)).max() < 1 << 15
        self.data = np.ascontiguousarray(values[:, self.order].T, np.int16 if small else np.int64)
        self.rest = _remaining(square[:, self.order].T).astype(np.float32)
        self.length = float(np.sqrt(square.sum(axis=1).max(initial=0)))

    def search(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """Pairs (query, candidate, score) that may be among the best ``k``: all that reach ``least`` and aren't beaten here."""
        width, n = self.data.shape
        q = np.zeros((len(queries), width), np.int64)
        both = min(width, queries.shape[1])
        q[:, :both] = queries[:, :both]
        q = q[:, self.order]
        square = q.astype(np.float64) ** 2
        kind, slack = _exact_type(float(np.sqrt(square.sum(axis=1).max(initial=0))) * self.length)
        rest, floor = _remaining(square.T), least.astype(np.float64) - slack
        q = q.astype(kind)
        pairs, score = None, np.zeros((len(q), n), kind)
        for step, at in enumerate(range(0, width, DIMENSIONS)):
            some = slice(at, at + DIMENSIONS)
            if pairs is None:
                score += q[:, some] @ self.data[some].astype(kind)
                live = score + rest[step][:, None].astype(np.float32) * self.rest[step] >= floor[:, None].astype(np.float64)
                if np.count_nonzero(live) <= COMPACT * live.size:
                    pairs = np.nonzero(live)
                    score = score[pairs]
            else:
                for d in range(at, min(at + DIMENSIONS, width)):
                    score += q[pairs[0], d] * self.data[d, pairs[1]]
                live = score + rest[step][pairs[0]] * self.rest[step][pairs[1]] >= floor[pairs[0]]
                pairs, score = (pairs[0][live], pairs[1][live]), score[live]
        if pairs is None:
            bar = floor
            if n > k:  # one more than k, as a query's own row may be among them
                bar = np.maximum(floor, np.partition(score, n - k - 1, axis=1)[:, n - k - 1].astype(np.float64) - slack)
            pairs = np.nonzero(score >= bar[:, None])
            score = score[pairs]
        score = score.astype(np.int64)
        keep = (score >= least[pairs[0]]) & (self.rows[pairs[1]] != own[pairs[0]])
        return pairs[0][keep], pairs[1][keep], score[keep]


def best_of(blocks: list[Block], queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query number, candidate's id, whether it is null, and score: the best ``k`` of each query over all blocks."""
    least = np.full(len(queries), _NONE)
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
    for block in blocks:
        at, of, score = block.search(queries, own, least, k)
        held = tuple(map(np.concatenate, zip(held, (at, block.ids[of], block.no_id[of], score))))
        order = np.lexsort((held[1], held[2], ~held[3], held[0]))
        at = held[0][order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        held = tuple(x[order][rank < k] for x in held)
        last = rank[rank < k] == k - 1
        least[held[0][last]] = held[3][last]
    return held


class Group:
    """The candidates of a group, cut into blocks as they arrive."""

    def __init__(self, k: int):
        self.k, self.blocks, self.held, self.cells = k, [], [], 0

    def add(self, part: pa.RecordBatch) -> None:
        for some in _cut(part, BLOCK_CELLS, BLOCK_CELLS):
            width, n = some.column("size")[-1].as_py(), sum(p.num_rows for p in self.held) + some.num_rows
            if self.held and (n * max(width, 1) > BLOCK_CELLS):
                self.close()
            self.held.append(some)

    def close(self) -> None:
        if self.held:
            table = pa.Table.from_batches(self.held).combine_chunks().to_batches()[0]
            self.blocks.append(Block(*_columns(table)))
            self.held = []

    def ask(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.close()
        for some in _cut(part, QUERY_BLOCK, BLOCK_CELLS):
            flat, sizes, rows, ids, _ = _columns(some)
            at, found, no_id, score = best_of(self.blocks, _padded(flat, sizes), rows, self.k)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[at]), pa.array(ids[at]), pa.array(found, mask=no_id), pa.array(score)],
                    ["query_row", "query_id", "vec_id", "score"],
                )


def _columns(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Components end to end, sizes, rows, ids and null ids."""
    vectors, ids = part.column("v"), part.column("id")
    return (
        vectors.flatten().to_numpy(zero_copy_only=False),
        part.column("size").to_numpy(),
        part.column("row").to_numpy(),
        ids.fill_null(0).to_numpy(),
        ids.is_null().to_numpy(zero_copy_only=False),
    )


def _cut(part: pa.RecordBatch, rows: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Pieces of so many rows and, filled up to their longest vector, cells at most. Sizes ascend."""
    size, at = np.maximum(part.column("size").to_numpy(), 1), 0
    while at < part.num_rows:
        n = np.searchsorted(size[at : at + rows] * np.arange(1, len(size[at : at + rows]) + 1), cells, side="right")
        yield part.slice(at, max(1, int(n)))
        at += max(1, int(n))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
    group_cells: int = GROUP_CELLS,
    least_group_cells: int = LEAST_GROUP_CELLS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the best ``k`` rows for each query. Runs jobs.

    ``is_query`` is a condition on the column ``id``, the key as a long.
    """
    held = stage(quantised(vectors, key, vector, scale).select("*", F.size("v").alias("size"), F.coalesce(is_query, F.lit(False)).alias("asks")), "vectors")
    cells, asking = held.agg(F.sum(F.col("size").cast("long") + 1), F.sum(F.when(F.col("asks"), F.col("size").cast("long") + 1))).first()
    cells, asking = cells or 0, asking or 1
    groups = max(1, -(-cells // group_cells), min(cells // asking, -(-cells // least_group_cells)))
    parts = -(-asking // group_cells)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["row", "id", "size", "v"]
    candidates = held.select(
        F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), spread(parts).alias("part"), F.lit(0).alias("kind"), *columns
    )
    queries = held.filter("asks").select(
        spread(groups).alias("group"), F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"), *columns
    )
    dealt = candidates.unionByName(queries).repartition(groups * parts, "group", "part").sortWithinPartitions("group", "part", "kind", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, group = None, Group(k)
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("group", "part", "kind")])
            cuts = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if here != tuple(place[:2, lo]):
                    here, group = tuple(place[:2, lo]), Group(k)
                if place[2, lo] == 0:
                    group.add(batch.slice(lo, hi - lo))
                else:
                    yield from group.ask(batch.slice(lo, hi - lo))

    found = dealt.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
