"""Near-duplicate documents by banded MinHash, odd sketches and confirmed links.

A document's set are the hashes of its distinct runs of five words. Documents of
one set are merged first, so a copy costs a row. Samples of a MinHash are cut
into bands; sets that agree in a band share a bucket. All samples are folded
into a bitmap in which each one flips a bit, an odd sketch: the bits in which
two sketches differ estimate how many samples differ, most precisely where few
do. Pairs that the estimate leaves far below the wanted similarity are dropped,
all others are decided on the full sets.

Buckets never emit all their pairs. In each round every unresolved bucket names
hubs, and only members outside a hub's component are compared with it. A hub has
then met its whole bucket and leaves it. A bucket is resolved when all members
left in it belong to one component; the number of hubs grows sixty-four-fold from
round to round, and where it reaches the members of a bucket, all of them are hubs
and the bucket is resolved. Every pair of a bucket is thus either decided or within a
component, as if all had been compared, while a group of near copies costs a row for each.

Tables are counted while they are staged. Those of few rows are broadcast, so that the
later rounds, in which little is left, don't shuffle for each join.

Bands of four samples, twenty of them, miss a pair of similarity 0.85 with
probability 4e-7.

Defined cases: a null text is empty. A text without words has no set, links with
nothing and is kept. A text of fewer words than a shingle has one shingle, the
whole of it. A row with a null id can't be named in a link: it is linked with
nothing and kept. Repeated ids are nodes of each of their texts. Other columns
are not read by :func:`components`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkwell.llm.common import text_of
from linkwell.session import shuffle_tasks, stage, stage_counted

SHINGLE = 5
BANDS, BAND_ROWS, SAMPLES = 20, 4, 256
SKETCH_WORDS = 16
SLACK = 0.14
BROADCAST_IDS = 1_000_000
BROADCAST_ROWS, BROADCAST_WIDE = 100_000, 25_000  # some 100 bytes a row, or 400
HUB_GROWTH = 64
CHUNK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20_240_607)
_SCALE = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_LETTER = _RANDOM.integers(1, (1 << 64) - 1, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, (1 << 64) - 1, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit of the result hangs on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lookup() -> tuple[np.ndarray, np.ndarray]:
    letters, space = _LETTER.copy(), np.zeros(256, bool)
    letters[65:91] = letters[97:123]  # A-Z as a-z
    space[[32, *range(9, 14)]] = True
    letters[space] = 0
    return letters, space


_LETTERS, _IS_SPACE = _lookup()


class _Powers:
    """Powers of the base and of its inverse, as many as the longest chunk so far asks for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            run = np.full(n, _BASE, np.uint64), np.full(n, _BASE_INVERSE, np.uint64)
            for r in run:
                r[0] = 1
            self.up, self.down = (np.multiply.accumulate(r) for r in run)
        return self.up, self.down


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word in the UTF-8 bytes of texts, and each text's first word's number (and the end)."""
    space = _IS_SPACE[data]
    begins = np.empty(len(data), bool)
    if len(data):
        begins[0], begins[1:] = True, space[:-1]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins & ~space)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), bounds
    up, down = powers.to(len(data))
    sums = np.add.reduceat(_LETTERS[data] * up[: len(data)], starts)
    return _mix(sums * down[starts]), bounds


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The set of each text: sorted distinct hashes of its shingles."""
    powers = _Powers()
    at, n = 0, len(texts)
    offsets = np.frombuffer(texts.buffers()[1], _offset_type(texts), n + 1 + texts.offset)[texts.offset :].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES)) - 1)
        to = min(to, n)
        own = offsets[at : to + 1]
        words, bounds = word_hashes(data[own[0] : own[-1]], own - own[0], powers)
        with np.errstate(over="ignore"):
            runs = sum((words[j : max(j, len(words) - size + 1 + j)] * _PLACE[j] for j in range(size)), np.uint64(0))
            runs = _mix(np.atleast_1d(runs)) if len(words) >= size else np.empty(0, np.uint64)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo >= size:
                    yield np.unique(runs[lo : hi - size + 1])
                elif hi > lo:
                    few = (words[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                    yield _mix(np.array([few], np.uint64))
                else:
                    yield np.empty(0, np.uint64)
        at = to


def _offset_type(texts: pa.Array) -> type:
    return np.int64 if pa.types.is_large_string(texts.type) else np.int32


def samples(hashes: np.ndarray, step: int = 4096) -> np.ndarray:
    """MinHash samples of a set that isn't empty."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, np.uint32(0xFFFFFFFF))
    for lo in range(0, len(short), step):
        part = short[None, lo : lo + step] * _SCALE[:, None] + _SHIFT[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _parity(hashes: np.ndarray) -> np.ndarray:
    """A bitmap in which each number flips a bit."""
    bits = SKETCH_WORDS * 64
    count = np.bincount((_mix(hashes) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).view(np.uint64)


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """The samples folded into a bitmap: each flips a bit, chosen by its value and number."""
    return _parity(found.astype(np.uint64) + (np.arange(len(found), dtype=np.uint64) << np.uint64(32)))


def set_sketch(hashes: np.ndarray) -> np.ndarray:
    """The whole set folded likewise. Two such bitmaps differ in at most as many bits as sets differ in members."""
    return _parity(hashes ^ np.uint64(_BASE))


def most_odd_bits(similarity: float, slack: float = SLACK) -> int:
    """Differing bits above which a pair's estimated similarity is below the wanted one by more than ``slack``."""
    bits = SKETCH_WORDS * 64
    return int(bits / 2 * (1 - np.exp(-4 * SAMPLES * (1 - similarity + slack) / bits)))


def signatures(docs: DataFrame) -> DataFrame:
    """Id, set size, two sums that stand for the set, bands and odd sketch of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            with np.errstate(over="ignore"):
                for found in shingle_sets(batch.column(1)):
                    if not len(found):
                        rows.append((0, 0, 0, None, None, None))
                        continue
                    least = samples(found)
                    keys = least[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
                    bands = _mix((keys * _PLACE[:BAND_ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                    sums = found.sum(dtype=np.uint64), _mix(found).sum(dtype=np.uint64)
                    rows.append((len(found), *(int(x.view(np.int64)) for x in sums), bands.view(np.int64), odd_sketch(least).view(np.int64), set_sketch(found).view(np.int64)))
            n, a, b, bands, sketch, members = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 *[pa.array(x, pa.list_(pa.int64())) for x in (bands, sketch, members)]],
                ["doc_id", "n_shingles", "sum_a", "sum_b", "bands", "sketch", "members"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_shingles long, sum_a long, sum_b long, bands array<long>, sketch array<long>, "
        "members array<long>",
    )


SET = ["n_shingles", "sum_a", "sum_b"]


def _words() -> list[Column]:
    """The words of both bitmaps as columns of their own, which a join condition reads fastest."""
    return [F.get(c, F.lit(i)).alias(f"{c}{i}") for c in ("sketch", "members") for i in range(SKETCH_WORDS)]


def _few(df: DataFrame, rows: int, most: int) -> DataFrame:
    """The table, broadcast if it has at most so many rows."""
    return F.broadcast(df) if rows <= most else df


def full_sets(docs: DataFrame, nodes: DataFrame, count: int) -> DataFrame:
    """``node`` and its set, for the ``count`` nodes of ``nodes`` (doc_id and what stands for the set), staged."""
    ids = _few(nodes.select(F.col("doc_id").alias("node")), count, BROADCAST_IDS)  # 8 bytes an id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = [(s, s.sum(dtype=np.uint64), _mix(s).sum(dtype=np.uint64)) for s in shingle_sets(part.column(1))]
                sums = [pa.array([len(s) for s, _, _ in found], pa.int64())]
                sums += [pa.array([int(x[i].view(np.int64)) for x in found], pa.int64()) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *sums, pa.array([s.view(np.int64) for s, _, _ in found], pa.list_(pa.int64()))],
                    ["node", *SET, "hashes"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("node"), text_of().alias("text")).join(ids, "node", "left_semi")
    found = rows.mapInArrow(run, f"node {kind}, n_shingles long, sum_a long, sum_b long, hashes array<long>")
    own = _few(nodes.select(F.col("doc_id").alias("node"), *SET), count, BROADCAST_ROWS)
    return stage(found.join(own, ["node", *SET], "left_semi").dropDuplicates(["node", *SET]), "sets")


def connected_components(edges: DataFrame, count: int) -> tuple[DataFrame, int]:
    """``node`` and ``component``, its least reachable node, of ``count`` staged edges (a, b), and how many. Runs jobs.

    Alternates two steps until all components are stars around their least node: each
    node hands its greater neighbours, then its lesser ones, to the least of them. Both
    keep all components and only group and join by node.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("m"), F.count_if(F.col("b") < F.col("a")).alias("less"), F.count(F.lit(1)).alias("all"))
        if not around.filter("less > 1 or less = 1 and all > 1").take(1):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")), count
        least = _few(around.select("a", F.least("m", "a").alias("m")), 2 * count, BROADCAST_ROWS)
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large, count = stage_counted(large, "edges")
        least = _few(large.groupBy("a").agg(F.min("b").alias("m")), count, BROADCAST_ROWS)
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges, count = stage_counted(small.select("e.*").filter("a != b").distinct(), "edges")


def _near(pair: DataFrame, hub: DataFrame, percent: int) -> DataFrame:
    """Members and hubs of a bucket, of different components, whose sizes and sketches allow a link: distinct (a, b).

    The comparison is a condition of the join, so only pairs that pass it become rows.
    """
    differ = lambda c: reduce(
        Column.__add__, [F.bit_count(F.col(f"{c}{i}").bitwiseXOR(F.col(f"h_{c}{i}"))) for i in range(SKETCH_WORDS)]
    )
    sizes = 100 * F.least("n_shingles", "h_n_shingles") >= percent * F.greatest("n_shingles", "h_n_shingles")
    # Linked sets differ in at most this share of their sizes, and their bitmaps in no more bits.
    few = (100 + percent) * differ("members") <= (100 - percent) * (F.col("n_shingles") + F.col("h_n_shingles"))
    met = pair.join(
        hub.toDF(*[f"h_{c}" for c in hub.columns]),
        (F.col("bucket") == F.col("h_bucket")) & (F.col("component") != F.col("h_component"))
        & (~F.col("is_hub") | (F.col("node") < F.col("h_node"))) & sizes & few
        & (differ("sketch") <= most_odd_bits(percent / 100)),
    )
    return met.select(F.least("node", "h_node").alias("a"), F.greatest("node", "h_node").alias("b")).distinct()


def _links(pairs: DataFrame, count: int, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``count`` pairs (a, b) whose full sets share at least ``percent`` of their union."""
    hashes = lambda s: sets.select(F.col("node").alias(s), F.col("hashes").alias(f"h_{s}"))
    if count <= BROADCAST_ROWS:
        whole = hashes("b").join(F.broadcast(pairs), "b").join(hashes("a").join(F.broadcast(pairs), "a"), ["a", "b"])
    else:
        whole = pairs.join(hashes("b"), "b").join(hashes("a"), "a")
    shared, size = F.size(F.array_intersect("h_a", "h_b")), F.size("h_a") + F.size("h_b")
    whole = whole.withColumns({"shared": shared, "size": size})
    return whole.filter(100 * F.col("shared") >= percent * (F.col("size") - F.col("shared"))).select("a", "b")


def _with_hubs(live: DataFrame, count: int, hubs: int) -> tuple[DataFrame, int]:
    """The ``count`` rows of ``live`` (bucket, its number ``n`` of members, node, component) with ``is_hub``, staged, and the number of hubs.

    At most ``hubs`` for each bucket, drawn by a hash of the node; all members where they aren't more.
    """
    drawn = F.xxhash64("node")
    part = F.when(F.col("n") <= hubs, drawn).otherwise(F.pmod(drawn, F.lit(hubs))).alias("part")
    chosen = live.groupBy("bucket", part).agg(F.min("node").alias("node")).select("bucket", "node", F.lit(True).alias("is_hub"))
    marked = live.join(_few(chosen, count, BROADCAST_ROWS), ["bucket", "node"], "left")
    marked = marked.select("bucket", "node", "component", F.coalesce("is_hub", F.lit(False)).alias("is_hub"))
    seen = Observation()
    marked = stage(marked.observe(seen, F.count_if("is_hub").alias("hubs")), "marked")
    return marked, seen.get["hubs"]


def components(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``. Runs jobs; texts are read twice."""
    signed = stage(signatures(docs), "signatures")
    named = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    nodes = named.groupBy(*SET).agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"), *[F.any_value(c).alias(c) for c in ("sketch", "members")])
    # An id with several texts is a node for each; they are told apart by number.
    nodes = stage(nodes.withColumn("node", F.struct("doc_id", *SET)), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # All nodes are components of their own yet, so every bucket is open.
    live, count = stage_counted(buckets.join(shared, "bucket").select("bucket", "n", "node", F.col("node").alias("component")), "live")
    met = _few(live.select("node"), count, BROADCAST_ROWS)
    near = nodes.join(met, "node", "left_semi").select("node", F.col("node.n_shingles").alias("n_shingles"), *_words())
    near, n_near = stage_counted(near, "near")
    sets = full_sets(docs, near.select("node.*"), n_near).select(F.struct(F.col("node").alias("doc_id"), *SET).alias("node"), "hashes")
    traits = _few(near, n_near, BROADCAST_WIDE)
    labels, n_labels, hubs = None, 0, 1
    while count:
        marked, n_hubs = _with_hubs(live, count, hubs)
        drawn = lambda x: x.join(traits, "node").select("bucket", "node", "component", *[c for c in near.columns if c != "node"], "is_hub")
        pair, hub = marked, drawn(marked.filter("is_hub")).drop("is_hub")
        if n_hubs <= BROADCAST_WIDE:
            # Members meet their hubs wherever they are: a hot bucket is spread as well.
            hub = F.broadcast(hub)
            if n_near <= BROADCAST_WIDE:
                pair = marked.repartition(shuffle_tasks(docs.sparkSession))
        pairs, n_pairs = stage_counted(_near(drawn(pair), hub, percent), "pairs")
        links, n_links = stage_counted(_links(pairs, n_pairs, sets, percent), "links") if n_pairs else (pairs, 0)
        if n_links and labels is None:
            labels, n_labels = connected_components(links, n_links)
        elif n_links:
            of = lambda s: _few(labels.select(F.col("node").alias(s), F.col("component").alias(f"c_{s}")), n_labels, BROADCAST_ROWS)
            ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
                F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")
            )
            found, n_found = connected_components(*stage_counted(ends, "ends"))
            moved = found.select(F.col("node").alias("component"), F.col("component").alias("to"))
            kept = labels.join(_few(moved, n_found, BROADCAST_ROWS), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            fresh = found.join(_few(labels, n_labels, BROADCAST_ROWS), "node", "left_anti")
            labels, n_labels = stage_counted(kept.unionByName(fresh), "labels")
        left = marked.filter(~F.col("is_hub")).select("bucket", "node")
        if labels is None:
            left = left.withColumn("component", F.col("node"))
        else:
            known = left.join(_few(labels, n_labels, BROADCAST_ROWS), "node", "left")
            left = known.select("bucket", "node", F.coalesce("component", "node").alias("component"))
        open_ = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        open_ = _few(open_.filter("lo != hi").select("bucket", "n"), count - n_hubs, BROADCAST_ROWS)
        live, count = stage_counted(left.join(open_, "bucket").select("bucket", "n", "node", "component"), "live")
        hubs *= HUB_GROWTH
    base = nodes.select(*SET, "node")
    if labels is not None:
        base = base.join(_few(labels, n_labels, BROADCAST_ROWS), "node", "left").select(*SET, F.coalesce("component", "node").alias("node"))
    base = base.select(*SET, F.col("node.doc_id").alias("first_id"))
    slim = signed.select("doc_id", *SET)
    known = slim.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).join(base, SET)
    alone = slim.filter(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).withColumn("first_id", F.col("doc_id"))
    return known.unionByName(alone).select(
        "doc_id", "n_shingles", F.col("first_id").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("first_id")).alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` but those linked to one of lesser id, or of equal id earlier in the table. Runs jobs.

    Rows are told apart by number, so repeated ids and null ones, which come
    first, are documents like others. Rows without words stay.
    """
    numbered = [F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]]
    rows = stage(docs.select(*numbered), "rows")
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    ids = F.struct(F.col(name["doc_id"]).alias("id"), "row").alias("doc_id")
    found = components(rows.select(ids, F.col(name["text"]).alias("text")), percent)
    gone = stage(found.filter(~F.col("kept")).select(F.col("doc_id.row").alias("row")), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone  # 8 bytes a row
    return rows.join(gone, "row", "left_anti").select(*[F.col(v).alias(c) for c, v in name.items()])
