"""Removal of bytes covered by long strings that also start earlier.

The first document (least id) keeps a repeated string, later ones lose it. What
must be decided is which windows of ``length`` bytes occur before. From each
window the rarest-looking q-gram, that of the least hash, is its anchor. Equal
windows have equal anchors at equal places, so only windows of one anchor need be
compared, and consecutive windows of one anchor form a segment.

1. Batches of documents send the distinct hashes of their anchors, packed, to
   buckets; each learns which of its anchors occur elsewhere or twice.
2. Batches cut out the segments of those anchors. Of equal segments in a batch
   the first goes on, the others are repeats. A string that stands in a third of
   all documents thus costs a row for each batch.
3. Segments of an anchor meet. Equal ones but the first are repeats. The others
   are matched with the first from the anchor both ways; windows within the match
   are repeats. Windows outside it can only equal such windows of other segments,
   since what equals the first has been found. Those that share a hash go, in
   distinct runs, through a suffix array built by Lyndon grouping
   (:mod:`linkwell.llm.suffix_array`): windows that share their first ``length``
   bytes are neighbours in it, and all but the first of them are repeats.
   An anchor with more than ``HOT_SEGMENTS`` segments is not brought together: its
   first segment is found by an aggregate and joined back, segments are matched with
   it row by row wherever they are, and windows that this leaves open are grouped by
   their digest.
4. Repeats return to their batch, where covered bytes are removed.

A batch holds texts of one class of sizes, fewer the longer they are, so it has at
most ``BATCH_BYTES`` or one text. There are as many buckets as the bytes ask for.
Documents are written once, bucketed by batch, so they are not shuffled.

Defined cases: documents are in the order of doc_id, null first, and rows of one
id in the order of the table, as further documents. A null text is empty. A text
shorter than a window loses nothing. Other columns and all rows are kept; an
empty table stays empty.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwell.llm.common import text_of
from linkwell.llm.suffix_array import suffix_array
from linkwell.session import release, scratch_mark, scratch_path, scratch_since, shuffle_tasks, stage, stage_counted

LENGTH, GRAM = 100, 32
BATCH_BITS = 10
CHUNK = 1 << 22
PLACE_BITS = 24
BLOCK_SEGMENTS = 100_000
HOT_SEGMENTS = 50_000
BATCH_BYTES = 1 << 24
PRINTS_PER_BUCKET = 1 << 22
#: About so many bytes of text have an anchor of their own.
BYTES_PER_PRINT = 32
_LETTER = np.random.default_rng(77).integers(1, (1 << 64) - 1, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the bytes from each position on, ``size`` of them, by doubling."""
    have, at, part, width = None, 0, _LETTER[data], 1
    while True:
        if size & width:
            if have is None:
                have, at = part, width
            else:
                m = min(len(have), len(part) - at)
                have, at = have[:m] * _power(width) + part[at : at + m], at + width
        width *= 2
        if width > size:
            break
        m = len(part) - width // 2
        part = part[:m] * _power(width // 2) + part[width // 2 :]
    x = have ^ (have >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of ``size`` values from each position on."""
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, anchor position, first and last window of each segment of texts laid end to end."""
    found = []
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for lo in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[lo : lo + CHUNK + length - 1]
        if len(part) < length:
            continue
        hashes = _gram_hashes(part, gram)
        place = mask - np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the last is the least
        least = _sliding_least((hashes & ~mask) | place, length - gram + 1)
        anchor = (mask - (least & mask)).astype(np.int64)
        starts = lo + np.arange(len(anchor))
        text = np.searchsorted(offsets, starts, side="right") - 1
        whole = starts + length <= offsets[text + 1]
        change = np.ones(len(anchor), bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
        first = np.flatnonzero(change & whole)
        ends = np.flatnonzero(np.append(change[1:], True) & whole | (whole & ~np.append(whole[1:], False)))
        found.append((hashes[anchor[first]], lo + anchor[first], lo + first, lo + ends))
    if not found:
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _laid_out(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of texts end to end, and where each begins (and the end)."""
    parts = [t.encode("utf-8") for t in texts.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def _in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of one batch number, which arrive together, as tables."""
    held: list[pa.RecordBatch] = []
    for arrived in batches:
        number = arrived.column("batch").to_numpy()
        cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                if held and held[-1].column("batch")[0].as_py() != number[lo]:
                    yield held[0].column("batch")[0].as_py(), pa.Table.from_batches(held)
                    held = []
                held.append(arrived.slice(lo, hi - lo))
    if held:
        yield held[0].column("batch")[0].as_py(), pa.Table.from_batches(held)


def _anchors_of(table: pa.Table, length: int, gram: int) -> tuple[np.ndarray, ...]:
    data, offsets = _laid_out(table.column("text"))
    with np.errstate(over="ignore"):
        return data, offsets, *segments(data, offsets, length, gram)


def _sent(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """For each batch and bucket, the sorted distinct anchor hashes, and whether each occurs twice in the batch."""

    def run(batches):
        for number, table in _in_batches(batches):
            prints = np.sort(_anchors_of(table, length, gram)[2])
            distinct, count = np.unique(prints, return_counts=True)
            bucket = (distinct >> np.uint64(32)) % np.uint64(buckets)
            rows = []
            for b in range(buckets):
                own = bucket == b
                if own.any():
                    rows.append((number, b, distinct[own].astype("<u8").tobytes(), np.packbits(count[own] > 1).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    ["batch", "bucket", "prints", "twice"],
                )

    return docs.select("batch", "text").mapInArrow(run, "batch long, bucket int, prints binary, twice binary")


def _marked(sent: DataFrame) -> DataFrame:
    """For each batch and bucket, the hashes that occur twice or more anywhere."""

    def run(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(p, "<u8") for p in table.column("prints").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8))[: len(p)].astype(bool) for t, p in zip(table.column("twice").to_pylist(), lists)]
        every, count = np.unique(np.concatenate(lists), return_counts=True)
        again = np.union1d(every[count > 1], np.concatenate([p[t] for p, t in zip(lists, twice)]))
        kept = [np.intersect1d(p, again, assume_unique=True).astype("<u8").tobytes() for p in lists]
        return pa.table({"batch": table.column("batch"), "prints": pa.array(kept, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "batch long, prints binary").filter("octet_length(prints) > 0")


FOUND = "print long, row long, doc long, start long, ahead int, bytes binary, batch long, first long, last long"
_FOUND_KINDS = [pa.int64()] * 4 + [pa.int32(), pa.binary()] + [pa.int64()] * 3


def _cut(docs: DataFrame, marks: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of marked anchors: the first of each content in its batch with its bytes, others as repeats.

    ``first`` and ``last`` number the windows of a segment within its text.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(p, "<u8") for p in right.column("prints").to_pylist()]
        columns: list[list] = [[] for _ in _FOUND_KINDS]
        if left.num_rows and blobs:
            data, offsets, prints, at, first, last = _anchors_of(left, length, gram)
            own = np.flatnonzero(np.isin(prints, np.concatenate(blobs)))
            text = np.searchsorted(offsets, first[own], side="right") - 1
            rows, docs_ = left.column("row").to_numpy(), left.column("doc").to_numpy()
            order = np.lexsort((first[own], rows[text], docs_[text]))
            seen, raw = set(), data.tobytes()
            number = left.column("batch")[0].as_py()
            for k in order.tolist():
                s, t = own[k], text[k]
                lo, hi, base = int(first[s]), int(last[s]), int(offsets[t])
                content = raw[lo : hi + length]
                key = (int(prints[s].view(np.int64)), int(at[s]) - lo, content)
                fresh = key not in seen
                seen.add(key)
                for c, v in zip(columns, (
                    key[0] if fresh else None, int(rows[t]), int(docs_[t]), lo - base, key[1], content if fresh else None,
                    number, lo - base, hi - base,
                )):
                    c.append(v)
        return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(FOUND.split(", "), columns, _FOUND_KINDS)})

    return docs.select("batch", "row", "doc", "text").groupBy("batch").cogroup(marks.groupBy("batch")).applyInArrow(run, FOUND)


def _shared_ends(a: bytes, b: bytes) -> int:
    """How many bytes two strings have in common from their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return ((x & -x).bit_length() - 1) >> 3


def _windows(runs: list[tuple[tuple, int, bytes]], length: int) -> list[tuple[tuple, int, int]]:
    """Repeated windows of runs (place in order, window number, bytes), as (place, from, to).

    Of each content the first by place and number isn't repeated.
    """
    runs = [r for r in runs if len(r[2]) >= length]
    if len(runs) < 2:
        return []
    joined = b"".join(r[2] for r in runs)
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(r[2]) for r in runs])
    with np.errstate(over="ignore"):
        hashes = _gram_hashes(data, length)
    at = np.arange(len(hashes))
    of = np.searchsorted(ends, at, side="right")
    valid = at + length <= ends[of]
    _, inverse, count = np.unique(hashes[valid], return_inverse=True, return_counts=True)
    live = np.zeros(len(data) + 1, bool)
    live[: len(valid)][valid] = count[inverse] > 1
    lo = np.flatnonzero(live[:-1] & ~np.append(False, live[:-2]))  # a run's last windows are cut off, so none join
    begins = np.concatenate([[0], ends])
    first: dict[bytes, tuple[tuple, int]] = {}
    out: list[tuple[tuple, int, int]] = []
    for start in lo.tolist():
        k = int(of[start])
        stop = start
        while stop < ends[k] and live[stop]:
            stop += 1
        place, number, _ = runs[k]
        content = joined[start : stop - 1 + length]
        here = (place, number + start - int(begins[k]))
        held = first.get(content)
        if held is None or here < held:
            first[content], here = here, held
        if here is not None:
            out.append((*here, here[1] + len(content) - length))
    return out + _by_suffixes(first, length)


def _by_suffixes(first: dict[bytes, tuple[tuple, int]], length: int) -> list[tuple[tuple, int, int]]:
    """The same for distinct runs: windows that are neighbours in the suffix array of all runs are compared."""
    symbols: list[int] = []
    owner: list[tuple[tuple, int] | None] = []
    for content, (place, number) in first.items():
        symbols.extend(content)
        owner.extend((place, number + i) for i in range(len(content) - length + 1))
        owner.extend([None] * length)  # the last bytes and a mark that is no byte begin no window
        symbols.append(256)
    raw = np.array(symbols, np.uint16)
    out, group = [], []

    def close() -> None:
        group.sort()
        out.extend((place, number, number) for place, number in group[1:])

    previous = None
    for s in suffix_array(symbols):
        if owner[s] is None:
            continue
        if previous is None or not np.array_equal(raw[previous : previous + length], raw[s : s + length]):
            close()
            group = []
        group.append(owner[s])
        previous = s
    close()
    return out


def _compare(cut: DataFrame, tasks: int, length: int, hot_segments: int) -> DataFrame:
    """Repeated windows of the segments that were the first in their batches."""
    fresh = cut.filter(F.col("print").isNotNull()).select("print", "doc", "row", "start", "ahead", "bytes", "batch")
    counted = fresh.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_segments)
    hot, n = stage_counted(counted.select("print"), "hot_anchors")
    if not n:
        return _compare_together(fresh, tasks, length)
    alone = _compare_apart(stage(fresh.join(hot, "print", "left_semi"), "hot_segments"), length)
    return _compare_together(fresh.join(hot, "print", "left_anti"), tasks, length).unionByName(alone)


def _compare_apart(fresh: DataFrame, length: int) -> DataFrame:
    """The same for anchors of many segments, none of which are brought together."""
    order = F.struct("doc", "row", "start")
    base = fresh.groupBy("print").agg(F.min_by(F.struct("row", "start", "ahead", "bytes"), order).alias("base"))
    base = base.select("print", *[F.col(f"base.{c}").alias(f"base_{c}") for c in ("row", "start", "ahead", "bytes")])

    def run(batches):
        names = ["row", "start", "ahead", "bytes", "doc", "batch", "base_row", "base_start", "base_ahead", "base_bytes"]
        for batch in batches:
            rows = []
            for row, start, ahead, content, doc, number, *first in zip(*(batch.column(c).to_pylist() for c in names)):
                if [row, start] == first[:2]:
                    continue
                found, left = _settle(row, start, ahead, content, first[2], first[3], length)
                rows += [(number, doc, *f, None) for f in found]
                for at, part in left:
                    for i in range(len(part) - length + 1):
                        rows.append((number, doc, row, at + i, at + i, hashlib.md5(part[i : i + length]).digest()))
            kinds = [*[pa.int64()] * 5, pa.binary()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["batch", "doc", "row", "first", "last", "digest"]
            )

    met = fresh.join(base, "print").mapInArrow(run, "batch long, doc long, row long, first long, last long, digest binary")
    found = stage(met, "hot_windows")
    open_ = found.filter(F.col("digest").isNotNull()).withColumn("place", F.struct("doc", "row", "first"))
    firsts = open_.groupBy("digest").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = open_.join(firsts, "digest").filter("place != least")
    columns = ["batch", "row", "first", "last"]
    return found.filter(F.col("digest").isNull()).select(columns).unionByName(again.select(columns))


def _compare_together(fresh: DataFrame, tasks: int, length: int) -> DataFrame:
    """The same for anchors whose segments fit in one list."""

    def run(batches):
        held, count = [], 0
        names = ["print", "doc", "row", "start", "ahead", "bytes", "batch"]
        for batch in batches:
            for item in zip(*(batch.column(n).to_pylist() for n in names)):
                if count >= BLOCK_SEGMENTS and item[0] != held[-1][0]:
                    yield from found(held)
                    held, count = [], 0
                held.append(item)
                count += 1
        if held:
            yield from found(held)

    def found(items):
        out, pool, batch_of, at = [], [], {}, 0
        while at < len(items):
            to = at + 1
            while to < len(items) and items[to][0] == items[at][0]:
                to += 1
            if to - at > 1:
                _match(items[at:to], pool, out, length)
            at = to
        for item in items:
            batch_of[item[2]] = item[6]
        out.extend((row, lo, hi) for (_, row), lo, hi in _windows(pool, length))
        if out:
            row, lo, hi = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch_of[r] for r in row], pa.int64()), *[pa.array(x, pa.int64()) for x in (row, lo, hi)]],
                ["batch", "row", "first", "last"],
            )

    dealt = fresh.repartition(tasks, "print").sortWithinPartitions("print", "doc", "row", "start")
    return dealt.mapInArrow(run, "batch long, row long, first long, last long")


def _settle(row: int, start: int, ahead: int, content: bytes, base_ahead: int, base: bytes, length: int) -> tuple[list, list]:
    """Windows of a segment that equal some of the first one's (row, from, to), and the runs of others (number, bytes)."""
    lo = ahead - _shared_ends(content[:ahead][::-1], base[:base_ahead][::-1])
    hi = ahead + _shared_ends(content[ahead:], base[base_ahead:]) - length
    if lo > hi:
        return [], [(start, content)]
    left = [(start, content[: lo - 1 + length])] if lo > 0 else []
    if hi < len(content) - length:
        left.append((start + hi + 1, content[hi + 1 :]))
    return [(row, start + lo, start + hi)], left


def _match(items: list[tuple], pool: list, out: list, length: int) -> None:
    """Compare the segments of an anchor with the first; what it doesn't settle goes to the pool."""
    _, _, _, _, base_ahead, base, _ = items[0]
    seen = {(base_ahead, base)}
    for _, doc, row, start, ahead, content, _ in items[1:]:
        if (ahead, content) in seen:
            out.append((row, start, start + len(content) - length))
            continue
        seen.add((ahead, content))
        found, left = _settle(row, start, ahead, content, base_ahead, base, length)
        out.extend(found)
        pool.extend(((doc, row), at, part) for at, part in left)


def _removed(docs: DataFrame, repeats: DataFrame, columns: list[str], length: int) -> DataFrame:
    """The rows with their remaining bytes."""
    fields = {f.name: f for f in docs.schema}
    kept = T.StructType([T.StructField(c, fields[c].dataType) for c in columns if c != "text"])
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t in (
        ("kept", T.BinaryType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()))]])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, first, last = (right.column(n).to_numpy() for n in ("row", "first", "last"))
        order = np.argsort(row, kind="stable")
        row, first, last = row[order], first[order], last[order]
        made: list[list] = [[], [], [], []]
        for key, text in zip(left.column("row").to_pylist(), left.column("text").to_pylist()):
            data = text.encode("utf-8")
            lo, hi = np.searchsorted(row, [key, key + 1])
            spans = 0
            if hi > lo:
                edge = np.bincount(first[lo:hi], minlength=len(data) + 1)[: len(data) + 1].astype(np.int64)
                edge -= np.bincount(last[lo:hi] + length, minlength=len(data) + 1)[: len(data) + 1]
                gone = np.cumsum(edge)[:-1] > 0
                spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
            else:
                rest = data
            for m, v in zip(made, (rest, len(data), len(data) - len(rest), spans)):
                m.append(v)
        own = [left.column(c).combine_chunks() for c in columns if c != "text"]
        new = [pa.array(m, t) for m, t in zip(made, (pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
        return pa.table([*own, *new], names=[*kept.names, "kept", "n_bytes", "n_removed", "n_spans"])

    return docs.groupBy("batch").cogroup(repeats.groupBy("batch")).applyInArrow(run, schema)


def _bucketed(spark: SparkSession, docs: DataFrame, tasks: int) -> tuple[DataFrame, int]:
    """The rows, bucketed by batch, and the bytes of their texts."""
    name, seen = f"suffix_documents_{uuid.uuid4().hex}", Observation()
    counted = docs.observe(seen, F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    counted.write.option("path", scratch_path(spark, name)).bucketBy(tasks, "batch").sortBy("batch").saveAsTable(name)
    return spark.table(name), seen.get["bytes"] or 0


def batch_of(row: Column, size: Column, batch_bits: int, batch_bytes: int) -> Column:
    """Number of the batch of a row whose text has so many bytes.

    Up to the bytes that ``2 ** batch_bits`` texts may have each, so many consecutive
    rows share a batch; for texts up to 8, 64, ... times as long an eighth, a 64th, ...
    The class of sizes is the number's lowest decimal digit.
    """
    out, bits, most = F.lit(None).cast("long"), batch_bits, batch_bytes >> batch_bits
    for kind in range(9):
        out = F.coalesce(out, F.when((size <= most) | F.lit(bits == 0), F.shiftright(row, bits) * 10 + kind))
        bits, most = max(0, bits - 3), most << 3
    return out


def dedup_substrings(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    batch_bits: int = BATCH_BITS,
    batch_bytes: int = BATCH_BYTES,
    hot_segments: int = HOT_SEGMENTS,
) -> DataFrame:
    """``docs`` with ``kept`` (remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans`` in place of ``text``. Runs jobs.

    New columns replace columns of their names.

    A batch has ``2 ** batch_bits`` rows and ``batch_bytes`` bytes at most, or one row.
    """
    spark = docs.sparkSession
    tasks = shuffle_tasks(spark)
    own = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != "text"}
    row = F.monotonically_increasing_id()
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(row.alias("row"), order.alias("doc"), text_of().alias("text"), *[F.col(c).alias(v) for c, v in own.items()])
    number = batch_of(F.col("row"), F.octet_length("text"), batch_bits, batch_bytes)
    held, size = _bucketed(spark, rows.withColumn("batch", number), tasks)
    buckets = max(tasks, -(-size // (BYTES_PER_PRINT * PRINTS_PER_BUCKET)))
    begun = scratch_mark()
    marks = stage(_marked(_sent(held, buckets, length, gram)), "marks")
    used = scratch_since(begun)
    cut = stage(_cut(held, marks, length, gram), "segments")
    release(spark, used)  # each is read by the next table only, which is written
    local = cut.filter(F.col("print").isNull()).select("batch", "row", "first", "last")
    found, before = local.unionByName(_compare(cut, tasks, length, hot_segments)), scratch_since(begun)
    repeats = stage(found, "repeats")
    release(spark, before)
    done = _removed(held, repeats, ["text", *own.values()], length)
    made = ["kept", "n_bytes", "n_removed", "n_spans"]
    return done.select(*[F.col(v).alias(c) for c, v in own.items() if c not in made], *made)
