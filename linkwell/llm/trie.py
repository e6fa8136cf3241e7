"""The prefix trie of conversations, encoded as balanced parentheses shard by shard.

A turn is represented by 128 bits of the digest of its role and text, and by its
length; texts themselves are never brought together. Conversations are sorted by
their sequences of turns, which is the depth-first order of the trie, and ranges of
them are the shards. Equal sequences are ordered by id, so a group of copies is cut
like anything else. Each shard writes its part of the trie as parentheses, one pair a
node, and keeps the least and greatest excess of each block of them. Subtrees end
where ``find_close`` says, found by those blocks; leaves below a node are counted by
the rank of ``()``; members and savings of subtrees are differences of cumulative
arrays.

Only nodes on the paths to a shard's first and last conversation, its spines, can
lie in other shards too. Shards hand on partial counts for them, and those of equal
nodes are merged. What is merged, two paths a shard, is small against the table (a
shard has about ``TURNS_PER_SHARD`` turns) and is one trie in depth-first order again,
summed by the same means in one task. Ids of conversations that end on a spine are
digested by one stream for each node, as SHA-256 asks for, in bounded memory.

Defined cases: rows without a conversation id belong to none. Null turns come first;
rows of one turn number are in the order of their digests, and repeated rows are
turns like others. A null role or text is empty. A conversation without turns is a
member of the root only. No conversations give no node. Turns of one conversation,
52 bytes each, lie in one row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.llm.common import text_of
from linkwell.session import stage

TURNS_PER_SHARD = 1 << 17
DIGEST_BYTES = 16
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Parentheses:
    """Balanced parentheses (true opens) with the range of the excess in each block, and of twice as many blocks on each level above."""

    def __init__(self, opens: np.ndarray):
        n = len(opens)
        self.excess = np.cumsum(np.where(opens, 1, -1))
        filled = np.concatenate([self.excess, np.full(-n % BLOCK, self.excess[-1] if n else 0)]).reshape(-1, BLOCK)
        self.blocks = filled
        least, most = [filled.min(axis=1)], [filled.max(axis=1)]
        while len(least[-1]) > 1:
            odd = len(least[-1]) % 2
            pair = lambda x, odd=odd: np.append(x, x[-1:] if odd else []).astype(np.int64).reshape(-1, 2)
            least.append(pair(least[-1]).min(axis=1))
            most.append(pair(most[-1]).max(axis=1))
        self.start = np.cumsum([0, *map(len, least)])
        self.least, self.most = np.concatenate(least), np.concatenate(most)
        self.open = np.flatnonzero(opens)
        leaf = opens & ~np.append(opens[1:], False)
        self.leaf_rank = np.concatenate([[0], np.cumsum(leaf)])

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where each of these opening parentheses is closed: the next place with one less of excess."""
        target, out = self.excess[at] - 1, np.full(len(at), -1)
        todo, place = np.arange(len(at)), at + 1
        for _ in range(BLOCK):  # within its own block
            todo = todo[place[todo] % BLOCK != 0]
            if not len(todo):
                break
            hit = self.excess[place[todo]] == target[todo]
            out[todo[hit]] = place[todo[hit]]
            todo = todo[~hit]
            place[todo] += 1
        todo = np.flatnonzero(out < 0)
        level, node = np.zeros(len(todo), np.int64), at[todo] // BLOCK + 1
        goal = target[todo]

        def holds(level: np.ndarray, node: np.ndarray, goal: np.ndarray) -> np.ndarray:
            i = self.start[level] + node
            return (self.least[i] <= goal) & (goal <= self.most[i])

        climbing = np.arange(len(todo))
        while len(climbing):  # the first node to the right that holds the target
            climbing = climbing[~holds(level[climbing], node[climbing], goal[climbing])]
            odd = node[climbing] % 2
            node[climbing] = np.where(odd, (node[climbing] + 1) // 2, node[climbing] + 1)
            level[climbing] += odd
        while (down := np.flatnonzero(level > 0)).size:
            level[down] -= 1
            node[down] *= 2
            node[down] += ~holds(level[down], node[down], goal[down])
        found = np.argmax(self.blocks[node] == goal[:, None], axis=1) if len(todo) else np.empty(0, np.int64)
        out[todo] = node * BLOCK + found
        return out

    def leaves(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Leaf pairs from the opening to the closing parenthesis."""
        return self.leaf_rank[last + 1] - self.leaf_rank[first]


def parents_of(depth: np.ndarray) -> np.ndarray:
    """Parents of nodes in preorder: the last node before with a depth less by one; -1 for a root."""
    n, at = len(depth), np.arange(len(depth))
    key = depth * (n + 1) + at
    order = np.sort(key)
    where = np.searchsorted(order, (depth - 1) * (n + 1) + at) - 1
    return np.where(depth > 0, order[where] % (n + 1), -1)


def parentheses_of(depth: np.ndarray) -> Parentheses:
    """Of a trie, by the depths of its nodes in preorder."""
    closed = np.append(depth[:-1] - depth[1:] + 1, depth[-1] + 1)
    return Parentheses(np.repeat(np.tile([True, False], len(depth)), np.stack([np.ones_like(closed), closed], axis=1).ravel()))


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums over subtrees of nodes in preorder."""
    total = np.concatenate([[0], np.cumsum(values)])
    at = np.arange(len(values))
    return total[at + size] - total[at]


def _common(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many first turns each sequence shares with the one before."""
    out = np.zeros(len(lengths), np.int64)
    both = np.minimum(lengths[1:], lengths[:-1])
    some = np.flatnonzero(both)
    both = both[some]
    if len(some):
        first = np.concatenate([[0], np.cumsum(both)[:-1]])
        inside = np.arange(both.sum()) - np.repeat(first, both)
        same = (turns[np.repeat(starts[some + 1], both) + inside] == turns[np.repeat(starts[some], both) + inside]).all(axis=1)
        out[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(both, both), inside), first)
    return out


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shard_nodes(ids: np.ndarray, turns: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, shard: int) -> pa.RecordBatch:
    """The trie of a shard's conversations, sorted by sequence and id.

    ``turns`` holds two words for each turn, ``sizes`` its characters. Nodes off the
    spines are complete but for a parent's id on a spine, named by ``parent_key``. Those
    on spines have a ``key``; their counts are of this shard, of leaves and savings
    only what lies off the spines.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    shared = _common(turns, starts, lengths)
    new = lengths - shared
    row = np.concatenate([[0], np.repeat(np.arange(len(ids)), new)])
    first = np.concatenate([[0], np.cumsum(new)[:-1]])
    depth = np.concatenate([[0], np.arange(new.sum()) - np.repeat(first, new) + np.repeat(shared, new) + 1])
    n = len(depth)
    ends = np.cumsum(new)  # the node each conversation ends at
    size_of = np.concatenate([[0], sizes[starts[row[1:]] + depth[1:] - 1]]) if n > 1 else np.zeros(1, np.int64)

    trie = parentheses_of(depth)
    close = trie.find_close(trie.open)
    subtree = (close - trie.open + 1) // 2
    members = _sums(np.bincount(ends, minlength=n), subtree)
    bounds = np.stack([row, row + members], axis=1).ravel()
    least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
    parent = parents_of(depth)

    spine = np.zeros(n, bool)
    keys = np.full(n, None, object)
    for conversation in (0, len(ids) - 1):
        path, node = hashlib.sha256(), int(ends[conversation])
        nodes = []
        while node >= 0:
            nodes.append(node)
            node = int(parent[node])
        for at, node in enumerate(reversed(nodes)):
            if at:
                path.update(turns[starts[conversation] + at - 1].tobytes())
            spine[node], keys[node] = True, path.hexdigest()

    saved = (members - 1) * size_of
    off = ~spine
    leaves = trie.leaves(trie.open, close)
    children = np.bincount(parent[1:][off[1:]], minlength=n)
    leaves = leaves - _sums((subtree == 1) & spine, subtree)
    up = np.maximum(parent, 0)
    beside = spine[up] & (depth > 0)
    digests, spine_ids = np.full(n, NO_ENDS, object), np.full(n, None, object)
    where = np.concatenate([[0], np.flatnonzero(np.diff(ends)) + 1, [len(ids)]])
    for lo, hi in zip(where[:-1].tolist(), where[1:].tolist()):
        node = ends[lo]
        if spine[node]:
            spine_ids[node] = ids[lo:hi].astype("<i8").tobytes()
        else:
            digests[node] = hashlib.sha256(_joined(ids[lo:hi])).hexdigest()
    columns = {
        "key": pa.array(keys, pa.string()), "parent_key": pa.array(np.where(beside, keys[up], None), pa.string()),
        "shard": pa.array(np.full(n, shard)), "place": pa.array(np.arange(n)), "size": pa.array(size_of), "conv_id": pa.array(least),
        "depth": pa.array(depth), "parent_conv_id": pa.array(least[up], mask=beside | (depth == 0)),
        "n_convs": pa.array(members), "n_children": pa.array(children), "n_leaves": pa.array(leaves),
        "saved_tokens": pa.array(_sums(np.where(off, saved, 0), subtree)), "ends_sha256": pa.array(digests, pa.string()),
        "ids": pa.array(spine_ids, pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


NODES = (
    "key string, parent_key string, shard long, place long, size long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids binary"
)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    turns = np.frombuffer(b"".join(table.column("path").to_pylist()), np.uint64).reshape(-1, 2)
    lengths = table.column("length").to_numpy().astype(np.int64)
    sizes = table.column("sizes").flatten().to_numpy().astype(np.int64)
    nodes = shard_nodes(table.column("conv_id").to_numpy(), turns, lengths, sizes, TaskContext.get().partitionId())
    for lo in range(0, nodes.num_rows, 20_000):
        yield nodes.slice(lo, 20_000)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Complete spine nodes, which arrive in depth-first order."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    key = table.column("key")
    conv, depth, size, members, children, leaves, saved = (
        table.column(c).to_numpy() for c in ("conv_id", "depth", "size", "n_convs", "n_children", "n_leaves", "saved_tokens")
    )
    trie = parentheses_of(depth)
    subtree = (trie.find_close(trie.open) - trie.open + 1) // 2
    parent = parents_of(depth)
    children = children + np.bincount(parent[1:], minlength=len(depth))
    yield pa.RecordBatch.from_arrays(
        [key.combine_chunks().cast(pa.string()), *map(pa.array, (
            conv, depth)), pa.array(conv[np.maximum(parent, 0)], mask=parent < 0), *map(pa.array, (
                members, children, leaves + _sums((children == 0).astype(np.int64), subtree), saved + _sums((members - 1) * size, subtree)))],
        ["key", *RESULT[:-1]],
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each node, which arrive together and in order."""
    key, stream = None, None
    for batch in batches:
        done = []
        for name, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if name != key:
                if key is not None:
                    done.append((key, stream.hexdigest()))
                key, stream = name, hashlib.sha256()
            else:
                stream.update(b",")
            stream.update(_joined(np.frombuffer(ids, "<i8")))
        yield _pairs(done)
    if key is not None:
        yield _pairs([(key, stream.hexdigest())])


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    keys, digests = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "ends_sha256"])


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, each a struct of ``digest`` and ``size``."""
    role, text = text_of("role"), text_of("text")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * DIGEST_BYTES)
    turn = F.struct("turn", digest.alias("digest"), F.char_length(text).alias("size"))
    own = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), turn.alias("t"))
    ordered = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))))


def rebuilt(conversations: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Sequences whose first ``head`` turns (``most`` at most) are replaced by those of conversation ``base``.

    Both are expressions of ``conv_id``. A base that is absent has no turns.
    """
    own = stage(sequences(conversations), "sequences").withColumns({"_base": base, "_head": head})
    bases = own.select(F.col("_base").alias("conv_id")).distinct().join(own.select("conv_id", F.slice("turns", 1, most).alias("first")), "conv_id")
    joined = own.join(bases.withColumnRenamed("conv_id", "_base"), "_base", "left")
    first = F.coalesce(F.slice("first", F.lit(1), F.col("_head").cast("int")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_head").cast("int") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


def prefix_trie(found: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """A row for each node of the trie of ``found``, the sequences of conversations. Runs jobs.

    Columns: conv_id (its least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = stage(
        found.select("conv_id", path.alias("path"), F.size("turns").alias("length"), F.transform("turns", lambda t: t["size"]).alias("sizes")),
        "paths",
    )
    shards = max(1, -(-(rows.agg(F.sum(F.col("length").cast("long") + 1)).first()[0] or 0) // turns_per_shard))
    dealt = rows.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = stage(dealt.mapInArrow(_shards, NODES), "nodes")
    spine = nodes.filter(F.col("key").isNotNull())
    merged = spine.groupBy("key").agg(
        F.min(F.struct("shard", "place")).alias("at"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("size").alias("size"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    counts = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    whole = stage(merged.repartition(1).sortWithinPartitions("at").mapInArrow(_merge, f"key string, {counts}"), "spines")
    chunks = spine.filter(F.col("ids").isNotNull()).select("key", "shard", "ids").repartition("key").sortWithinPartitions("key", "shard")
    ends = chunks.mapInArrow(_digests, "key string, ends_sha256 string")
    on_spines = whole.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    off = nodes.filter(F.col("key").isNull())
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    beside = off.filter(F.col("parent_key").isNotNull()).join(above, "parent_key").withColumn("parent_conv_id", F.col("_parent"))
    inside = off.filter(F.col("parent_key").isNull())
    return on_spines.select(RESULT).unionByName(beside.select(RESULT)).unionByName(inside.select(RESULT))
