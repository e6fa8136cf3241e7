"""Merkle manifest of a dataset: a tree of leaves for each group, a tree of their roots, and proofs by multiproofs.

The digest of a row is a leaf. Leaves of a group are numbered in order without
bringing a group to one task, and cut into partitions of ``2 ** BITS`` consecutive
ones. A partition hashes its own subtree and hands on its top; tops are cut into
partitions again, so a tree of n leaves takes log n / BITS rounds, each much smaller
than the one before. Only nodes at the tops of first partitions and above are kept.

Proofs of all leaves of a partition are taken together (octopus): going up level by
level, a node is missing if its parent lies on some path and neither it nor all
below it belong to the partition. The coordinates that are missing, their union for
all leaves, are fetched once by a join with the kept nodes; everything inside the
partition is derived from its leaves again, and single proofs are put together from
both. Group roots are leaves of another such forest of one tree, and its proofs
go on where those of the groups end.

Every two consecutive nodes become their parent, the digest of both in order as
lowercase hexadecimal text; a last single node becomes the digest of itself. A step
of a proof is what stands left and right of the path (empty where nothing does).

Defined cases: leaves of a group ascend by key, null first, equal keys by digest;
equal rows are interchangeable and each has a leaf. A null group is a group and
comes first. A single leaf is its group's root, a single group's root that of all,
and the proof then has no steps. No rows give no tree. Rows may have any other
columns; only those named are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwell.operators.running import running
from linkwell.session import stage

BITS = 12
NODE = "tree string, block long, level int, index long, digest string"
STEPS = "array<struct<left: string, right: string>>"


def digest_of(*parts: Column) -> Column:
    """SHA-256 of texts one after another, as lowercase hexadecimal text."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(*fields: Column) -> Column:
    """Digest of fields: ``-`` for null, otherwise the number of bytes, a colon and the value as text."""
    texts = [f.cast("string") for f in fields]
    return digest_of(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf has by the steps of a proof."""
    return F.aggregate(steps, leaf, lambda acc, s: digest_of(s["left"], acc, s["right"]))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def parents(digests: list[str]) -> list[str]:
    """Digests of every two consecutive nodes; the last may be single."""
    return [_hash("".join(digests[i : i + 2])) for i in range(0, len(digests), 2)]


def width_at(n: int, level: int) -> int:
    return -(-n >> level)


def missing_nodes(leaves: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Level and numbers of the nodes that proofs of all these leaves need and that don't follow from them."""
    known, level, out = np.unique(leaves), 0, []
    while width_at(n, level) > 1:
        above = np.unique(known >> 1)
        siblings = np.concatenate([2 * above, 2 * above + 1])
        lacking = np.setdiff1d(siblings[siblings < width_at(n, level)], known)
        if len(lacking):
            out.append((level, lacking))
        known, level = above, level + 1
    return out


def _subtree(digests: list[str], n: int, level: int, bits: int) -> list[list[str]]:
    """Levels of a partition's nodes from its own up, ``bits`` higher at most."""
    levels = [digests]
    while len(levels) <= bits and width_at(n, level + len(levels) - 1) > 1:
        levels.append(parents(levels[-1]))
    return levels


def _ordered(table: pa.Table, name: str) -> pa.Table:
    return table.sort_by(name).combine_chunks()


def _grow(placed: DataFrame, level: int, bits: int) -> DataFrame:
    """Nodes above those of ``level``; at level 0, tops of partitions only, and with a null digest what they lack."""

    def run(table: pa.Table) -> pa.Table:
        table = _ordered(table, "index")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        index = table.column("index").to_numpy()
        block = int(index[0]) >> bits
        levels = _subtree(table.column("digest").to_pylist(), n, level, bits)
        rows = []
        for up in range(1 if level else len(levels) - 1, len(levels)):
            first = int(index[0]) >> up
            rows += [(tree, block, level + up, first + i, d) for i, d in enumerate(levels[up])]
        if not level:
            rows += [(tree, block, at, i, None) for at, lacking in missing_nodes(index, n) for i in lacking.tolist()]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, kinds)], ["tree", "block", "level", "index", "digest"])

    block = F.shiftright("index", bits).alias("block")
    return placed.select("tree", "n", "index", "digest", block).groupBy("tree", "block").applyInArrow(run, NODE)


def _expand(placed: DataFrame, fetched: DataFrame, keep: Sequence[str], bits: int) -> DataFrame:
    """Proof of each leaf, and the root of its tree, from its partition's leaves and the nodes fetched for it."""
    fields = {f.name: f for f in placed.schema}
    kept = [T.StructField(c, fields[c].dataType) for c in keep]
    step = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t in (
        ("tree", T.StringType()), ("index", T.LongType()), ("digest", T.StringType()), ("root", T.StringType()), ("steps", T.ArrayType(step)))]])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _ordered(left, "index")
        index, n = left.column("index").to_numpy(), left.column("n")[0].as_py()
        levels = _subtree(left.column("digest").to_pylist(), n, 0, bits)
        pool, start = [""], []
        for nodes in levels:
            start.append(len(pool))
            pool.extend(nodes)
        remote = {}
        for at, i, digest in zip(*(right.column(c).to_pylist() for c in ("level", "index", "digest"))):
            remote[at, i] = len(pool)
            pool.append(digest)
        height = 0
        while width_at(n, height) > 1:
            height += 1
        places = np.zeros((2, len(index), height), np.int64)
        for at in range(height):
            sibling = (index >> at) ^ 1
            there = sibling < width_at(n, at)
            if at < len(levels):
                own = sibling - (int(index[0]) >> at)
                inside = (own >= 0) & (own < len(levels[at]))
            else:
                own, inside = sibling, np.zeros(len(index), bool)
            place = np.where(inside, start[min(at, len(levels) - 1)] + own, 0)
            for i in np.unique(sibling[there & ~inside]).tolist():
                place[sibling == i] = remote[at, i]
            place[~there] = 0
            places[((index >> at) & 1 ^ 1), np.arange(len(index)), at] = place
        root = levels[-1][0]
        for at in range(len(levels) - 1, height):
            root = _hash(pool[places[0, 0, at]] + root + pool[places[1, 0, at]])
        nodes = pa.array(pool, pa.string())
        sides = pa.StructArray.from_arrays([nodes.take(pa.array(places[i].ravel())) for i in (0, 1)], ["left", "right"])
        steps = pa.ListArray.from_arrays(pa.array(np.arange(len(index) + 1, dtype=np.int32) * height), sides)
        roots = pa.array([root] * len(index), pa.string())
        own = [left.column(c) for c in (*keep, "tree", "index", "digest")]
        return pa.table([*own, roots, steps], names=schema.names)

    block = F.shiftright("index", bits).alias("block")
    return placed.select("*", block).groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(run, schema)


def forest(rows: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Proofs and roots of rows with ``tree`` (not null) and ``digest``; leaves of a tree are in the order of ``keys``.

    The first frame has ``keep``, ``tree``, ``digest``, the leaf's ``index``, the tree's ``root`` and the ``steps`` to it
    of each row; the second ``tree`` and ``root`` of each tree, without going through the proofs. Runs jobs.
    """
    named = dict.fromkeys(["tree", "digest", *keys, *keep])
    numbered = running(rows.select(*named), keys, by=["tree"], number="index")
    sizes = stage(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "sizes")
    placed = stage(numbered.withColumn("index", F.col("index") - 1).join(sizes, "tree"), "leaves")
    highest = sizes.agg(F.max("n")).first()[0] or 0
    grown = stage(_grow(placed, 0, bits), "nodes")
    nodes, level = [grown.filter(F.col("digest").isNotNull())], bits
    while width_at(highest, level) > 1:
        tops = nodes[-1].filter(F.col("level") == level).join(sizes, "tree")
        nodes.append(stage(_grow(tops, level, bits), "nodes"))
        level += bits
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    lacking = grown.filter(F.col("digest").isNull()).drop("digest")
    fetched = lacking.join(every.drop("block"), ["tree", "level", "index"]).select("tree", "block", "level", "index", "digest")
    roots = every.groupBy("tree").agg(F.max_by("digest", "level").alias("root"))
    return _expand(placed, fetched, keep, bits), roots


def manifest(rows: DataFrame, group: str, key: str, leaf: str = "leaf", keep: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """``keep``, ``leaf``, ``subroot``, ``root`` and ``steps`` (from the leaf to the root of all) of each row. Runs jobs.

    ``leaf`` holds digests, as :func:`leaf_of` makes them.
    """
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    names = {c: f"_keep_{i}" for i, c in enumerate(keep)}
    renamed = rows.select(
        tree.alias("tree"), F.col(leaf).alias("digest"), F.col(key).alias("_key"), *[F.col(c).alias(v) for c, v in names.items()]
    )
    renamed = stage(renamed, "digests")
    proved, roots = forest(renamed, ["_key", "digest"], list(names.values()), bits)
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("_group"), F.col("root").alias("digest"))
    above, _ = forest(tops, ["_group"], ["_group"], bits)
    above = stage(above.select(F.col("_group").alias("tree"), F.col("root").alias("_root"), F.col("steps").alias("_steps")), "roots")
    return proved.join(above, "tree").select(
        *[F.col(v).alias(c) for c, v in names.items()],
        F.col("digest").alias("leaf"), F.col("root").alias("subroot"), F.col("_root").alias("root"),
        F.concat("steps", "_steps").alias("steps"),
    )
