"""The Merkle manifest and the trie of conversations."""

import hashlib
import random
import zlib

import numpy as np
from corpus_cases import SCHEMA, odd_rows
from pyspark.sql import functions as F

from linkwell.llm import merkle, queries, trie
from linkwell.llm.common import table

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def steps_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        out.append((nodes[i - 1], "") if i % 2 else ("", nodes[i + 1] if i + 1 < len(nodes) else ""))
        i //= 2
    return out


def manifest_by_force(rows):
    """(doc_id, leaf, subroot, root, steps) of rows (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(field, r)))
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels_of([h for *_, h in sorted(by_lang[x])]) for x in langs}
    top = levels_of([trees[x][-1][0] for x in langs])
    out = []
    for g, x in enumerate(langs):
        for i, (there, key, h) in enumerate(sorted(by_lang[x])):
            out.append((key if there else None, h, trees[x][-1][0], top[-1][0], steps_of(trees[x], i) + steps_of(top, g)))
    return sorted(out, key=repr)


def found_manifest(frame, bits):
    rows = frame.select("doc_id", "lang", merkle.leaf_of(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))).alias("leaf"), "row")
    made = merkle.manifest(rows, "lang", "doc_id", keep=["doc_id", "row"], bits=bits)
    assert made.columns == ["doc_id", "row", "leaf", "subroot", "root", "steps"]
    assert made.filter(merkle.fold(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.steps]) for r in made.collect()), key=repr)


def test_manifest_of_odd_rows(spark):
    rng = random.Random(3)
    given = odd_rows()
    extra = given[0][5:]
    for i, (lang, n) in enumerate([("hot", 70), ("é", 5), ("z", 1), ("", 9), ("zz", 16)]):
        given += [(rng.randint(-9, 60), f"text {i} {j}", lang, "s", j, *extra) for j in range(n)]
    frame = spark.createDataFrame(given, SCHEMA).repartition(3)
    wanted = manifest_by_force([(r[0], r[3], r[2], r[4], r[1]) for r in given])
    for bits in (1, 3, 12):
        assert found_manifest(frame, bits) == wanted, bits
    one = [(r[0], r[1], "en", *r[3:]) for r in given[:1]]
    assert found_manifest(spark.createDataFrame(one, SCHEMA), 2) == manifest_by_force([(r[0], r[3], r[2], r[4], r[1]) for r in one])
    assert found_manifest(frame.limit(0), 2) == []


def test_missing_nodes_are_the_least_set():
    """What is missing and the leaves give every proof, and no missing node follows from the rest."""
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 7, 8, 21, 64):
        for size in (1, 2, 5):
            leaves = rng.choice(n, min(n, size), replace=False)
            lacking = {(at, i) for at, some in merkle.missing_nodes(leaves, n) for i in some.tolist()}
            needed, level = set(), 0
            known = {(0, int(i)) for i in leaves}
            while merkle.width_at(n, level) > 1:
                for at, i in [(level, int(i) >> level) for i in leaves]:
                    if (i ^ 1) < merkle.width_at(n, at):
                        needed.add((at, i ^ 1))
                    known.add((at + 1, i >> 1))
                level += 1
            assert lacking == needed - known


def test_tampering_is_found(spark):
    docs = {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}
    found = queries.QUERIES["op12_octopus_manifest"](spark, SMALL).collect()
    assert len(found) == len(docs)
    wanted = {w[0]: w for w in manifest_by_force([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.values()])}
    for r in found:
        changed = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and docs[r.doc_id].n_chars is not None
        _, leaf, subroot, root, steps = wanted[r.doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (leaf, subroot, root, sha("".join(a + b for a, b in steps)))
        assert r.verified == (not changed) == (r.folded_root == r.root)
    assert 0 < sum(not r.verified for r in found) < len(found)


TURNS = "conv_id bigint, turn bigint, role string, text string, key string, path string, depth string, ids string, size string"


def digest_of(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def trie_by_force(rows, century=True):
    """Rows of all nodes of the trie of (conv_id, turn, role, text), rebuilt as the query asks."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest_of(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if century else 0
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, some in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(some) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, some in members.items():
        ends = ",".join(map(str, sorted(c for c in some if len(whole[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(some), len(path), parent, len(some), children.get(path, 0), leaves[path], saved[path], sha(ends)))
    return sorted(out, key=repr)


def odd_turns():
    rng = random.Random(11)
    lines = ["", "hello", "é 😀", "ok", None, "x" * 3000]
    rows = []
    for c in [*range(-120, -80), *range(0, 330, 3), 1000, 1100, 5001]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(lines) if rng.random() < 0.3 else "hello"))
    same = [(c, t, "user", "the same") for c in range(700, 800) for t in range(3)]  # a group of copies
    deep = [(c, t, "user", f"turn {t}") for c in (900, 901, 903) for t in range(c - 700)]
    rows += same + deep + [(3, None, None, None), (3, 1, "user", "hello"), (3, 1, "user", "hello"), (None, 0, "user", "lost"), (6, 1, "b", "tie"), (6, 1, "a", "tie")]
    rng.shuffle(rows)
    return rows


def found_trie(spark, rows, **how):
    frame = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], TURNS).repartition(3)
    c = F.col("conv_id")
    again = trie.rebuilt(frame, c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6, 5)
    return sorted((tuple(r) for r in trie.prefix_trie(again, **how).collect()), key=repr)


def test_trie_of_odd_turns(spark):
    rows = odd_turns()
    wanted = trie_by_force(rows)
    assert found_trie(spark, rows) == wanted
    for size in (40, 700):  # many shards: spines of copies, of deep paths and of the root
        assert found_trie(spark, rows, turns_per_shard=size) == wanted, size
    only = [(5, 0, "user", "gone")]  # rebuilt from a conversation that is absent
    assert found_trie(spark, only) == trie_by_force(only)
    assert found_trie(spark, []) == []


def test_find_close_equals_a_stack():
    rng = random.Random(12)
    for n, deep in [(1, 0.5), (40, 0.5), (700, 0.5), (3000, 0.9), (3000, 0.1), (5000, 0.52)]:
        depth = [0]
        for _ in range(n - 1):
            depth.append(depth[-1] + 1 if rng.random() < deep else rng.randint(1, max(1, depth[-1])))
        depth = np.array(depth)
        marks, stack, closes = trie.parentheses_of(depth), [], {}
        opens = np.zeros(2 * n, bool)
        opens[marks.open] = True
        for i, o in enumerate(opens):
            if o:
                stack.append(i)
            else:
                closes[stack.pop()] = i
        assert not stack and marks.find_close(marks.open).tolist() == [closes[i] for i in marks.open.tolist()]
        leaf = opens[:-1] & ~opens[1:]
        assert marks.leaves(marks.open, marks.find_close(marks.open)).tolist() == [int(leaf[i : closes[i]].sum()) for i in marks.open.tolist()]
