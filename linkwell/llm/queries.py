"""The corpus operators as queries over the given tables, and SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwell.llm import (
    exact_dedup, line_dedup, merkle, minhash, packing, pieces, quality, sharding, suffix_dedup, topk, toxicity, trie, warc,
)
from linkwell.llm.common import table, text_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op6_distribution_divergence(spark, sf_dir):
    judged = quality.quality(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance",
    )


@query
def op5_jump_hash_shards(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8, grown=9)


@query
def op7_sentencepiece_agenda(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_streaming_exact_dedup(spark, sf_dir):
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("digest", "text_sha256")


SQL["op3_streaming_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
           count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents"""


@query
def op8_warc_members(spark, sf_dir):
    archives = warc.archive_pages(spark, table(spark, sf_dir, "pages"))
    return warc.read_back(archives).drop("archive", "offset")


SQL["op8_warc_members"] = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
         f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first
               FROM p)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM f"""


@query
def op9_minhash_odd_sketch(spark, sf_dir):
    return minhash.components(table(spark, sf_dir, "documents"))


SQL["op9_minhash_odd_sketch"] = r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
         s AS MATERIALIZED (SELECT doc_id, unnest(list_distinct(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 3, 2) END),
                              lambda i: array_to_string(w[i:i + 4], ' ')))) AS g FROM w),
         n AS MATERIALIZED (SELECT doc_id, count(g) AS n FROM (SELECT doc_id FROM documents) LEFT JOIN s USING (doc_id) GROUP BY 1),
         p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
         e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
         r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.m)
    SELECT n.doc_id, n.n AS n_shingles, min(m) AS component_id, n.doc_id = min(m) AS kept FROM n JOIN r USING (doc_id) GROUP BY 1, 2"""


@query
def op4_winnowed_line_dedup(spark, sf_dir):
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"))


SQL["op4_winnowed_line_dedup"] = r"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS j FROM documents),
         w AS (SELECT *, row_number() OVER d AS i, lead(line) OVER d AS after
               FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW d AS (PARTITION BY doc_id ORDER BY j)),
         r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line, after ORDER BY doc_id, i) > 1 AS again
               FROM w WHERE after IS NOT NULL),
         a AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS again
               FROM w WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 10),
         g AS (SELECT doc_id, i FROM r WHERE again UNION SELECT doc_id, i + 1 FROM r WHERE again
               UNION SELECT doc_id, i FROM a WHERE again),
         n AS (SELECT w.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
                      count(g.i) FILTER (b.i IS NULL) AS n_runs
               FROM w LEFT JOIN g USING (doc_id, i) LEFT JOIN g b ON b.doc_id = g.doc_id AND b.i = g.i - 1 GROUP BY 1),
         k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.j) FILTER (g.i IS NULL) AS kept
               FROM l LEFT JOIN w USING (doc_id, j) LEFT JOIN g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY 1)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""


@query
def op2_bm25_packing(spark, sf_dir):
    tokens = packing.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), compact=True)
    return packing.pack(tokens).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op10_suffix_array_dedup(spark, sf_dir):
    done = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op1_factorization_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op11_columnar_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


SQL["op11_columnar_top_k"] = """
    WITH v AS MATERIALIZED (
           SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
                      coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0)::BIGINT
                        AS score
               FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
         k AS (SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
               FROM s)
    SELECT * FROM k WHERE rank <= 5"""


@query
def op12_octopus_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before, text = [F.col(c) for c in ("doc_id", "source", "lang")], F.col("text")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20, 0)") + 1
    rows = docs.select(
        "doc_id", "lang", merkle.leaf_of(*before, F.col("n_chars"), text).alias("leaf"),
        F.when(changed & more.isNotNull(), merkle.leaf_of(*before, more, text)).alias("claimed"),
    )
    proved = merkle.manifest(rows, group="lang", key="doc_id", keep=["doc_id", "claimed"])
    folded = proved.withColumn("folded_root", merkle.fold(F.coalesce("claimed", "leaf"), F.col("steps")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of ASCII text: eight shifts for each byte."""
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    data = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda a, b: {bits}), 4294967295)"


def _levels(name: str, by: str, source: str) -> str:
    """CTEs of a tree for each value of ``by``: 24 levels, enough for 16 million leaves; a root stays as it is on higher ones."""
    parts = [f"{name}_0 AS MATERIALIZED ({source})"]
    for at in range(24):
        parts.append(
            f"{name}_{at + 1} AS MATERIALIZED (SELECT {by}, i // 2 AS i, "
            f"CASE WHEN max(w) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (max(w) + 1) // 2 AS w "
            f"FROM {name}_{at} GROUP BY {by}, i // 2)"
        )
    steps = " UNION ALL ".join(f"SELECT *, {at} AS lv FROM {name}_{at} WHERE w > 1" for at in range(24))
    return ", ".join([*parts, f"{name} AS MATERIALIZED ({steps})"])


SQL["op12_octopus_manifest"] = f"""
    WITH d AS (SELECT *, CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS l FROM documents),
         f AS (SELECT doc_id, l, lang, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
                        || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END || l AS head,
                      CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail, n_chars AS n
               FROM d),
         e AS (SELECT doc_id, l, lang, sha256(head || CASE WHEN n IS NULL THEN '-' ELSE strlen(n::VARCHAR) || ':' || n END || tail) AS leaf,
                      sha256(head || CASE WHEN n IS NULL THEN '-' ELSE strlen((n + 1)::VARCHAR) || ':' || (n + 1) END || tail) AS other
               FROM f),
         p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY l ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM e),
         {_levels("t", "l", "SELECT l, i, leaf AS h, count(*) OVER (PARTITION BY l) AS w FROM p")},
         r AS MATERIALIZED (SELECT l, t_24.h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
                            FROM t_24 JOIN (SELECT DISTINCT l, lang FROM p) USING (l)),
         {_levels("s", "z", "SELECT 0 AS z, g AS i, subroot AS h, count(*) OVER () AS w FROM r")},
         a AS (SELECT p.doc_id, p.leaf, p.other, p.i, r.g, r.subroot, s_24.h AS root, l FROM p JOIN r USING (l), s_24),
         b AS (SELECT a.l, a.i, t.lv, h.h AS h, (a.i >> t.lv) % 2 AS odd
               FROM a JOIN (SELECT DISTINCT l, lv FROM t) t USING (l)
               LEFT JOIN t h ON h.l = a.l AND h.lv = t.lv AND h.i = xor(a.i >> t.lv, 1)
               UNION ALL
               SELECT a.l, a.i, 100 + t.lv, h.h, (a.g >> t.lv) % 2
               FROM a CROSS JOIN (SELECT DISTINCT lv FROM s) t LEFT JOIN s h ON h.lv = t.lv AND h.i = xor(a.g >> t.lv, 1)),
         c AS (SELECT l, i, string_agg(coalesce(h, ''), '' ORDER BY lv) AS siblings,
                      list(CASE WHEN odd = 1 THEN 'L' ELSE 'R' END || coalesce(h, '') ORDER BY lv) AS steps FROM b GROUP BY 1, 2),
         v AS (SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256,
                      list_reduce(list_prepend(CASE WHEN crc % 7 = 0 THEN other ELSE leaf END, coalesce(steps, [])),
                                  lambda acc, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || acc ELSE acc || x[2:] END)) AS folded_root
               FROM (SELECT *, {_crc32("doc_id::VARCHAR")} AS crc FROM a) LEFT JOIN c USING (l, i))
    SELECT *, folded_root = root AS verified FROM v"""


@query
def op13_parentheses_trie(spark, sf_dir):
    c = F.col("conv_id")
    head = F.crc32(c.cast("string").cast("binary")) % 6
    return trie.prefix_trie(trie.rebuilt(table(spark, sf_dir, "conversations"), c - c % 100, head, 5))


SQL["op13_parentheses_trie"] = f"""
    WITH s AS (SELECT conv_id, turn, left(sha256(strlen(r) || ':' || r || t), 32) AS g, length(t) AS n
               FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
                     WHERE conv_id IS NOT NULL)),
         o AS MATERIALIZED (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h, list(g ORDER BY turn NULLS FIRST, g) AS gs,
                                   list(n ORDER BY turn NULLS FIRST, g) AS ns FROM s GROUP BY conv_id),
         b AS MATERIALIZED (SELECT o.conv_id, list_concat(coalesce(p.gs[1:o.h], []), o.gs[o.h + 1:]) AS gs,
                                   list_concat(coalesce(p.ns[1:o.h], []), o.ns[o.h + 1:]) AS ns
                            FROM o LEFT JOIN o p ON p.conv_id = o.conv_id - o.conv_id % 100),
         m AS (SELECT conv_id, gs, ns, unnest(range(0, len(gs) + 1)) AS d FROM b),
         c AS MATERIALIZED (SELECT gs[1:d] AS path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                                   max(CASE WHEN d > 0 THEN ns[d] ELSE 0 END) AS n
                            FROM m GROUP BY gs[1:d], d),
         k AS MATERIALIZED (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM c WHERE d > 0 GROUP BY 1),
         w AS (SELECT c.path, d, (n_convs - 1) * n AS saved, n_children IS NULL AS leaf FROM c LEFT JOIN k USING (path)),
         u AS (SELECT path, saved, leaf, unnest(range(0, d + 1)) AS a FROM w),
         t AS (SELECT path[1:a] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM u GROUP BY 1),
         e AS (SELECT gs AS path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS h FROM b GROUP BY 1)
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           saved_tokens, coalesce(h, sha256('')) AS ends_sha256
    FROM c LEFT JOIN c p ON p.d = c.d - 1 AND p.path = c.path[1:c.d - 1] LEFT JOIN k ON k.path = c.path
    JOIN t ON t.path = c.path LEFT JOIN e ON e.path = c.path"""
