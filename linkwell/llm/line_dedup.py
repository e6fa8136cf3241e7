"""Repeated runs of lines, found by winnowing over line hashes.

Lines that hold a word are hashed. What counts as a run is ``run`` consecutive such
lines, or a single one of ``alone_words`` words or more. From each window of ``run``
lines the line of the least hash, the last of equals, is selected as fingerprint; a
line that is a run by itself is one. Windows of such lines only need no other.
Selected places, each once, are what is shuffled. Those whose hash stands at two
places or more are joined with their earlier places and extended to both sides as
far as their windows reach: by the digests of the lines a place is compared with
the first one that goes on alike to the left, with the first to the right and with
the first of the line itself, so a match that ends with one earlier place goes on
with another. A longer repeat is a chain of such steps, as each of its windows has a
fingerprint. All but the first by document and position are repeats, and a line
goes if a repeated run covers it.

A line that stands in a third of all documents is combined before the shuffle
and meets its first place in a join that adaptive execution splits; no pairs of
places are built.

Defined cases: documents are in the order of doc_id, null first, and rows of one
id in the order of the table. A null text stays null and has no lines. Lines
without a word are neither counted nor deleted; a text may lose all others. The
rows and other columns stay as they are; names of the input may be any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.llm.common import text_of, words_of
from linkwell.session import stage

RUN, ALONE_WORDS = 2, 10


def _n_words(line: Column) -> Column:
    return F.size(words_of(line))


def _span(ahead: Column, length: int, lines: Column) -> Column:
    digest = F.unhex(F.md5(lines.cast("binary")))
    return F.struct(ahead.cast("int").alias("ahead"), F.lit(length).alias("length"), digest.alias("digest"))


def dedup_lines(docs: DataFrame, run: int = RUN, alone_words: int = ALONE_WORDS) -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text``, and ``n_lines``, ``n_removed`` and ``n_runs``.

    New columns replace columns of their names. Runs jobs: the numbered rows and
    the fingerprints are staged.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = stage(
        docs.select(F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(v) for c, v in names.items()]), "rows"
    )
    text, lines = F.col(names["text"]), F.split(text_of(names["text"]), "\n")
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    worded = F.filter(F.transform(lines, lambda x, j: F.struct(x.alias("x"), j.alias("j"))), lambda s: has_word(s["x"]))
    hashed = F.transform("worded", lambda s: F.struct(
        F.xxhash64(s["x"]).alias("h"), s["x"].alias("x"), (_n_words(s["x"]) >= alone_words).alias("alone")))

    def spans(p):
        """Of the windows that hold place ``p`` those that select it, and the line if it is a run: where ``p`` is in them, length, digest."""
        own = F.get(F.col("hashed"), p)

        def window(ahead):
            part = F.slice(F.col("hashed"), p - ahead + 1, F.lit(run))
            before, after = F.slice(part, F.lit(1), ahead), F.slice(part, ahead + 2, F.lit(run))
            least = F.forall(before, lambda s: s["h"] >= own["h"]) & F.forall(after, lambda s: s["h"] > own["h"])
            return F.when(least & F.exists(part, lambda s: ~s["alone"]), _span(ahead, run, F.array_join(F.transform(part, lambda s: s["x"]), "\n")))

        inside = F.filter(F.sequence(F.lit(0), F.lit(run - 1)), lambda a: (p - a >= 0) & (p - a + run <= F.size("hashed")))
        alone = F.when(own["alone"], _span(F.lit(0), 1, own["x"]))
        return F.array_compact(F.concat(F.transform(inside, window), F.array(alone)))

    places = F.transform(F.sequence(F.lit(0), F.size("hashed") - 1), lambda p: F.struct(
        p.alias("place"), F.get(F.col("hashed"), p)["h"].alias("print"), spans(p).alias("spans")))
    prints = stage(
        rows.select("row", F.col(names["doc_id"]).alias("doc"), worded.alias("worded"))
        .filter(F.size("worded") > 0)
        .select("row", "doc", hashed.alias("hashed"))
        .select("row", "doc", F.explode(F.filter(places, lambda s: F.size(s["spans"]) > 0)).alias("s"))
        .select("row", "doc", "s.place", "s.print", "s.spans"),
        "fingerprints",
    )
    ends = [f(c).alias(f"{n}_{c}") for c in ("row", "place") for n, f in (("lo", F.min), ("hi", F.max))]
    shared = prints.groupBy("print").agg(*ends).filter("lo_row != hi_row or lo_place != hi_place").select("print")
    near = prints.join(shared, "print", "left_semi").withColumn("begin", F.struct("doc", "row", "place"))
    near = near.select("print", "begin", F.explode("spans").alias("span"))
    same = ["print", "span"]
    firsts = near.groupBy(*same).agg(F.min("begin").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    at = F.col("begin.place") - F.col("span.ahead")
    repeats = near.join(firsts, same).filter("begin != first").select(
        "begin.row", F.struct(at.alias("at"), (at + F.col("span.length") - 1).alias("to")).alias("at"))
    gone = repeats.groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("starts"))

    every = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s["at"], s["to"]))))
    cut = rows.join(gone, "row", "left").withColumn("worded", worded).withColumn("lines", lines)
    cut = cut.withColumn("gone", F.coalesce(every, F.array().cast("array<int>")))
    runs = F.aggregate(
        F.sort_array("gone"),
        F.struct(F.lit(0).alias("n"), F.lit(-2).alias("last")),
        lambda a, p: F.struct((a["n"] + F.when(p == a["last"] + 1, 0).otherwise(1)).alias("n"), p.alias("last")),
    )["n"]
    drop = F.transform("gone", lambda i: F.get(F.col("worded"), i)["j"])
    cut = cut.withColumn("drop", drop)
    keep = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    cut = cut.withColumn("keep", F.when((F.size("drop") > 0) & (F.size("lines") > 0), keep))
    left = F.array_join(F.transform("keep", lambda j: F.get(F.col("lines"), j)), "\n")
    made = {
        "text": F.when(F.size("drop") > 0, left).otherwise(text),
        "n_lines": F.size("worded").cast("long"), "n_removed": F.size("gone").cast("long"), "n_runs": runs.cast("long"),
    }
    old = [made["text"].alias("text") if c == "text" else F.col(v).alias(c) for c, v in names.items() if c == "text" or c not in made]
    return cut.select(*old, *[e.alias(c) for c, e in made.items() if c != "text"])
