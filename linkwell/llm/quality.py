"""Quality rules: divergence of a text's histograms from references of its language.

Two histograms describe a text: its characters by class, and its words by the
common words of its language with all other words as one more bin. The
references are the same histograms summed over all documents of the language
that have enough words, so they follow the corpus. A text is rejected if the
Jensen-Shannon distance (base 2, 0 to 1) of either histogram from the reference
passes its threshold. A histogram of too few characters or words is no
evidence; such a text is not judged by it.

Everything is DataFrame expressions. Each text is read once: its counts are
staged, the references are summed from them, one row for each language, and
the verdicts computed from both. Nothing else is shuffled.

Defined cases: a null text is an empty one, without words, and fails the base
rules. A language that is null or has no word list is compared with the
reference of all such documents under the first words of all lists; where a
reference is empty, the distance is 0. Repeated rows are judged alike, each by
itself. An empty table stays empty. Other columns are kept; internal ones start
with ``_q_``, and columns of the input with such names are not touched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.llm.common import text_of, words_of
from linkwell.session import stage

# Common words of each language, as many for each.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with".split(),
    "de": "der die und in den von zu das mit sich des auf".split(),
    "fr": "de la le et les des en un du une que est".split(),
    "es": "de la que el en y a los del se las por".split(),
}
BINS = 12
OTHER = "other"
# Character classes besides letters; what none of them matches is the last class.
UPPER, LETTERS, SPACE, SYMBOL = r"\p{Lu}", r"\p{L}", r"\x20\x09-\x0D", r"#*$%&|<>"
CLASSES = {"digit": r"\p{Nd}", "space": SPACE, "stop": r".,;:!?'\"()\-", "symbol": SYMBOL}
MIN_WORDS, MAX_REPEATED = 50, 0.5
MIN_CHARS_JUDGED, MIN_WORDS_JUDGED = 200, 100
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.2, 0.27
INDEX_BITS = 24


def _total(counts: Column, zero: object = 0) -> Column:
    return F.aggregate(counts, F.lit(zero).cast("double" if zero == 0.0 and isinstance(zero, float) else "long"), lambda a, x: a + x)


def _repeated_windows(words: Column, n: Column, packed: Column) -> Column:
    """Positions of three-word windows that occur twice or more.

    ``packed`` holds, sorted, the upper bits of each window's hash over its
    position, so equal windows are neighbours. Neighbours of one hash are
    compared by their words; should two differ, as after a collision, or should
    the text be too long for the position bits, whole windows are sorted.
    """
    low = (1 << INDEX_BITS) - 1
    position = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
    head = lambda x: F.shiftright(x, INDEX_BITS)
    window = lambda i: F.struct(*[F.get(words, i + j).alias(f"w{j}") for j in range(3)])
    every = F.sequence(F.lit(0), n - 3)
    # (position, next position) of neighbours of one hash
    pairs = F.transform(
        F.filter(every, lambda k: F.coalesce(head(F.get(packed, k)) == head(F.get(packed, k + 1)), F.lit(False))),
        lambda k: F.struct(position(F.get(packed, k)).alias("a"), position(F.get(packed, k + 1)).alias("b")),
    )
    whole = F.sort_array(F.transform(every, lambda i: F.struct(window(i).alias("w"), i.alias("i"))))
    same = lambda s, k: F.coalesce(F.get(s, k)["w"] == F.get(s, k + 1)["w"], F.lit(False))
    again = lambda s: F.transform(
        F.filter(every, lambda k: same(s, k) | same(s, k - 1)), lambda k: F.get(s, k)["i"]
    )
    # An expression in a lambda is computed at each call, so lists go into lambdas as arguments.
    slow = F.get(F.transform(F.array(whole), again), F.lit(0))
    quick = lambda found: F.when(
        F.exists(found, lambda p: window(p["a"]) != window(p["b"])), slow
    ).otherwise(F.array_union(F.transform(found, lambda p: p["a"]), F.transform(found, lambda p: p["b"])))
    return F.when(n > low, slow).otherwise(F.get(F.transform(F.array(pairs), quick), F.lit(0)))


def _counts(docs: DataFrame) -> DataFrame:
    """The base counts and the two histograms of each row."""
    words, n = F.col("_q_words"), F.size("_q_words")
    lines = F.filter(F.split(F.col("_q_text"), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    keep = (1 << INDEX_BITS) - 1
    hashes = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(3)]).bitwiseAND(F.lit(~keep)),
    )
    packed = F.sort_array(F.transform("_q_hashes", lambda h, i: h.bitwiseOR(i.cast("long"))))
    spans = F.aggregate(
        F.sort_array("_q_again"),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
    )["n"]
    rest = F.col("_q_rest")
    in_class = {c: F.length(F.regexp_replace(rest, f"[^{p}]+", "")) for c, p in CLASSES.items()}
    length = F.length("_q_text")
    lists = reduce(
        lambda c, k: c.when(F.col("_q_ref") == k, F.array(*[F.lit(w) for w in COMMON_WORDS[k]])), COMMON_WORDS,
        F.when(F.lit(False), F.array(*[F.lit("")] * BINS)),
    ).otherwise(F.array(*[F.lit(w) for w in [w for ws in zip(*COMMON_WORDS.values()) for w in ws][:BINS]]))
    found = [(n - F.size(F.array_remove(words, F.get("_q_list", F.lit(i))))).cast("long") for i in range(BINS)]
    return (
        docs.withColumn("_q_text", text_of())
        .withColumn("_q_words", words_of(F.col("_q_text")))
        .withColumn("_q_rest", F.regexp_replace("_q_text", f"{LETTERS}+", ""))
        .withColumn("_q_lines", lines)
        .withColumn("_q_ref", F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(F.lit(OTHER)))
        .withColumn("_q_list", lists)
        .withColumn("_q_hashes", F.when(n >= 4, hashes))
        .withColumn("n_words", n.cast("long"))
        .withColumn("_q_length", length)
        .withColumns({f"_q_n_{c}": e for c, e in in_class.items()})
        .withColumn("word_chars", (F.col("_q_length") - F.col("_q_n_space")).cast("long"))
        .withColumn("n_symbols", F.col("_q_n_symbol").cast("long"))
        .withColumn("n_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))
        .withColumn("_q_packed", F.when(F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes"), packed))
        .withColumn("_q_again", F.when(F.col("_q_packed").isNotNull(), _repeated_windows(words, n, F.col("_q_packed"))))
        .withColumn("n_repeat_words", F.coalesce(spans, F.lit(0)).cast("long"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
        )
        .withColumn("_q_upper", F.length(F.regexp_replace("_q_text", f"[^{UPPER}]+", "")))
        .withColumn("_q_chars", F.array("_q_upper", *[f"_q_n_{c}" for c in CLASSES]).cast("array<long>"))
        .withColumn("_q_chars", F.concat("_q_chars", F.array(F.col("_q_length") - _total(F.col("_q_chars")))))
        .withColumn("_q_common", F.array(*found))
        .withColumn("_q_common", F.concat("_q_common", F.array(F.col("n_words") - _total(F.col("_q_common")))))
    )


def _shares(counts: Column) -> Column:
    total = _total(counts, 0.0)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, base 2; 0 if either is empty or missing."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    full = (_total(p, 0.0) > 0) & (_total(q, 0.0) > 0)
    return F.coalesce(F.when(full, F.sqrt(F.greatest(_total(terms, 0.0), F.lit(0.0)))), F.lit(0.0))


def references(counts: DataFrame) -> DataFrame:
    """Both histograms of each language, summed over all documents with enough words."""
    first = len(CLASSES) + 2
    sums = (
        counts.filter(F.col("n_words") >= MIN_WORDS_JUDGED)
        .select("_q_ref", F.posexplode(F.concat("_q_chars", "_q_common")).alias("_q_bin", "_q_n"))
        .groupBy("_q_ref", "_q_bin")
        .agg(F.sum("_q_n").alias("_q_n"))
        .groupBy("_q_ref")
        .agg(F.sort_array(F.collect_list(F.struct("_q_bin", "_q_n")))["_q_n"].alias("_q_all"))
    )
    return sums.select(
        "_q_ref",
        F.slice("_q_all", 1, first).alias("_q_ref_chars"),
        F.slice("_q_all", first + 1, BINS + 1).alias("_q_ref_common"),
    )


def quality(
    docs: DataFrame,
    keep: list[str] | None = None,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all if not given), base counts, two distances and ``kept``.

    Runs a job, which stages counts and kept columns. The table of references
    has at most one row for each word list, so it is broadcast.
    """
    keep = docs.columns if keep is None else keep
    inputs = {c: f"_q_in_{i}" for i, c in enumerate(keep)}
    rows = docs.select("text", "lang", *[F.col(c).alias(v) for c, v in inputs.items()])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    hidden = ["_q_ref", "_q_length", "_q_chars", "_q_common"]
    counts = stage(_counts(rows).select(*inputs.values(), *names, *hidden), "quality")
    judged = (
        counts.join(F.broadcast(references(counts)), "_q_ref", "left")
        .withColumns({n: _shares(F.col(n)) for n in ("_q_chars", "_q_common", "_q_ref_chars", "_q_ref_common")})
        .withColumn("char_distance", js_distance(F.col("_q_chars"), F.col("_q_ref_chars")))
        .withColumn("word_distance", js_distance(F.col("_q_common"), F.col("_q_ref_common")))
    )
    odd = ((F.col("_q_length") >= MIN_CHARS_JUDGED) & (F.col("char_distance") > max_char_distance)) | (
        (F.col("n_words") >= MIN_WORDS_JUDGED) & (F.col("word_distance") > max_word_distance)
    )
    made = {**{n: F.col(n) for n in names}, "char_distance": F.col("char_distance"), "word_distance": F.col("word_distance")}
    made["kept"] = ~F.col("base_failed") & ~odd
    return judged.select(*[F.col(v).alias(c) for c, v in inputs.items() if c not in made], *[e.alias(c) for c, e in made.items()])


def keep_good(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with their own columns only."""
    numbered = {c: f"_q_own_{i}" for i, c in enumerate(docs.columns)}
    both = docs.select("text", "lang", *[F.col(c).alias(v) for c, v in numbered.items()])
    kept = quality(both, list(numbered.values()), **limits).filter("kept")
    return kept.select(*[F.col(v).alias(c) for c, v in numbered.items()])
