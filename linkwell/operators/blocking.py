"""Candidate generation: blocking rules as joins of S1 with the targets S2 and S3.

Every function takes the normalized S1 table and the normalized targets with
their ``source`` column, and returns long candidate pairs. Entity ids must be
unique. Rules are combined by making them disjoint, so the union needs no
``distinct`` over all pairs. Small key tables, the keys beyond a cap and the hot
keys of a join, are staged before the join that looks them up: the planner then
knows their size and can spare the large side a shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwell.functions.text import name_prefix, name_tokens
from linkwell.operators.skew import MOST_TASKS, PAIRS_PER_TASK, ROWS_PER_CELL, key_counts, spread_join
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import dealt, stage, stage_counted

# Frequency caps of the prefix rules and the token cap.
PREFIX4_CAP = 500
PREFIX6_CAP = 1000
TOKEN_CAP = 200


def union_targets(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """S2 and S3 as one table with a ``source`` column: each rule is one join, not two."""
    return s2.withColumn("source", F.lit("S2")).unionByName(s3.withColumn("source", F.lit("S3")))


def _named(df: DataFrame) -> DataFrame:
    return df.filter(F.col("name_norm") != "")


def _left(s1: DataFrame, *columns: str | Column) -> DataFrame:
    return _named(s1).select(F.col("entity_id").alias(S1_ID), *columns)


def _right(targets: DataFrame, *columns: str | Column) -> DataFrame:
    return _named(targets).select(F.col("entity_id").alias(CANDIDATE_ID), *columns)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(S1_ID, CANDIDATE_ID)


# --- block keys --------------------------------------------------------------------------------


def prefix_key_counts(targets: DataFrame, length: int) -> DataFrame:
    """Rows per ``(source, country_norm, prefix)``; map-side combined."""
    column = f"name_prefix{length}"
    return (
        _named(targets)
        .groupBy("source", "country_norm", name_prefix(F.col("name_norm"), length).alias(column))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def eligible_prefix_keys(targets: DataFrame, length: int, cap: int) -> DataFrame:
    """Block keys that at most ``cap`` target rows of a source share."""
    return prefix_key_counts(targets, length).filter(F.col("frequency") <= cap)


def blocking_key_stats(targets: DataFrame, caps: dict[int, int] | None = None) -> DataFrame:
    """Per source and prefix length: keys, average and maximum frequency, keys within the cap."""
    caps = caps or {4: PREFIX4_CAP, 6: PREFIX6_CAP}
    parts = [
        prefix_key_counts(targets, n)
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("total_keys"),
            F.avg("frequency").alias("avg_frequency"),
            F.max("frequency").alias("max_frequency"),
            F.count_if(F.col("frequency") <= cap).alias("eligible_keys"),
        )
        .select("source", F.lit(n).alias("prefix_length"), "total_keys", "avg_frequency", "max_frequency",
                "eligible_keys")
        for n, cap in caps.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- single rules ------------------------------------------------------------------------------


def block_exact_name(s1: DataFrame, targets: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Pairs with the same non-empty normalized name."""
    joined = spread_join(
        _left(s1, "name_norm"), _right(targets, "name_norm"), ["name_norm"], S1_ID, CANDIDATE_ID, rows_per_cell
    )
    return _pairs(joined)


def rule_exceptions(counted: DataFrame, prefix4_cap: int = PREFIX4_CAP, prefix6_cap: int = PREFIX6_CAP) -> DataFrame:
    """Keys ``(source, country_norm, name_prefix6)`` that prefix 4 does not admit, with ``_exception``.

    Equal prefixes of six imply equal prefixes of four, so the longer prefix
    matters only where the shorter one is beyond its cap: ``_exception`` is 6
    where the longer one is within its own cap, else 0. Both counts come from
    one pass over ``counted``.
    """
    by6 = prefix_key_counts(counted, 6).withColumn("name_prefix4", F.substring("name_prefix6", 1, 4))
    key4 = ["source", "country_norm", "name_prefix4"]
    common4 = by6.groupBy(*key4).agg(F.sum("frequency").alias("_n")).filter(F.col("_n") > prefix4_cap)
    return by6.join(common4, key4, "left_semi").select(
        "source", "country_norm", "name_prefix6",
        F.when(F.col("frequency") <= prefix6_cap, 6).otherwise(0).alias("_exception"),
    )


def admitting_rule(targets: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Add ``_rule``: 4 or 6 for the prefix rule that admits a named target row, 0 if both keys are too common."""
    keyed = _named(targets).withColumn("name_prefix6", name_prefix(F.col("name_norm"), 6))
    keys = ["source", "country_norm", "name_prefix6"]
    return keyed.join(exceptions, keys, "left").withColumn("_rule", F.coalesce("_exception", F.lit(4))).drop("_exception")


def block_prefix(
    s1: DataFrame, targets: DataFrame, length: int = 4, cap: int | None = None, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Pairs with equal country and name prefix, optionally only for keys within a frequency cap."""
    key = name_prefix(F.col("name_norm"), length).alias("_prefix")
    right = _right(targets, "source", "country_norm", key)
    if cap is not None:
        # Keys beyond the cap are the few, at most rows/cap of them.
        beyond = stage(prefix_key_counts(targets, length).filter(F.col("frequency") > cap), "beyond-cap")
        beyond = beyond.withColumnRenamed(f"name_prefix{length}", "_prefix")
        right = right.join(beyond, ["source", "country_norm", "_prefix"], "left_anti")
    left = _left(s1, "country_norm", key)
    return _pairs(spread_join(left, right, ["country_norm", "_prefix"], S1_ID, CANDIDATE_ID, rows_per_cell))


def block_token(
    s1: DataFrame, targets: DataFrame, min_length: int = 3, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Pairs that share any name token of at least ``min_length`` characters.

    A pair meets once per shared token and is kept at the least one only, so no
    ``distinct`` has to shuffle the pairs. That is where neither side has an earlier
    token that the other has; a bit for each earlier token tells so of most pairs,
    and only where bits agree the tokens are compared.
    """
    tokens = F.array_sort(F.array_distinct(name_tokens(F.col("name_norm"), min_length)))
    left = _with_earlier(_left(s1, tokens.alias("_tokens")), "_s1")
    right = _with_earlier(_right(targets, tokens.alias("_tokens")), "_t")
    joined = spread_join(left, right, ["_token"], S1_ID, CANDIDATE_ID, rows_per_cell)
    apart = F.col("_s1_bits").bitwiseAND(F.col("_t_bits")) == 0
    return _pairs(joined.filter(apart | ~F.arrays_overlap("_s1_earlier", "_t_earlier")))


def _with_earlier(rows: DataFrame, side: str) -> DataFrame:
    """A row for each of the sorted ``_tokens``, with the tokens before it and a bit for each of these."""
    at = rows.select("*", F.posexplode("_tokens").alias("_at", "_token")).withColumn(f"{side}_earlier", F.slice("_tokens", 1, F.col("_at")))
    bits = F.expr(f"aggregate({side}_earlier, 0L, (bits, t) -> bits | shiftleft(1L, int(pmod(xxhash64(t), 64))))")
    return at.withColumn(f"{side}_bits", bits).drop("_tokens", "_at")


def _token_hits(
    s1: DataFrame, targets: DataFrame, cap: int, min_length: int, rows_per_cell: int, *carried: Column
) -> DataFrame:
    """Pairs of :func:`token_cap`, with columns carried over from S1."""
    tokens = F.array_distinct(name_tokens(F.col("name_norm"), min_length))
    rank = F.row_number().over(Window.partitionBy("source", "_token").orderBy(CANDIDATE_ID))
    postings = (
        _right(targets, "source", F.explode(tokens).alias("_token"))
        .withColumn("_n", rank)
        .filter(F.col("_n") <= cap)
        .groupBy("source", "_token")
        .agg(F.sort_array(F.collect_list(CANDIDATE_ID)).alias("_ids"))
    )
    probes = _left(s1, *carried, F.posexplode(tokens).alias("_at", "_token"))
    met = spread_join(probes, postings, ["_token"], S1_ID, "_token", rows_per_cell)
    kept = [c for c in probes.columns if not c.startswith("_")]
    walked = F.sort_array(F.collect_list(F.struct("source", "_at", "_ids")))
    return (
        met.groupBy(*kept)
        .agg(F.slice(F.array_distinct(F.flatten(walked.getField("_ids"))), 1, cap).alias("_ids"))
        .select(*kept, F.explode("_ids").alias(CANDIDATE_ID))
    )


def token_cap(
    s1: DataFrame,
    targets: DataFrame,
    cap: int = TOKEN_CAP,
    min_length: int = 3,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """At most ``cap`` token candidates per S1 record, S2 before S3.

    An S1 record walks its tokens in name order over the S2 postings and then
    the S3 postings until it has ``cap`` candidates; within a posting, ids
    ascend. A candidate first met at a token can only rank within ``cap`` if it
    is among the ``cap`` smallest ids of that token's posting, as all smaller
    ids there rank before it. Cutting each posting at ``cap`` ids is therefore
    exact. A cut posting is one row, at most two of them meet a token of an S1
    record, and ranking within postings is pre-cut before its shuffle, so no
    token, however common, grows with the table.
    """
    return _pairs(_token_hits(s1, targets, cap, min_length, rows_per_cell))


# --- rule combinations -------------------------------------------------------------------------

_RULE_KEY = ["_by", "_country", "_key"]
Carried = tuple[DataFrame, DataFrame]


def _key(by: int, key: Column, country: Column | None = None) -> Column:
    return F.struct(
        F.lit(by).alias("_by"), (F.lit("") if country is None else country).alias("_country"), key.alias("_key")
    )


def _prefix_key(length: int) -> Column:
    return _key(length, name_prefix(F.col("name_norm"), length), F.col("country_norm"))


def _join_by_rules(
    s1: DataFrame, targets: DataFrame, s1_keys: list[Column], target_keys: list[Column], rows_per_cell: int,
    carried: Carried | None = None, pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """All rules as one join: each row brings one key per rule, tagged with the rule.

    Rule 0 is the exact name; prefix rules leave pairs with equal names to it,
    so that every pair comes out once and no ``distinct`` is needed.

    ``carried`` are tables by S1 and by candidate id. Joined to the records before
    these meet, they give what joining them to the pairs would give, and no pair is
    shuffled for it.
    """
    def keyed(df: DataFrame, key: str, name: str, keys: list[Column], extra: DataFrame | None) -> DataFrame:
        at = df.select(
            F.col("entity_id").alias(key), F.col("name_norm").alias(name), F.explode(F.array_compact(F.array(*keys))).alias("_at")
        ).select(key, name, *[F.col(f"_at.{c}").alias(c) for c in _RULE_KEY])
        return at if extra is None else at.join(extra, key)

    ours, theirs = carried or (None, None)
    left = keyed(_named(s1), S1_ID, "_s1_name", s1_keys, ours)
    right = keyed(_named(targets), CANDIDATE_ID, "_t_name", target_keys, theirs)
    joined = spread_join(left, right, _RULE_KEY, S1_ID, CANDIDATE_ID, rows_per_cell, pairs_per_task)
    more = [c for side in carried or () for c in side.columns if c not in (S1_ID, CANDIDATE_ID)]
    return joined.filter((F.col("_by") == 0) | (F.col("_s1_name") != F.col("_t_name"))).select(S1_ID, CANDIDATE_ID, *more)


def block_index(
    s1: DataFrame,
    targets: DataFrame,
    max_token_candidates: int = TOKEN_CAP,
    prefix_length: int = 4,
    rows_per_cell: int = ROWS_PER_CELL,
    listed: bool = False,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Exact name, or country and prefix, or one of the capped token candidates.

    ``listed`` gives the same pairs as lists: one row for each S1 id, those without any
    included, with its sorted candidates as an array, which no shuffle of pairs has put together.
    """
    if listed:
        return _index_lists(s1, targets, max_token_candidates, prefix_length, rows_per_cell, pairs_per_task)
    by_key = index_by_keys(s1, targets, prefix_length, rows_per_cell)
    return by_key.unionByName(index_by_tokens(s1, targets, max_token_candidates, prefix_length, rows_per_cell))


def _index_lists(
    s1: DataFrame, targets: DataFrame, max_token_candidates: int, prefix_length: int, rows_per_cell: int, pairs_per_task: int
) -> DataFrame:
    """The lists of :func:`block_index`. Runs jobs.

    All S1 records of a country and prefix have the same targets there: these are listed
    once and the list is joined to the records, in cells of ``pairs_per_task`` listed ids. Only what
    goes beyond it, targets of equal name in other countries and the capped token
    candidates, is grouped by S1 id, as are the pairs of ids that are null or come more than once.
    """
    same_id = lambda ids: F.col("entity_id").eqNullSafe(ids["_id"])
    repeated = s1.groupBy(F.col("entity_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 or _id is null")
    repeated, n_repeated = stage_counted(repeated.select("_id"), "repeated-ids")
    again = s1.join(repeated, same_id(repeated), "left_semi")
    if n_repeated:
        s1 = s1.join(repeated, same_id(repeated), "left_anti")

    on = ["country_norm", "_prefix"]
    prefix = name_prefix(F.col("name_norm"), prefix_length).alias("_prefix")
    left, right = _left(s1, "country_norm", prefix), _right(targets, "country_norm", prefix).filter(F.col(CANDIDATE_ID).isNotNull())
    seen = Observation()
    met = F.col("_ln").cast("double") * F.col("_rn")
    counts = key_counts(left, right, on).observe(seen, F.coalesce(F.sum(met), F.lit(0.0)).alias("pairs"))
    cells = F.least(F.ceil(met / pairs_per_task), F.col("_ln")).cast("int").alias("_cells")
    hot, n_hot = stage_counted(counts.filter(met > pairs_per_task).select(*on, cells), "hot-lists")
    tasks = min(math.ceil(seen.get["pairs"] / pairs_per_task), MOST_TASKS)

    country = lambda c: F.col("country_norm").alias(c)
    named = spread_join(
        _left(s1, "name_norm", country("_c1")), _right(targets, "name_norm", country("_c2")), ["name_norm"], S1_ID, CANDIDATE_ID, rows_per_cell
    )
    elsewhere = _pairs(named.filter(~F.coalesce(F.col("_c1") == F.col("_c2"), F.lit(False))))
    beyond = elsewhere.unionByName(index_by_tokens(s1, targets, max_token_candidates, prefix_length, rows_per_cell))
    beyond = beyond.groupBy(S1_ID).agg(F.collect_list(CANDIDATE_ID).alias("_beyond"))

    listed = right.groupBy(*on).agg(F.sort_array(F.collect_set(CANDIDATE_ID)).alias("_ids"))
    whole = s1.select(F.col("entity_id").alias(S1_ID)).join(left, S1_ID, "left").join(beyond, S1_ID, "left")
    if n_hot:
        n_cells = F.coalesce("_cells", F.lit(1))
        whole = whole.join(hot, on, "left").withColumn("_cell", F.pmod(F.xxhash64(S1_ID), n_cells).cast("int")).drop("_cells")
        listed = listed.join(hot, on, "left").withColumn("_cell", F.explode(F.sequence(F.lit(0), n_cells - 1))).drop("_cells")
        on = [*on, "_cell"]
    none = F.array().cast(T.ArrayType(T.StringType()))
    ids = F.coalesce("_ids", none)
    both = F.when(F.col("_beyond").isNull(), ids).otherwise(F.sort_array(F.array_distinct(F.concat(ids, F.coalesce("_beyond", none)))))
    lists = dealt(whole, tasks, *on).join(dealt(listed, tasks, *on), on, "left").select(S1_ID, both.alias(CANDIDATE_ID))
    if not n_repeated:
        return lists
    others = _grouped(again, block_index(again, targets, max_token_candidates, prefix_length, rows_per_cell))
    return lists.unionByName(others.select(S1_ID, F.sort_array("_ids").alias(CANDIDATE_ID)))


def index_by_keys(
    s1: DataFrame, targets: DataFrame, prefix_length: int = 4, rows_per_cell: int = ROWS_PER_CELL,
    carried: Carried | None = None, pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """The pairs of :func:`block_index` by exact name, or country and prefix, which are those of profiles, uncapped."""
    keys = [_key(0, F.col("name_norm")), _prefix_key(prefix_length)]
    return _join_by_rules(s1, targets, keys, keys, rows_per_cell, carried, pairs_per_task)


def index_by_tokens(
    s1: DataFrame, targets: DataFrame, max_token_candidates: int = TOKEN_CAP, prefix_length: int = 4,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """The capped token candidates of :func:`block_index` that :func:`index_by_keys` doesn't give."""
    prefix = lambda side: name_prefix(F.col(f"{side}_name"), prefix_length)
    carried = [F.col("name_norm").alias("s1_name"), F.col("country_norm").alias("s1_country")]
    theirs = _right(targets, F.col("name_norm").alias("t_name"), F.col("country_norm").alias("t_country"))
    hits = _token_hits(s1, targets, max_token_candidates, 3, rows_per_cell, *carried).join(theirs, CANDIDATE_ID)
    covered = (F.col("s1_name") == F.col("t_name")) | (
        (F.col("s1_country") == F.col("t_country")) & (prefix("s1") == prefix("t"))
    )
    return _pairs(hits.filter(~covered))


def block_capped(
    s1: DataFrame,
    targets: DataFrame,
    prefix4_cap: int = PREFIX4_CAP,
    prefix6_cap: int = PREFIX6_CAP,
    rows_per_cell: int = ROWS_PER_CELL,
    counted: DataFrame | None = None,
    carried: Carried | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Exact name, or prefix 4 within its cap, or prefix 6 within its cap.

    The caps count the rows of ``counted``, by default the targets themselves. The
    columns of ``carried``, a table by S1 id and one by candidate id, come with each pair.
    """
    name = _key(0, F.col("name_norm"))
    exceptions = rule_exceptions(targets if counted is None else counted, prefix4_cap, prefix6_cap)
    ruled = admitting_rule(targets, stage(exceptions, "rule-exceptions"))
    admitted = [name, *[F.when(F.col("_rule") == n, _prefix_key(n)) for n in (4, 6)]]
    keys = [name, _prefix_key(4), _prefix_key(6)]
    return _join_by_rules(s1, ruled, keys, admitted, rows_per_cell, carried, pairs_per_task)


# --- list form ---------------------------------------------------------------------------------


def _grouped(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each S1 id with the set ``_ids`` of its candidates.

    Ids and pairs are grouped together, which needs one shuffle where a join
    after the grouping would need two.
    """
    ids = s1.select(F.col("entity_id").alias(S1_ID), F.lit(None).cast("string").alias(CANDIDATE_ID))
    return (
        ids.withColumn("_known", F.lit(True))
        .unionByName(pairs.withColumn("_known", F.lit(False)))
        .groupBy(S1_ID)
        .agg(F.bool_or("_known").alias("_known"), F.collect_set(CANDIDATE_ID).alias("_ids"))
        .filter("_known")
    )


def candidate_lists(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per S1 id with its sorted candidates; ids without any keep an empty list.

    Pairs that :func:`block_index` gives as lists of the same S1 are written as they are.
    """
    if isinstance(pairs.schema[CANDIDATE_ID].dataType, T.ArrayType):
        ids = F.col(CANDIDATE_ID)
    else:
        pairs, ids = _grouped(s1, pairs), F.sort_array("_ids")
    return pairs.select(S1_ID, F.array_join(ids, ",").alias("candidate_entity_ids"))
