"""Queries of the operators that stand beside the linkage pipeline: similarity, temporal and running joins and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwell.functions import alignment
from linkwell.operators import blocking, counted, reports, running, setjoin, sketches, temporal
from linkwell.plans.index_pipeline import resolve_index
from linkwell.plans.registry import THRESHOLD, PREFIX4_CAP, PREFIX6_CAP, capped_pairs, query, records, scored, sides
from linkwell.schema import CANDIDATE_ID, S1_ID
from linkwell.session import dealt, scratch_path, stage, tasks_for
from linkwell.sources import files
from linkwell.streaming import events as streams
from linkwell.streaming.linkage import link_files

SIMILAR, LOOSE = 80, 50


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/{name}.parquet")


# --- set similarity ----------------------------------------------------------------------------


@query
def similar_name_classes(spark, sf_dir):
    """Classes of names with equal words whose words agree by half or more."""
    return setjoin.class_links(*sides(spark, sf_dir), percent=LOOSE)


@query
def block_similar_names(spark, sf_dir):
    return setjoin.block_similar(*sides(spark, sf_dir), percent=SIMILAR)


@query
def block_similar_addresses(spark, sf_dir):
    return setjoin.block_similar(*sides(spark, sf_dir), percent=60, column="address_norm")


# --- arriving records --------------------------------------------------------------------------


@query
def link_incrementally(spark, sf_dir):
    """Records that arrive in files, two at a time, and meet those of earlier files by exact name or by country and prefix."""
    raw, out, state = (scratch_path(spark, n) for n in ("arriving", "pairs", "state"))
    arriving = records(spark, sf_dir, "ascii").select("entity_id", "name_norm", "country_norm", "source")
    arriving.repartition(4, "entity_id").write.parquet(raw)
    link_files(spark, raw, out, state, arriving.schema, files_per_batch=2).awaitTermination()
    return spark.read.parquet(out)


# --- along time --------------------------------------------------------------------------------


@query
def last_order_of_event(spark, sf_dir):
    """For each event the last earlier order of the customer of its number, if it isn't too old."""
    orders = _table(spark, sf_dir, "orders")
    return temporal.as_of_join(
        _table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("o_custkey"), "ts"), orders,
        by=["o_custkey"], left_time="ts", right_time="o_orderdate", take=["o_orderkey", "o_totalprice"], ties=["o_orderkey"],
        tolerance=F.expr("INTERVAL '8250' DAY"),
    ).select("event_id", "o_orderkey", "o_totalprice")


@query
def last_click_of_purchase(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("clicked"), F.col("event_id").alias("click_id"))
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return temporal.as_of_join(
        purchases, clicks, by=["user_id"], left_time="ts", right_time="clicked", take=["click_id"], ties=["click_id"],
        tolerance=F.expr("INTERVAL '36' HOUR"),
    ).select("event_id", "click_id")


@query
def purchases_during_errors(spark, sf_dir):
    """Purchases within five minutes of an error that lasts as many minutes as its value says."""
    events = _table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    errors = events.filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), micros.alias("e_from"), (micros + F.floor(F.col("value") * 60_000_000)).alias("e_to")
    )
    bought = events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), (micros - 300_000_000).alias("p_from"), (micros + 300_000_000).alias("p_to")
    )
    met = temporal.overlap_join(errors, bought, ("e_from", "e_to"), ("p_from", "p_to"), "error_id", "purchase_id", width=1 << 28)
    return met.select("error_id", "purchase_id")


@query
def orders_open_together(spark, sf_dir):
    """Pairs of an urgent and another order of a customer that are open at the same time, until their last item is shipped."""
    shipped = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    spans = _table(spark, sf_dir, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", "o_orderkey", "o_orderpriority", day("o_orderdate").alias("opened"), (day("last") + 1).alias("closed")
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    side = lambda df, p: df.select("o_custkey", *[F.col(c).alias(f"{p}_{c}") for c in ("o_orderkey", "opened", "closed")])
    met = temporal.overlap_join(
        side(spans.filter(urgent), "u"), side(spans.filter(~urgent), "x"), ("u_opened", "u_closed"), ("x_opened", "x_closed"),
        "u_o_orderkey", "x_o_orderkey", by=["o_custkey"], width=16,
    )
    return met.select("o_custkey", F.col("u_o_orderkey").alias("urgent_key"), F.col("x_o_orderkey").alias("other_key"))


def _arriving(spark, sf_dir: str, parts: int = 3) -> tuple[str, DataFrame]:
    """Events in files by time, neighbouring files overlapping, and at the end one of each type that closes what is open."""
    raw = scratch_path(spark, "events")
    events = _table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp"), "user_id", "event_type", "value")
    hour = F.date_trunc("hour", "ts")
    ends = events.agg(F.min(hour).alias("lo"), F.max(hour).alias("hi")).first()
    late = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0  # a fifth comes up to a day late
    seconds = F.unix_timestamp("ts") + F.when(late, 80_000).otherwise(0)
    part = F.floor((seconds - F.unix_timestamp(F.lit(ends["lo"]))) * parts / ((ends["hi"] - ends["lo"]).total_seconds() + 1e5))
    dealt = stage(events.withColumn("_part", part), "dealt")
    for i in range(parts):
        dealt.filter(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(raw)
    closing = events.groupBy("event_type").agg((F.max("ts") + F.expr("INTERVAL 9 DAY")).alias("ts"))
    nobody = lambda c, t: F.lit(None).cast(t).alias(c)
    apart = (-1 - F.pmod(F.xxhash64("event_type"), F.lit(1 << 40))).alias("user_id")  # keys of their own, which a join doesn't filter out
    closing.select(nobody("event_id", "long"), "ts", apart, "event_type", nobody("value", "double")).coalesce(1).write.mode(
        "append").parquet(raw)
    return raw, events


@query
def user_sessions(spark, sf_dir):
    raw, events = _arriving(spark, sf_dir)
    out, state = scratch_path(spark, "sessions"), scratch_path(spark, "state")
    streams.session_files(
        spark, raw, out, state, events.schema, ["user_id"], "ts", "12 hours", "2 days", "value", files_per_batch=1
    ).awaitTermination()
    return spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "end")})


@query
def clicks_before_purchases(spark, sf_dir):
    """Each click with the user's purchases within six hours, or none, from one stream of events."""
    raw, events = _arriving(spark, sf_dir)
    out, state = scratch_path(spark, "followed"), scratch_path(spark, "state")
    side = lambda kind, names: streams.read_events(spark, raw, events.schema, "ts", "2 days", 1).filter(
        F.col("event_type") == kind).select("user_id", *[F.col(c).alias(n) for c, n in names.items()])
    clicks, bought = side("click", {"event_id": "click_id", "ts": "clicked"}), side("purchase", {"event_id": "purchase_id", "ts": "bought"})
    met = streams.followed_by(clicks, bought, ["user_id"], "clicked", "bought", "6 HOURS")
    streams.append(met.select("click_id", "purchase_id"), out, state).awaitTermination()
    return spark.read.parquet(out)


# --- running sums ------------------------------------------------------------------------------


@query
def order_ledger(spark, sf_dir):
    """All orders by date and key: number, cents so far, and the key of the order before."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return running.running(
        orders, ["o_orderdate", "o_orderkey"], number="position", sums={"cents_so_far": "cents"}, lags={"key_before": "o_orderkey"}
    ).select("o_orderkey", "position", "cents_so_far", "key_before")


@query
def event_ledger(spark, sf_dir):
    """The same within each type of event, of which there are few and each is hot."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return running.running(
        events, ["ts", "event_id"], by=["event_type"], number="position", sums={"cents_so_far": "cents"}, lags={"before": "ts"}
    ).select("event_id", "event_type", "position", "cents_so_far", "before")


# --- blocking rules on counted profiles --------------------------------------------------------


@query
def exact_name_profiles(spark, sf_dir):
    return counted.counted_pairs(blocking.block_exact_name, *sides(spark, sf_dir))


@query
def prefix4_profiles(spark, sf_dir):
    return counted.counted_pairs(lambda a, b: blocking.block_prefix(a, b, 4), *sides(spark, sf_dir, "unicode"))


@query
def token_profiles(spark, sf_dir):
    return counted.counted_pairs(blocking.block_token, *sides(spark, sf_dir, "unicode"))


@query
def token_profile_totals(spark, sf_dir):
    """Totals of the pairs of :func:`token_profiles`, which are counted, not built."""
    return counted.token_totals(*sides(spark, sf_dir, "unicode"))


@query
def resolve_by_index(spark, sf_dir):
    """Match lists from index candidates under a fixed score, the mean of four features."""
    parts = ["name_jaccard", "address_jaccard", "numeric_overlap", "country_match"]
    mean = sum((F.col(p).cast("double") for p in parts[1:]), F.col(parts[0])) / 4
    return resolve_index(*sides(spark, sf_dir, "unicode"), lambda f: f.withColumn("match_probability", mean), THRESHOLD)


@query
def match_alignments(spark, sf_dir):
    """How far the names of accepted matches agree, from the blocks of their best alignment; each pair of names once."""
    alignment.register(spark)
    names = lambda df, key, c: df.select(F.col("entity_id").alias(key), F.col("name_norm").alias(c))
    ours, theirs = sides(spark, sf_dir)
    good = scored(spark, sf_dir).filter(F.col("match_probability") >= THRESHOLD)
    met = good.join(names(ours, S1_ID, "a"), S1_ID).join(names(theirs, CANDIDATE_ID, "b"), CANDIDATE_ID).select("a", "b").distinct()
    met = stage(met.select(F.md5(F.concat_ws("\t", "a", "b")).alias("id"), "a", "b"), "matched-names")
    met.createOrReplaceTempView("matched_names")
    blocks = spark.sql(f"SELECT id, sum(length) AS same, max(window) AS window FROM {alignment.NAME}(TABLE(matched_names)) GROUP BY id")
    whole = F.least(F.char_length("a"), F.char_length("b")) + F.col("window")
    empty = F.when((F.col("a") == "") & (F.col("b") == ""), 1.0).otherwise(0.0)
    return met.join(blocks, "id", "left").select("a", "b", F.coalesce(2.0 * F.col("same") / whole, empty).alias("score"))


# --- reports -----------------------------------------------------------------------------------


@query
def metrics_by_sets(spark, sf_dir):
    """Scored pairs by source, country and tenth of the score, and by coarser sets of these."""
    ours, theirs = sides(spark, sf_dir)
    tasks = tasks_for(scored(spark, sf_dir))
    pairs = scored(spark, sf_dir).select(S1_ID, CANDIDATE_ID, "label", F.floor(F.col("match_probability") * 10).cast("int").alias("tenth"))
    pairs = dealt(pairs, tasks, CANDIDATE_ID).join(theirs.select(F.col("entity_id").alias(CANDIDATE_ID), "source"), CANDIDATE_ID)
    pairs = dealt(pairs, tasks, S1_ID).join(ours.select(F.col("entity_id").alias(S1_ID), "country"), S1_ID)
    sets = [["source", "country", "tenth"], ["source", "country"], ["source", "tenth"], ["country"], ["source"], []]
    return reports.counts_by_sets(pairs, sets, {"n_true": F.col("label") == 1})


@query
def candidate_diff(spark, sf_dir):
    """What tighter caps change: pairs of both runs with their status."""
    pairs = capped_pairs(spark, sf_dir)
    return reports.multiset_diff(pairs, blocking.block_capped(*sides(spark, sf_dir), PREFIX4_CAP, PREFIX6_CAP), tasks_for(pairs))


@query
def key_surplus(spark, sf_dir):
    """Block keys of targets beyond those of S1, copies counted."""
    ours, theirs = (df.select("country_norm", "name_prefix4") for df in sides(spark, sf_dir))
    return reports.surplus(reports.multiset_diff(ours, theirs))


@query
def decision_changes(spark, sf_dir):
    """Decisions at one threshold against those at another, on different subsets of the pairs."""
    decided = lambda least, limit: scored(spark, sf_dir).filter(F.col("match_probability") >= least).select(
        S1_ID, CANDIDATE_ID, (F.col("match_probability") >= limit).alias("match"))
    return reports.compare_runs(decided(0.2, 0.6), decided(0.3, 0.7), [S1_ID, CANDIDATE_ID], ["match"])


@query
def event_sketches(spark, sf_dir):
    """Merged daily sketches of each type of event, and whether they keep their bounds."""
    events = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = stage(sketches.sketch(events, ["day", "event_type"], "user_id", "value"), "sketches")
    merged = sketches.merge(daily, ["event_type"]).select(
        "event_type", "n", sketches.n_distinct(F.col("values_state")).alias("users"), sketches.quantile(F.col("ranks_state"), 0.5).alias("median")
    )
    counters = sketches.merge_counters(stage(sketches.counters(events, ["day", "event_type"], "user_id"), "counters"), ["event_type"])
    by_user = events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("truth"))
    seen = sketches.frequencies(counters, by_user, ["event_type"], "user_id").join(by_user, ["event_type", "user_id"])
    more = F.col("estimate") - F.col("truth")
    counts = seen.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_users"), F.min(more).alias("least"), F.avg(more).alias("over"))
    ranks = events.join(merged, "event_type").groupBy("event_type").agg(F.avg((F.col("value") <= F.col("median")).cast("double")).alias("rank"))
    every = merged.join(counts, "event_type").join(ranks, "event_type")
    return every.select(
        "event_type", "n", "n_users",
        (F.abs(F.col("users") - F.col("n_users")) <= 0.05 * F.col("n_users")).alias("users_in_bounds"),
        (F.abs(F.col("rank") - 0.5) <= 0.03).alias("median_in_bounds"),
        ((F.col("least") >= 0) & (F.col("over") <= F.exp(F.lit(1.0)) / sketches.WIDTH * F.col("n"))).alias("counts_in_bounds"),
    )
