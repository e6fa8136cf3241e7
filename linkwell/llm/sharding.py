"""Sharding by jump consistent hashing: a stable key and the shard count alone name the shard.

No table of ring positions is kept. When shards are appended, a row either stays
or moves into an appended shard, and only the necessary share moves.

Defined cases: a null text has no bytes and counts one; a null id is the key of
the empty string's digest; rows of one id share a shard. Rows that agree in id,
size and checksum are interchangeable and take consecutive slots. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linkwell.llm.common import text_of
from linkwell.session import stage_counted

# Fixed value: the multiplier of the published generator.
STEP = np.uint64(2862933555777941757)
ROWS_PER_CELL = 50_000
COPIES_PER_ROW = 100_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key. About ``ln(shards)`` rounds over the whole array."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64, copy=True)
    at = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(open_):
            state[open_] = state[open_] * STEP + np.uint64(1)
            draw = (state[open_] >> np.uint64(33)).astype(np.float64) + 1.0
            jump = ((at[open_] + 1).astype(np.float64) * (float(1 << 31) / draw)).astype(np.int64)
            inside = jump < shards
            at[open_[inside]] = jump[inside]
            open_ = open_[inside]
    return at.astype(np.int32)


def key_of(column: Column) -> Column:
    """A well-mixed 64-bit key: the first half of the MD5 digest of the value as text."""
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
    high, low = (F.conv(F.substring(digest, i, 8), 16, 10).cast("long") for i in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf(T.IntegerType())
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy().view(np.uint64), shards))

    return shard(key)


def assign_slots(rows: DataFrame, shard: str, key: str, ties: list[str], rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard in the order of the unsigned ``key`` and ``ties``.

    Runs a job: the rows are staged, equal ones merged with their number. Upper
    bits of the keys, as many as the rows ask for, cut each shard into cells of
    about ``rows_per_cell`` distinct rows. Ranks run within cells, after the
    rows of earlier cells; only counts of cells are ranked across a shard.
    """
    columns = [shard, key, *ties]
    merged, n = stage_counted(rows.groupBy(*columns, *[c for c in rows.columns if c not in columns]).agg(
        F.count(F.lit(1)).alias("_copies")), "slots")
    bits = max(1, int(np.ceil(np.log2(max(2.0, n / rows_per_cell)))))
    cell = F.shiftrightunsigned(F.col(key), 64 - bits).alias("_cell")
    counted = merged.select("*", cell)
    before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy(shard, "_cell")
        .agg(F.sum("_copies").alias("_rows"))
        .select(shard, "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy(shard, "_cell")
        .orderBy(F.shiftrightunsigned(F.col(key), 1), key, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_start") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    chunk = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(COPIES_PER_ROW)))
    last = F.least(F.col("_chunk") + COPIES_PER_ROW, F.col("_copies")) - 1
    return (
        counted.join(starts, [shard, "_cell"])
        .withColumn("_first", first)
        .withColumn("_chunk", chunk)
        .withColumn("_copy", F.explode(F.sequence(F.col("_chunk"), last)))
        .withColumn("slot", F.col("_first") + F.col("_copy"))
        .drop("_cell", "_copies", "_start", "_first", "_chunk", "_copy")
    )


def shard_documents(docs: DataFrame, shards: int = 8, grown: int | None = None) -> DataFrame:
    """Shard, slot and the shard after growth for each row of ``docs``; texts are read but not shuffled."""
    text = text_of()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key_of(F.col("doc_id")).alias("_key"),
    )
    rows = rows.withColumns({
        "shard": shard_of(F.col("_key"), shards),
        "grown_shard": shard_of(F.col("_key"), grown or shards + 1),
    })
    slotted = assign_slots(rows, "shard", "_key", ["doc_id", "size", "text_crc32"])
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
