"""Exact deduplication of a stream of files with disk-backed keyed state.

Arriving files go through a streaming aggregation keyed by the digest of the
text. Its state, kept in RocksDB and in the checkpoint without expiry, holds for
each digest the identifier that stays, the place of its content (file and row)
and the number of rows. Copies are combined before the shuffle, so a group that
holds a third of all rows brings each task one row.

A digest seen again is a hit. The full bytes of all hits are compared before
anything is dropped: equal digests are told apart by their least and greatest
text, again combined before the shuffle. Should two texts share a digest, the
rows of that digest are grouped by their whole texts instead.

Defined cases: a null text is the empty text. Of equal texts the row with the
largest id stays; if several have it, the one last by file and row; a row with a
null id stays only if all have none. Rows are told apart by file and row, so
repeated rows are copies like others. Without files the result is empty; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwell.llm.common import text_of
from linkwell.session import scratch_path

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Files are not allocated ahead, which for many small stores takes more room than their content.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 1_000
#: Spark ignores files this much older than the newest one seen; a thousand years, so none is.
MAX_FILE_AGE = "365000d"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(frame: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Id, place, digest and text of each row of a file source."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return frame.select("doc_id", place.alias("place"), text_of().alias("text")).withColumn("digest", digest(F.col("text")))


def update_state(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType,
    checkpoint: str,
    out: str,
    files_per_batch: int = FILES_PER_BATCH,
    digest: Callable[[Column], Column] = sha256,
) -> None:
    """Take in the files of ``pattern`` that ``checkpoint`` hasn't seen, and write the changed keys to ``out``.

    Runs a streaming query until no new file is left. Each batch writes a folder
    of its own, so a batch that is run again after a failure replaces its rows.
    """
    session = spark.newSession()
    for key, value in STATE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    options = {"maxFilesPerTrigger": files_per_batch, "maxFileAge": MAX_FILE_AGE}
    arriving = session.readStream.schema(schema).options(**options).parquet(pattern)
    keyed = (
        _rows(arriving, digest)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "place")).alias("kept_row"), F.count(F.lit(1)).alias("rows"))
    )

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    keyed.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(
        keep
    ).start().awaitTermination()


KEY_STATE = "digest string, kept_row struct<doc_id:{id}, place:struct<file:string, row:bigint>>, rows bigint, batch int"


def state(spark: SparkSession, out: str, id_type: str = "bigint") -> DataFrame:
    """The last state of each key from the changes of all batches."""
    changes = spark.read.schema(KEY_STATE.format(id=id_type)).parquet(out)
    last = F.max(F.struct("batch", "kept_row", "rows")).alias("last")
    return changes.groupBy("digest").agg(last).select("digest", "last.kept_row", "last.rows")


def deduplicate(
    spark: SparkSession,
    path: str,
    files_per_batch: int = FILES_PER_BATCH,
    digest: Callable[[Column], Column] = sha256,
    checkpoint: str | None = None,
) -> DataFrame:
    """A row for each row of the Parquet files at ``path``: id, the id that stays, group size, ``kept``, ``digest``.

    Runs a streaming query to its end. ``checkpoint`` keeps the state for files
    that come later; by default each call has a state of its own.
    """
    home, path = checkpoint or scratch_path(spark, "exact"), path.rstrip("/")
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # a pattern may match a folder or one file
    update_state(spark, pattern, schema, f"{home}/checkpoint", f"{home}/keys", files_per_batch, digest)
    id_type = schema["doc_id"].dataType.simpleString()
    if not spark.read.parquet(path).take(1):
        keys = spark.createDataFrame([], KEY_STATE.format(id=id_type)).drop("batch")
    else:
        keys = state(spark, f"{home}/keys", id_type)
    rows = _rows(spark.read.parquet(path), digest)

    # The full bytes of the hits: one text under a digest if the least and the greatest are the same bytes.
    repeated = keys.filter("rows > 1").select("digest")
    hits = rows.select("digest", "text").join(repeated, "digest", "left_semi")
    spread = hits.groupBy("digest").agg((F.min("text") != F.max("text")).alias("mixed")).filter("mixed").select("digest")
    slim = rows.select("doc_id", "place", "digest")
    clean = slim.join(spread, "digest", "left_anti").join(keys, "digest")
    same_text = rows.join(spread, "digest", "left_semi").select("doc_id", "place", "digest", sha256(F.col("text")).alias("_t"), "text")
    regrouped = same_text.groupBy("digest", "_t", "text").agg(
        F.max(F.struct("doc_id", "place")).alias("kept_row"), F.count(F.lit(1)).alias("rows")
    )
    mixed = same_text.join(regrouped, ["digest", "_t", "text"]).select(*clean.columns)
    return clean.unionByName(mixed).select(
        "doc_id",
        F.col("kept_row.doc_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        F.struct("doc_id", "place").eqNullSafe(F.col("kept_row")).alias("kept"),
        "digest",
    )
