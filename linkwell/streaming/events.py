"""Sessions and interval joins of events that arrive in files, out of order up to a delay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def sessions(events: DataFrame, by: Sequence[str], time: str, gap: str, value: str) -> DataFrame:
    """Sessions of each key: events that follow each other by less than ``gap``. For batches and, after a watermark, streams.

    Columns: ``by``, ``first`` (time), ``end`` (last time plus the gap), ``n`` and the
    ``largest`` value. A null key is a key; rows of a null time are in no session.
    """
    found = events.filter(F.col(time).isNotNull()).groupBy(F.session_window(time, gap).alias("w"), *by)
    return found.agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("largest")).select(
        *by, F.col("w.start").alias("first"), F.col("w.end").alias("end"), "n", "largest"
    )


def read_events(spark: SparkSession, path: str, schema: StructType, time: str, delay: str, files_per_batch: int) -> DataFrame:
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withWatermark(time, delay)


def append(rows: DataFrame, output_path: str, checkpoint_path: str) -> StreamingQuery:
    """Write what is final, take all files there are, and stop."""
    return (
        rows.writeStream.format("parquet").option("checkpointLocation", checkpoint_path).option("path", output_path)
        .outputMode("append").trigger(availableNow=True).start()
    )


def session_files(
    spark: SparkSession, input_path: str, output_path: str, checkpoint_path: str, schema: StructType, by: Sequence[str],
    time: str, gap: str, delay: str, value: str, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append each session once, as soon as the watermark says that it is over.

    However events are cut into files, if none comes more than ``delay`` after later ones
    of an earlier batch, the sessions are those of :func:`sessions` over all events. An
    event that comes later still, behind the watermark, is left out of all sessions
    and counted: :func:`late_rows`. Sessions not over yet stay in the state; an event
    later than all by ``gap`` and ``delay``, of a key of its own, closes them.
    """
    arriving = read_events(spark, input_path, schema, time, delay, files_per_batch)
    return append(sessions(arriving, by, time, gap, value), output_path, checkpoint_path)


def late_rows(query: StreamingQuery) -> int:
    """Rows behind the watermark that a finished query left out."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows held in the state after each batch."""
    return [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]


def followed_by(
    first: DataFrame, then: DataFrame, by: Sequence[str], first_time: str, then_time: str, within: str
) -> DataFrame:
    """Rows of ``first``, each with all rows of ``then`` of the same key at its time or up to ``within`` later, or with nulls.

    For batches, and for streams with watermarks on both times. The condition on time tells
    a stream how long either side can still match, so both states are evicted by the
    watermark, and rows without a match come out then. Columns of ``then`` but ``by``
    must have other names than those of ``first``; nulls in keys or times match nothing.
    """
    other = then.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], *[c for c in then.columns if c not in by])
    met = F.col(then_time) >= F.col(first_time)
    met &= F.col(then_time) <= F.col(first_time) + F.expr(f"INTERVAL {within}")
    for i, c in enumerate(by):
        met &= F.col(c) == F.col(f"_by_{i}")
    return first.join(other, met, "left_outer").drop(*[f"_by_{i}" for i in range(len(by))])
