"""Bounded-memory normalization of TSV files, chunk by chunk, appended to one Parquet table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkwell.operators.normalize import normalize_entities
from linkwell.schema import ENTITY
from linkwell.sources.files import TSV_OPTIONS


def normalize_files(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    dialect: str = "unicode",
    files_per_chunk: int = 1000,
) -> StreamingQuery:
    """Normalize every TSV file not yet processed and append the rows to ``output_path``.

    Each chunk commits on its own, so a restarted run goes on where the last one
    stopped and no file is taken twice. The header must name the four entity
    columns in order. Returns the query; it ends by itself once all files are
    taken.
    """
    rows = (
        spark.readStream.schema(ENTITY)
        .options(**TSV_OPTIONS, enforceSchema="false", maxFilesPerTrigger=str(files_per_chunk))
        .csv(input_path)
    )
    return (
        normalize_entities(rows, dialect)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .option("path", output_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
