"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def columns_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of each batch, texts as Python lists and the rest as Arrow arrays."""
    for batch in batches:
        yield tuple(
            batch.column(n).to_pylist() if pa.types.is_string(batch.column(n).type) else batch.column(n) for n in names
        )


def batches_of(rows: Iterator[tuple], schema: pa.Schema, most: int = 5_000) -> Iterator[pa.RecordBatch]:
    """Rows of an iterator as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
