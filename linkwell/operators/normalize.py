"""Normalization of whole entity tables and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwell.functions import text
from linkwell.schema import ENTITY_COLUMNS, require_columns


def normalize_entities(df: DataFrame, dialect: str = "unicode", keep_extra: bool | None = None) -> DataFrame:
    """Add the three normalized fields and the two blocking prefixes.

    A narrow projection: no shuffle, any number of rows. The ``ascii`` dialect
    keeps the four entity columns only, ``unicode`` keeps extra columns too,
    unless ``keep_extra`` says otherwise.
    """
    require_columns(df, ENTITY_COLUMNS)
    if keep_extra is None:
        keep_extra = dialect == "unicode"
    typed = {c: F.col(c).cast("string") for c in ENTITY_COLUMNS}
    extra = [F.col(c) for c in df.columns if c not in typed] if keep_extra else []
    return (
        df.select(*[c.alias(n) for n, c in typed.items()], *extra)
        .withColumns(
            {
                "name_norm": text.normalize_name(F.col("business_name"), dialect),
                "address_norm": text.normalize_address(F.col("business_address"), dialect),
                "country_norm": text.normalize_country(F.col("country"), dialect),
            }
        )
        .withColumns({f"name_prefix{n}": text.name_prefix(F.col("name_norm"), n) for n in (4, 6)})
    )


def quality_stats(df: DataFrame) -> DataFrame:
    """Row count and empty-field counts in one pass."""
    empty = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) == "")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        empty("name_norm").alias("empty_names"),
        empty("address_norm").alias("empty_addresses"),
        empty("country_norm").alias("empty_countries"),
    )


def repeated_ids(df: DataFrame) -> DataFrame:
    """Entity ids that more than one row has, with the number of rows."""
    return df.groupBy("entity_id").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` records by id, raw next to normalized."""
    columns = [
        "entity_id", "business_name", "name_norm", "business_address", "address_norm", "country", "country_norm",
    ]
    return df.select(*columns).orderBy("entity_id").limit(n)


def source_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per source, one output row for every table given, empty ones included."""
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(s).alias("source"), "row_count")
              for s, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)
