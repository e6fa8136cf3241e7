"""TSV, Parquet and JSON files of entities, pairs, lists and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from linkwell.schema import ENTITY_COLUMNS, require_columns

# The TSV format.
TSV_OPTIONS = {"header": "true", "sep": "\t", "quote": '"', "escape": '"'}


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """All-string TSV with a header. Only blank fields become null, so ``NA`` stays text.

    With a schema the header must name its columns, in order. Records are
    single lines, so large files are read in splits.
    """
    df = spark.read.options(**TSV_OPTIONS, multiLine="false", inferSchema="false").csv(path)
    if schema is not None and df.columns != schema.fieldNames():
        raise ValueError(f"expected columns {schema.fieldNames()}, found {df.columns}")
    return df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, through the file system that would hold it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def unreadable_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines of a TSV that don't have as many fields as the schema, as column ``line``."""
    whole = T.StructType([*schema, T.StructField("_line", T.StringType())])
    read = spark.read.schema(whole).options(**TSV_OPTIONS, multiLine="false", columnPruning="false", columnNameOfCorruptRecord="_line").csv(path)
    # the reader refuses to be asked for broken lines alone, so nothing of the first field goes with them
    return read.filter("_line is not null").selectExpr(f"concat(_line, left(coalesce({schema.fieldNames()[0]}, ''), 0)) as line")


def read_entities(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Entity TSV with any column order; extra columns are kept."""
    return require_columns(read_tsv(spark, path), ENTITY_COLUMNS)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_tsv(
    df: DataFrame, path: str, sort_by: str | None = None, single_file: bool = False, mode: str = "overwrite"
) -> None:
    """TSV folder with headers; an empty list is a blank field.

    ``sort_by`` range-partitions by that column, so part files are in order.
    ``single_file`` sends all rows to one task: for small results only.
    """
    if sort_by:
        df = df.orderBy(sort_by)
    if single_file:
        df = df.coalesce(1)
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(**TSV_OPTIONS, emptyValue="", nullValue="", **keep_blanks).csv(path)


def write_parquet(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Snappy Parquet; the number of files follows the data unless ``files`` sets it."""
    out = df if files is None else df.repartition(files)
    out.write.mode(mode).option("compression", "snappy").parquet(path)


def write_threshold(threshold: DataFrame, path: str) -> None:
    """The one-row threshold record as JSON."""
    threshold.write.mode("overwrite").json(path)


def read_threshold(spark: SparkSession, path: str) -> DataFrame:
    names = ["threshold", "precision", "recall", "f05", "entity_macro_f05"]
    return spark.read.schema(T.StructType([T.StructField(n, T.DoubleType()) for n in names])).json(path)
