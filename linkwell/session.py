"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="linkwell-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/linkwell/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def scratch_mark() -> int:
    """A point in time, for :func:`scratch_since`."""
    return len(_scratch)


def scratch_since(mark: int) -> list[str]:
    """Scratch paths made since then."""
    return _scratch[mark:]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders, through the file system that holds them. Whatever reads them must have run."""
    jvm = spark.sparkContext._jvm
    for name in set(paths) & set(_scratch):
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage_counted(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """:func:`stage`, and the number of rows, counted while they are written."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return staged, seen.get["rows"]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and, unlike a cached or
    checkpointed DataFrame, keeps column pruning, filter pushdown and sizes for
    the planner.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(staged: DataFrame, rows: int = 1_000_000) -> int:
    """Into how many tasks to deal a staged table, so that each has about ``rows`` of its rows; counted from its files' footers."""
    return max(1, math.ceil(staged.count() / rows))


def dealt(df: DataFrame, tasks: int, *by: str) -> DataFrame:
    """Deal rows out by columns; a grouping by these then needs no more memory in a task for more rows. One task: left as is."""
    return df.repartition(tasks, *by) if tasks > 1 else df


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
