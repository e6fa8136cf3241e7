"""Reports over groups of groups, and comparisons of two runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwell.schema import S1_ID
from linkwell.session import dealt


def counts_by_sets(
    rows: DataFrame, sets: Sequence[Sequence[str]], counted: Mapping[str, Column], distinct: str = S1_ID, name: str = "n_ids"
) -> DataFrame:
    """For each of several grouping sets: the number of ``rows``, of those that meet ``counted`` conditions, and of ``distinct`` values.

    ``grouping`` tells sets and null values apart: bit by bit, the first column highest,
    1 where a column is not part of the set. Nulls of ``distinct`` are not counted as a value.

    Rows are combined by all columns and the distinct value first, before they are
    copied for the sets, and once more by set and value. So the input is read and
    shuffled once, no count of distinct values is kept in memory, and no group, however
    large, is more than partial counts for any task.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    fine = rows.groupBy(*columns, distinct).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(f"_{n}") for n, c in counted.items()]
    )
    sums = lambda: [F.sum(f"_{n}").alias(f"_{n}") for n in ("rows", *counted)]
    copied = fine.groupingSets([[*s, distinct] for s in sets], *columns, distinct).agg(
        F.shiftright(F.grouping_id(), 1).cast("int").alias("grouping"), *sums()
    )
    return copied.groupBy(*columns, "grouping").agg(
        F.sum("_rows").alias("n_rows"), *[F.sum(f"_{n}").alias(n) for n in counted], F.count(distinct).alias(name)
    )


def multiset_diff(old: DataFrame, new: DataFrame, tasks: int = 1) -> DataFrame:
    """Distinct rows of two tables of the same columns, how often each has them (``n_old``, ``n_new``), and a ``status``.

    ``same`` and as often, ``added`` or ``dropped`` (only in one), ``more`` or ``fewer`` copies.
    Nulls are equal to each other. One grouping of both tables, combined before its
    shuffle; rows of ``EXCEPT ALL`` are those with a surplus, :func:`surplus` lists them.
    Very many rows that hardly repeat are dealt to ``tasks`` before they are grouped.
    """
    one, none = F.lit(1), F.lit(0)
    both = old.select("*", one.alias("_o"), none.alias("_n")).unionByName(new.select("*", none.alias("_o"), one.alias("_n")))
    counted = dealt(both, tasks, *old.columns).groupBy(*old.columns).agg(F.sum("_o").alias("n_old"), F.sum("_n").alias("n_new"))
    a, b = F.col("n_old"), F.col("n_new")
    status = F.when(a == b, "same").when(a == 0, "added").when(b == 0, "dropped").when(a < b, "more").otherwise("fewer")
    return counted.withColumn("status", status)


def surplus(diff: DataFrame, of: str = "n_new", over: str = "n_old") -> DataFrame:
    """Rows of ``EXCEPT ALL``: each as often as one table has it more than the other."""
    columns = [c for c in diff.columns if c not in ("n_old", "n_new", "status")]
    more = diff.filter(F.col(of) > F.col(over))
    return more.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(of) - F.col(over)))).select(columns)


def compare_runs(old: DataFrame, new: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A full outer comparison by ``key``, which must be unique on each side: status and ``old`` and ``new`` values.

    ``added``, ``dropped``, ``changed`` (any value differs, null being a value) or ``same``.
    One grouping in place of two anti joins and a join. A key that repeats on a side is
    ``repeated``, whatever its values, and shows the greatest.
    """
    held = F.struct(*values)
    side = lambda df, o: df.select(*key, F.when(F.lit(o), held).alias("_old"), F.when(F.lit(not o), held).alias("_new"), F.lit(o).alias("_is_old"))
    met = side(old, True).unionByName(side(new, False)).groupBy(*key).agg(
        F.max("_old").alias("old"), F.max("_new").alias("new"), F.count_if("_is_old").alias("_n_old"), F.count_if(~F.col("_is_old")).alias("_n_new")
    )
    a, b = F.col("_n_old"), F.col("_n_new")
    same = F.lit(True)
    for v in values:
        same &= F.col(f"old.{v}").eqNullSafe(F.col(f"new.{v}"))
    status = F.when((a > 1) | (b > 1), "repeated").when(a == 0, "added").when(b == 0, "dropped").when(same, "same").otherwise("changed")
    return met.select(*key, status.alias("status"), *[F.col(f"{s}.{v}").alias(f"{s}_{v}") for v in values for s in ("old", "new")])
