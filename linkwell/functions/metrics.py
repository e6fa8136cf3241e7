"""Precision, recall and F-beta as Column expressions, 0.0 where undefined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _share(part: Column, rest: Column) -> Column:
    total = part + rest
    return F.when(total > 0, part.cast("double") / total).otherwise(F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return _share(tp, fp)


def recall(tp: Column, fn: Column) -> Column:
    return _share(tp, fn)


def f_from_rates(p: Column, r: Column, beta: float = 0.5) -> Column:
    b2 = float(beta) ** 2
    return F.when((p > 0) | (r > 0), (F.lit(1.0 + b2) * p * r) / (F.lit(b2) * p + r)).otherwise(F.lit(0.0))


def fbeta(tp: Column, fp: Column, fn: Column, beta: float = 0.5) -> Column:
    return f_from_rates(precision(tp, fp), recall(tp, fn), beta)


def f05(tp: Column, fp: Column, fn: Column) -> Column:
    return fbeta(tp, fp, fn, 0.5)
