"""A table function that shows where two texts agree in their best alignment."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeResult, OrderingColumn, PartitioningColumn

NAME = "align_texts"


def _made() -> type:
    """Made in a function, so that workers get it by value."""

    class Align:
        """Blocks of the best window of the longer text, one pair of texts at a time."""

        @staticmethod
        def analyze(pairs) -> AnalyzeResult:
            names = [f.name for f in pairs.dataType.fields]
            for needed in ("id", "a", "b"):
                if needed not in names:
                    raise ValueError(f"the table needs the columns id, a and b, found {', '.join(names)}")
            kind = next(f.dataType for f in pairs.dataType.fields if f.name == "id")
            number = lambda n: StructField(n, IntegerType())
            schema = StructType([StructField("id", kind), number("block"), number("a_from"), number("b_from"), number("length"), number("window"), StructField("text", StringType())])
            return AnalyzeResult(schema, partitionBy=[PartitioningColumn("id")], orderBy=[OrderingColumn("a"), OrderingColumn("b")])

        def eval(self, row) -> Iterator[tuple]:
            a, b = row["a"] or "", row["b"] or ""
            if not a or not b:
                return
            swapped = len(a) > len(b)
            short, long = (b, a) if swapped else (a, b)
            score, at, size = best_window(short, long)
            if len(a) == len(b):
                other = best_window(long, short)
                if other[0] > score:
                    (score, at, size), short, long, swapped = other, long, short, not swapped
            for n, (i, j, length) in enumerate(blocks(short, long[at : at + size])):
                i_a, i_b = (at + j, i) if swapped else (i, at + j)
                yield row["id"], n, i_a, i_b, length, size, short[i : i + length]

    def table(a: str, b: str) -> list[list[int]]:
        """Longest common subsequences of all beginnings."""
        rows = [[0] * (len(b) + 1)]
        for x in a:
            last, new = rows[-1], [0]
            for j, y in enumerate(b):
                new.append(last[j] + 1 if x == y else max(last[j + 1], new[j]))
            rows.append(new)
        return rows

    def best_window(short: str, long: str) -> tuple[float, int, int]:
        """Similarity, start and length of the window of ``long`` most like ``short``, the first of equals."""
        best = (-1.0, 0, 0)
        for k in range(1 - len(short), len(long)):
            window = long[max(k, 0) : k + len(short)]
            value = 2 * table(short, window)[-1][-1] / (len(short) + len(window))
            if value > best[0]:
                best = (value, max(k, 0), len(window))
        return best

    def blocks(a: str, b: str) -> list[tuple[int, int, int]]:
        """Runs of a longest common subsequence: places in both and length."""
        rows, i, j, out = table(a, b), len(a), len(b), []
        while i and j:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                if out and out[-1][0] == i + 1 and out[-1][1] == j + 1:
                    out[-1] = (i, j, out[-1][2] + 1)
                else:
                    out.append((i, j, 1))
            elif rows[i - 1][j] >= rows[i][j - 1]:
                i -= 1
            else:
                j -= 1
        return out[::-1]

    return Align


def register(spark: SparkSession, name: str = NAME) -> None:
    """Make the function callable from SQL: ``SELECT * FROM align_texts(TABLE(pairs))`` over a table with ``id``, ``a`` and ``b``.

    A row for each block of characters that both texts have in common, in order, in
    the window of the longer text that is most like the shorter one (the alignment of
    ``partial_ratio``): its number from 0, where it begins in each, its length, and that
    of the window. Twice the sum of lengths over the lengths of shorter text and window is the score. The function
    asks for a partition for each ``id`` itself, so no task holds more than a pair at a time;
    repeated ids are aligned one after another. A null or empty text has no block.
    """
    spark.udtf.register(name, udtf(_made()))
