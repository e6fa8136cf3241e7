"""From raw documents to packed training sequences: the corpus operators in a row.

Each stage takes the documents its predecessor kept and returns, but for the
last, documents with the same columns. :func:`run` writes the result of each
stage as Parquet to the shared folder and reads it back, so a stage that loses
executors starts again from written tables.

Defined cases: rows with null ids or texts, repeated rows and empty tables pass
as the operators define them; a document whose lines or bytes are all repeats
stays with an empty text. Extra columns of the documents are kept up to the last
stage. The column ``n_chars``, where there is one, describes the original text
and is not changed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwell.llm import line_dedup, minhash, packing, quality, suffix_dedup
from linkwell.llm.common import table
from linkwell.session import release, scratch_mark, scratch_since, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SIMILARITY = 85
_held: list[str] = []


def releasing(step: Stage) -> Stage:
    """A stage that first deletes the intermediate tables of the stage before.

    That one's result has been written by then, as ``docs`` is what was written.
    """

    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _held)
        mark = scratch_mark()
        made = step(spark, docs, sf_dir)
        _held[:] = scratch_since(mark)
        return made

    return run_step


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of runs of lines."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    return minhash.keep_one(docs, SIMILARITY)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes of long strings that start earlier; what is left of a cut character is U+FFFD."""
    done = suffix_dedup.dedup_substrings(docs)
    return done.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, in sequences of 4096 tokens."""
    return packing.pack(packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), compact=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", releasing(quality_rules)),
    ("repeated_lines", releasing(repeated_lines)),
    ("near_duplicates", releasing(near_duplicates)),
    ("repeated_substrings", releasing(repeated_substrings)),
    ("packed_sequences", releasing(packed_sequences)),
]

#: The stages cut and join texts in ways SQL doesn't express; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
