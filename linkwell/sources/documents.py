"""Three entity tables and a truth table derived from a table of documents.

Stands in for business tables where none exist: each document is a record of
one source. The whole text is read: its longest distinct words give the name
and the street, its word and character counts the numbers, and the digest of
all its words tells which records are copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwell.schema import CANDIDATE_ID, S1_ID

# Spellings that normalization has to undo.
SUFFIXES = ["", " Pvt. Ltd.", ", Inc.", " Company", " & Co."]
STREETS = {1: " Street, Suite ", 2: " St., Suite ", 3: " Street, Ste "}


def document_entities(documents: DataFrame) -> DataFrame:
    """Entity columns plus ``source`` and ``truth_key``; one narrow pass over the documents."""
    all_words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    by_length = F.sort_array(
        F.transform(F.array_distinct("_words"), lambda w: F.struct((-F.length(w)).alias("l"), w.alias("w")))
    )
    number = (F.col("doc_id") % 3 + 1).cast("int")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("doc_id") % len(SUFFIXES) + 1).cast("int"))
    street = F.element_at(F.array(*[F.lit(STREETS[i]) for i in (1, 2, 3)]), number)
    text = lambda c: c.cast("string")
    return (
        documents.select("doc_id", "lang", "n_chars", all_words.alias("_words"))
        .withColumn("_top", F.transform(F.slice(by_length, 1, 4), lambda s: s["w"]))
        .select(
            F.concat(F.lit("S"), text(number), F.lit("-"), text(F.col("doc_id"))).alias("entity_id"),
            F.concat(F.array_join(F.slice("_top", 1, 3), " "), suffix).alias("business_name"),
            F.concat(
                text(F.size("_words") % 900 + 1), F.lit(" "), F.coalesce(F.get("_top", F.lit(3)), F.lit("")),
                street, text(F.col("n_chars") % 9),
            ).alias("business_address"),
            F.when(F.col("n_chars") % 17 != 0, F.upper("lang")).alias("country"),
            F.concat(F.lit("S"), text(number)).alias("source"),
            F.md5(F.array_join("_words", " ")).alias("truth_key"),
        )
    )


def split_sources(entities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S1, S2 and S3 with the entity columns and whatever was added to them."""
    hidden = ["source", "truth_key"]
    return tuple(entities.filter(F.col("source") == s).drop(*hidden) for s in ("S1", "S2", "S3"))


def truth_groups(entities: DataFrame) -> DataFrame:
    """The truth in linear form: a group for each record, ``(entity_id, truth_key)``.

    Records of S1 and targets of one group are true pairs. A text of very many
    copies costs a row for each copy here, not one for each pair.
    """
    return entities.select("entity_id", "truth_key")


def truth_pairs(entities: DataFrame) -> DataFrame:
    """All true pairs: S1 records and the target records of their group.

    The long form of :func:`truth_groups`, for reports and files that name pairs.
    """
    side = lambda c, name: entities.filter(c).select(F.col("entity_id").alias(name), "truth_key")
    ours, theirs = side(F.col("source") == "S1", S1_ID), side(F.col("source") != "S1", CANDIDATE_ID)
    return ours.join(theirs, "truth_key").select(S1_ID, CANDIDATE_ID)


def truth_lists(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """Wide truth: every S1 id with its comma-joined partners."""
    joined = pairs.groupBy(S1_ID).agg(F.array_join(F.sort_array(F.collect_set(CANDIDATE_ID)), ",").alias("_ids"))
    return (
        s1.select(F.col("entity_id").alias(S1_ID))
        .join(joined, S1_ID, "left")
        .select(S1_ID, F.coalesce("_ids", F.lit("")).alias("matched_entity_ids"))
    )
