"""Table schemas and plan-time column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names and order of the exchanged tables.
ENTITY_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
NORMALIZED_COLUMNS = ["name_norm", "address_norm", "country_norm", "name_prefix4", "name_prefix6"]
FEATURE_COLUMNS = [
    "name_ratio",
    "name_partial_ratio",
    "name_token_set_ratio",
    "name_jaccard",
    "address_ratio",
    "address_partial_ratio",
    "address_token_set_ratio",
    "address_jaccard",
    "numeric_overlap",
    "country_match",
    "name_length_diff",
    "address_length_diff",
]
S1_ID = "source1_entity_id"
CANDIDATE_ID = "candidate_entity_id"
TARGET_SOURCES = ["S2", "S3"]

ENTITY = _strings(*ENTITY_COLUMNS)
PAIRS = _strings(S1_ID, CANDIDATE_ID)
CANDIDATE_LISTS = _strings(S1_ID, "candidate_entity_ids")
MATCH_LISTS = _strings(S1_ID, "matched_entity_ids")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail while the plan is built, before any job runs, if a column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def require_label(df: DataFrame) -> DataFrame:
    if "label" not in df.columns:
        raise ValueError("Training dataset must contain 'label'")
    return df
