"""Normalization of names, addresses and countries as Column expressions.

Two dialects exist. ``unicode`` keeps letters and digits of every script and
strips legal suffixes anywhere in a name; ``ascii`` keeps ``a-z0-9`` only and
strips one suffix at the end. After the text step every token is separated by
exactly one space, so whole-word rules work on whole tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes removed from names.
UNICODE_SUFFIXES = [
    "private limited", "private ltd", "pvt limited", "pvt ltd", "pvt", "limited", "ltd", "llc",
    "incorporated", "inc", "corp", "corporation", "company", "co", "plc",
]
ASCII_SUFFIXES = [
    "private limited", "pvt limited", "pvt ltd", "private ltd", "limited", "ltd", "incorporated",
    "inc", "corporation", "corp", "llc", "llp", "plc", "co", "company",
]

# Address words and their abbreviations.
UNICODE_ADDRESS = {
    "street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "highway": "hwy",
    "lane": "ln", "drive": "dr", "apartment": "apt", "suite": "ste", "building": "bldg",
    "floor": "fl",
}
ASCII_ADDRESS = {
    "street": "st", "road": "rd", "avenue": "ave", "av": "ave", "boulevard": "blvd",
    "drive": "dr", "lane": "ln", "highway": "hwy", "parkway": "pkwy", "circle": "cir",
    "court": "ct", "place": "pl", "terrace": "ter", "apartment": "apt", "suite": "ste",
    "building": "bldg", "floor": "fl",
}

DIALECTS = ("unicode", "ascii")


def _check(dialect: str) -> None:
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}, got {dialect!r}")


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def normalize_text(c: Column, dialect: str = "unicode") -> Column:
    """Lower-case text whose words are joined by single spaces; null gives ``""``.

    Everything that is not kept, white space included, collapses in one regex
    pass: a run of dropped characters is a run of spaces either way.
    """
    _check(dialect)
    lowered = F.lower(null_to_empty(c))
    if dialect == "unicode":
        spelled = F.replace(lowered, F.lit("&"), F.lit(" and "))
        return F.trim(F.regexp_replace(spelled, r"[^\p{L}\p{N}_]+", " "))
    return F.trim(F.regexp_replace(lowered, r"[^a-z0-9]+", " "))


def normalize_name(c: Column, dialect: str = "unicode") -> Column:
    text = normalize_text(c, dialect)
    if dialect == "unicode":
        whole_words = rf"(?<= |^)(?:{'|'.join(UNICODE_SUFFIXES)})(?= |$)"
        bare = F.regexp_replace(text, whole_words, " ")
        return F.trim(F.regexp_replace(bare, " +", " "))
    return F.regexp_replace(text, rf" (?:{'|'.join(ASCII_SUFFIXES)})$", "")


def normalize_address(c: Column, dialect: str = "unicode") -> Column:
    """Replace whole words by their abbreviations, all rules in one pass."""
    _check(dialect)
    rules = UNICODE_ADDRESS if dialect == "unicode" else ASCII_ADDRESS
    lookup = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    words = F.split(normalize_text(c, dialect), " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(lookup, w), w)), " ")


def normalize_country(c: Column, dialect: str = "unicode") -> Column:
    return normalize_text(c, dialect)


def name_prefix(name_norm: Column, length: int) -> Column:
    return F.substring(name_norm, 1, length)


def words(c: Column) -> Column:
    """Space-separated words; the empty text has none."""
    return F.array_remove(F.split(null_to_empty(c), " "), "")


def name_tokens(name_norm: Column, min_length: int = 3) -> Column:
    """Words long enough to block on, in order and with repeats."""
    return F.filter(F.split(null_to_empty(name_norm), " "), lambda w: F.length(w) >= min_length)


def numbers(c: Column) -> Column:
    """Distinct runs of digits."""
    return F.array_distinct(F.regexp_extract_all(null_to_empty(c), F.lit(r"(\p{Nd}+)"), 1))
