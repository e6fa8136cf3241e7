import pytest
from pyspark.sql import functions as F

from linkwell.functions import idlist, text
from linkwell.operators.normalize import normalize_entities, quality_stats, repeated_ids, sample_rows, source_row_counts


def apply(spark, make, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("dialect,cases", [
    ("unicode", {
        None: "", "  ": "", "A&B": "a and b", "Foo_Bar!": "foo_bar", "x²½ y": "x²½ y", "Café\tdu  Nord": "café du nord",
        "हिन्दी": "ह न द",
    }),
    ("ascii", {None: "", "  ": "", "A&B": "a b", "Foo_Bar!": "foo bar", "Café\tdu  Nord": "caf du nord", "x²½ y": "x y"}),
])
def test_text(spark, dialect, cases):
    assert apply(spark, lambda c: text.normalize_text(c, dialect), list(cases)) == list(cases.values())


@pytest.mark.parametrize("dialect,cases", [
    ("unicode", {
        "ABC Technologies Pvt. Ltd.": "abc technologies", "Ltd": "", "abc co ltd": "abc", "co pvt abc limited x": "abc x",
        "private abc": "private abc", "Compañía co": "compañía", "incs corp": "incs", "ABC LLP": "abc llp", "éco": "éco",
        "Private Limited Private Ltd": "",
    }),
    ("ascii", {
        "ABC Technologies Pvt. Ltd.": "abc technologies", "Ltd": "ltd", "abc co ltd": "abc co", "abc pvt": "abc pvt",
        "ABC LLP": "abc", "ABC Private Limited": "abc", "co abc": "co abc", None: "",
    }),
])
def test_name(spark, dialect, cases):
    assert apply(spark, lambda c: text.normalize_name(c, dialect), list(cases)) == list(cases.values())


@pytest.mark.parametrize("dialect,cases", [
    ("unicode", {"123 Main Street, Suite 5": "123 main st ste 5", "St. Road Av": "st rd av", "streets": "streets", None: ""}),
    ("ascii", {"1 Elm Av, 2nd Floor": "1 elm ave 2nd fl", "Road Road Parkway": "rd rd pkwy", "": ""}),
])
def test_address(spark, dialect, cases):
    assert apply(spark, lambda c: text.normalize_address(c, dialect), list(cases)) == list(cases.values())


def test_unknown_dialect():
    with pytest.raises(ValueError):
        text.normalize_text(None, "klingon")


def test_tokens_numbers_and_ids(spark):
    assert apply(spark, text.name_tokens, ["an old co old", "", None]) == [["old", "old"], [], []]
    assert apply(spark, text.numbers, ["12 elm 7 12a", "none", None]) == [["12", "7"], [], []]
    assert apply(spark, idlist.parse_ids, [" a, b,,a ", "", None]) == [["a", "b"], [], []]
    assert apply(spark, lambda c: idlist.join_ids(idlist.split_ids(c)), ["b,a,b", ""]) == ["a,b", ""]
    assert apply(spark, idlist.is_target, ["S2-1", "S3-x", "S1-1", "S21", "", None]) == [True, True, False, False, False, False]


def test_table(spark, sample):
    s1 = sample[0].withColumn("extra", F.lit(1))
    assert "extra" in normalize_entities(s1, "unicode").columns
    assert normalize_entities(s1, "ascii").columns == [
        "entity_id", "business_name", "business_address", "country",
        "name_norm", "address_norm", "country_norm", "name_prefix4", "name_prefix6",
    ]
    with pytest.raises(ValueError, match="Missing required columns"):
        normalize_entities(s1.drop("country"))


def test_reports(spark):
    rows = [("S1-1", "Ltd", None, "NA"), ("S1-2", "Ab", "1 Elm", ""), ("S1-3", None, "", None)]
    df = normalize_entities(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    assert quality_stats(df).first().asDict() == {
        "total_rows": 3, "empty_names": 2, "empty_addresses": 2, "empty_countries": 2,
    }
    assert [r.entity_id for r in sample_rows(df, 2).collect()] == ["S1-1", "S1-2"]
    assert [tuple(r) for r in repeated_ids(df.union(df.filter("entity_id = 'S1-2'"))).collect()] == [("S1-2", 2)]
    counts = source_row_counts({"S1": df, "S2": df.limit(0)}).collect()
    assert {r.source: r.row_count for r in counts} == {"S1": 3, "S2": 0}
