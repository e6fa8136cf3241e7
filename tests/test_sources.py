import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linkwell import session
from linkwell.schema import CANDIDATE_LISTS, ENTITY, ENTITY_COLUMNS, S1_ID
from linkwell.sources import documents, files
from linkwell.streaming.incremental import normalize_files

ROWS = [("S1-1", 'Say "hi"', "1 Elm", "NA"), ("S1-2", None, " padded ", ""), ("S1-3", "tab less", "x,y", "fr")]


def test_entities_roundtrip(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_tsv(spark.createDataFrame(ROWS, ENTITY), path)
    got = sorted(map(tuple, files.read_entities(spark, path).collect()))
    assert got == [ROWS[0], ("S1-2", None, " padded ", None), ROWS[2]]


def test_lists_are_blank_and_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    lists = spark.createDataFrame([(f"S1-{i:03}", "" if i % 2 else "S2-1,S2-2") for i in range(50)][::-1], CANDIDATE_LISTS)
    files.write_tsv(lists, path, sort_by=S1_ID)
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        header, *body = open(part).read().splitlines()
        assert header == f"{S1_ID}\tcandidate_entity_ids"
        lines += body
    assert lines[:2] == ["S1-000\tS2-1,S2-2", "S1-001\t"] and lines == sorted(lines) and len(lines) == 50
    with pytest.raises(ValueError, match="expected columns"):
        files.read_tsv(spark, path, ENTITY)
    files.write_tsv(lists, path, single_file=True)
    assert len(glob.glob(f"{path}/part-*")) == 1


def test_missing_column(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_tsv(spark.createDataFrame(ROWS, ENTITY).drop("country"), path)
    with pytest.raises(ValueError, match="country"):
        files.read_entities(spark, path)


def test_parquet_files(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(spark.range(1000), path, files=8)
    assert len(glob.glob(f"{path}/part-*.snappy.parquet")) == 8
    files.write_parquet(spark.range(10), path)
    assert spark.read.parquet(path).count() == 10


def test_threshold(spark, tmp_path):
    names = ["threshold", "precision", "recall", "f05", "entity_macro_f05"]
    record = spark.createDataFrame([(0.71, 1.0, 0.5, 0.8333, 0.9)], ", ".join(f"{n} double" for n in names))
    files.write_threshold(record, str(tmp_path / "t"))
    assert files.read_threshold(spark, str(tmp_path / "t")).collect() == record.collect()


def test_incremental(spark, tmp_path):
    raw, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    df = spark.createDataFrame(ROWS, ENTITY)
    files.write_tsv(df.repartition(3), raw)
    normalize_files(spark, raw, out, state, files_per_chunk=1).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    # A second run takes only the files that came since.
    files.write_tsv(df.limit(1).withColumn("entity_id", F.lit("S1-9")), raw, mode="append")
    normalize_files(spark, raw, out, state).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r.entity_id for r in got.collect()) == ["S1-1", "S1-2", "S1-3", "S1-9"]
    assert {r.country_norm for r in got.collect()} == {"na", "", "fr"}


def test_stage_keeps_rows_and_pushdown(spark):
    staged = session.stage(spark.createDataFrame(ROWS, ENTITY), "rows")
    assert sorted(map(tuple, staged.collect()), key=str) == sorted(ROWS, key=str)
    assert "PushedFilters: [IsNotNull(country), EqualTo(country,fr)]" in (
        staged.filter("country = 'fr'")._jdf.queryExecution().executedPlan().toString()
    )


def test_document_entities(spark):
    rows = [
        (0, "one three seven seven eleven", "en", 28), (1, "One, three! SEVEN\nseven eleven", "en", 34),
        (2, "one three seven seven eleven", "en", 28), (3, "", "de", 0), (4, "one three seven seven eleven", "fr", 28),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint")
    entities = documents.document_entities(docs)
    got = {r.entity_id: r for r in entities.collect()}
    assert got["S1-0"].business_name == "eleven seven three"
    assert got["S1-0"].business_address == "6 one Street, Suite 1"
    assert got["S2-1"].business_name == "eleven seven three Pvt. Ltd."
    assert (got["S1-3"].business_name, got["S1-3"].country) == (" Company", None)
    truth = {tuple(r) for r in documents.truth_pairs(entities).collect()}
    assert truth == {("S1-0", "S2-1"), ("S1-0", "S3-2"), ("S1-0", "S2-4")}
    s1, s2, s3 = documents.split_sources(entities)
    assert s1.columns == ENTITY_COLUMNS and s2.count() == 2
    lists = dict(map(tuple, documents.truth_lists(s1, documents.truth_pairs(entities)).collect()))
    assert lists == {"S1-0": "S2-1,S2-4,S3-2", "S1-3": ""}


def test_scratch_tables_are_released(spark):
    mark = session.scratch_mark()
    staged = session.stage(spark.range(3).toDF("n"), "rows")
    (path,) = session.scratch_since(mark)
    assert staged.count() == 3
    session.release(spark, [path, "/tmp/not-a-scratch-folder"])
    with pytest.raises(AnalysisException):
        spark.read.parquet(path).count()
