import pytest

from linkwell.__main__ import main, parser
from linkwell.sources import documents, files
from conftest import SMALL


def test_jobs_end_to_end(spark, tmp_path):
    """Every stage from raw TSV to checked results, through the command line."""
    d = str(tmp_path)
    entities = documents.document_entities(spark.read.parquet(f"{SMALL}/documents.parquet"))
    for name, table in zip(("s1", "s2", "s3"), documents.split_sources(entities)):
        files.write_tsv(table, f"{d}/{name}.tsv")
        assert main(["preprocess", "--input", f"{d}/{name}.tsv", "--output", f"{d}/{name}"]) == 0
    s1 = spark.read.parquet(f"{d}/s1")
    files.write_tsv(documents.truth_lists(s1, documents.truth_pairs(entities)), f"{d}/truth.tsv")
    sides = [a for n in ("s1", "s2", "s3") for a in (f"--{n}", f"{d}/{n}")]
    main(["block", *sides, "--output", f"{d}/candidates.tsv", "--strategy", "index"])
    main(["make-features", *sides, "--candidates", f"{d}/candidates.tsv", "--output", f"{d}/features",
          "--ground-truth", f"{d}/truth.tsv"])
    spark.read.parquet(f"{d}/s2").union(spark.read.parquet(f"{d}/s2").limit(1)).write.parquet(f"{d}/twice")
    with pytest.raises(ValueError, match="unique"):
        main(["make-features", "--s1", f"{d}/s1", "--s2", f"{d}/twice", "--s3", f"{d}/s3", "--candidates",
              f"{d}/candidates.tsv", "--output", f"{d}/never"])
    main(["train", "--train", f"{d}/features", "--model-dir", f"{d}/model", "--max-iter", "2", "--max-depth", "2"])
    main(["score", "--input", f"{d}/features", "--model-path", f"{d}/model/model", "--output", f"{d}/scores"])
    main(["choose-threshold", "--predictions", f"{d}/model/validation_predictions.parquet", "--output", f"{d}/threshold"])
    best = files.read_threshold(spark, f"{d}/threshold").first()
    assert 0.5 <= best.threshold <= 0.95
    main(["match", "--predictions", f"{d}/scores", "--candidates", f"{d}/candidates.tsv", "--output-dir", f"{d}/out",
          "--threshold", str(best.threshold)])
    check = ["validate", *[a for n in ("s1", "s2", "s3") for a in (f"--test-{n}", f"{d}/{n}.tsv")],
             "--candidate-pairs", f"{d}/out/candidate_pairs.tsv"]
    assert main([*check, "--matching-results", f"{d}/out/matching_results.tsv"]) == 0
    assert main([*check, "--matching-results", f"{d}/candidates.tsv"]) == 1
    for report in (["quality", "--input", f"{d}/s1"], ["key-stats", *sides], ["candidate-stats", *sides],
                   ["blocking-size", "--candidates", f"{d}/candidates.tsv"],
                   ["blocking-recall", "--ground-truth", f"{d}/truth.tsv", "--candidates", f"{d}/candidates.tsv"]):
        assert main(report) == 0
    lists = ["--candidates", f"{d}/candidates.tsv"]
    assert main(["candidate-stats", *sides, *lists, "--output", f"{d}/stats"]) == 0
    sizes = [len((r[0] or "").split(",")) if r[0] else 0 for r in files.read_tsv(spark, f"{d}/candidates.tsv").select("candidate_entity_ids").collect()]
    row = files.read_tsv(spark, f"{d}/stats").first()
    assert (int(row.total_pairs), int(row.s1_covered), int(row.max_candidates)) == (sum(sizes), sum(n > 0 for n in sizes), max(sizes))


@pytest.mark.parametrize("strategy", ["capped", "index"])
def test_the_whole_chain_as_one_job(spark, tmp_path, strategy):
    d = str(tmp_path)
    entities = documents.document_entities(spark.read.parquet(f"{SMALL}/documents.parquet"))
    for name, table in zip(("s1", "s2", "s3"), documents.split_sources(entities)):
        files.write_tsv(table, f"{d}/{name}.tsv")
    truth = documents.truth_lists(documents.split_sources(entities)[0], documents.truth_pairs(entities))
    files.write_tsv(truth, f"{d}/truth.tsv")
    sides = [a for n in ("s1", "s2", "s3") for a in (f"--{n}", f"{d}/{n}.tsv")]
    assert main(["resolve", *sides, "--ground-truth", f"{d}/truth.tsv", "--output-dir", f"{d}/out", "--strategy", strategy,
                 "--max-iter", "2", "--max-depth", "2"]) == 0
    check = ["validate", *[a for n in ("s1", "s2", "s3") for a in (f"--test-{n}", f"{d}/{n}.tsv")]]
    out = ["--matching-results", f"{d}/out/matching_results.tsv", "--candidate-pairs", f"{d}/out/candidate_pairs.tsv"]
    assert main([*check, *out]) == 0
    assert any(r[1] for r in files.read_tsv(spark, f"{d}/out/matching_results.tsv").collect())


def test_missing_and_unreadable_files(spark, sample, tmp_path):
    """Rows of the violation table, not an error of the reader."""
    from linkwell.plans.jobs import validate

    d = str(tmp_path)
    for name, table in zip(("s1", "s2", "s3"), sample):
        files.write_tsv(table, f"{d}/{name}.tsv")
    (tmp_path / "good.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\t\n")
    (tmp_path / "pairs.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\nS1-3\t\n")
    (tmp_path / "bad.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\tS3-1\nS1-2\nS1-3\t\n")
    given = [f"{d}/{n}.tsv" for n in ("s1", "s2", "s3")]
    run = lambda a, b: sorted((r.rule, r.detail.split(":")[0]) for r in validate(spark, *given, f"{d}/{a}", f"{d}/{b}").collect())
    assert run("good.tsv", "pairs.tsv") == []
    assert run("none.tsv", "nor.tsv") == [("V1", "matching_results"), ("V2", "candidate_pairs")]
    assert run("good.tsv", "nor.tsv") == [("V2", "candidate_pairs")]
    assert run("good.tsv", "bad.tsv") == [("V11", "candidate_pairs")] * 2
    assert run("pairs.tsv", "pairs.tsv") == [("V12", "matching_results")]


def test_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["block", "--s1", "x"])
