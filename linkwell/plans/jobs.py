"""The pipeline's stages as jobs that read and write paths.

Tables of raw entities, candidates, truth and results are TSV; normalized
entities, features and predictions are Parquet. Any path Spark can read works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwell.operators import blocking, coverage, evaluate, features, model, normalize, output
from linkwell.plans import index_pipeline, pipeline
from linkwell.schema import CANDIDATE_LISTS, MATCH_LISTS, S1_ID
from linkwell.session import stage
from linkwell.sources import files


def _sides(spark: SparkSession, s1: str, s2: str, s3: str) -> tuple[DataFrame, DataFrame]:
    ours, *theirs = (spark.read.parquet(p) for p in (s1, s2, s3))
    return ours, blocking.union_targets(*theirs)


def preprocess(spark: SparkSession, input: str, output: str, dialect: str = "ascii", files_out: int = 0) -> None:
    """Raw TSV to normalized Parquet; ``files_out`` sets the number of files, 0 leaves it to the data."""
    tidy = normalize.normalize_entities(files.read_entities(spark, input), dialect)
    files.write_parquet(tidy, output, files_out or None)


def quality(spark: SparkSession, input: str) -> DataFrame:
    return normalize.quality_stats(spark.read.parquet(input))


def block(
    spark: SparkSession, s1: str, s2: str, s3: str, output: str, strategy: str = "capped",
    prefix4_cap: int = blocking.PREFIX4_CAP, prefix6_cap: int = blocking.PREFIX6_CAP,
    token_cap: int = blocking.TOKEN_CAP,
) -> None:
    """Normalized Parquet to candidate lists, by the ``capped`` or the ``index`` rules."""
    ours, theirs = _sides(spark, s1, s2, s3)
    if strategy == "capped":
        pairs = blocking.block_capped(ours, theirs, prefix4_cap, prefix6_cap)
    elif strategy == "index":
        pairs = blocking.block_index(ours, theirs, token_cap, listed=True)
    else:
        raise ValueError(f"strategy must be capped or index, got {strategy!r}")
    files.write_tsv(blocking.candidate_lists(ours, pairs), output, sort_by=S1_ID)


def key_stats(
    spark: SparkSession, s1: str, s2: str, s3: str,
    prefix4_cap: int = blocking.PREFIX4_CAP, prefix6_cap: int = blocking.PREFIX6_CAP,
) -> DataFrame:
    """Block keys of the targets and how many of them are within the caps."""
    return blocking.blocking_key_stats(_sides(spark, s1, s2, s3)[1], {4: prefix4_cap, 6: prefix6_cap})


def candidate_stats(
    spark: SparkSession, s1: str, s2: str, s3: str, candidates: str = "",
    prefix4_cap: int = blocking.PREFIX4_CAP, prefix6_cap: int = blocking.PREFIX6_CAP,
) -> DataFrame:
    """Coverage and distribution of the candidate lists given, or of the capped rules without building their pairs."""
    ours, theirs = _sides(spark, s1, s2, s3)
    if candidates:
        pairs = features.explode_candidates(files.read_tsv(spark, candidates, CANDIDATE_LISTS))
        counts = coverage.pair_candidate_counts(ours, pairs)
    else:
        counts = coverage.capped_candidate_counts(ours, theirs, prefix4_cap, prefix6_cap)
    counts = stage(counts, "counts")
    spread = coverage.candidate_distribution(counts).select(F.struct("*")).scalar()
    return coverage.candidate_coverage(counts).withColumn("_d", spread).select("*", "_d.*").drop("_d")


def make_features(
    spark: SparkSession, s1: str, s2: str, s3: str, candidates: str, output: str, ground_truth: str = ""
) -> None:
    """Features of the candidates, labelled if a truth table is given; entity ids must be unique."""
    truth = files.read_tsv(spark, ground_truth, MATCH_LISTS) if ground_truth else None
    lists = files.read_tsv(spark, candidates, CANDIDATE_LISTS)
    ours, theirs = _sides(spark, s1, s2, s3)
    for side in (ours, theirs):
        if not normalize.repeated_ids(side).isEmpty():
            raise ValueError("entity_id must be unique")
    files.write_parquet(features.feature_table(lists, ours, theirs, truth), output)


def train(spark: SparkSession, train: str, model_dir: str, max_iter: int = 500, max_depth: int = 7) -> None:
    """Fit on 80% of the S1 ids; writes the model and its predictions for the other 20%."""
    rows = spark.read.parquet(train)
    fitted, validation = model.train_and_validate(rows, maxIter=max_iter, maxDepth=max_depth)
    model.save_model(fitted, f"{model_dir}/model")
    files.write_parquet(validation, f"{model_dir}/validation_predictions.parquet")


def score(spark: SparkSession, input: str, model_path: str, output: str) -> None:
    files.write_parquet(model.score(model.load_model(model_path), spark.read.parquet(input)), output)


def choose_threshold(spark: SparkSession, predictions: str, output: str) -> None:
    files.write_threshold(evaluate.select_threshold(spark.read.parquet(predictions)), output)


def match(
    spark: SparkSession, predictions: str, candidates: str, output_dir: str, threshold: float = output.DEFAULT_THRESHOLD
) -> None:
    """Match lists and the candidate lists they were chosen from."""
    lists = files.read_tsv(spark, candidates, CANDIDATE_LISTS)
    found = output.match_lists(spark.read.parquet(predictions), lists, threshold)
    files.write_tsv(found, f"{output_dir}/matching_results.tsv", sort_by=S1_ID)
    files.write_tsv(lists, f"{output_dir}/candidate_pairs.tsv")


def blocking_size(spark: SparkSession, candidates: str) -> DataFrame:
    return coverage.blocking_size_report(files.read_tsv(spark, candidates, CANDIDATE_LISTS))


def blocking_recall(spark: SparkSession, ground_truth: str, candidates: str) -> DataFrame:
    truth = features.explode_candidates(files.read_tsv(spark, ground_truth, MATCH_LISTS), "matched_entity_ids")
    return coverage.blocking_recall(
        truth, features.explode_candidates(files.read_tsv(spark, candidates, CANDIDATE_LISTS))
    )


def validate(
    spark: SparkSession, test_s1: str, test_s2: str, test_s3: str, matching_results: str, candidate_pairs: str
) -> DataFrame:
    """All rule violations of the output files; an empty table means they are valid.

    Beside the rules of :func:`~linkwell.operators.output.validate_output`: V1 and V2, the file of
    matches or of candidates isn't there; V11, lines that aren't readable as TSV of two fields.
    """
    named = (("V1", "matching_results", matching_results, MATCH_LISTS), ("V2", "candidate_pairs", candidate_pairs, CANDIDATE_LISTS))
    shape = f"rule string, {S1_ID} string, detail string"
    missing = [(rule, None, f"{name}: no such file: {path}") for rule, name, path, _ in named if not files.exists(spark, path)]
    if missing:
        return spark.createDataFrame(missing, shape)
    broken = [
        files.unreadable_lines(spark, path, schema).select(
            F.lit("V11").alias("rule"), F.lit(None).cast("string").alias(S1_ID), F.concat(F.lit(f"{name}: "), "line").alias("detail"))
        for _, name, path, schema in named
    ]
    broken = stage(broken[0].unionByName(broken[1]), "unreadable")
    if broken.take(1):
        return broken
    entities = [files.read_entities(spark, p) for p in (test_s1, test_s2, test_s3)]
    return output.validate_output(
        files.read_tsv(spark, matching_results), files.read_tsv(spark, candidate_pairs), *entities
    )


def resolve(
    spark: SparkSession, s1: str, s2: str, s3: str, ground_truth: str, output_dir: str, strategy: str = "capped", dialect: str = "ascii",
    threshold: float = 0.0, max_iter: int = model.GBT_PARAMS["maxIter"], max_depth: int = model.GBT_PARAMS["maxDepth"],
) -> None:
    """The whole chain: raw TSV and truth to a trained model, match lists and candidate lists.

    A ``threshold`` of 0 takes the best one of the validation side (capped strategy), or the default.
    """
    ours, theirs = pipeline.prepare(*[files.read_entities(spark, p) for p in (s1, s2, s3)], dialect=dialect)
    truth = features.explode_candidates(files.read_tsv(spark, ground_truth, MATCH_LISTS), "matched_entity_ids")
    trees = {"maxIter": max_iter, "maxDepth": max_depth}
    if strategy == "capped":
        fitted, best = pipeline.fit(ours, theirs, truth, **trees)
        limit = threshold or best.first()["threshold"]
        matches, pairs = pipeline.resolve_prepared(ours, theirs, fitted, limit), blocking.block_capped(ours, theirs)
    elif strategy == "index":
        fitted, limit = index_pipeline.fit_index(ours, theirs, truth, **trees), threshold or output.DEFAULT_THRESHOLD
        matches, pairs = index_pipeline.resolve_index(ours, theirs, fitted, limit), blocking.block_index(ours, theirs, listed=True)
    else:
        raise ValueError(f"strategy must be capped or index, got {strategy!r}")
    model.save_model(fitted, f"{output_dir}/model")
    files.write_tsv(matches, f"{output_dir}/matching_results.tsv", sort_by=S1_ID)
    files.write_tsv(blocking.candidate_lists(ours, pairs), f"{output_dir}/candidate_pairs.tsv", sort_by=S1_ID)


JOBS = {
    f.__name__.replace("_", "-"): f
    for f in (
        preprocess, quality, block, key_stats, candidate_stats, make_features, train, score, choose_threshold, match,
        blocking_size, blocking_recall, validate, resolve,
    )
}
