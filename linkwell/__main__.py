"""``spark-submit``/``python -m linkwell JOB --argument value ...``: one pipeline stage per run."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import DataFrame, SparkSession

from linkwell.plans.jobs import JOBS
from linkwell.session import stage
from linkwell.sources import files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="linkwell")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, f in JOBS.items():
        sub = jobs.add_parser(name, help=(f.__doc__ or "").split("\n")[0])
        for p in list(inspect.signature(f).parameters.values())[1:]:
            needed = p.default is inspect.Parameter.empty
            kind = str if needed else type(p.default)
            sub.add_argument(f"--{p.name.replace('_', '-')}", dest=p.name, required=needed, type=kind,
                             default=None if needed else p.default)
        if "DataFrame" in str(f.__annotations__["return"]):
            sub.add_argument("--output", dest="report", default="", help="write the whole report here as TSV")
    return top


def main(argv: list[str] | None = None) -> int:
    args = vars(parser().parse_args(argv))
    job, path = JOBS[args.pop("job")], args.pop("report", "")
    spark = SparkSession.builder.appName(f"linkwell-{job.__name__}").getOrCreate()
    report = job(spark, **args)
    if isinstance(report, DataFrame):
        report = stage(report, "report")
        if path:
            files.write_tsv(report, path)
        report.show(100, truncate=False)
        if job.__name__ == "validate":
            return 0 if report.isEmpty() else 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
