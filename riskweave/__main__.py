"""Jobs for spark-submit: ``python -m riskweave etl|ingest|report ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from riskweave.plans.etl import run_etl
from riskweave.plans.report import risk_report
from riskweave.session import tuned
from riskweave.sources.files import export_extract, read_clean
from riskweave.streaming.ingest import ingest_arrivals


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskweave")
    jobs = parser.add_subparsers(dest="job", required=True)

    etl = jobs.add_parser("etl", help="raw CSV to the clean table")
    etl.add_argument("--source", required=True)
    etl.add_argument("--target", required=True)
    etl.add_argument("--year", type=int, help="only this origination year")
    etl.add_argument("--job-name", default="loan-data-transform")

    ingest = jobs.add_parser("ingest", help="clean the files that arrived since the last run")
    for name in ("--source", "--target", "--checkpoint"):
        ingest.add_argument(name, required=True)
    ingest.add_argument("--profile", help="folder for rule counts per batch")

    report = jobs.add_parser("report", help="portfolio risk summary as CSV")
    for name in ("--loans", "--scores", "--target"):
        report.add_argument(name, required=True)
    report.add_argument("--as-of", help="date printed in the report")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = tuned(SparkSession.builder.appName(f"riskweave-{args.job}").getOrCreate())
    if args.job == "etl":
        print(json.dumps(run_etl(spark, args.source, args.target, args.year, args.job_name)))
    elif args.job == "ingest":
        ingest_arrivals(spark, args.source, args.checkpoint, args.target, args.profile)
    else:
        report = risk_report(read_clean(spark, args.loans), spark.read.parquet(args.scores), args.as_of)
        export_extract(report, args.target)


if __name__ == "__main__":
    main()
