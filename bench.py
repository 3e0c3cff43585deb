"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from riskweave import catalog
from riskweave.session import local_session

HEADLINE = [
    "loans_raw", "dq_profile", "dq_quarantine", "contract_check", "features_etl", "features_sql", "features_notebook",
    "portfolio_overview", "default_by_credit_tier", "geographic_risk", "economic_regime", "risk_report",
    "risk_decile", "early_warning", "merge_scores", "performance_summary", "auc_roc", "stratified_split",
    "describe_by", "feature_correlation", "partitioned_write", "csv_round_trip", "ingest_arrivals",
]


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute every row and column of a query."""
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "riskweave-bench")
    spark.sparkContext.setLogLevel("ERROR")
    small = re.sub(r"sf[0-9.]+/*$", "sf0.001", folder)
    for name in ("portfolio_overview", "early_warning"):  # start-up of the JVM is not measured
        run(spark, name, small if os.path.isdir(small) else folder)
    seconds = {name: run(spark, name, folder) for name in names}
    found = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else None, "cpus": cores,
    }))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
