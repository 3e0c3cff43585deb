import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave import catalog
from riskweave.operators import loading
from riskweave.operators.positions import with_positions
from riskweave.schemas import Contract
from riskweave.sources import files

CONTRACT = Contract(["name"], ["id"], {"name": 5, "absent": 3})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_load_parts_rows_by_their_constraints(spark):
    rows = [(1, "a", 1.0), (2, None, 1.0), (None, "b", 1.0), (3, "too long", 1.0), (None, None, 1.0),
            (4, "x", 2.0), (4, "x", 1.0), (4, "y", 0.0), (5, "s", 1.0), (5, "s", 1.0), (6, "", None)]
    accepted, rejects = loading.load_checked(spark.createDataFrame(rows, "id long, name string, v double").repartition(4), CONTRACT)
    assert rows_of(accepted) == sorted([(1, "a", 1.0), (4, "x", 1.0), (5, "s", 1.0), (6, "", None)], key=repr)
    assert rows_of(rejects) == sorted([
        (2, None, 1.0, ["null_name"]), (None, "b", 1.0, ["null_id"]), (3, "too long", 1.0, ["too_long_name"]),
        (None, None, 1.0, ["null_name", "null_id"]), (4, "x", 2.0, ["repeated_key"]), (4, "y", 0.0, ["repeated_key"]),
        (5, "s", 1.0, ["repeated_key"])], key=repr)
    counts = dict(map(tuple, loading.reject_counts(accepted, rejects).collect()))
    assert counts == {"accepted": 4, "rejected": 7, "null_name": 2, "null_id": 2, "too_long_name": 1, "repeated_key": 3}


def test_accepted_rows_are_those_without_reasons_and_compiled(spark):
    rows = [(1, "a", 1.0), (2, None, 1.0), (None, "b", 1.0), (3, "too long", 1.0), (None, None, None), (4, "x", 2.0), (4, "x", 2.0), (6, "", None)]
    df = spark.createDataFrame(rows, "id long, name string, v double")
    accepted = loading.accepted_rows(df, CONTRACT)
    assert rows_of(accepted) == rows_of(df.where(F.size(loading.broken_constraints(df, CONTRACT)) == 0))
    assert rows_of(accepted) == rows_of(spark.createDataFrame([rows[0], *rows[5:]], df.schema))
    assert "lambda" not in accepted._jdf.queryExecution().optimizedPlan().toString()  # is interpreted for every row
    free = loading.accepted_rows(df, Contract([], []))
    assert free.count() == len(rows)


def test_load_of_a_hot_key_and_of_no_rows(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("id"), F.lit("n").alias("name"), F.col("id").alias("v"))
    accepted, rejects = loading.load_checked(many, CONTRACT)
    assert accepted.count() == 2001 and rejects.count() == 999
    assert accepted.where("id = 7").first()["v"] == 0
    nothing = [df.count() for df in loading.load_checked(many.where("id < 0"), CONTRACT)]
    assert nothing == [0, 0]


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_are_those_of_a_sort(spark, partitions):
    df = spark.range(2500).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), "id").repartition(partitions)
    df = df.withColumn("a", F.when(F.col("id") % 100 == 1, None).otherwise(F.col("a")))
    got = with_positions(df, F.col("a").desc_nulls_last(), F.col("id")).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(2500))
    assert [r["id"] for r in got] == [r["id"] for r in df.orderBy(F.col("a").desc_nulls_last(), "id").collect()]
    assert with_positions(df.where("id < 0"), F.col("id")).count() == 0


def test_files_are_grouped_by_their_headers(spark, tmp_path):
    """Long files, of which only the first line is looked at."""
    for k, header in enumerate(("loan_id,loan_type", "loan_type,loan_id", "loan_id,loan_type")):
        lines = "".join(f"LN{i:08d},Auto and a good deal of text to make the line long\n" for i in range(60_000))
        (tmp_path / f"f{k}.csv").write_text(f"{header}\n{lines}")
    found = files._files_by_header(spark, str(tmp_path))
    assert {k: len(v) for k, v in found.items()} == {("loan_id", "loan_type"): 2, ("loan_type", "loan_id"): 1}
    assert files.read_raw_loans(spark, str(tmp_path)).count() == 180_000


def test_a_fresh_session_stages_and_cleans_up(tmp_path):
    """A session without spark.checkpoint.dir, and without any preset configuration."""
    code = """
import sys
from riskweave.session import local_session, scratch_root, staged
spark = local_session(2, "fresh", "1g")
assert not spark.conf.get("spark.checkpoint.dir", None)
print("ROOT", scratch_root(spark), staged(spark.range(10), "t").count())
"""
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    _, root, n = next(line for line in done.stdout.splitlines() if line.startswith("ROOT")).split()
    assert n == "10" and root.startswith(f"file:{tmp_path}/riskweave-")
    assert not list(tmp_path.glob("riskweave-*"))


def test_loans_that_a_load_rejects_stay_in_the_views(spark, loan, monkeypatch):
    book = loan({}, {"loan_id": None}, {"loan_type": None}, {"origination_date": None})
    monkeypatch.setattr(catalog, "raw", lambda *_: book)
    run = lambda name: catalog.QUERIES[name](spark, "rejected-rows")
    for name in ("features_sql", "loans_clean", "risk_decile", "head_preview"):
        assert run(name).count() == 4, name
    assert run("portfolio_overview").agg(F.sum("total_loans")).first()[0] == 4
    assert [r["loan_id"] for r in run("head_preview").collect()][-1] is None
    broken = {r["rule"]: r["violations"] for r in run("contract_check").collect()}
    assert broken["not_null:loan_id"] == broken["not_null:loan_type"] == broken["not_null:origination_date"] == 1
    assert {r["outcome"]: r["rows"] for r in run("load_outcome").collect()}["accepted"] == 1
