"""The same answers when one customer, one order or one score holds a third of all rows."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point

QUERIES = ["loans_raw", "portfolio_overview", "early_warning", "risk_decile", "contract_check", "dq_extended",
           "performance_summary", "describe_by", "stratified_split", "merge_scores", "partitioned_write"]


@pytest.fixture(scope="module")
def skewed(spark, sf, tmp_path_factory):
    """Copies of the tables with a hot customer, and a hot order holding a third of the lines."""
    folder = tmp_path_factory.mktemp("skewed")
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    orders = read("orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("o_custkey")))
    lines = read("lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(5).cast("bigint")).otherwise(F.col("l_orderkey")))
    tables = {"orders": orders, "lineitem": lines, "customer": read("customer"), "nation": read("nation")}
    for name, table in tables.items():
        table.write.parquet(str(folder / f"{name}.parquet"))
    return folder


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables(spark, skewed, name):
    con = duckdb.connect()
    for file in Path(skewed).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}/*.parquet'")
    cursor = con.execute(entry_point.oracle_sql()[name])
    place = {d[0]: i for i, d in enumerate(cursor.description)}
    df = entry_point.queries()[name](spark, str(skewed))
    expected = sorted(tuple(repr(row[place[c]]) for c in df.columns) for row in cursor.fetchall())
    assert sorted(tuple(map(repr, row)) for row in df.collect()) == expected
