"""Lookups and key joins between loans, rates, scores and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V


def _constant_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A literal table as a VALUES clause, so that its size is known when the plan is made."""
    values = ", ".join(
        "(" + ", ".join(f"{v}D" if isinstance(v, float) else str(v) for v in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def fed_rate_table(spark: SparkSession) -> DataFrame:
    """The 28 quarterly policy rates; a constant, so always safe to broadcast."""
    return _constant_table(spark, V.FED_FUNDS_QUARTERLY, "fed_year, fed_quarter, fed_rate")


def with_fed_rate(loans: DataFrame, date: str = "origination_date", grain: str = "quarter",
                  name: str = "fed_funds_rate") -> DataFrame:
    """Policy rate at origination by quarter (or by year), 2.5 outside the table."""
    spark = loans.sparkSession
    if grain == "year":
        rates = _constant_table(spark, V.FED_FUNDS_YEARLY, "fed_year, fed_rate")
        match = F.col("fed_year") == F.year(date)
    else:
        rates = fed_rate_table(spark)
        match = (F.col("fed_year") == F.year(date)) & (F.col("fed_quarter") == F.quarter(date))
    joined = loans.drop(name).join(F.broadcast(rates), match, "left")
    return joined.withColumn(
        name, F.coalesce("fed_rate", F.lit(V.FED_FUNDS_DEFAULT))
    ).drop(*rates.columns)


def loans_with_scores(loans: DataFrame, scores: DataFrame, version: str = "v1.0",
                      columns: tuple[str, ...] = ("xgb_default_prob", "ensemble_default_prob",
                                                  "risk_tier", "if_is_anomaly")) -> DataFrame:
    """Every loan with the scores of one model version; loans without a score keep NULLs.

    The version is filtered before the join, so only one version's scores are shuffled.
    """
    wanted = scores.where(F.col("model_version") == version).select("loan_id", *columns)
    return loans.join(wanted, "loan_id", "left")


def attach_keys(scored: DataFrame, source: DataFrame, columns: list[str], key: str = "loan_id") -> DataFrame:
    """Bring source columns back to scored rows by key."""
    return scored.join(source.select(key, *columns), key)


def shared_rows(left: DataFrame, right: DataFrame, key: str = "loan_id") -> DataFrame:
    """Rows of ``left`` whose key also occurs in ``right``: a split without leakage has none."""
    return left.join(right.select(key), key, "left_semi")


def check_no_leakage(train: DataFrame, test: DataFrame, key: str = "loan_id") -> DataFrame:
    """One row: sizes of both parts and the number of shared keys."""
    keys = (
        train.select(key, F.lit(1).alias("in_train"), F.lit(0).alias("in_test"))
        .unionByName(test.select(key, F.lit(0).alias("in_train"), F.lit(1).alias("in_test")))
        .groupBy(key).agg(F.sum("in_train").alias("a"), F.sum("in_test").alias("b"))
    )
    return keys.agg(
        F.sum("a").alias("train_rows"), F.sum("b").alias("test_rows"),
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("shared_keys"),
    )


def shared_keys(left: DataFrame, right: DataFrame, key: str = "loan_id") -> DataFrame:
    """Set intersection of the keys of two frames."""
    return left.select(key).intersect(right.select(key))


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it does not have yet."""
    fresh = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)
