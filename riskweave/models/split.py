"""Seeded stratified split and class-balance figures."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.numeric import round_half_up
from riskweave.operators.ranking import lowest_hashed


def stratified_split(df: DataFrame, key: str = "loan_id", label: str = "is_default",
                     test: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: exactly ``ceil(test * n)`` rows of each class are 'test', the rest 'train'.

    The rows of lowest seeded hash form the test part.  Only rows around the cut are ranked; all
    others are compared with it in a map-only pass.
    """
    share = F.lit(Decimal(str(test)))
    marked = lowest_hashed(df, [key], lambda n: F.ceil(n * share), seed, by=[label], name="_test")
    return marked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def class_balance_report(split: DataFrame, label: str = "is_default") -> DataFrame:
    """Rows, defaults and default rate per part of the split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).alias("defaults"),
        round_half_up(F.avg(label), 6).alias("default_rate"),
    )
