"""Aggregations that are not tied to one view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import (
    correlation, money_mean, percent_of_rows, rate_mean, ratio, round_half_up,
)
from riskweave.functions.risk import risk_tier, row_hash
from riskweave.operators.positions import with_positions
from riskweave.operators.ranking import exact_percentiles


def dataset_summary(loans: DataFrame) -> DataFrame:
    """Totals, default rates overall and per product, and means, in one aggregation."""
    product = F.upper(F.trim("loan_type"))
    rate_of = lambda p: F.avg(F.when(product == p.upper(), F.col("is_default"))) * 100
    mortgage, auto = V.PRODUCTS
    return loans.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.count_if(product == mortgage.upper()).alias("mortgage_loans"),
        F.count_if(product == auto.upper()).alias("auto_loans"),
        round_half_up(percent_of_rows("is_default"), 2).alias("default_rate_pct"),
        round_half_up(rate_of(mortgage), 2).alias("mortgage_default_rate_pct"),
        round_half_up(rate_of(auto), 2).alias("auto_default_rate_pct"),
        round_half_up(money_mean("loan_amount"), 0).alias("avg_loan_amount"),
        round_half_up(F.avg("credit_score"), 0).alias("avg_credit_score"),
        round_half_up(rate_mean("dti_ratio"), 1).alias("avg_dti"),
        round_half_up(rate_mean("interest_rate"), 2).alias("avg_interest_rate"),
    )


def value_counts(df: DataFrame, columns: list[str], ordered: bool = False) -> DataFrame:
    """(field, value, rows) for several low-cardinality columns from one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    out = (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        .select(F.inline(pairs), "_n")
        .groupBy("field", "value").agg(F.sum("_n").alias("rows"))
    )
    return out.orderBy("field", F.desc("rows"), "value") if ordered else out


def tier_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("loans"))


def default_rate_by_tier(scored: DataFrame, label: str = "is_default") -> DataFrame:
    return scored.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("loans"), round_half_up(F.avg(label), 3).alias("default_rate")
    )


def tier_separation(scored: DataFrame, label: str = "is_default") -> DataFrame:
    """Default rate of the highest tier over that of the lowest."""
    rate_of = lambda t: F.avg(F.when(F.col("risk_tier") == t, F.col(label)))
    return scored.agg(
        rate_of(V.RISK_TIERS[0]).alias("critical"), rate_of(V.RISK_TIERS[-1]).alias("low")
    ).select(
        round_half_up("critical", 6).alias("critical_rate"),
        round_half_up("low", 6).alias("low_rate"),
        round_half_up(ratio("critical", "low"), 4).alias("separation"),
        (F.col("critical") > F.col("low")).alias("separates"),
    )


def describe_by(df: DataFrame, by: str, value: str, digits: int = 4) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per group.

    The quartiles are exact and scan the frame several times: pass a stored table.
    """
    rounded = lambda c: round_half_up(c, digits)
    moments = df.groupBy(by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    quartiles = exact_percentiles(df, value, [0.25, 0.50, 0.75], [by])
    joined = moments.alias("m").join(
        quartiles.alias("q"), F.col(f"m.{by}").eqNullSafe(F.col(f"q.{by}")), "left"
    )
    return joined.select(
        F.col(f"m.{by}").alias(by), "count",
        *[rounded(F.col(c)).alias(c) for c in ("mean", "std", "min")],
        *[rounded(F.col(p)).alias(p) for p in ("p25", "p50", "p75")],
        rounded(F.col("max")).alias("max"),
    )


def feature_correlation(df: DataFrame, features: list[str] | None = None,
                        label: str = "is_default", ordered: bool = False) -> DataFrame:
    """(feature, correlation) with the label, three decimals, from one aggregation."""
    features = features or V.CORRELATED_FEATURES
    wide = df.agg(*[correlation(f, label).alias(f) for f in features])
    pairs = ", ".join(f"'{f}', `{f}`" for f in features)
    long = wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, r)").select(
        "feature", round_half_up("r", 3).alias("correlation")
    )
    return long.orderBy("correlation", "feature") if ordered else long


def anomaly_overlap(df: DataFrame, flag: str = "if_is_anomaly", label: str = "is_default") -> DataFrame:
    """How far flagged rows and defaults coincide."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(flag) == 1).alias("flagged"),
        F.count_if(F.col(label) == 1).alias("defaults"),
        F.count_if((F.col(flag) == 1) & (F.col(label) == 1)).alias("flagged_defaults"),
    )
    share = lambda a, b: round_half_up(ratio(F.col(a).cast("double"), F.col(b).cast("double")), 6)
    return counts.select(
        "*", share("flagged", "rows").alias("flagged_share"),
        share("defaults", "rows").alias("default_share"),
        share("flagged_defaults", "flagged").alias("overlap_of_flagged"),
        share("flagged_defaults", "defaults").alias("default_capture_rate"),
    )


def union_products(*frames: DataFrame) -> DataFrame:
    """Product frames put together by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def shuffle_rows(df: DataFrame, seed: int = 42, key: str = "loan_id") -> DataFrame:
    """All rows with their ``position`` in a seeded random order, that of a hash of the key."""
    return with_positions(df, row_hash(key, seed=seed), F.col(key))


def head(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The first n rows of an order, NULL last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


def with_risk_tier(scores: DataFrame, probability: str = "ensemble_default_prob") -> DataFrame:
    return scores.withColumn("risk_tier", risk_tier(probability))
