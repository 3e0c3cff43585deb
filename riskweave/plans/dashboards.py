"""Dashboard figures over the three extracts (overview, tier and geography views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import money_total, ratio, round_half_up


def dashboard_trend(overview: DataFrame) -> DataFrame:
    """Year and product: summed default rate and exposure."""
    return overview.groupBy("origination_year", "loan_type").agg(
        round_half_up(money_total("default_rate_pct"), 2).alias("default_rate_pct"),
        round_half_up(money_total("total_exposure"), 2).alias("total_exposure"),
    )


def dashboard_tier(tiers: DataFrame) -> DataFrame:
    """Score band and product: plain mean of the yearly rates, and the rate weighted by loans."""
    weighted = ratio(F.sum("defaults").cast("double"), F.sum("loan_count").cast("double")) * 100
    return tiers.groupBy("credit_score_bucket", "loan_type").agg(
        round_half_up(F.avg(F.col("default_rate_pct").cast("decimal(18,2)")).cast("double"), 4)
        .alias("avg_default_rate_pct"),
        round_half_up(weighted, 2).alias("weighted_default_rate_pct"),
    )


def dashboard_state(geography: DataFrame) -> DataFrame:
    """State: rates and exposure added over both products, and the rate weighted by loans."""
    weighted = ratio(F.sum("total_defaults").cast("double"), F.sum("loan_count").cast("double")) * 100
    known = F.initcap("loan_type").isin(V.PRODUCTS)
    return geography.where(known).groupBy("state").agg(
        round_half_up(money_total("default_rate_pct"), 2).alias("sum_default_rate_pct"),
        round_half_up(money_total("total_exposure_millions"), 2).alias("total_exposure_millions"),
        round_half_up(weighted, 2).alias("weighted_default_rate_pct"),
    )


def dashboard_relate(overview: DataFrame, tiers: DataFrame, geography: DataFrame) -> DataFrame:
    """The three extracts related on product; each is reduced to one row per product first."""
    a = overview.groupBy("loan_type").agg(
        F.sum("total_loans").alias("overview_loans"), F.sum("total_defaults").alias("overview_defaults"))
    b = tiers.groupBy("loan_type").agg(
        F.sum("loan_count").alias("tier_loans"), F.sum("defaults").alias("tier_defaults"))
    c = geography.groupBy("loan_type").agg(
        F.sum("loan_count").alias("state_loans"), F.sum("total_defaults").alias("state_defaults"))
    return a.join(b, "loan_type").join(c, "loan_type")
