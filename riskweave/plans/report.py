"""The portfolio risk summary: eight (metric, value) rows of text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.numeric import money_total, percent_of_rows, rate_mean


def _plain(c: Column, digits: int) -> Column:
    """Rounded number as text without trailing zeros and never in exponent form."""
    text = F.round(c.cast("decimal(28,8)"), digits).cast(f"decimal(28,{digits})").cast("string")
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit(".")) if digits else text


def risk_report(loans: DataFrame, scores: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Report rows; ``as_of`` is printed and filters nothing.

    All loan figures come from one aggregation, the critical count from one over the scores.
    """
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    loan_figures = loans.agg(
        F.count(F.lit(1)).cast("string").alias("n"),
        _plain(money_total("loan_amount") / 1000000, 2).alias("exposure"),
        _plain(percent_of_rows("is_default"), 2).alias("rate"),
        F.sum("is_high_risk").cast("string").alias("high"),
        _plain(F.avg("credit_score"), 0).alias("score"),
        _plain(rate_mean("dti_ratio"), 1).alias("dti"),
    ).select(day.cast("string").alias("day"), "*")
    loan_rows = loan_figures.selectExpr(
        "stack(7, 'Report Date', day, 'Total Loans', n, 'Total Exposure ($M)', exposure, "
        "'Overall Default Rate (%)', rate, 'High Risk Loans', high, 'Avg Credit Score', score, "
        "'Avg DTI Ratio (%)', dti) AS (metric, value)"
    )
    critical = scores.where(F.col("risk_tier") == "CRITICAL").agg(
        F.lit("Critical Risk Loans").alias("metric"), F.count(F.lit(1)).cast("string").alias("value")
    )
    return loan_rows.unionByName(critical)
