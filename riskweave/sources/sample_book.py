"""A loan book and model scores derived from the order tables.

``orders``, ``customer``, ``nation`` and ``lineitem`` stand in for loan files: an order becomes a
loan, its customer the borrower, returned lines become delinquencies.  Dates are moved 23 years
ahead.  All quantities are integers with at most one final division, and a few rows carry a
defect, so that the quality rules have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.risk import (
    band_above, band_at_least, band_below, credit_tier, format_short_loan_id,
)
from riskweave.operators.lookups import fed_rate_table

DEFECTS = {  # remainder of the order key -> defect
    "negative_amount": (997, 1), "score_900": (991, 2), "dti_120": (983, 3), "null_id": (977, 4),
    "null_type": (971, 5), "default_2": (967, 6), "bad_date": (953, 7), "null_inquiries": (211, 0),
}


def _hit(defect: str) -> Column:
    divisor, remainder = DEFECTS[defect]
    return F.col("k") % divisor == remainder


#: Declared, so that opening a table needs no job that reads file footers.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_returnflag string",
    "events": "event_id bigint, user_id bigint, event_type string, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns used here of one of the given tables."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(c: Column) -> Column:
    return c.cast("double") / F.lit(100.0)


def _borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the integers everything else is computed from.

    The orders are spread by their key first: the join with the line counts needs that placement
    anyway, and it keeps all cores busy when the table comes as one small file.
    """
    returned = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_ret")
    )
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    return (
        orders.repartition("o_orderkey")
        .join(returned, F.col("l_orderkey") == k, "left")
        .join(customer, ck == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("k"), ck.alias("ck"), F.col("o_totalprice").alias("amt"),
            "c_acctbal", "c_mktsegment", "n_name", "n_ret",
            F.expr("CAST(o_orderdate + INTERVAL '23' YEAR AS DATE)").alias("od"),
            F.when(k % 25 < 14, "Mortgage").otherwise("Auto").alias("lt"),
            (480 + (k * 101) % 186 + (ck * 37 + k) % 186).alias("cs"),
            (500 + (k * 13 + ck * 7) % 5001).alias("dti_c"),
            (5000 + (k * 29) % 5001).alias("ltv_c"),
        )
    )


def _with_points(df: DataFrame) -> DataFrame:
    """Term, policy rate and default points (hundredths of probability)."""
    k, cs, dti, ltv = (F.col(c) for c in ("k", "cs", "dti_c", "ltv_c"))
    mortgage = F.col("lt") == "Mortgage"
    year = F.year("od")
    rates = fed_rate_table(df.sparkSession).select(
        "fed_year", "fed_quarter", F.rint(F.col("fed_rate") * 100).cast("int").alias("fc")
    )
    rated = df.join(
        F.broadcast(rates),
        (F.col("fed_year") == year) & (F.col("fed_quarter") == F.quarter("od")), "left",
    ).withColumn("fc2", F.coalesce("fc", F.lit(int(V.FED_FUNDS_DEFAULT * 100))))
    mortgage_term = F.when(k % 20 == 0, 180).when(k % 20 < 3, 240).otherwise(360)
    auto_term = band_below(k % 20, [(2, 36), (5, 48), (12, 60), (17, 72)], 84)
    points = (
        5
        + band_below(cs, [(580, 18), (620, 12), (660, 7), (700, 3), (740, 1)], -2)
        + F.when(dti < 2000, -2).otherwise(band_above(dti, [(5000, 10), (4300, 6), (3600, 3)], 0))
        + F.when(~mortgage, 2).when(ltv < 6000, -2)
        .otherwise(band_above(ltv, [(9500, 8), (9000, 5), (8000, 2)], 0))
        + band_below(F.col("ck") % 400, [(10, 4), (20, 2)], 0)
        + F.when(F.col("ck") % 20 < 3, 3).otherwise(0)
        + F.when(year == 2020, 4).when(year.isin(2022, 2023), 3).otherwise(0)
        + F.when(F.col("fc2") > 400, 2).otherwise(0)
    )
    return rated.withColumns({
        "term": F.when(mortgage, mortgage_term).otherwise(auto_term).cast("int"),
        "pts": F.greatest(F.lit(1), points),
    }).withColumn(
        "dflt", F.when((k * 7919 + F.col("ck") * 31) % 10007 < F.col("pts") * 100, 1).otherwise(0)
    )


def loans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """35 raw fields; the origination date is text as in a file."""
    df = _with_points(_borrowers(spark, sf_dir))
    k, ck, cs, amt, term, od = (F.col(c) for c in ("k", "ck", "cs", "amt", "term", "od"))
    mortgage, auto = F.col("lt") == "Mortgage", F.col("lt") == "Auto"
    defaulted = F.col("dflt") == 1
    income = 25000 + (F.col("c_acctbal") + 1000) * 20
    spread = F.when(mortgage, 1800).otherwise(3500)
    rate = F.col("fc2") * 10 + spread + F.greatest(F.lit(0), (720 - cs) * 15) + (k % 61 - 30) * 10
    status = (
        F.when(defaulted, band_below(k % 20, [(9, "Charged Off"), (16, "Default")], "90+ DPD"))
        .when(F.date_add(od, term * 30) <= F.lit(V.OBSERVATION_END).cast("date"), "Paid Off")
        .otherwise(band_below(k % 100, [(93, "Current"), (97, "30 DPD")], "60 DPD"))
    )
    fields = {
        "loan_id": F.when(~_hit("null_id"), format_short_loan_id(k)),
        "loan_type": F.when(~_hit("null_type"), F.col("lt")),
        "origination_date": F.when(_hit("bad_date"), "2020-13-45").otherwise(od.cast("string")),
        "origination_year": F.year(od).cast("int"),
        "origination_quarter": F.concat(F.lit("Q"), F.quarter(od).cast("string")),
        "loan_amount": F.when(_hit("negative_amount"), -amt).otherwise(amt),
        "term_months": term,
        "interest_rate": F.least(F.lit(24000), F.greatest(F.lit(2000), rate)).cast("double") / F.lit(1000.0),
        "loan_purpose": F.when(auto, F.when(k % 5 == 0, "Refinance").otherwise("Purchase"))
        .otherwise(band_below(k % 20, [(11, "Purchase"), (17, "Refinance")], "Cash-Out Refinance")),
        "ltv_ratio": _hundredths(F.col("ltv_c")),
        "monthly_payment": _hundredths(F.floor(amt * 105 / term)),
        "borrower_age": (22 + ck % 54).cast("int"),
        "annual_income": income,
        "monthly_income": _hundredths(F.floor(income * 100 / 12)),
        "employment_years": (ck % 400).cast("double") / F.lit(10.0),
        "is_self_employed": F.when(ck % 20 < 3, 1).otherwise(0),
        "employment_sector": F.col("c_mktsegment"),
        "state": F.concat(F.lit(" "), F.lower("n_name")),
        "credit_score": F.when(_hit("score_900"), 900).otherwise(cs).cast("int"),
        "credit_tier": credit_tier("cs"),
        "dti_ratio": _hundredths(F.when(_hit("dti_120"), 12000).otherwise(F.col("dti_c"))),
        "num_open_accounts": (1 + ck % 25).cast("int"),
        "num_delinquencies": F.col("n_ret").cast("int"),
        "num_inquiries_12m": F.when(~_hit("null_inquiries"), k % 7).cast("int"),
        "fed_funds_rate": _hundredths(F.col("fc2")),
        "property_type": F.when(mortgage, band_below(
            k % 20, [(13, "Single Family"), (17, "Condo"), (19, "Townhouse")], "Multi-Family")),
        "property_value": F.when(mortgage, _hundredths(F.floor(amt * 1000000 / F.col("ltv_c")))),
        "vehicle_make": F.when(auto, F.concat(F.lit("Make"), (k % 8).cast("string"))),
        "vehicle_model": F.when(auto, F.concat(F.lit("Model"), (k % 29).cast("string"))),
        "vehicle_year": F.when(auto, F.year(od) - k % 6).cast("int"),
        "vehicle_type": F.when(auto, band_below(k % 20, [(7, "New"), (16, "Used")], "Certified Pre-Owned")),
        "loan_status": status,
        "is_default": F.when(_hit("default_2"), 2).otherwise(F.col("dflt")).cast("int"),
        "default_probability": _hundredths(F.col("pts")),
        "months_to_default": F.when(defaulted, 1 + k % 36).cast("int"),
    }
    return df.select(*[c.alias(name) for name, c in fields.items()])


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two model versions: v1.0 for nine loans in ten, v0.9 for every second loan."""
    loans = loans_raw(spark, sf_dir).where(F.col("loan_id").isNotNull()).select(
        "loan_id", F.substring("loan_id", 3, 8).cast("bigint").alias("k"),
        F.round(F.col("default_probability") * 100).cast("bigint").alias("pts"),
    )
    k, pts = F.col("k"), F.col("pts")
    scored = F.when(k % 10 < 5, F.array(F.lit("v1.0"), F.lit("v0.9"))).when(k % 10 < 9, F.array(F.lit("v1.0")))
    within = lambda c: F.least(F.lit(999), F.greatest(F.lit(1), c))
    points = loans.withColumns({
        "lr": within(pts * 15 + (k * 17) % 101 - 50),
        "xg": within(pts * 20 + (k * 23) % 101 - 50),
        "model_version": F.explode(scored),
    })
    lr, xg = F.col("lr"), F.col("xg")
    both, odd = lr + xg, (k * 41) % 300
    prediction = lambda c, limit: F.when(c >= limit, 1).otherwise(0)
    return points.select(
        "loan_id", "model_version",
        (lr.cast("double") / F.lit(1000.0)).alias("lr_default_prob"),
        prediction(lr, 500).alias("lr_prediction"),
        (xg.cast("double") / F.lit(1000.0)).alias("xgb_default_prob"),
        prediction(xg, 500).alias("xgb_prediction"),
        (both.cast("double") / F.lit(2000.0)).alias("ensemble_default_prob"),
        prediction(both, 1000).alias("ensemble_prediction"),
        (-((400 + odd).cast("double") / F.lit(1000.0))).alias("if_anomaly_score"),
        prediction(odd, 285).alias("if_is_anomaly"),
        band_at_least(both, [(1200, "CRITICAL"), (800, "HIGH"), (400, "MEDIUM")], "LOW").alias("risk_tier"),
    )
