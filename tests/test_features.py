import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions import numeric, risk
from riskweave.operators.cleaning import clean_loans
from riskweave.operators.features import engineer_features, to_loans_clean
from riskweave.operators.lookups import with_fed_rate
from riskweave.schemas import LOANS_CLEAN, RAW_LOANS_TEXT


def values(spark, expr, data, dtype="double"):
    df = spark.createDataFrame([(v,) for v in data], f"x {dtype}")
    return [r[0] for r in df.select(expr).collect()]


def test_rounding_is_decimal_half_up(spark):
    assert values(spark, numeric.round_half_up("x", 2), [0.285, 1.005, -0.285, None]) == [0.29, 1.01, -0.29, None]


def test_rounding_of_any_two_decimal_half(spark):
    data = [n / 1000 for n in range(-4005, 4005, 7)]
    expected = [float(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in data]
    assert values(spark, numeric.round_half_up("x", 2), data) == expected


def test_half_even_rounding_is_that_of_numpy(spark):
    data = np.random.default_rng(1).uniform(-5, 5, 500).tolist() + [0.5, 1.5, 2.5, 0.125]
    assert values(spark, numeric.round_half_even("x", 2), data) == list(np.round(data, 2))


def test_ratio_by_zero_is_null(spark):
    assert values(spark, numeric.ratio(F.lit(1.0), "x"), [0.0, 2.0, None]) == [None, 0.5, None]


def test_clamp(spark):
    assert values(spark, numeric.clamp("x", 2, 24), [1.0, 5.0, 30.0, None]) == [2.0, 5.0, 24.0, None]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (1.0, 4.0, 3.0), (1.0, None, 9.0)], "a double, b double, c double")
    row = df.select(numeric.correlation("a", "b").alias("x"), numeric.correlation("b", "c").alias("y")).first()
    assert row["x"] is None and row["y"] == pytest.approx(1.0)


def test_money_total_is_exact(spark):
    assert values(spark, numeric.money_total("x"), [0.1] * 10) == [1.0]


@pytest.mark.parametrize("score, label", [
    (850, "800+"), (800, "800+"), (799, "740-799"), (740, "740-799"), (670, "670-739"), (669, "620-669"),
    (620, "620-669"), (619, "580-619"), (580, "580-619"), (579, "<580"), (None, "<580"),
])
def test_score_bands(spark, score, label):
    assert values(spark, risk.credit_score_bucket("x"), [score], "int") == [label]


def test_other_bands_and_their_null_band(spark):
    assert values(spark, risk.dti_bucket("x"), [19.99, 20.0, 36.0, 43.0, None]) == [
        "Low (<20)", "Moderate (20-36)", "High (36-43)", "Very High (43+)", "Very High (43+)"]
    assert values(spark, risk.ltv_bucket("x"), [59.9, 60.0, 80.0, 90.0, 97.0, None]) == [
        "Low (<60)", "Standard (60-80)", "High (80-90)", "Very High (90-97)", "Above 97", "Above 97"]
    assert values(spark, risk.income_bucket("x"), [39999.0, 40000.0, 75000.0, 120000.0, 200000.0]) == [
        "Low (<40K)", "Lower-Mid (40-75K)", "Middle (75-120K)", "Upper-Mid (120-200K)", "High (200K+)"]


@pytest.mark.parametrize("expr, edges, data", [
    (risk.credit_score_ordinal, V.CREDIT_SCORE_EDGES, [1.0, 579.0, 580.0, 619.0, 620.0, 850.0]),
    (risk.dti_ordinal, V.DTI_EDGES, [0.5, 20.0, 20.01, 36.0, 43.0, 100.0]),
    (risk.income_ordinal, V.INCOME_EDGES, [1.0, 40000.0, 40001.0, 200000.0, 9e9]),
])
def test_ordinal_bands_match_pandas_cut(spark, expr, edges, data):
    expected = pd.cut(pd.Series(data), bins=edges, labels=False) + 1
    assert values(spark, expr("x"), data) == list(expected)


def test_ordinal_band_outside_is_null(spark):
    assert values(spark, risk.credit_score_ordinal("x"), [0.0, 851.0, None]) == [None, None, None]


@pytest.mark.parametrize("p, tier", [
    (0.60, "CRITICAL"), (0.85, "CRITICAL"), (1.0, "CRITICAL"), (0.40, "HIGH"), (0.50, "HIGH"), (0.59, "HIGH"),
    (0.20, "MEDIUM"), (0.30, "MEDIUM"), (0.39, "MEDIUM"), (0.19, "LOW"), (0.05, "LOW"), (0.0, "LOW"), (None, "LOW"),
])
def test_risk_tiers(spark, p, tier):
    assert values(spark, risk.risk_tier("x"), [p]) == [tier]


def test_ratios_and_score(loan):
    row = engineer_features(loan({"num_delinquencies": 2}), "etl").first()
    assert row["loan_to_income_ratio"] == round(250000 / 90000, 4)
    assert row["payment_to_income_ratio"] == 0.2
    assert row["rate_spread"] == 5.065
    assert row["risk_score"] == pytest.approx(150 / 550 * 40 + 15 + 8 + 10 + 2, abs=0.005)


def test_score_falls_with_credit_and_rises_with_debt(loan):
    base, better, indebted = (r["risk_score"] for r in engineer_features(
        loan({}, {"credit_score": 800}, {"dti_ratio": 45.0}), "sql").orderBy("loan_id").collect())
    assert better < base < indebted


@pytest.mark.parametrize("change, flag", [
    ({}, 0), ({"credit_score": 619}, 1), ({"credit_score": 620}, 0), ({"dti_ratio": 43.0}, 0),
    ({"dti_ratio": 43.1}, 1), ({"ltv_ratio": 95.5}, 1), ({"num_delinquencies": 3}, 1), ({"num_delinquencies": None}, 0),
])
def test_high_risk(loan, change, flag):
    assert engineer_features(loan(change), "sql").first()["is_high_risk"] == flag


def test_variants_differ_where_documented(loan):
    df = loan({"origination_date": dt.date(2020, 2, 1), "origination_year": 2020, "num_inquiries_12m": None})
    etl = engineer_features(clean_loans(df), "etl").first()
    sql = engineer_features(df, "sql").first()
    notebook = engineer_features(clean_loans(df), "notebook").first()
    assert (etl["is_covid_period"], sql["is_covid_period"], notebook["is_covid_period"]) == (0, 0, 1)
    assert etl["risk_score"] is not None and sql["risk_score"] is None
    assert etl["credit_score_bucket"] == "670-739" and notebook["credit_score_bucket"] == 4
    assert notebook["payment_to_income_ratio"] == pytest.approx(250000 / 5.125 / 7500, abs=1e-4)
    assert notebook["is_mortgage"] == 1
    with pytest.raises(ValueError):
        engineer_features(df, "other")


def test_covid_and_hike_periods(loan):
    dates = [dt.date(2020, 3, 1), dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.date(2022, 6, 1), dt.date(2023, 1, 1)]
    rows = engineer_features(loan(*[{"origination_date": d, "origination_year": d.year} for d in dates]), "sql")
    got = [(r["is_covid_period"], r["is_rate_hike_period"]) for r in rows.orderBy("origination_date").collect()]
    assert got == [(1, 0), (1, 0), (0, 0), (0, 1), (0, 1)]


def test_zero_income_gives_null(loan):
    row = engineer_features(loan({"annual_income": 0.0, "monthly_income": 0.0}), "etl").first()
    assert row["loan_to_income_ratio"] is None and row["payment_to_income_ratio"] is None


def test_cleaning(loan, spark):
    df = loan({"loan_type": " auto ", "state": " ca", "credit_tier": " Good ", "interest_rate": 5.12355,
               "num_delinquencies": None, "months_to_default": None})
    row = clean_loans(df).first()
    assert (row["loan_type"], row["state"], row["credit_tier"]) == ("AUTO", "CA", "Good")
    assert (row["interest_rate"], row["num_delinquencies"], row["months_to_default"]) == (5.124, 0, -1)


def test_bad_date_text_becomes_null(loan):
    text = loan({"origination_date": "2020-13-45"}, {"origination_date": "2020-02-29"}, schema=_text_dates())
    rows = engineer_features(clean_loans(text), "etl").orderBy("loan_id").collect()
    assert rows[0]["origination_date"] is None and rows[0]["origination_year"] is None
    assert rows[1]["origination_quarter"] == "Q1" and rows[1]["origination_month"] == 2


def _text_dates():
    from pyspark.sql import types as T
    from riskweave.schemas import RAW_LOANS
    return T.StructType([RAW_LOANS_TEXT[f.name] if f.name == "origination_date" else f for f in RAW_LOANS.fields])


def test_clean_table_has_48_columns_in_order(loan):
    df = to_loans_clean(engineer_features(loan({}), "sql"))
    assert df.columns == LOANS_CLEAN.fieldNames() and len(df.columns) == 48


def test_scorecard_limits_and_sum(loan):
    worst = {"credit_score": 500, "dti_ratio": 60.0, "ltv_ratio": 99.0, "employment_years": 0.5,
             "is_self_employed": 1, "origination_date": dt.date(2023, 1, 1), "fed_funds_rate": 4.57}
    best = {"credit_score": 800, "dti_ratio": 10.0, "ltv_ratio": 50.0, "employment_years": 10.0}
    auto = {"loan_type": "Auto", "ltv_ratio": 99.0}
    date = F.col("origination_date")
    got = loan(worst, best, auto).select("loan_id", risk.rule_default_probability(date).alias("p"))
    p = [r["p"] for r in got.orderBy("loan_id").collect()]
    assert p == [pytest.approx(.05 + .18 + .10 + .08 + .04 + .03 + .03 + .02), 0.005, pytest.approx(.05 + .01 + .02)]


def test_loan_outcome(loan):
    rows = loan(
        {"is_default": 1, "months_to_default": 60, "origination_date": dt.date(2024, 1, 1), "loan_status": "Default"},
        {"is_default": 1, "months_to_default": 2, "origination_date": dt.date(2024, 1, 1), "loan_status": "Default"},
        {"term_months": 36, "origination_date": dt.date(2018, 1, 1)},
        {"loan_status": "30 DPD"},
    ).select("loan_id", risk.loan_outcome(F.col("origination_date")).alias("o")).orderBy("loan_id").collect()
    assert [tuple(r["o"]) for r in rows] == [(0, "Current"), (1, "Default"), (0, "Paid Off"), (0, "30 DPD")]


def test_ids_and_regimes(spark):
    df = spark.createDataFrame([("Mortgage", 2021, 1, dt.date(2020, 3, 31)), ("Auto", 2018, 12, dt.date(2030, 1, 1))],
                               "t string, y int, n int, d date")
    rows = df.select(risk.format_loan_id(F.col("t"), F.col("y"), F.col("n")), risk.format_short_loan_id(F.col("n")),
                     risk.economic_regime_label(F.col("d"))).collect()
    assert tuple(rows[0]) == ("MRD-MOR-2021-0000001", "LN00000001", "COVID-19 shock")
    assert tuple(rows[1]) == ("MRD-AUT-2018-0000012", "LN00000012", None)


def test_fed_rate_lookup(loan):
    dates = [dt.date(2020, 1, 1), dt.date(2020, 4, 1), dt.date(2024, 12, 31), dt.date(2030, 1, 1)]
    df = loan(*[{"origination_date": d} for d in dates])
    assert [r["fed_funds_rate"] for r in with_fed_rate(df).orderBy("loan_id").collect()] == [1.58, 0.06, 4.83, 2.5]
    yearly = with_fed_rate(df, grain="year").orderBy("loan_id").collect()
    assert [r["fed_funds_rate"] for r in yearly] == [0.25, 0.25, 5.00, 2.5]


def test_means_keep_small_values_and_leave_out_nan(spark):
    assert values(spark, numeric.rate_mean("x"), [0.00002, 0.00004]) == [0.00003]
    assert values(spark, numeric.money_total("x"), [1.5, float("nan"), float("inf")]) == [1.5]
