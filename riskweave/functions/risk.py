"""Risk features of a loan as Column expressions.

Band tables and limits come from :mod:`riskweave.fixed_values`.  In every banded expression a
NULL input falls to the last (ELSE) band, and a NULL in a flag's condition counts as "not met".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import clamp, ratio


def _first_match(pairs: list[tuple[Column, object]], otherwise) -> Column:
    (condition, value), *rest = pairs
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def band_at_least(c: Column, bands: list[tuple[float, object]], otherwise) -> Column:
    return _first_match([(c >= F.lit(low), label) for low, label in bands], otherwise)


def band_below(c: Column, bands: list[tuple[float, object]], otherwise) -> Column:
    return _first_match([(c < F.lit(high), label) for high, label in bands], otherwise)


def band_above(c: Column, bands: list[tuple[float, object]], otherwise) -> Column:
    return _first_match([(c > F.lit(low), label) for low, label in bands], otherwise)


def ordinal_band(c: Column, edges: list[float]) -> Column:
    """1-based index of the right-closed interval holding the value, NULL outside all of them."""
    inside = None
    for index, (low, high) in enumerate(zip(edges, edges[1:]), start=1):
        hit = (c > F.lit(float(low))) & (c <= F.lit(float(high)))
        inside = F.when(hit, index) if inside is None else inside.when(hit, index)
    return inside


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# ---------------------------------------------------------------- ratios and scores

def loan_to_income() -> Column:
    return ratio("loan_amount", "annual_income")


def payment_to_income(variant: str = "sql") -> Column:
    """Payment over income; the notebook variant approximates the payment by amount / rate."""
    if variant == "notebook":
        return ratio(ratio("loan_amount", "interest_rate"), "monthly_income")
    return ratio("monthly_payment", "monthly_income")


def rate_spread() -> Column:
    return F.col("interest_rate") - F.col("fed_funds_rate")


def risk_score() -> Column:
    """Composite score: score shortfall, debt, leverage, delinquencies and inquiries."""
    shortfall = (F.lit(V.SCORE_CEILING) - F.col("credit_score")) / F.lit(float(V.SCORE_SPAN))
    parts = [
        shortfall * F.lit(float(V.SCORE_WEIGHT)),
        F.col("dti_ratio") / F.lit(float(V.DTI_DIVISOR)),
        F.col("ltv_ratio") / F.lit(float(V.LTV_DIVISOR)),
        F.col("num_delinquencies") * V.DELINQUENCY_WEIGHT,
        F.col("num_inquiries_12m") * V.INQUIRY_WEIGHT,
    ]
    return reduce(lambda a, b: a + b, parts)


def is_high_risk() -> Column:
    return flag(
        (F.col("credit_score") < V.HIGH_RISK_SCORE_BELOW)
        | (F.col("dti_ratio") > V.HIGH_RISK_DTI_ABOVE)
        | (F.col("ltv_ratio") > V.HIGH_RISK_LTV_ABOVE)
        | (F.col("num_delinquencies") > V.HIGH_RISK_DELINQUENCIES_ABOVE)
    )


# ---------------------------------------------------------------- bands

def credit_score_bucket(c: str = "credit_score") -> Column:
    return band_at_least(F.col(c), V.CREDIT_SCORE_BANDS_AT_LEAST, V.CREDIT_SCORE_BAND_ELSE)


def dti_bucket(c: str = "dti_ratio") -> Column:
    return band_below(F.col(c), V.DTI_BANDS_BELOW, V.DTI_BAND_ELSE)


def ltv_bucket(c: str = "ltv_ratio") -> Column:
    return band_below(F.col(c), V.LTV_BANDS_BELOW, V.LTV_BAND_ELSE)


def income_bucket(c: str = "annual_income") -> Column:
    return band_below(F.col(c), V.INCOME_BANDS_BELOW, V.INCOME_BAND_ELSE)


def credit_score_ordinal(c: str = "credit_score") -> Column:
    return ordinal_band(F.col(c), V.CREDIT_SCORE_EDGES)


def dti_ordinal(c: str = "dti_ratio") -> Column:
    return ordinal_band(F.col(c), V.DTI_EDGES)


def income_ordinal(c: str = "annual_income") -> Column:
    return ordinal_band(F.col(c), V.INCOME_EDGES)


def credit_tier(c: str = "credit_score") -> Column:
    return band_at_least(F.col(c), V.CREDIT_TIERS_AT_LEAST, V.CREDIT_TIER_ELSE)


def risk_tier(c: Column | str = "ensemble_default_prob") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return band_at_least(c, V.RISK_TIERS_AT_LEAST, V.RISK_TIER_ELSE)


# ---------------------------------------------------------------- dates and regimes

def quarter_label(date: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def is_covid_period(year: Column, month: Column | None = None) -> Column:
    """2020 as a whole, or from March on when a month is given."""
    inside = year == 2020
    return flag(inside if month is None else inside & (month >= 3))


def is_rate_hike_period(year: Column) -> Column:
    return flag(year.isin(2022, 2023))


def is_mortgage(c: str = "loan_type") -> Column:
    return flag(F.upper(F.trim(F.col(c))) == F.lit(V.PRODUCTS[0].upper()))


def economic_regime_label(date: Column) -> Column:
    """Name of the rate regime a date falls in; NULL outside the documented span."""
    starts = [start for start, _ in V.REGIMES_FROM] + [V.REGIMES_END]
    label = None
    for (start, name), end in zip(V.REGIMES_FROM, starts[1:]):
        inside = (date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date"))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label


# ---------------------------------------------------------------- rules of the loan book

def rule_default_probability(date: Column) -> Column:
    """Additive default scorecard, added up in thousandths so that the sum is exact."""
    mortgage = is_mortgage() == 1
    points = [
        F.lit(V.SCORECARD_BASE),
        band_below(F.col("credit_score"), V.SCORECARD_SCORE_BELOW, V.SCORECARD_SCORE_ELSE),
        F.when(F.col("dti_ratio") < 20, V.SCORECARD_DTI_BELOW_20)
        .otherwise(band_above(F.col("dti_ratio"), V.SCORECARD_DTI_ABOVE, 0)),
        F.when(~mortgage, 0)
        .when(F.col("ltv_ratio") < 60, V.SCORECARD_MORTGAGE_LTV_BELOW_60)
        .otherwise(band_above(F.col("ltv_ratio"), V.SCORECARD_MORTGAGE_LTV_ABOVE, 0)),
        band_below(F.col("employment_years"), V.SCORECARD_TENURE_BELOW, 0),
        F.when(F.col("is_self_employed") == 1, V.SCORECARD_SELF_EMPLOYED).otherwise(0),
        _first_match([(F.year(date) == y, p) for y, p in V.SCORECARD_YEARS], 0),
        F.when(F.upper(F.trim(F.col("loan_type"))) == V.PRODUCTS[1].upper(), V.SCORECARD_AUTO)
        .otherwise(0),
        F.when(F.col("fed_funds_rate") > 4, V.SCORECARD_FED_ABOVE_4).otherwise(0),
    ]
    total = reduce(lambda a, b: a + b, points)
    return clamp(total, V.SCORECARD_FLOOR, V.SCORECARD_CEILING).cast("double") / 1000


def loan_outcome(date: Column, as_of: str = V.OBSERVATION_END) -> Column:
    """(is_default, loan_status) once the observation window closes at ``as_of``.

    A default that would fall after the window has not happened yet: the loan is current.  A loan
    without default whose term ended inside the window is paid off.  Otherwise the given status
    stands.
    """
    horizon = F.lit(as_of).cast("date")
    defaulted = F.col("is_default") == 1
    default_day = F.date_add(date, F.col("months_to_default") * V.DAYS_PER_MONTH)
    maturity = F.date_add(date, F.col("term_months") * V.DAYS_PER_MONTH)
    pending = defaulted & (default_day > horizon)
    status = (
        F.when(pending, "Current")
        .when(~defaulted & (maturity <= horizon), "Paid Off")
        .otherwise(F.col("loan_status"))
    )
    return F.struct(
        F.when(pending, 0).otherwise(F.col("is_default")).alias("is_default"),
        status.alias("loan_status"),
    )


def format_loan_id(loan_type: Column, year: Column, sequence: Column,
                   prefix: str = V.LOAN_ID_PREFIX) -> Column:
    return F.concat_ws(
        "-", F.lit(prefix), F.upper(F.substring(loan_type, 1, 3)), year.cast("string"),
        F.lpad(sequence.cast("string"), 7, "0"),
    )


def format_short_loan_id(sequence: Column) -> Column:
    return F.concat(F.lit("LN"), F.lpad(sequence.cast("string"), 8, "0"))


# ---------------------------------------------------------------- early-warning flags

def warning_flags() -> dict[str, Column]:
    return {
        "flag_poor_credit": flag(F.col("credit_score") < V.WARN_SCORE_BELOW),
        "flag_high_dti": flag(F.col("dti_ratio") > V.WARN_DTI_ABOVE),
        "flag_high_ltv": flag(F.col("ltv_ratio") > V.WARN_LTV_ABOVE),
        "flag_delinquency": flag(F.col("num_delinquencies") > V.WARN_DELINQUENCIES_ABOVE),
        "flag_inquiry_spike": flag(F.col("num_inquiries_12m") > V.WARN_INQUIRIES_ABOVE),
        "flag_model_high_risk": flag(F.col("ensemble_default_prob") > V.WARN_PROBABILITY_ABOVE),
        "flag_anomaly": flag(F.col("if_is_anomaly") == 1),
    }


def total_flags(names: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(n) for n in names])


# ---------------------------------------------------------------- hashing

def row_hash(*parts: Column | str, seed: int | str = 0) -> Column:
    """Hex digest of the parts and a seed: the same row gets the same value in every run."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))

