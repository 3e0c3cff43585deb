"""Feature engineering in its three variants, each as one projection.

``etl``       cleaned files: nulls filled, year/month/quarter from the date, Covid = March-December
              2020 by date.
``sql``       table form: inputs as they are (a NULL input gives a NULL score), year from the raw
              column.
``notebook``  model inputs: ordinal bands, array-library rounding, Covid = all of 2020.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import risk
from riskweave.functions.numeric import round_half_even, round_half_up
from riskweave.operators.cleaning import parse_origination_date
from riskweave.schemas import LOANS_CLEAN

VARIANTS = ("etl", "sql", "notebook")


def _bands() -> dict:
    return {
        "credit_score_bucket": risk.credit_score_bucket(),
        "dti_bucket": risk.dti_bucket(),
        "ltv_bucket": risk.ltv_bucket(),
        "income_bucket": risk.income_bucket(),
    }


def _shared(rounded) -> dict:
    return {
        "loan_to_income_ratio": rounded(risk.loan_to_income(), 4),
        "rate_spread": rounded(risk.rate_spread(), 3),
        "risk_score": rounded(risk.risk_score(), 2),
        "is_high_risk": risk.is_high_risk(),
    }


def engineer_features(df: DataFrame, variant: str = "etl") -> DataFrame:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    df = parse_origination_date(df)
    date, raw_year = F.col("origination_date"), F.col("origination_year")
    if variant == "notebook":
        return df.withColumns(_shared(round_half_even) | {
            "payment_to_income_ratio": round_half_even(risk.payment_to_income("notebook"), 4),
            "is_covid_period": risk.is_covid_period(raw_year),
            "is_rate_hike_period": risk.is_rate_hike_period(raw_year),
            "is_mortgage": risk.is_mortgage(),
            "credit_score_bucket": risk.credit_score_ordinal(),
            "dti_bucket": risk.dti_ordinal(),
            "income_bucket": risk.income_ordinal(),
        })
    month = F.month(date)
    year = F.year(date) if variant == "etl" else raw_year
    columns = _shared(round_half_up) | _bands() | {
        "payment_to_income_ratio": round_half_up(risk.payment_to_income(), 4),
        "origination_month": month,
        "is_covid_period": risk.is_covid_period(year, month),
        "is_rate_hike_period": risk.is_rate_hike_period(year),
    }
    if variant == "etl":
        columns |= {"origination_year": year, "origination_quarter": risk.quarter_label(date)}
    else:
        columns |= {"months_to_default": F.coalesce("months_to_default", F.lit(-1))}
    return df.withColumns(columns)


def to_loans_clean(df: DataFrame) -> DataFrame:
    """The 48 columns of the clean table, by name, in table order and type."""
    if "processed_at" not in df.columns:
        df = df.withColumn("processed_at", F.current_timestamp())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LOANS_CLEAN.fields])
