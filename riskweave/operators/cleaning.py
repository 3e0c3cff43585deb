"""Cleaning of raw loan fields: dates, text case and blanks, rounding, missing counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.numeric import round_half_up

UPPER_TRIMMED = ["loan_type", "state"]
TRIMMED = ["credit_tier", "loan_status", "employment_sector"]
ROUNDED = {"interest_rate": 3, "dti_ratio": 2, "ltv_ratio": 2, "annual_income": 2, "monthly_income": 2}
FILLED = {"num_delinquencies": 0, "num_inquiries_12m": 0, "months_to_default": -1}


def parse_origination_date(df: DataFrame) -> DataFrame:
    """ISO text to date; text that is no date becomes NULL instead of failing the job."""
    if dict(df.dtypes)["origination_date"] == "date":
        return df
    return df.withColumn("origination_date", F.try_to_date("origination_date", "yyyy-MM-dd"))


def clean_loans(df: DataFrame) -> DataFrame:
    """All cleaning steps as one projection."""
    return parse_origination_date(df).withColumns(
        {c: F.upper(F.trim(c)) for c in UPPER_TRIMMED}
        | {c: F.trim(c) for c in TRIMMED}
        | {c: round_half_up(c, n) for c, n in ROUNDED.items()}
        | {c: F.coalesce(c, F.lit(v)) for c, v in FILLED.items()}
    )


def with_audit_columns(df: DataFrame, job_name: str) -> DataFrame:
    """When and by which job a row was produced."""
    return df.withColumns({"etl_processed_at": F.current_timestamp(), "etl_job_name": F.lit(job_name)})
