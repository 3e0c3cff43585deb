import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskweave.schemas import RAW_LOANS  # noqa: E402
from riskweave.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "riskweave-tests", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def loan(spark):
    """Function building a raw loan frame from dictionaries of the fields that matter."""
    base = {
        "loan_id": "LN00000001", "loan_type": "Mortgage", "origination_date": dt.date(2021, 5, 3),
        "origination_year": 2021, "origination_quarter": "Q2", "loan_amount": 250000.0,
        "term_months": 360, "interest_rate": 5.125, "loan_purpose": "Purchase", "ltv_ratio": 80.0,
        "monthly_payment": 1500.0, "borrower_age": 40, "annual_income": 90000.0,
        "monthly_income": 7500.0, "employment_years": 5.0, "is_self_employed": 0,
        "employment_sector": "Energy", "state": "CA", "credit_score": 700, "credit_tier": "Good",
        "dti_ratio": 30.0, "num_open_accounts": 4, "num_delinquencies": 0, "num_inquiries_12m": 1,
        "fed_funds_rate": 0.06, "property_type": "Condo", "property_value": 312500.0,
        "loan_status": "Current", "is_default": 0, "default_probability": 0.05,
    }

    def build(*rows, schema=RAW_LOANS):
        filled = [base | {"loan_id": f"LN{i:08d}"} | row for i, row in enumerate(rows, start=1)]
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in filled], schema)

    return build
