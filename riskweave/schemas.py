"""Declared schemas of the four tables and the constraints that go with them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TS = T.DateType(), T.TimestampType()


def _struct(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


RAW_LOANS = _struct([
    ("loan_id", _S), ("loan_type", _S), ("origination_date", _DATE), ("origination_year", _I),
    ("origination_quarter", _S), ("loan_amount", _D), ("term_months", _I), ("interest_rate", _D),
    ("loan_purpose", _S), ("ltv_ratio", _D), ("monthly_payment", _D), ("borrower_age", _I),
    ("annual_income", _D), ("monthly_income", _D), ("employment_years", _D),
    ("is_self_employed", _I), ("employment_sector", _S), ("state", _S), ("credit_score", _I),
    ("credit_tier", _S), ("dti_ratio", _D), ("num_open_accounts", _I), ("num_delinquencies", _I),
    ("num_inquiries_12m", _I), ("fed_funds_rate", _D), ("property_type", _S),
    ("property_value", _D), ("vehicle_make", _S), ("vehicle_model", _S), ("vehicle_year", _I),
    ("vehicle_type", _S), ("loan_status", _S), ("is_default", _I), ("default_probability", _D),
    ("months_to_default", _I),
])

#: The same fields as they lie in a file: all text, so that a bad cell never fails a job.
RAW_LOANS_TEXT = _struct([(f.name, _S) for f in RAW_LOANS.fields])

_AFTER_QUARTER = RAW_LOANS.fieldNames().index("origination_quarter") + 1
LOANS_CLEAN = T.StructType(
    RAW_LOANS.fields[:_AFTER_QUARTER]
    + [T.StructField("origination_month", _I)]
    + RAW_LOANS.fields[_AFTER_QUARTER:]
    + _struct([
        ("loan_to_income_ratio", _D), ("payment_to_income_ratio", _D), ("rate_spread", _D),
        ("risk_score", _D), ("is_high_risk", _I), ("credit_score_bucket", _S), ("dti_bucket", _S),
        ("ltv_bucket", _S), ("income_bucket", _S), ("is_covid_period", _I),
        ("is_rate_hike_period", _I), ("processed_at", _TS),
    ]).fields
)

MODEL_SCORES = _struct([
    ("loan_id", _S), ("model_version", _S), ("scored_at", _TS), ("lr_default_prob", _D),
    ("lr_prediction", _I), ("xgb_default_prob", _D), ("xgb_prediction", _I),
    ("ensemble_default_prob", _D), ("ensemble_prediction", _I), ("if_anomaly_score", _D),
    ("if_is_anomaly", _I), ("risk_tier", _S),
])

INCOMING_SCORES = T.StructType(
    [f for f in MODEL_SCORES.fields if f.name not in ("model_version", "scored_at", "risk_tier")]
)

MODEL_PERFORMANCE = _struct([
    ("model_name", _S), ("model_version", _S), ("eval_date", _DATE), ("dataset", _S),
    ("n_samples", _L), ("n_defaults", _L), ("default_rate", _D), ("auc_roc", _D), ("auc_pr", _D),
    ("accuracy", _D), ("precision_score", _D), ("recall_score", _D), ("f1_score", _D),
    ("ks_statistic", _D), ("gini_coefficient", _D),
])


@dataclass(frozen=True)
class Contract:
    """Constraints of one table: required columns, primary key, longest text per column."""

    not_null: list[str]
    primary_key: list[str]
    max_length: dict[str, int] = field(default_factory=dict)


_TEXT_LENGTHS = {
    "loan_id": 30, "loan_type": 10, "origination_quarter": 2, "loan_purpose": 30,
    "employment_sector": 50, "state": 2, "credit_tier": 20, "property_type": 30,
    "vehicle_make": 30, "vehicle_model": 30, "vehicle_type": 30, "loan_status": 20,
}

RAW_LOANS_CONTRACT = Contract(["loan_id", "loan_type"], ["loan_id"], _TEXT_LENGTHS)
LOANS_CLEAN_CONTRACT = Contract(
    ["loan_id", "loan_type", "origination_date", "origination_year", "loan_amount",
     "term_months", "interest_rate", "credit_score", "is_default"],
    ["loan_id"],
    _TEXT_LENGTHS | {"credit_score_bucket": 10, "dti_bucket": 20, "ltv_bucket": 20,
                     "income_bucket": 25},
)
MODEL_SCORES_CONTRACT = Contract(
    ["loan_id", "model_version"], ["loan_id", "model_version"],
    {"loan_id": 30, "model_version": 20, "risk_tier": 10},
)
MODEL_PERFORMANCE_CONTRACT = Contract(
    ["model_name", "model_version"], ["model_name", "model_version", "dataset"],
    {"model_name": 50, "model_version": 20, "dataset": 10},
)
