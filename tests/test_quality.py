from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import catalog
from riskweave.operators import quality
from riskweave.schemas import LOANS_CLEAN_CONTRACT, RAW_LOANS_CONTRACT


def as_dict(df):
    return {r["rule"]: r["violations"] for r in df.collect()}


def test_profile_counts_each_rule_once_per_row(loan):
    df = loan({}, {"loan_amount": 0.0, "credit_score": 299}, {"credit_score": 851}, {"dti_ratio": -0.1},
              {"dti_ratio": 100.0}, {"loan_id": None}, {"loan_type": None, "is_default": 2})
    assert as_dict(quality.dq_profile(df)) == {
        "invalid_loan_amount": 1, "invalid_credit_score": 2, "invalid_dti": 1,
        "null_key_fields": 2, "invalid_target": 1,
    }


def test_unknown_value_breaks_no_rule_but_is_filtered(loan):
    df = loan({"loan_amount": None}, {"credit_score": None}, {"dti_ratio": None}, {"is_default": None})
    assert quality.dq_profile(df).count() == 0
    assert quality.dq_filter(df).count() == 0


def test_boundaries_pass_the_filter(loan):
    df = loan({"credit_score": 300}, {"credit_score": 850}, {"dti_ratio": 0.0}, {"dti_ratio": 100.0})
    assert quality.dq_filter(df).count() == 4


def test_table_variant_keeps_rows_without_keys(loan):
    df = loan({"loan_id": None}, {"loan_type": None})
    assert quality.dq_filter_sql(df).count() == 2
    assert quality.dq_filter(df).count() == 0


def test_quarantine_and_filter_agree(spark, sf):
    raw = catalog.raw(spark, sf)
    clean, rejects = quality.dq_quarantine(raw)
    assert clean.count() == quality.dq_filter(raw).count()
    assert clean.count() + rejects.count() == raw.count()
    assert rejects.where(F.size("broken_rules") == 0).count() == 0


def test_quarantine_names_every_broken_rule(loan):
    _, rejects = quality.dq_quarantine(loan({"loan_amount": -1.0, "dti_ratio": 101.0, "loan_type": None}))
    assert rejects.first()["broken_rules"] == ["invalid_loan_amount", "invalid_dti", "null_key_fields"]


def test_extended_rules(loan):
    df = loan({"loan_id": "A"}, {"loan_id": "A"}, {"loan_id": "A"}, {"annual_income": 0.0},
              {"loan_type": "Boat"}, {"interest_rate": 30.5}, {"origination_year": 2017})
    counts = as_dict(quality.dq_extended(df))
    assert counts["duplicate_loan_id"] == 2
    assert counts["non_positive_income"] == counts["unknown_loan_type"] == 1
    assert counts["interest_rate_out_of_range"] == counts["origination_year_out_of_range"] == 1


def test_domain_rules(loan):
    df = loan({}, {"loan_id": "MRD-MOR-2021-0000001"}, {"loan_id": "X1"}, {"term_months": 48},
              {"loan_type": "AUTO", "term_months": 48}, {"loan_status": "Late"}, {"vehicle_type": "Old"})
    counts = as_dict(quality.dq_domains(df))
    assert counts["loan_id_format"] == counts["term_months_domain"] == 1
    assert counts["loan_status_domain"] == counts["vehicle_type_domain"] == 1
    assert counts["property_type_domain"] == 0


def test_contract(loan):
    df = loan({"loan_id": "A"}, {"loan_id": "A"}, {"loan_type": None}, {"state": "California"},
              {"loan_type": "a much too long type"})
    counts = as_dict(quality.check_contract(df, RAW_LOANS_CONTRACT))
    assert counts["primary_key"] == counts["not_null:loan_type"] == 1
    assert counts["max_length:state"] == counts["max_length:loan_type"] == 1
    assert "origination_date" in LOANS_CLEAN_CONTRACT.not_null


def test_contract_counts_duplicates_of_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("loan_id"),
        F.lit("Auto").alias("loan_type"),
    )
    assert as_dict(quality.check_contract(df, RAW_LOANS_CONTRACT))["primary_key"] == 999


def test_outside_domain(spark):
    df = spark.createDataFrame([("Auto",), ("Boat",), (None,)], T.StructType([T.StructField("t", T.StringType())]))
    assert [r["t"] for r in quality.outside_domain(df, "t", ["Auto", "Mortgage"]).collect()] == ["Boat"]


def test_summary_is_one_row(spark, sf):
    row = quality.dq_summary(catalog.raw(spark, sf), 35).first()
    assert row["raw_rows"] == row["clean_rows"] + row["removed_rows"]
    assert row["issues"].count("=") == 5
