"""Data-quality rules, filters, quarantine and table contracts.

Each rule is a Column that is true for a violating row.  All rules of a profile are counted in
one aggregation over one scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import percent_of_rows, rate_mean, round_half_up
from riskweave.schemas import Contract


def _outside(name: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return (F.col(name) < low) | (F.col(name) > high)


def basic_rules() -> dict[str, Column]:
    """Five load rules.  An unknown value violates none of them (three-valued logic)."""
    return {
        "invalid_loan_amount": F.col("loan_amount") <= 0,
        "invalid_credit_score": _outside("credit_score", V.CREDIT_SCORE_RANGE),
        "invalid_dti": _outside("dti_ratio", V.DTI_RANGE),
        "null_key_fields": F.col("loan_id").isNull() | F.col("loan_type").isNull(),
        "invalid_target": ~F.col("is_default").isin(0, 1),
    }


def extended_rules() -> dict[str, Column]:
    """Further rules on a raw frame; uniqueness is added by :func:`dq_extended`."""
    missing = {
        f"null_{c}": F.col(c).isNull()
        for c in ("loan_id", "loan_type", "loan_amount", "credit_score", "is_default")
    }
    return {
        "non_positive_income": F.col("annual_income") <= 0,
        "unknown_loan_type": ~F.col("loan_type").isin(V.PRODUCTS),
        **missing,
        "interest_rate_out_of_range": _outside("interest_rate", V.INTEREST_RATE_RANGE),
        "origination_year_out_of_range": _outside("origination_year", V.YEAR_RANGE),
    }


def domain_rules() -> dict[str, Column]:
    """Documented formats and word lists."""
    kind = F.upper(F.trim("loan_type"))
    mortgage, auto = (kind == p.upper() for p in V.PRODUCTS)
    return {
        "loan_id_format": ~F.col("loan_id").rlike(V.LOAN_ID_PATTERN),
        "term_months_domain": (mortgage & ~F.col("term_months").isin(V.MORTGAGE_TERMS))
        | (auto & ~F.col("term_months").isin(V.AUTO_TERMS)),
        "loan_purpose_domain": ~F.col("loan_purpose").isin(V.PURPOSES),
        "credit_tier_domain": ~F.col("credit_tier").isin(V.CREDIT_TIERS),
        "property_type_domain": ~F.col("property_type").isin(V.PROPERTY_TYPES),
        "vehicle_type_domain": ~F.col("vehicle_type").isin(V.VEHICLE_TYPES),
        "loan_status_domain": ~F.col("loan_status").isin(V.LOAN_STATUSES),
    }


def _long(counts: DataFrame, rules: list[str]) -> DataFrame:
    """One wide row of counts -> (rule, violations)."""
    pairs = ", ".join(f"'{r}', `{r}`" for r in rules)
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, violations)")


def count_rules(df: DataFrame, rules: dict[str, Column], keep_zero: bool = False) -> DataFrame:
    counts = df.agg(*[F.count_if(condition).alias(rule) for rule, condition in rules.items()])
    long = _long(counts, list(rules))
    return long if keep_zero else long.where("violations > 0")


def dq_profile(df: DataFrame) -> DataFrame:
    """(rule, violations) of the load rules that found something.

    A row that breaks two rules is counted under both.
    """
    return count_rules(df, basic_rules())


def surplus_rows(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """(rule, violations): rows beyond the first of every complete key.

    Only the key is shuffled, after map-side counting: a key repeated in a third of the rows reaches
    its reducer as one count per task.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.where(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    surplus = F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0))
    return per_key.agg(surplus.alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def dq_extended(df: DataFrame) -> DataFrame:
    """(rule, violations) of the extended rules, zero counts included.

    The rules are one scan with a one-row result; uniqueness reads just the id.
    """
    counts = count_rules(df, extended_rules(), keep_zero=True)
    return counts.unionByName(surplus_rows(df, ["loan_id"], "duplicate_loan_id"))


def dq_domains(df: DataFrame) -> DataFrame:
    return count_rules(df, domain_rules(), keep_zero=True)


def dq_filter(df: DataFrame) -> DataFrame:
    """Rows with valid amount, score, ratio and target and with both keys (file variant)."""
    return dq_filter_sql(df).where(F.col("loan_id").isNotNull() & F.col("loan_type").isNotNull())


def dq_filter_sql(df: DataFrame) -> DataFrame:
    """Rows with valid amount, score, ratio and target (table variant: keys are not tested)."""
    return df.where(
        (F.col("loan_amount") > 0)
        & F.col("credit_score").between(*V.CREDIT_SCORE_RANGE)
        & F.col("dti_ratio").between(*V.DTI_RANGE)
        & F.col("is_default").isin(0, 1)
    )


def broken_rules(rules: dict[str, Column] | None = None) -> Column:
    """Names of the rules a row breaks, as an array; a NULL where a value is needed counts too."""
    rules = rules or basic_rules() | {
        "missing_value": reduce(
            lambda a, b: a | b,
            [F.col(c).isNull() for c in ("loan_amount", "credit_score", "dti_ratio", "is_default")],
        )
    }
    return F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()]), lambda x: x.isNotNull())


def dq_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects): the file filter, and the rows it drops with the rules they broke."""
    marked = df.withColumn("broken_rules", broken_rules())
    clean = marked.where(F.size("broken_rules") == 0).drop("broken_rules")
    return clean, marked.where(F.size("broken_rules") > 0)


def dq_summary(raw: DataFrame, n_columns: int) -> DataFrame:
    """One row: raw, clean and removed counts, column count and the issues found, in one scan."""
    rules = basic_rules()
    ok = F.size(broken_rules()) == 0
    issues = F.filter(
        F.array(*[F.when(F.col(r) > 0, F.concat(F.lit(f"{r}="), F.col(r).cast("string"))) for r in rules]),
        lambda x: x.isNotNull(),
    )
    counts = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(ok).alias("clean_rows"),
        *[F.count_if(c).alias(r) for r, c in rules.items()],
    )
    return counts.select(
        "raw_rows", "clean_rows", (F.col("raw_rows") - F.col("clean_rows")).alias("removed_rows"),
        F.lit(n_columns).cast("bigint").alias("n_columns"),
        reduce(lambda a, b: a + b, [F.col(r) for r in rules]).alias("total_issues"),
        F.array_join(issues, ";").alias("issues"),
    )


def verify_load(df: DataFrame) -> DataFrame:
    """Totals of a loaded raw table."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.sum("is_default").alias("total_defaults"),
        round_half_up(percent_of_rows("is_default"), 2).alias("default_rate_pct"),
        F.count_distinct("loan_type").alias("loan_types"),
        F.min("origination_date").alias("earliest_loan"),
        F.max("origination_date").alias("latest_loan"),
    )


def verify_clean(df: DataFrame) -> DataFrame:
    """Totals of a clean table per product."""
    return df.groupBy("loan_type").agg(
        F.count(F.lit(1)).alias("records"),
        round_half_up(percent_of_rows("is_default"), 2).alias("default_rate_pct"),
        round_half_up(F.avg("credit_score"), 0).alias("avg_credit_score"),
        round_half_up(rate_mean("dti_ratio"), 1).alias("avg_dti"),
        round_half_up(rate_mean("risk_score"), 1).alias("avg_risk_score"),
        F.sum("is_high_risk").alias("high_risk_count"),
    )


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations) for NOT NULL, text length and primary key.

    ``primary_key`` counts the surplus rows of repeated keys.
    """
    rules = {f"not_null:{c}": F.col(c).isNull() for c in contract.not_null}
    rules |= {
        f"max_length:{c}": F.length(c) > limit
        for c, limit in contract.max_length.items() if c in df.columns
    }
    counts = count_rules(df, rules, keep_zero=True)
    return counts.unionByName(surplus_rows(df, contract.primary_key, "primary_key"))


def outside_domain(df: DataFrame, column: str, domain: list) -> DataFrame:
    """Distinct values of a column that the domain does not list; empty when it is a subset."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    allowed = df.sparkSession.createDataFrame([(v,) for v in domain], values.schema)
    return values.exceptAll(allowed)
