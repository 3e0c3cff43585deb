"""SQL building blocks for the oracle: the sample loan book, scores, cleaning and features.

Runs on DuckDB over the same parquet tables; shares with the Spark code only the fixed values.
"""

from __future__ import annotations

from riskweave import fixed_values as V


def case_at_least(column: str, bands: list[tuple], otherwise: str) -> str:
    """CASE over lower bounds, highest first."""
    return "CASE " + " ".join(f"WHEN {column}>={low} THEN '{label}'" for low, label in bands) + f" ELSE '{otherwise}' END"


def case_below(column: str, bands: list[tuple], otherwise: str) -> str:
    """CASE over upper bounds, lowest first."""
    return "CASE " + " ".join(f"WHEN {column}<{high} THEN '{label}'" for high, label in bands) + f" ELSE '{otherwise}' END"


def case_ordinal(column: str, edges: list[float]) -> str:
    """Index of the right-closed interval."""
    bounds = [(a, b) for a, b in zip(edges, edges[1:])]
    whens = " ".join(
        f"WHEN {column}>{a}" + ("" if b == float("inf") else f" AND {column}<={b}") + f" THEN {i}"
        for i, (a, b) in enumerate(bounds, start=1))
    return f"CAST(CASE {whens} END AS INT)"


def flag(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS INT)"


def in_list(column: str, values: list) -> str:
    return f"{column} IN (" + ",".join(repr(v) for v in values) + ")"


_FED_ROWS = ",".join(f"({y},{q},{round(rate * 100)})" for y, q, rate in V.FED_FUNDS_QUARTERLY)
FED = f"fed AS (SELECT * FROM (VALUES {_FED_ROWS}) AS t(fy,fq,fc))"

LOANS_RAW = FED + """,
li AS (SELECT l_orderkey, SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS n_ret FROM lineitem GROUP BY l_orderkey),
b AS (SELECT o_orderkey AS k, o_custkey AS ck, o_totalprice AS amt, c_acctbal, c_mktsegment, n_name, n_ret,
  CAST(o_orderdate + INTERVAL '23' YEAR AS DATE) AS od,
  CASE WHEN o_orderkey % 25 < 14 THEN 'Mortgage' ELSE 'Auto' END AS lt,
  480 + (o_orderkey*101) % 186 + (o_custkey*37 + o_orderkey) % 186 AS cs,
  500 + (o_orderkey*13 + o_custkey*7) % 5001 AS dti_c, 5000 + (o_orderkey*29) % 5001 AS ltv_c
  FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey LEFT JOIN li ON l_orderkey=o_orderkey),
p AS (SELECT b.*, coalesce(fc, 250) AS fc2,
  CASE WHEN lt='Mortgage' THEN CASE WHEN k%20=0 THEN 180 WHEN k%20<3 THEN 240 ELSE 360 END
       ELSE CASE WHEN k%20<2 THEN 36 WHEN k%20<5 THEN 48 WHEN k%20<12 THEN 60 WHEN k%20<17 THEN 72 ELSE 84 END END AS term,
  greatest(1, 5 + CASE WHEN cs<580 THEN 18 WHEN cs<620 THEN 12 WHEN cs<660 THEN 7 WHEN cs<700 THEN 3 WHEN cs<740 THEN 1 ELSE -2 END
    + CASE WHEN dti_c>5000 THEN 10 WHEN dti_c>4300 THEN 6 WHEN dti_c>3600 THEN 3 WHEN dti_c<2000 THEN -2 ELSE 0 END
    + CASE WHEN lt<>'Mortgage' THEN 2 WHEN ltv_c>9500 THEN 8 WHEN ltv_c>9000 THEN 5 WHEN ltv_c>8000 THEN 2 WHEN ltv_c<6000 THEN -2 ELSE 0 END
    + CASE WHEN ck%400<10 THEN 4 WHEN ck%400<20 THEN 2 ELSE 0 END + CASE WHEN ck%20<3 THEN 3 ELSE 0 END
    + CASE WHEN year(od)=2020 THEN 4 WHEN year(od) IN (2022,2023) THEN 3 ELSE 0 END
    + CASE WHEN coalesce(fc,250)>400 THEN 2 ELSE 0 END) AS pts
  FROM b LEFT JOIN fed ON fy=year(od) AND fq=quarter(od)),
d AS (SELECT p.*, CASE WHEN (k*7919+ck*31)%10007 < pts*100 THEN 1 ELSE 0 END AS dflt FROM p),
loans_raw AS (SELECT
 CASE WHEN k%977=4 THEN NULL ELSE concat('LN', lpad(CAST(k AS VARCHAR),8,'0')) END AS loan_id,
 CASE WHEN k%971=5 THEN NULL ELSE lt END AS loan_type,
 CASE WHEN k%953=7 THEN '2020-13-45' ELSE CAST(od AS VARCHAR) END AS origination_date,
 CAST(year(od) AS INT) AS origination_year, concat('Q', CAST(quarter(od) AS VARCHAR)) AS origination_quarter,
 CASE WHEN k%997=1 THEN -amt ELSE amt END AS loan_amount, CAST(term AS INT) AS term_months,
 CAST(least(24000, greatest(2000, fc2*10 + CASE WHEN lt='Mortgage' THEN 1800 ELSE 3500 END + greatest(0,(720-cs)*15) + (k%61-30)*10)) AS DOUBLE)/CAST(1000 AS DOUBLE) AS interest_rate,
 CASE WHEN lt='Auto' THEN CASE WHEN k%5=0 THEN 'Refinance' ELSE 'Purchase' END WHEN k%20<11 THEN 'Purchase' WHEN k%20<17 THEN 'Refinance' ELSE 'Cash-Out Refinance' END AS loan_purpose,
 CAST(ltv_c AS DOUBLE)/CAST(100 AS DOUBLE) AS ltv_ratio,
 CAST(floor(amt*105/term) AS DOUBLE)/CAST(100 AS DOUBLE) AS monthly_payment,
 CAST(22 + ck%54 AS INT) AS borrower_age,
 25000 + (c_acctbal+1000)*20 AS annual_income,
 CAST(floor((25000 + (c_acctbal+1000)*20)*100/12) AS DOUBLE)/CAST(100 AS DOUBLE) AS monthly_income,
 CAST(ck%400 AS DOUBLE)/CAST(10 AS DOUBLE) AS employment_years,
 CAST(CASE WHEN ck%20<3 THEN 1 ELSE 0 END AS INT) AS is_self_employed,
 c_mktsegment AS employment_sector, concat(' ', lower(n_name)) AS state,
 CAST(CASE WHEN k%991=2 THEN 900 ELSE cs END AS INT) AS credit_score,
 """ + case_at_least("cs", V.CREDIT_TIERS_AT_LEAST, V.CREDIT_TIER_ELSE) + """ AS credit_tier,
 CAST(CASE WHEN k%983=3 THEN 12000 ELSE dti_c END AS DOUBLE)/CAST(100 AS DOUBLE) AS dti_ratio,
 CAST(1 + ck%25 AS INT) AS num_open_accounts, CAST(n_ret AS INT) AS num_delinquencies,
 CAST(CASE WHEN k%211=0 THEN NULL ELSE k%7 END AS INT) AS num_inquiries_12m,
 CAST(fc2 AS DOUBLE)/CAST(100 AS DOUBLE) AS fed_funds_rate,
 CASE WHEN lt='Mortgage' THEN CASE WHEN k%20<13 THEN 'Single Family' WHEN k%20<17 THEN 'Condo' WHEN k%20<19 THEN 'Townhouse' ELSE 'Multi-Family' END END AS property_type,
 CASE WHEN lt='Mortgage' THEN CAST(floor(amt*1000000/ltv_c) AS DOUBLE)/CAST(100 AS DOUBLE) END AS property_value,
 CASE WHEN lt='Auto' THEN concat('Make', CAST(k%8 AS VARCHAR)) END AS vehicle_make,
 CASE WHEN lt='Auto' THEN concat('Model', CAST(k%29 AS VARCHAR)) END AS vehicle_model,
 CAST(CASE WHEN lt='Auto' THEN year(od) - k%6 END AS INT) AS vehicle_year,
 CASE WHEN lt='Auto' THEN CASE WHEN k%20<7 THEN 'New' WHEN k%20<16 THEN 'Used' ELSE 'Certified Pre-Owned' END END AS vehicle_type,
 CASE WHEN dflt=1 THEN CASE WHEN k%20<9 THEN 'Charged Off' WHEN k%20<16 THEN 'Default' ELSE '90+ DPD' END
      WHEN od + CAST(term*30 AS INT) <= DATE '2024-12-31' THEN 'Paid Off'
      WHEN k%100<93 THEN 'Current' WHEN k%100<97 THEN '30 DPD' ELSE '60 DPD' END AS loan_status,
 CAST(CASE WHEN k%967=6 THEN 2 ELSE dflt END AS INT) AS is_default,
 CAST(pts AS DOUBLE)/CAST(100 AS DOUBLE) AS default_probability,
 CAST(CASE WHEN dflt=1 THEN 1 + k%36 END AS INT) AS months_to_default
FROM d)"""

MODEL_SCORES = """sk AS (SELECT CAST(substr(loan_id,3) AS BIGINT) AS k, loan_id, CAST(round(default_probability*100) AS BIGINT) AS pts, v
  FROM loans_raw CROSS JOIN (VALUES ('v1.0'),('v0.9')) AS t(v) WHERE loan_id IS NOT NULL),
ss AS (SELECT sk.*, least(999,greatest(1, pts*15 + (k*17)%101 - 50)) AS lr, least(999,greatest(1, pts*20 + (k*23)%101 - 50)) AS xg FROM sk
  WHERE (v='v1.0' AND k%10<9) OR (v='v0.9' AND k%10<5)),
model_scores AS (SELECT loan_id, v AS model_version, CAST(lr AS DOUBLE)/CAST(1000 AS DOUBLE) AS lr_default_prob, CAST(CASE WHEN lr>=500 THEN 1 ELSE 0 END AS INT) AS lr_prediction,
 CAST(xg AS DOUBLE)/CAST(1000 AS DOUBLE) AS xgb_default_prob, CAST(CASE WHEN xg>=500 THEN 1 ELSE 0 END AS INT) AS xgb_prediction,
 CAST(lr+xg AS DOUBLE)/CAST(2000 AS DOUBLE) AS ensemble_default_prob, CAST(CASE WHEN lr+xg>=1000 THEN 1 ELSE 0 END AS INT) AS ensemble_prediction,
 -CAST(400+(k*41)%300 AS DOUBLE)/CAST(1000 AS DOUBLE) AS if_anomaly_score, CAST(CASE WHEN (k*41)%300>=285 THEN 1 ELSE 0 END AS INT) AS if_is_anomaly,
 CASE WHEN lr+xg>=1200 THEN 'CRITICAL' WHEN lr+xg>=800 THEN 'HIGH' WHEN lr+xg>=400 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM ss)"""


def r(expression: str, digits: int) -> str:
    """Decimal half-up rounding back to double."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,8)),{digits}) AS DOUBLE)"


def money(expression: str) -> str:
    """Exact sum."""
    return f"CAST(SUM(CAST(({expression}) AS DECIMAL(28,6))) AS DOUBLE)"


def mean(column: str) -> str:
    """Exact mean."""
    return f"(CAST(SUM(CAST({column} AS DECIMAL(28,12))) AS DOUBLE)/COUNT({column}))"


VALID = ("loan_amount > 0 AND credit_score BETWEEN 300 AND 850 "
         "AND dti_ratio BETWEEN 0 AND 100 AND is_default IN (0,1)")
VALID_KEYS = VALID + " AND loan_id IS NOT NULL AND loan_type IS NOT NULL"

#: Rows that the contract of the clean table takes; of its other columns none is ever null or too long.
TAKEN = " AND ".join(f"{c} IS NOT NULL" for c in (
    "loan_id", "loan_type", "origination_date", "origination_year", "loan_amount", "term_months", "interest_rate",
    "credit_score", "is_default"))

CLEANED = f"""cleaned AS (SELECT * REPLACE (
 TRY_CAST(origination_date AS DATE) AS origination_date,
 upper(trim(loan_type)) AS loan_type, upper(trim(state)) AS state, trim(credit_tier) AS credit_tier,
 trim(loan_status) AS loan_status, trim(employment_sector) AS employment_sector,
 {r('interest_rate', 3)} AS interest_rate, {r('dti_ratio', 2)} AS dti_ratio, {r('ltv_ratio', 2)} AS ltv_ratio,
 {r('annual_income', 2)} AS annual_income, {r('monthly_income', 2)} AS monthly_income,
 coalesce(num_delinquencies,0) AS num_delinquencies, coalesce(num_inquiries_12m,0) AS num_inquiries_12m,
 coalesce(months_to_default,-1) AS months_to_default) FROM loans_raw WHERE {VALID_KEYS})"""

_SCORE = " + ".join([
    f"({V.SCORE_CEILING}-credit_score)/CAST({V.SCORE_SPAN} AS DOUBLE)*CAST({V.SCORE_WEIGHT} AS DOUBLE)",
    f"dti_ratio/CAST({V.DTI_DIVISOR} AS DOUBLE)", f"ltv_ratio/CAST({V.LTV_DIVISOR} AS DOUBLE)",
    f"num_delinquencies*{V.DELINQUENCY_WEIGHT}", f"num_inquiries_12m*{V.INQUIRY_WEIGHT}",
])
_HIGH = flag(" OR ".join([
    f"credit_score<{V.HIGH_RISK_SCORE_BELOW}", f"dti_ratio>{V.HIGH_RISK_DTI_ABOVE}",
    f"ltv_ratio>{V.HIGH_RISK_LTV_ABOVE}", f"num_delinquencies>{V.HIGH_RISK_DELINQUENCIES_ABOVE}",
]))
_BANDS = ", ".join(f"{case} AS {name}" for name, case in {
    "credit_score_bucket": case_at_least("credit_score", V.CREDIT_SCORE_BANDS_AT_LEAST, V.CREDIT_SCORE_BAND_ELSE),
    "dti_bucket": case_below("dti_ratio", V.DTI_BANDS_BELOW, V.DTI_BAND_ELSE),
    "ltv_bucket": case_below("ltv_ratio", V.LTV_BANDS_BELOW, V.LTV_BAND_ELSE),
    "income_bucket": case_below("annual_income", V.INCOME_BANDS_BELOW, V.INCOME_BAND_ELSE),
}.items())
_RATIOS = f"""{r('loan_amount/NULLIF(annual_income,0)', 4)} AS loan_to_income_ratio,
 {r('monthly_payment/NULLIF(monthly_income,0)', 4)} AS payment_to_income_ratio,
 {r('interest_rate-fed_funds_rate', 3)} AS rate_spread, {r(_SCORE, 2)} AS risk_score, {_HIGH} AS is_high_risk,
 {_BANDS}"""

FEATURES_ETL = f"""features_etl AS (SELECT * EXCLUDE (origination_year, origination_quarter),
 CAST(year(origination_date) AS INT) AS origination_year,
 'Q' || CAST(quarter(origination_date) AS VARCHAR) AS origination_quarter,
 CAST(month(origination_date) AS INT) AS origination_month, {_RATIOS},
 {flag('year(origination_date)=2020 AND month(origination_date) BETWEEN 3 AND 12')} AS is_covid_period,
 {flag('year(origination_date) IN (2022,2023)')} AS is_rate_hike_period
FROM cleaned)"""

_TYPED = "typed AS (SELECT * REPLACE (TRY_CAST(origination_date AS DATE) AS origination_date) FROM loans_raw)"
_CLEAN = f"""(SELECT * REPLACE (coalesce(months_to_default,-1) AS months_to_default),
 CAST(month(origination_date) AS INT) AS origination_month, {_RATIOS},
 {flag('origination_year=2020 AND month(origination_date)>=3')} AS is_covid_period,
 {flag('origination_year IN (2022,2023)')} AS is_rate_hike_period
FROM typed WHERE {VALID})"""

FEATURES_SQL = f"""{_TYPED},
loans AS {_CLEAN}"""

#: What a load under the contract leaves of them.
ACCEPTED = f"""{_TYPED},
offered AS {_CLEAN},
loans AS (SELECT * FROM offered WHERE {TAKEN})"""

_np = lambda e, n: f"(round_even(({e})*1e{n}::DOUBLE, 0)/1e{n}::DOUBLE)"
FEATURES_NOTEBOOK = f"""features_notebook AS (SELECT *,
 {_np('loan_amount/NULLIF(annual_income,0)', 4)} AS loan_to_income_ratio,
 {_np('loan_amount/NULLIF(interest_rate,0)/NULLIF(monthly_income,0)', 4)} AS payment_to_income_ratio,
 {_np('interest_rate-fed_funds_rate', 3)} AS rate_spread, {_np(_SCORE, 2)} AS risk_score, {_HIGH} AS is_high_risk,
 {flag('origination_year=2020')} AS is_covid_period,
 {flag('origination_year IN (2022,2023)')} AS is_rate_hike_period,
 {flag("loan_type='MORTGAGE'")} AS is_mortgage,
 {case_ordinal('credit_score', V.CREDIT_SCORE_EDGES)} AS credit_score_bucket,
 {case_ordinal('dti_ratio', V.DTI_EDGES)} AS dti_bucket,
 {case_ordinal('annual_income', V.INCOME_EDGES)} AS income_bucket
FROM cleaned)"""

_CTES = {
    "loans_raw": (LOANS_RAW, []),
    "model_scores": (MODEL_SCORES, ["loans_raw"]),
    "cleaned": (CLEANED, ["loans_raw"]),
    "features_etl": (FEATURES_ETL, ["cleaned"]),
    "loans": (FEATURES_SQL, ["loans_raw"]),
    "accepted": (ACCEPTED, ["loans_raw"]),
    "features_notebook": (FEATURES_NOTEBOOK, ["cleaned"]),
}


def query(needs: list[str], body: str, extra: str = "") -> str:
    """``WITH`` the named blocks (and what they need) in front of a SELECT."""
    order: list[str] = []

    def add(name: str) -> None:
        for dependency in _CTES[name][1]:
            add(dependency)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    parts = [_CTES[name][0] for name in order] + ([extra] if extra else [])
    return "WITH " + ",\n".join(parts) + "\n" + body
