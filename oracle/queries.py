"""Oracle SQL per registered query."""

from __future__ import annotations

from oracle.base import (
    TAKEN, VALID, VALID_KEYS, case_at_least, flag, in_list, mean, money, query, r,
)
from riskweave import fixed_values as V
from riskweave.schemas import (
    LOANS_CLEAN, LOANS_CLEAN_CONTRACT, MODEL_PERFORMANCE_CONTRACT, MODEL_SCORES_CONTRACT, RAW_LOANS_CONTRACT, Contract,
)

RATE = r("AVG(is_default)*100", 2) + " AS default_rate_pct"
SCORE = r("AVG(credit_score)", 0) + " AS avg_credit_score"
BAD_AMOUNT = money("CASE WHEN is_default=1 THEN loan_amount ELSE 0 END")
AMOUNT = money("loan_amount")


def tier(column: str) -> str:
    return case_at_least(column, V.RISK_TIERS_AT_LEAST, V.RISK_TIER_ELSE)


def big(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


def count_if(condition: str) -> str:
    return big(f"COUNT(*) FILTER (WHERE {condition})")


def _of(column: str, value: str) -> str:
    return count_if(f"{column}='{value}'")


def _rate_of(product: str) -> str:
    return f"AVG(is_default) FILTER (WHERE loan_type='{product}')*100"


BASIC = {
    "invalid_loan_amount": "loan_amount <= 0",
    "invalid_credit_score": "credit_score < 300 OR credit_score > 850",
    "invalid_dti": "dti_ratio < 0 OR dti_ratio > 100",
    "null_key_fields": "loan_id IS NULL OR loan_type IS NULL",
    "invalid_target": "is_default NOT IN (0,1)",
}
EXTENDED = {
    "non_positive_income": "annual_income <= 0",
    "unknown_loan_type": "loan_type NOT IN ('Mortgage','Auto')",
    **{f"null_{c}": f"{c} IS NULL" for c in ("loan_id", "loan_type", "loan_amount", "credit_score", "is_default")},
    "interest_rate_out_of_range": "interest_rate < 0 OR interest_rate > 30",
    "origination_year_out_of_range": "origination_year < 2018 OR origination_year > 2024",
}
DOMAINS = {
    "loan_id_format": f"NOT regexp_matches(loan_id, '{V.LOAN_ID_PATTERN}')",
    "term_months_domain": " OR ".join(
        f"(upper(loan_type)='{p.upper()}' AND NOT {in_list('term_months', terms)})"
        for p, terms in zip(V.PRODUCTS, (V.MORTGAGE_TERMS, V.AUTO_TERMS))),
    **{f"{column}_domain": f"NOT {in_list(column, words)}" for column, words in {
        "loan_purpose": V.PURPOSES, "credit_tier": V.CREDIT_TIERS, "property_type": V.PROPERTY_TYPES,
        "vehicle_type": V.VEHICLE_TYPES, "loan_status": V.LOAN_STATUSES}.items()},
}


def rules_sql(rules: dict[str, str], source: str = "loans_raw") -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, {count_if(c)} AS violations FROM {source}" for n, c in rules.items())


_broken = "list_filter([" + ",".join(
    f"CASE WHEN {c} THEN '{n}' END" for n, c in BASIC.items()
) + ",CASE WHEN loan_amount IS NULL OR credit_score IS NULL OR dti_ratio IS NULL OR is_default IS NULL THEN 'missing_value' END], lambda x: x IS NOT NULL)"

_issues = "concat_ws(';'," + ",".join(
    f"CASE WHEN {n}>0 THEN concat('{n}=', {n}) END" for n in BASIC) + ")"


def contract_sql(contract: Contract, source: str) -> str:
    """(rule, violations) of a contract; all columns are those of the table."""
    rules = {f"not_null:{c}": f"{c} IS NULL" for c in contract.not_null}
    rules |= {f"max_length:{c}": f"length({c}) > {n}" for c, n in contract.max_length.items()}
    keys = ", ".join(contract.primary_key)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in contract.primary_key)
    return rules_sql(rules, source) + (
        f" UNION ALL SELECT 'primary_key', CAST(coalesce(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM {source} WHERE {whole} GROUP BY {keys})")


OVERVIEW = f"""SELECT loan_type, origination_year, COUNT(*) AS total_loans, {r(AMOUNT, 2)} AS total_exposure,
 {r(AMOUNT + '/COUNT(loan_amount)', 2)} AS avg_loan_amount, {big('SUM(is_default)')} AS total_defaults, {RATE}, {SCORE},
 {r(mean('dti_ratio'), 1)} AS avg_dti, {r(mean('interest_rate'), 2)} AS avg_interest_rate, {r(mean('ltv_ratio'), 1)} AS avg_ltv,
 {big('SUM(is_high_risk)')} AS high_risk_loans, {r(mean('risk_score'), 1)} AS avg_risk_score,
 {r('SUM(is_high_risk)/COUNT(*)*100', 2)} AS high_risk_pct, {r(BAD_AMOUNT, 2)} AS exposure_at_risk
 FROM loans GROUP BY loan_type, origination_year"""
TIERS = f"""SELECT origination_year, credit_tier, credit_score_bucket, loan_type, COUNT(*) AS loan_count,
 {big('SUM(is_default)')} AS defaults, {RATE}, {SCORE}, {r(AMOUNT + '/COUNT(loan_amount)', 2)} AS avg_loan_amount,
 {r(AMOUNT, 2)} AS total_exposure, {r(BAD_AMOUNT, 2)} AS defaulted_exposure
 FROM loans GROUP BY origination_year, credit_tier, credit_score_bucket, loan_type"""
GEOGRAPHY = f"""SELECT state, loan_type, COUNT(*) AS loan_count, {RATE}, {r(AMOUNT + '/1000000', 2)} AS total_exposure_millions,
 {SCORE}, {r(mean('dti_ratio'), 1)} AS avg_dti, {r(mean('risk_score'), 1)} AS avg_risk_score,
 {big('SUM(is_default)')} AS total_defaults, {r(BAD_AMOUNT + '/1000000', 2)} AS defaulted_exposure_millions
 FROM loans GROUP BY state, loan_type"""

_DECILES = "NTILE(10) OVER (ORDER BY risk_score DESC NULLS FIRST, md5(loan_id), loan_id)"

SCORED = "scored AS (SELECT s.*, l.is_default FROM model_scores s JOIN loans l USING (loan_id))"


def curve(source: str, by: str, score: str = "score") -> str:
    """Blocks pts/cum with running totals per distinct score."""
    part = f"PARTITION BY {by}" if by else ""
    cols = f"{by}, " if by else ""
    return f"""pts AS (SELECT {cols}{score} AS score, SUM(is_default) AS pos, SUM(1-is_default) AS neg FROM {source}
 WHERE {score} IS NOT NULL AND is_default IS NOT NULL GROUP BY ALL),
cum AS (SELECT *, SUM(pos) OVER (w ROWS UNBOUNDED PRECEDING) AS rp, SUM(neg) OVER (w ROWS UNBOUNDED PRECEDING) AS rn,
 SUM(pos) OVER ({part}) AS ap, SUM(neg) OVER ({part}) AS an FROM pts WINDOW w AS ({part} ORDER BY score))"""


_AUC = "SUM(CAST(pos AS HUGEINT)*CAST(2*rn-neg AS HUGEINT))::DOUBLE/(2*MAX(ap)::DOUBLE*MAX(an)::DOUBLE)"
_AP = "SUM(pos::DOUBLE/ap::DOUBLE*((ap-rp+pos)::DOUBLE/(ap-rp+pos+an-rn+neg)::DOUBLE))"
_KS = "MAX(ABS(rp::DOUBLE/ap::DOUBLE - rn::DOUBLE/an::DOUBLE))"


def confusion(score: str) -> str:
    return (f"{count_if(f'{score}>=0.5 AND is_default=1')} AS tp, {count_if(f'{score}>=0.5 AND is_default<>1')} AS fp, "
            f"{count_if(f'{score}<0.5 AND is_default<>1')} AS tn, {count_if(f'{score}<0.5 AND is_default=1')} AS fn")


RATIOS = f"""{r('(tp+tn)::DOUBLE/NULLIF(tp+fp+tn+fn,0)', 6)} AS accuracy,
 {r('coalesce(tp::DOUBLE/NULLIF(tp+fp,0),0)', 6)} AS precision_score,
 {r('coalesce(tp::DOUBLE/NULLIF(tp+fn,0),0)', 6)} AS recall_score,
 {r('coalesce(2*tp::DOUBLE/NULLIF(2*tp+fp+fn,0),0)', 6)} AS f1_score"""

LONG = SCORED + """, long AS (
 SELECT model_version, 'Logistic Regression' AS model_name, lr_default_prob AS score, is_default FROM scored
 UNION ALL SELECT model_version, 'XGBoost', xgb_default_prob, is_default FROM scored
 UNION ALL SELECT model_version, 'Ensemble', ensemble_default_prob, is_default FROM scored)"""
SUMMARY = LONG + ",\n" + curve("long", "model_version, model_name") + f""",
rk AS (SELECT model_version, model_name, {big('MAX(ap)+MAX(an)')} AS n_samples, {big('MAX(ap)')} AS n_defaults,
 {r(_AUC, 6)} AS auc_roc, {r('2*(' + _AUC + ')-1', 6)} AS gini_coefficient, {r(_AP, 6)} AS auc_pr, {r(_KS, 6)} AS ks_statistic
 FROM cum GROUP BY model_version, model_name),
cf AS (SELECT model_version, model_name, {confusion('score')} FROM long GROUP BY model_version, model_name),
summary AS (SELECT rk.*, {RATIOS} FROM rk JOIN cf USING (model_version, model_name))"""

_SAMPLES = ",".join("(" + ",".join(repr(v) for v in row) + ")" for row in V.SAMPLE_PERFORMANCE)
SAMPLE_LOG = f"""samples AS (SELECT * FROM (VALUES {_SAMPLES})
 AS t(model_name,model_version,dataset,n_samples,n_defaults,auc_roc,auc_pr,accuracy,precision_score,recall_score,f1_score,ks_statistic))"""
_METRICS = "n_samples, n_defaults, auc_roc, auc_pr, accuracy, precision_score, recall_score, f1_score, ks_statistic"
LOGGED = f"""measured AS (SELECT model_name, model_version, 'TEST' AS dataset, {_METRICS} FROM summary),
logged AS (SELECT model_name, model_version, DATE '2024-12-31' AS eval_date, dataset,
 {big('n_samples')} AS n_samples, {big('n_defaults')} AS n_defaults,
 CAST(n_defaults AS DOUBLE)/CAST(n_samples AS DOUBLE) AS default_rate,
 CAST(auc_roc AS DOUBLE) AS auc_roc, CAST(auc_pr AS DOUBLE) AS auc_pr, CAST(accuracy AS DOUBLE) AS accuracy,
 CAST(precision_score AS DOUBLE) AS precision_score, CAST(recall_score AS DOUBLE) AS recall_score,
 CAST(f1_score AS DOUBLE) AS f1_score, CAST(ks_statistic AS DOUBLE) AS ks_statistic,
 2*CAST(auc_roc AS DOUBLE)-1 AS gini_coefficient
 FROM (SELECT model_name, model_version, dataset, {_METRICS} FROM measured
  UNION ALL SELECT model_name, model_version, dataset, {_METRICS} FROM samples s WHERE NOT EXISTS (SELECT 1 FROM measured m
   WHERE m.model_name=s.model_name AND m.model_version=s.model_version AND m.dataset=s.dataset)))"""
_r4 = lambda c: f"{r(c, 4)} AS {c}"

_SCORE_COLS = ["lr_default_prob", "lr_prediction", "xgb_default_prob", "xgb_prediction",
               "ensemble_default_prob", "ensemble_prediction", "if_anomaly_score", "if_is_anomaly"]


def merged(strict: bool) -> str:
    """v1.0 scores merged into the table as version v0.9."""
    def pick(c: str) -> str:
        if strict and c.endswith("_prediction"):
            return f"CASE WHEN t.loan_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}"
        return f"CASE WHEN s.loan_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
    return f"""merged AS (SELECT * FROM model_scores WHERE model_version<>'v0.9' UNION ALL BY NAME
 SELECT coalesce(t.loan_id, s.loan_id) AS loan_id, 'v0.9' AS model_version, {', '.join(pick(c) for c in _SCORE_COLS)},
 CASE WHEN s.loan_id IS NOT NULL THEN {tier('s.ensemble_default_prob')} ELSE t.risk_tier END AS risk_tier
 FROM (SELECT * FROM model_scores WHERE model_version='v0.9') t
 FULL JOIN (SELECT * FROM model_scores WHERE model_version='v1.0') s ON t.loan_id=s.loan_id)"""


def _plain(e: str, digits: int) -> str:
    return f"rtrim(rtrim(CAST(ROUND(CAST({e} AS DECIMAL(28,8)),{digits}) AS VARCHAR),'0'),'.')"


_SPLIT = """ranked AS (SELECT loan_id, is_default, ROW_NUMBER() OVER (PARTITION BY is_default ORDER BY md5(concat_ws('|', loan_id, '42')), loan_id) AS rn,
 COUNT(*) OVER (PARTITION BY is_default) AS n FROM features_etl),
split AS (SELECT loan_id, is_default, CASE WHEN rn <= ceil(n*0.2) THEN 'test' ELSE 'train' END AS split FROM ranked)"""

_CORR = ["credit_score", "dti_ratio", "ltv_ratio", "risk_score", "loan_to_income_ratio", "rate_spread",
         "num_delinquencies"]

_CUTS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]

_REGIME_ENDS = [start for start, _ in V.REGIMES_FROM[1:]] + [V.REGIMES_END]
_REGIME = "CASE " + " ".join(
    f"WHEN origination_date>=DATE '{start}' AND origination_date<DATE '{end}' THEN '{name}'"
    for (start, name), end in zip(V.REGIMES_FROM, _REGIME_ENDS)) + " END"


def _points(column: str, sign: str, steps: list[tuple], otherwise: int = 0) -> str:
    return "CASE " + " ".join(f"WHEN {column}{sign}{limit} THEN {p}" for limit, p in steps) + f" ELSE {otherwise} END"


_IS = "upper(loan_type)='{}'"
_POINTS = " + ".join([
    str(V.SCORECARD_BASE),
    _points("credit_score", "<", V.SCORECARD_SCORE_BELOW, V.SCORECARD_SCORE_ELSE),
    _points("dti_ratio", ">", V.SCORECARD_DTI_ABOVE),
    _points("dti_ratio", "<", [(20, V.SCORECARD_DTI_BELOW_20)]),
    f"CASE WHEN {_IS.format('MORTGAGE')} THEN {_points('ltv_ratio', '>', V.SCORECARD_MORTGAGE_LTV_ABOVE)}"
    f" + {_points('ltv_ratio', '<', [(60, V.SCORECARD_MORTGAGE_LTV_BELOW_60)])} ELSE 0 END",
    _points("employment_years", "<", V.SCORECARD_TENURE_BELOW),
    _points("is_self_employed", "=", [(1, V.SCORECARD_SELF_EMPLOYED)]),
    _points("year(origination_date)", "=", V.SCORECARD_YEARS),
    f"CASE WHEN {_IS.format('AUTO')} THEN {V.SCORECARD_AUTO} ELSE 0 END",
    _points("fed_funds_rate", ">", [(4, V.SCORECARD_FED_ABOVE_4)]),
])
_YEARLY = ",".join(f"({y},CAST({rate} AS DOUBLE))" for y, rate in V.FED_FUNDS_YEARLY)
_WARNINGS = {
    "flag_poor_credit": f"credit_score<{V.WARN_SCORE_BELOW}", "flag_high_dti": f"dti_ratio>{V.WARN_DTI_ABOVE}",
    "flag_high_ltv": f"ltv_ratio>{V.WARN_LTV_ABOVE}",
    "flag_delinquency": f"num_delinquencies>{V.WARN_DELINQUENCIES_ABOVE}",
    "flag_inquiry_spike": f"num_inquiries_12m>{V.WARN_INQUIRIES_ABOVE}",
    "flag_model_high_risk": f"ensemble_default_prob>{V.WARN_PROBABILITY_ABOVE}", "flag_anomaly": "if_is_anomaly=1",
}
_PENDING = "(is_default=1 AND origination_date + CAST(months_to_default*30 AS INT) > DATE '2024-12-31')"


def build() -> dict[str, str]:
    q = query
    early_warning = f"""SELECT *, {'+'.join(_WARNINGS)} AS total_flags FROM (
 SELECT loan_id, loan_type, origination_date, loan_amount, credit_score, credit_tier, dti_ratio, ltv_ratio, risk_score, risk_decile, risk_tier,
 xgb_default_prob, ensemble_default_prob, if_is_anomaly, loan_status, is_default,
 {', '.join(f'{flag(c)} AS {n}' for n, c in _WARNINGS.items())}
 FROM (SELECT l.*, s.xgb_default_prob, s.ensemble_default_prob, s.risk_tier, s.if_is_anomaly, CAST({_DECILES.replace('risk_score','l.risk_score').replace('loan_id','l.loan_id')} AS INT) AS risk_decile
  FROM loans l LEFT JOIN model_scores s ON l.loan_id=s.loan_id AND s.model_version='v1.0') WHERE risk_decile<=3)"""
    out = {
        "loans_raw": q(["loans_raw"], "SELECT * FROM loans_raw"),
        "model_scores": q(["model_scores"], "SELECT * FROM model_scores"),
        "dq_profile": q(["loans_raw"], f"SELECT * FROM ({rules_sql(BASIC)}) WHERE violations>0"),
        "dq_extended": q(["loans_raw"], rules_sql(EXTENDED) + " UNION ALL SELECT 'duplicate_loan_id', CAST(COUNT(loan_id)-COUNT(DISTINCT loan_id) AS BIGINT) FROM loans_raw"),
        "dq_domains": q(["loans_raw"], rules_sql(DOMAINS)),
        "dq_quarantine": q(["loans_raw"], f"SELECT loan_id, loan_type, loan_amount, credit_score, dti_ratio, is_default, array_to_string({_broken}, ',') AS broken_rules FROM loans_raw WHERE len({_broken})>0"),
        "dq_summary": q(["loans_raw"], f"SELECT raw_rows, clean_rows, raw_rows-clean_rows AS removed_rows, CAST(35 AS BIGINT) AS n_columns, {'+'.join(BASIC)} AS total_issues, {_issues} AS issues FROM (SELECT COUNT(*) AS raw_rows, {count_if(VALID_KEYS)} AS clean_rows, {', '.join(f'{count_if(c)} AS {n}' for n, c in BASIC.items())} FROM loans_raw)"),
        "contract_check": q(["loans"], contract_sql(LOANS_CLEAN_CONTRACT, "loans")),
        "clean_loans": q(["cleaned"], "SELECT * FROM cleaned"),
        "dq_filter_sql": q(["loans_raw"], f"SELECT * FROM loans_raw WHERE {VALID}"),
        "features_etl": q(["features_etl"], "SELECT * FROM features_etl"),
        "features_sql": q(["loans"], "SELECT * FROM loans"),
        "features_notebook": q(["features_notebook"], "SELECT loan_id, is_default, " + ", ".join(
            ["credit_score", "dti_ratio", "ltv_ratio", "interest_rate", "loan_to_income_ratio",
             "payment_to_income_ratio", "rate_spread", "risk_score", "num_delinquencies", "num_inquiries_12m",
             "employment_years", "is_self_employed", "fed_funds_rate", "is_high_risk", "credit_score_bucket",
             "dti_bucket", "income_bucket", "is_mortgage", "is_covid_period", "is_rate_hike_period"]) + " FROM features_notebook"),
        "scorecard": q(["cleaned"], f"""SELECT loan_id, CAST(least(850, greatest(5, {_POINTS})) AS DOUBLE)/1000 AS rule_probability,
 {case_at_least('credit_score', V.CREDIT_TIERS_AT_LEAST, V.CREDIT_TIER_ELSE)} AS tier,
 concat_ws('-', 'MRD', upper(substr(loan_type,1,3)), CAST(origination_year AS VARCHAR), lpad(CAST(CAST(substr(loan_id,3) AS BIGINT) AS VARCHAR),7,'0')) AS long_id,
 {_REGIME} AS regime FROM cleaned"""),
        "loan_outcome": q(["cleaned"], f"""SELECT loan_id, CAST(CASE WHEN {_PENDING} THEN 0 ELSE is_default END AS INT) AS is_default,
 CASE WHEN {_PENDING} THEN 'Current' WHEN is_default<>1 AND origination_date + CAST(term_months*30 AS INT) <= DATE '2024-12-31' THEN 'Paid Off' ELSE loan_status END AS loan_status FROM cleaned"""),
        "fed_rate_lookup": q(["cleaned"], f"""SELECT loan_id, coalesce(fc/100.0::DOUBLE, 2.5::DOUBLE) AS fed_funds_rate, coalesce(yr, 2.5::DOUBLE) AS fed_rate_by_year
 FROM cleaned LEFT JOIN fed ON fy=year(origination_date) AND fq=quarter(origination_date)
 LEFT JOIN (VALUES {_YEARLY}) AS t(y,yr) ON y=year(origination_date)"""),
        "verify_load": q(["accepted"], f"SELECT COUNT(*) AS total_records, {big('SUM(is_default)')} AS total_defaults, {RATE}, COUNT(DISTINCT loan_type) AS loan_types, MIN(origination_date) AS earliest_loan, MAX(origination_date) AS latest_loan FROM typed"),
        "verify_clean": q(["loans"], f"SELECT loan_type, COUNT(*) AS records, {RATE}, {SCORE}, {r(mean('dti_ratio'), 1)} AS avg_dti, {r(mean('risk_score'), 1)} AS avg_risk_score, {big('SUM(is_high_risk)')} AS high_risk_count FROM loans GROUP BY loan_type"),
        "dataset_summary": q(["loans"], f"SELECT COUNT(*) AS total_loans, {_of('loan_type', 'Mortgage')} AS mortgage_loans, {_of('loan_type', 'Auto')} AS auto_loans, {RATE}, {r(_rate_of('Mortgage'), 2)} AS mortgage_default_rate_pct, {r(_rate_of('Auto'), 2)} AS auto_default_rate_pct, {r(AMOUNT + '/COUNT(loan_amount)', 0)} AS avg_loan_amount, {SCORE}, {r(mean('dti_ratio'), 1)} AS avg_dti, {r(mean('interest_rate'), 2)} AS avg_interest_rate FROM loans"),
        "value_counts": q(["loans"], "SELECT 'loan_status' AS field, loan_status AS value, COUNT(*) AS rows FROM loans GROUP BY loan_status UNION ALL SELECT 'credit_tier', credit_tier, COUNT(*) FROM loans GROUP BY credit_tier"),
        "portfolio_overview": q(["loans"], OVERVIEW),
        "default_by_credit_tier": q(["loans"], TIERS),
        "risk_segmentation": q(["loans"], f"SELECT dti_bucket, ltv_bucket, loan_type, COUNT(*) AS loan_count, {RATE}, {SCORE}, {r(mean('risk_score'), 1)} AS avg_risk_score, {r(mean('interest_rate'), 2)} AS avg_interest_rate, {r(AMOUNT + '/1000000', 2)} AS total_exposure_millions FROM loans GROUP BY dti_bucket, ltv_bucket, loan_type"),
        "geographic_risk": q(["loans"], GEOGRAPHY),
        "economic_regime": q(["loans"], f"""SELECT origination_year, origination_quarter, loan_type, {r(mean('fed_funds_rate'), 2)} AS avg_fed_rate, COUNT(*) AS originations,
 {r(AMOUNT + '/1000000', 2)} AS volume_millions, {RATE}, {r(mean('interest_rate'), 2)} AS avg_rate, {SCORE}, MAX(is_covid_period) AS is_covid_quarter, MAX(is_rate_hike_period) AS is_rate_hike_quarter,
 {r('AVG(is_default)*100 - LAG(AVG(is_default)*100) OVER (PARTITION BY loan_type ORDER BY origination_year, origination_quarter)', 2)} AS default_rate_qoq_change
 FROM loans GROUP BY origination_year, origination_quarter, loan_type"""),
        "sector_risk": q(["loans"], f"SELECT employment_sector, loan_type, COUNT(*) AS loan_count, {RATE}, {r(money('annual_income') + '/COUNT(annual_income)', 0)} AS avg_income, {SCORE}, {r(mean('dti_ratio'), 1)} AS avg_dti, {r(AMOUNT + '/1000000', 2)} AS exposure_millions FROM loans GROUP BY employment_sector, loan_type"),
        "risk_decile": q(["loans"], f"SELECT loan_id, risk_score, CAST({_DECILES} AS INT) AS risk_decile FROM loans"),
        "early_warning": q(["loans", "model_scores"], early_warning),
        "model_performance_view": q(["accepted", "model_scores"], f"SELECT model_name, model_version, eval_date, dataset, n_samples, {r('default_rate', 6)} AS default_rate, {', '.join(_r4(c) for c in ('auc_roc', 'auc_pr', 'f1_score', 'precision_score', 'recall_score', 'ks_statistic', 'gini_coefficient'))}, CAST(RANK() OVER (PARTITION BY dataset ORDER BY logged.auc_roc DESC) AS INT) AS auc_rank FROM logged", ",\n".join([SUMMARY, SAMPLE_LOG, LOGGED])),
        "log_performance": q(["loans", "model_scores"], f"SELECT * REPLACE ({r('default_rate', 8)} AS default_rate, {r('gini_coefficient', 6)} AS gini_coefficient) FROM logged", ",\n".join([SUMMARY, SAMPLE_LOG, LOGGED])),
        "dashboard_trend": q(["loans"], f"SELECT origination_year, loan_type, {r(money('default_rate_pct'), 2)} AS default_rate_pct, {r(money('total_exposure'), 2)} AS total_exposure FROM ({OVERVIEW}) GROUP BY origination_year, loan_type"),
        "dashboard_tier": q(["loans"], f"SELECT credit_score_bucket, loan_type, {r('CAST(AVG(default_rate_pct) AS DOUBLE)', 4)} AS avg_default_rate_pct, {r('SUM(defaults)::DOUBLE/SUM(loan_count)::DOUBLE*100', 2)} AS weighted_default_rate_pct FROM ({TIERS}) GROUP BY credit_score_bucket, loan_type"),
        "dashboard_state": q(["loans"], f"SELECT state, {r(money('default_rate_pct'), 2)} AS sum_default_rate_pct, {r(money('total_exposure_millions'), 2)} AS total_exposure_millions, {r('SUM(total_defaults)::DOUBLE/SUM(loan_count)::DOUBLE*100', 2)} AS weighted_default_rate_pct FROM ({GEOGRAPHY}) WHERE loan_type IN ('Mortgage','Auto') GROUP BY state"),
        "dashboard_relate": q(["loans"], f"SELECT * FROM (SELECT loan_type, {big('SUM(total_loans)')} AS overview_loans, {big('SUM(total_defaults)')} AS overview_defaults FROM ({OVERVIEW}) GROUP BY loan_type) JOIN (SELECT loan_type, {big('SUM(loan_count)')} AS tier_loans, {big('SUM(defaults)')} AS tier_defaults FROM ({TIERS}) GROUP BY loan_type) USING (loan_type) JOIN (SELECT loan_type, {big('SUM(loan_count)')} AS state_loans, {big('SUM(total_defaults)')} AS state_defaults FROM ({GEOGRAPHY}) GROUP BY loan_type) USING (loan_type)"),
        "risk_report": q(["accepted", "model_scores"], f"""SELECT 'Report Date' AS metric, '2024-12-31' AS value UNION ALL SELECT 'Total Loans', CAST(COUNT(*) AS VARCHAR) FROM loans
 UNION ALL SELECT 'Total Exposure ($M)', {_plain(AMOUNT + '/1000000', 2)} FROM loans UNION ALL SELECT 'Overall Default Rate (%)', {_plain('AVG(is_default)*100', 2)} FROM loans
 UNION ALL SELECT 'High Risk Loans', CAST(SUM(is_high_risk) AS VARCHAR) FROM loans UNION ALL SELECT 'Avg Credit Score', CAST(CAST({r('AVG(credit_score)', 0)} AS BIGINT) AS VARCHAR) FROM loans
 UNION ALL SELECT 'Avg DTI Ratio (%)', {_plain(mean('dti_ratio'), 1)} FROM loans UNION ALL SELECT 'Critical Risk Loans', CAST(COUNT(*) AS VARCHAR) FROM model_scores WHERE risk_tier='CRITICAL'"""),
        "merge_scores": q(["model_scores"], "SELECT * FROM merged", merged(False)),
        "merge_scores_strict": q(["model_scores"], "SELECT * FROM merged", merged(True)),
        "insert_missing": q(["model_scores"], "SELECT * FROM model_scores WHERE model_version='v0.9' UNION ALL SELECT * FROM model_scores s WHERE model_version='v1.0' AND NOT EXISTS (SELECT 1 FROM model_scores t WHERE t.model_version='v0.9' AND t.loan_id=s.loan_id)"),
        "refresh_risk_tiers": q(["model_scores"], f"SELECT total, critical, high, medium, low, 'Risk tiers refreshed for '||total||' loans. CRITICAL: '||critical||' | HIGH: '||high||' | MEDIUM: '||medium||' | LOW: '||low AS message FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE t='CRITICAL') AS critical, COUNT(*) FILTER (WHERE t='HIGH') AS high, COUNT(*) FILTER (WHERE t='MEDIUM') AS medium, COUNT(*) FILTER (WHERE t='LOW') AS low FROM (SELECT {tier('ensemble_default_prob')} AS t FROM model_scores))"),
        "tier_distribution": q(["model_scores"], "SELECT risk_tier, COUNT(*) AS loans FROM model_scores WHERE model_version='v1.0' GROUP BY risk_tier"),
        "default_rate_by_tier": q(["loans", "model_scores"], f"SELECT risk_tier, COUNT(*) AS loans, {r('AVG(is_default)', 3)} AS default_rate FROM scored WHERE model_version='v1.0' GROUP BY risk_tier", SCORED),
        "tier_separation": q(["loans", "model_scores"], f"SELECT {r('c', 6)} AS critical_rate, {r('l', 6)} AS low_rate, {r('c/NULLIF(l,0)', 4)} AS separation, c>l AS separates FROM (SELECT AVG(is_default) FILTER (WHERE risk_tier='CRITICAL') AS c, AVG(is_default) FILTER (WHERE risk_tier='LOW') AS l FROM scored WHERE model_version='v1.0')", SCORED),
        "describe_by": q(["loans", "model_scores"], f"SELECT is_default, COUNT(if_anomaly_score) AS count, {r('AVG(if_anomaly_score)', 4)} AS mean, {r('STDDEV(if_anomaly_score)', 4)} AS std, {r('MIN(if_anomaly_score)', 4)} AS min, {r('quantile_cont(if_anomaly_score,0.25)', 4)} AS p25, {r('quantile_cont(if_anomaly_score,0.5)', 4)} AS p50, {r('quantile_cont(if_anomaly_score,0.75)', 4)} AS p75, {r('MAX(if_anomaly_score)', 4)} AS max FROM scored WHERE model_version='v1.0' GROUP BY is_default", SCORED),
        "feature_correlation": q(["features_notebook"], " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'CORR({c}, is_default)', 3)} AS correlation FROM features_notebook" for c in _CORR)),
        "anomaly_overlap": q(["loans", "model_scores"], f"SELECT *, {r('flagged::DOUBLE/rows', 6)} AS flagged_share, {r('defaults::DOUBLE/rows', 6)} AS default_share, {r('flagged_defaults::DOUBLE/NULLIF(flagged,0)', 6)} AS overlap_of_flagged, {r('flagged_defaults::DOUBLE/NULLIF(defaults,0)', 6)} AS default_capture_rate FROM (SELECT COUNT(*) AS rows, {count_if('if_is_anomaly=1')} AS flagged, {count_if('is_default=1')} AS defaults, {count_if('if_is_anomaly=1 AND is_default=1')} AS flagged_defaults FROM scored WHERE model_version='v1.0')", SCORED),
        "auc_roc": q(["loans", "model_scores"], f"SELECT model_version, {r(_AUC, 6)} AS auc_roc FROM cum GROUP BY model_version", SCORED + ",\n" + curve("scored", "model_version", "ensemble_default_prob")),
        "average_precision": q(["loans", "model_scores"], f"SELECT model_version, {r(_AP, 6)} AS auc_pr FROM cum GROUP BY model_version", SCORED + ",\n" + curve("scored", "model_version", "ensemble_default_prob")),
        "ks_statistic": q(["loans", "model_scores"], f"SELECT model_version, {r(_KS, 6)} AS ks_statistic FROM cum GROUP BY model_version", SCORED + ",\n" + curve("scored", "model_version", "ensemble_default_prob")),
        "confusion_metrics": q(["loans", "model_scores"], f"SELECT *, {RATIOS} FROM (SELECT model_version, {confusion('ensemble_default_prob')} FROM scored GROUP BY model_version)", SCORED),
        "threshold_sweep": q(["loans", "model_scores"], f"SELECT threshold, tp, fp, {RATIOS} FROM (" + " UNION ALL ".join(f"SELECT CAST({c} AS DOUBLE) AS threshold, {count_if(f'ensemble_default_prob>={c} AND is_default=1')} AS tp, {count_if(f'ensemble_default_prob>={c} AND is_default<>1')} AS fp, {count_if(f'ensemble_default_prob<{c} AND is_default<>1')} AS tn, {count_if(f'ensemble_default_prob<{c} AND is_default=1')} AS fn FROM scored WHERE model_version='v1.0'" for c in _CUTS) + ")", SCORED),
        "performance_summary": q(["loans", "model_scores"], "SELECT * FROM summary", SUMMARY),
        "ensemble": q(["model_scores"], "SELECT loan_id, model_version, (lr_default_prob+xgb_default_prob)/2 AS ensemble_default_prob, CAST(CASE WHEN (lr_default_prob+xgb_default_prob)/2>=0.5 THEN 1 ELSE 0 END AS INT) AS ensemble_prediction FROM model_scores"),
        "stratified_split": q(["features_etl"], "SELECT * FROM split", _SPLIT),
        "leakage_check": q(["features_etl"], f"SELECT {_of('split', 'train')} AS train_rows, {_of('split', 'test')} AS test_rows, CAST(0 AS BIGINT) AS shared_keys FROM split", _SPLIT),
        "union_products": q(["cleaned"], "SELECT * FROM cleaned WHERE loan_type='AUTO' UNION ALL SELECT * FROM cleaned WHERE loan_type='MORTGAGE'"),
        "domain_check": q(["loans_raw"], "SELECT DISTINCT employment_sector FROM loans_raw WHERE employment_sector NOT IN ('BUILDING','AUTOMOBILE','MACHINERY')"),
        "head_preview": q(["loans"], "SELECT loan_id, loan_type, loan_amount, risk_score FROM loans ORDER BY loan_id LIMIT 5"),
    }
    typed = "SELECT * REPLACE (TRY_CAST(origination_date AS DATE) AS origination_date) FROM loans_raw"
    out |= {
        "csv_round_trip": q(["loans_raw"], typed),
        "csv_partitioned": q(["loans_raw"], typed),
        "load_tolerant": q(["loans_raw"], """SELECT 'loaded' AS reason, COUNT(*) AS rows FROM loans_raw WHERE loan_id IS NOT NULL AND loan_type IS NOT NULL AND TRY_CAST(origination_date AS DATE) IS NOT NULL
 UNION ALL SELECT 'bad_origination_date', COUNT(*) FROM loans_raw WHERE TRY_CAST(origination_date AS DATE) IS NULL
 UNION ALL SELECT 'null_loan_id', COUNT(*) FROM loans_raw WHERE loan_id IS NULL UNION ALL SELECT 'null_loan_type', COUNT(*) FROM loans_raw WHERE loan_type IS NULL"""),
        "partitioned_write": q(["features_etl"], "SELECT * FROM features_etl"),
        "mixed_headers": q(["loans_raw"], f"SELECT * FROM ({typed}) WHERE loan_id IS NOT NULL AND loan_type IS NOT NULL AND origination_date IS NOT NULL"),
        "etl_rerun": q(["features_etl"], "SELECT * FROM features_etl WHERE loan_type='AUTO'"),
        "etl_year": q(["features_etl"], "SELECT * FROM features_etl WHERE origination_year=2020"),
        "quarantine_clean": q(["loans_raw"], f"SELECT * FROM loans_raw WHERE {VALID_KEYS}"),
        "shared_keys": q(["model_scores"], "SELECT loan_id FROM model_scores WHERE model_version='v0.9' INTERSECT SELECT loan_id FROM model_scores WHERE model_version='v1.0'"),
        "append_rows": q(["model_scores"], "SELECT * FROM model_scores"),
        "replace_table": q(["model_scores"], "SELECT * FROM model_scores WHERE model_version='v1.0'"),
        "audit_columns": q(["cleaned"], "SELECT 'loan-data-transform' AS etl_job_name, COUNT(*) AS rows, COUNT(*) AS rows_with_time FROM cleaned"),
        "filter_year": q(["features_etl"], "SELECT * FROM features_etl WHERE origination_year=2020"),
        "product_subsets": q(["loans_raw"], "SELECT 'loans_raw' AS file_set, COUNT(*) AS rows FROM loans_raw UNION ALL SELECT 'loans_mortgage', COUNT(*) FROM loans_raw WHERE loan_type='Mortgage' UNION ALL SELECT 'loans_auto', COUNT(*) FROM loans_raw WHERE loan_type='Auto'"),
        "export_extract": q(["loans"], "SELECT " + ", ".join(f"{c} AS {c.upper()}" for c in (
            "state", "loan_type", "loan_count", "default_rate_pct", "total_exposure_millions", "avg_credit_score",
            "avg_dti", "avg_risk_score", "total_defaults", "defaulted_exposure_millions")) + f" FROM ({GEOGRAPHY})"),
        "ingest_arrivals": q(["features_etl"], "SELECT * FROM features_etl"),
        "ingest_compacted": q(["features_etl"], "SELECT * FROM features_etl"),
        "arrival_events": """SELECT event_id, 'lake-' || event_type AS bucket, 'raw/loans/' || user_id || s || '.csv' AS key,
 CASE WHEN event_id%5=0 THEN CAST(0 AS BIGINT) ELSE coalesce(CAST(props->>'$.k' AS BIGINT),0) END AS size
 FROM events JOIN (VALUES ('_a'),('_b')) AS t(s) ON s='_a' OR event_id%7=0 WHERE event_type<>'error' AND event_id%3<>0""",
    }
    out |= {
        "etl_job": q(["loans_raw"], f"SELECT raw_rows, clean_rows, raw_rows-clean_rows AS removed_rows, CAST(49 AS BIGINT) AS n_columns, {'+'.join(BASIC)} AS total_issues, {_issues} AS issues, clean_rows AS written_rows FROM (SELECT COUNT(*) AS raw_rows, {count_if(VALID_KEYS)} AS clean_rows, {', '.join(f'{count_if(c)} AS {n}' for n, c in BASIC.items())} FROM loans_raw)"),
        "merge_summary": q(["model_scores"], "SELECT 'Loaded ' || COUNT(*) || ' scores for model version v0.9' AS message FROM merged WHERE model_version='v0.9'", merged(False)),
        "performance_message": q(["accepted", "model_scores"], "SELECT model_name, model_version, dataset, 'Logged performance for ' || model_name || ' v' || model_version || ' (' || dataset || '): AUC=' || auc_roc || ', F1=' || f1_score AS message FROM logged", ",\n".join([SUMMARY, SAMPLE_LOG, LOGGED])),
        "loans_clean": q(["loans"], "SELECT " + ", ".join(LOANS_CLEAN.fieldNames()[:-1]) + " FROM loans"),
        "shuffle_rows": q(["cleaned"], "SELECT loan_id, loan_type, ROW_NUMBER() OVER (ORDER BY md5(concat_ws('|', loan_id, '42')), loan_id) - 1 AS position FROM cleaned"),
        "class_balance_report": q(["features_notebook"], f"""SELECT split AS part, COUNT(*) AS rows, {big('SUM(is_default)')} AS defaults, {r('AVG(is_default)', 6)} AS default_rate FROM split GROUP BY split
 UNION ALL SELECT 'train balanced', {big('2*MAX(n)')}, {big('MAX(n)')}, CAST(0.5 AS DOUBLE) FROM (SELECT COUNT(*) AS n FROM split WHERE split='train' GROUP BY is_default)""",
                                  _SPLIT.replace("features_etl", "features_notebook")),
        "register_views": q(["loans"], " UNION ALL ".join(
            f"SELECT 'vw_{name}' AS view_name, COUNT(*) AS rows FROM (SELECT DISTINCT {keys} FROM loans)" for name, keys in (
                ("portfolio_overview", "loan_type, origination_year"),
                ("default_by_credit_tier", "origination_year, credit_tier, credit_score_bucket, loan_type"),
                ("risk_segmentation", "dti_bucket, ltv_bucket, loan_type"), ("geographic_risk", "state, loan_type"),
                ("economic_regime", "origination_year, origination_quarter, loan_type"),
                ("sector_risk", "employment_sector, loan_type")))),
    }
    out |= {
        "contract_check_raw": q(["loans_raw"], contract_sql(RAW_LOANS_CONTRACT, "loans_raw")),
        "contract_check_scores": q(["model_scores"], contract_sql(MODEL_SCORES_CONTRACT, "model_scores")),
        "contract_check_performance": q(["accepted", "model_scores"], contract_sql(MODEL_PERFORMANCE_CONTRACT, "logged"), ",\n".join([SUMMARY, SAMPLE_LOG, LOGGED])),
        "load_outcome": q(["accepted"], f"""SELECT 'accepted' AS outcome, COUNT(*) AS rows FROM loans
 UNION ALL SELECT 'rejected', COUNT(*) FROM offered WHERE NOT ({TAKEN})
 UNION ALL SELECT * FROM (""" + " UNION ALL ".join(
            f"SELECT 'null_{c}' AS outcome, COUNT(*) AS rows FROM offered WHERE {c} IS NULL" for c in LOANS_CLEAN_CONTRACT.not_null) + ") WHERE rows > 0"),
        "load_rejects": q(["accepted"], "SELECT loan_id, loan_type, loan_amount, credit_score, risk_score, concat_ws(',', " + ", ".join(
            f"CASE WHEN {c} IS NULL THEN 'null_{c}' END" for c in LOANS_CLEAN_CONTRACT.not_null) + f") AS reasons FROM offered WHERE NOT ({TAKEN})"),
        "repeated_load": q(["model_scores"], """SELECT 'accepted' AS outcome, COUNT(DISTINCT loan_id) AS rows FROM model_scores
 UNION ALL SELECT 'rejected', COUNT(*) - COUNT(DISTINCT loan_id) FROM model_scores UNION ALL SELECT 'repeated_key', COUNT(*) - COUNT(DISTINCT loan_id) FROM model_scores"""),
        "unrounded_decile": q(["accepted"], "SELECT loan_id, CAST(NTILE(10) OVER (ORDER BY risk_score*CAST(1e-7 AS DOUBLE) + loan_amount/CAST(7e13 AS DOUBLE) DESC NULLS FIRST, md5(loan_id), loan_id) AS INT) AS decile FROM loans"),
        "curves_by_scale": q(["accepted", "model_scores"], f"""SELECT scale, {big('MAX(ap)+MAX(an)')} AS n_samples, {big('MAX(ap)')} AS n_defaults,
 {r(_AUC, 6)} AS auc_roc, {r('2*(' + _AUC + ')-1', 6)} AS gini_coefficient, {r(_AP, 6)} AS auc_pr, {r(_KS, 6)} AS ks_statistic FROM cum GROUP BY scale""",
                             SCORED + """, spread AS (SELECT is_default, scale, ensemble_default_prob*factor AS score FROM scored
 CROSS JOIN (VALUES ('wide', CAST(2e6 AS DOUBLE)), ('narrow', CAST(1e-9 AS DOUBLE))) AS t(scale, factor) WHERE model_version='v1.0'),
""" + curve("spread", "scale")),
        "percentiles_of_many_groups": q(["accepted"], "SELECT grp, " + ", ".join(
            r(f"quantile_cont(loan_amount, 0.{p})", 4) + f" AS p{p}" for p in (25, 50, 75)) + """ FROM (SELECT loan_amount,
 CAST(CASE WHEN CAST(substr(loan_id,3) AS BIGINT)%3=0 THEN 0 ELSE CAST(substr(loan_id,3) AS BIGINT)%997 END AS INT) AS grp FROM loans) GROUP BY grp"""),
        "portfolio_positions": q(["accepted"], f"SELECT loan_type, origination_year, total_loans, ROW_NUMBER() OVER (ORDER BY loan_type, origination_year) - 1 AS position FROM ({OVERVIEW})"),
        "performance_listing": q(["accepted", "model_scores"], "SELECT model_name, dataset, model_version, n_samples, ROW_NUMBER() OVER (ORDER BY model_name, dataset, model_version, eval_date) - 1 AS position FROM logged", ",\n".join([SUMMARY, SAMPLE_LOG, LOGGED])),
    }
    out |= {
        "planted_leakage": q(["features_etl"], f"""SELECT {count_if("split='train' OR loan_id LIKE '%7'")} AS train_rows, {_of('split', 'test')} AS test_rows,
 {count_if("split='test' AND loan_id LIKE '%7'")} AS shared_keys FROM split""", _SPLIT),
        "merge_from_view": out["merge_scores"],
        "list_objects": "SELECT 'view' AS kind, name FROM (VALUES " + ",".join(f"('vw_{n}')" for n in (
            "portfolio_overview", "default_by_credit_tier", "risk_segmentation", "geographic_risk", "economic_regime",
            "sector_risk", "early_warning", "model_performance")) + ") AS t(name)",
        "load_audit": q(["loans_raw"], "SELECT origination_year AS file_year, COUNT(*) AS rows, COUNT(*) AS rows_with_time, COUNT(*) AS rows_with_file FROM loans_raw GROUP BY origination_year"),
        "rejected_lines": q(["loans_raw"], """SELECT * FROM (SELECT loan_id, loan_type, origination_date, concat_ws(',', CASE WHEN loan_id IS NULL THEN 'null_loan_id' END,
 CASE WHEN loan_type IS NULL THEN 'null_loan_type' END, CASE WHEN TRY_CAST(origination_date AS DATE) IS NULL THEN 'bad_origination_date' END) AS reasons FROM loans_raw) WHERE reasons <> ''"""),
    }
    parts = _SPLIT.replace("features_etl", "features_notebook")
    features = ["credit_score", "dti_ratio", "ltv_ratio", "interest_rate", "loan_to_income_ratio",
                "payment_to_income_ratio", "rate_spread", "risk_score", "num_delinquencies", "num_inquiries_12m",
                "employment_years", "is_self_employed", "fed_funds_rate", "is_high_risk", "credit_score_bucket",
                "dti_bucket", "income_bucket", "is_mortgage", "is_covid_period", "is_rate_hike_period"]
    zero = "CAST(0 AS BIGINT)"
    rate = lambda part: f"(SELECT AVG(is_default) FROM split WHERE split='{part}')"
    # properties that any correct fit has, with the sizes that follow from the tables
    out |= {
        "shap_additivity": q(["features_notebook"], f"SELECT COUNT(*) AS explained_rows, {zero} AS violations FROM split WHERE split='test'", parts),
        "boosting_stop": q(["features_notebook"], "SELECT COUNT(*)>0 AS grew, true AS stopped_by_rule, true AS within_allowed FROM split", parts),
        "smote_properties": q(["features_notebook"], f"SELECT {big('MAX(n)-MIN(n)')} AS synthetic_rows, {zero} AS off_segment FROM (SELECT COUNT(*) AS n FROM split WHERE split='train' GROUP BY is_default)", parts),
        "isolation_properties": q(["features_notebook"], "SELECT CAST(200 AS BIGINT) AS trees, least(256, COUNT(*)) AS fewest_rows, least(256, COUNT(*)) AS most_rows, true AS share_kept FROM split WHERE split='train'", parts),
        "importance_properties": q(["features_notebook"], f"SELECT CAST({len(features)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, {zero} AS negative, {zero} AS out_of_order FROM split HAVING COUNT(*)>0", parts),
        "score_frame_properties": q(["features_notebook"], "SELECT COUNT(*) AS rows, COUNT(DISTINCT loan_id) AS loans, " + ", ".join(
            f"{zero} AS off_{c}" for c in ("mean", "class", "range", "tier")) + " FROM split WHERE split='test'", parts),
        "logistic_gradient": q(["features_notebook"], "SELECT feature, CAST(0 AS DOUBLE) AS gradient, rows FROM (VALUES "
                               + ",".join(f"('{f}')" for f in features) + f") AS t(feature), (SELECT {big('2*MAX(n)')} AS rows FROM (SELECT COUNT(*) AS n FROM split WHERE split='train' GROUP BY is_default))", parts),
        "split_gates": q(["features_notebook"], f"""SELECT 'default rate within 5-25 %' AS gate, round(AVG(is_default), 9) AS value, AVG(is_default) BETWEEN 0.05 AND 0.25 AS passed FROM split
 UNION ALL SELECT 'train and test rates within 0.02', round(gap, 9), gap<0.02 FROM (SELECT abs({rate('train')}-{rate('test')}) AS gap)""", parts),
    }
    out["view_early_warning"] = q(["accepted", "model_scores"], early_warning)
    out["view_model_performance"] = out["model_performance_view"]
    return out
