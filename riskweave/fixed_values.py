"""Fixed values of the loan-risk domain.

Everything in this module is a value that results depend on: lookup tables, band edges and
labels, allowed words, thresholds and formats.  They are stated here once, as plain text, in
natural order; no logic lives here.
"""

# --- policy rate by (year, quarter), percent; used when a date falls outside the table: 2.5
FED_FUNDS_QUARTERLY = [
    (2018, 1, 1.42), (2018, 2, 1.71), (2018, 3, 1.91), (2018, 4, 2.18),
    (2019, 1, 2.40), (2019, 2, 2.38), (2019, 3, 2.19), (2019, 4, 1.78),
    (2020, 1, 1.58), (2020, 2, 0.06), (2020, 3, 0.09), (2020, 4, 0.09),
    (2021, 1, 0.07), (2021, 2, 0.06), (2021, 3, 0.08), (2021, 4, 0.08),
    (2022, 1, 0.08), (2022, 2, 0.77), (2022, 3, 2.33), (2022, 4, 3.78),
    (2023, 1, 4.57), (2023, 2, 5.08), (2023, 3, 5.33), (2023, 4, 5.33),
    (2024, 1, 5.33), (2024, 2, 5.33), (2024, 3, 5.10), (2024, 4, 4.83),
]
FED_FUNDS_YEARLY = [
    (2018, 1.75), (2019, 2.25), (2020, 0.25), (2021, 0.10),
    (2022, 3.50), (2023, 5.25), (2024, 5.00),
]
FED_FUNDS_DEFAULT = 2.5

# --- label bands. "at_least": first lower bound reached; "below": first upper bound not reached
CREDIT_SCORE_BANDS_AT_LEAST = [
    (800, "800+"), (740, "740-799"), (670, "670-739"), (620, "620-669"), (580, "580-619"),
]
CREDIT_SCORE_BAND_ELSE = "<580"
DTI_BANDS_BELOW = [(20, "Low (<20)"), (36, "Moderate (20-36)"), (43, "High (36-43)")]
DTI_BAND_ELSE = "Very High (43+)"
LTV_BANDS_BELOW = [
    (60, "Low (<60)"), (80, "Standard (60-80)"), (90, "High (80-90)"), (97, "Very High (90-97)"),
]
LTV_BAND_ELSE = "Above 97"
INCOME_BANDS_BELOW = [
    (40000, "Low (<40K)"), (75000, "Lower-Mid (40-75K)"), (120000, "Middle (75-120K)"),
    (200000, "Upper-Mid (120-200K)"),
]
INCOME_BAND_ELSE = "High (200K+)"
CREDIT_TIERS_AT_LEAST = [(800, "Exceptional"), (740, "Very Good"), (670, "Good"), (580, "Fair")]
CREDIT_TIER_ELSE = "Poor"
RISK_TIERS_AT_LEAST = [(0.60, "CRITICAL"), (0.40, "HIGH"), (0.20, "MEDIUM")]
RISK_TIER_ELSE = "LOW"
RISK_TIERS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]

# --- ordinal bands, right-closed: value in (edge[i-1], edge[i]] -> i
CREDIT_SCORE_EDGES = [0, 579, 619, 669, 739, 799, 850]
DTI_EDGES = [0, 20, 36, 43, 100]
INCOME_EDGES = [0, 40000, 75000, 120000, 200000, float("inf")]

# --- composite risk score and high-risk limits
SCORE_CEILING, SCORE_SPAN, SCORE_WEIGHT = 850, 550, 40
DTI_DIVISOR, LTV_DIVISOR = 2, 10
DELINQUENCY_WEIGHT, INQUIRY_WEIGHT = 5, 2
HIGH_RISK_SCORE_BELOW, HIGH_RISK_DTI_ABOVE = 620, 43
HIGH_RISK_LTV_ABOVE, HIGH_RISK_DELINQUENCIES_ABOVE = 95, 2

# --- early-warning limits
WARN_SCORE_BELOW, WARN_DTI_ABOVE, WARN_LTV_ABOVE = 580, 43, 95
WARN_DELINQUENCIES_ABOVE, WARN_INQUIRIES_ABOVE, WARN_PROBABILITY_ABOVE = 2, 5, 0.50
WARNING_DECILES, WARNING_DECILE_LIMIT = 10, 3

# --- additive default scorecard, in thousandths of probability
SCORECARD_BASE = 50
SCORECARD_SCORE_BELOW = [(580, 180), (620, 120), (660, 70), (700, 30), (740, 10)]
SCORECARD_SCORE_ELSE = -20
SCORECARD_DTI_ABOVE = [(50, 100), (43, 60), (36, 30)]
SCORECARD_DTI_BELOW_20 = -20
SCORECARD_MORTGAGE_LTV_ABOVE = [(95, 80), (90, 50), (80, 20)]
SCORECARD_MORTGAGE_LTV_BELOW_60 = -20
SCORECARD_TENURE_BELOW = [(1, 40), (2, 20)]
SCORECARD_SELF_EMPLOYED = 30
SCORECARD_YEARS = [(2020, 40), (2022, 30), (2023, 30)]
SCORECARD_AUTO = 20
SCORECARD_FED_ABOVE_4 = 20
SCORECARD_FLOOR, SCORECARD_CEILING = 5, 850

# --- economic regimes by origination date (first day of each period, name)
REGIMES_FROM = [
    ("2018-01-01", "Gradual rate normalization"),
    ("2020-01-01", "COVID-19 shock"),
    ("2020-04-01", "Near-zero rates"),
    ("2022-01-01", "Aggressive rate hikes"),
    ("2024-01-01", "Rate stabilization"),
]
REGIMES_END = "2025-01-01"

# --- data-quality limits and documented domains
CREDIT_SCORE_RANGE = (300, 850)
DTI_RANGE = (0, 100)
INTEREST_RATE_RANGE = (0, 30)
YEAR_RANGE = (2018, 2024)
PRODUCTS = ["Mortgage", "Auto"]
MORTGAGE_TERMS = [180, 240, 360]
AUTO_TERMS = [36, 48, 60, 72, 84]
PURPOSES = ["Purchase", "Refinance", "Cash-Out Refinance"]
CREDIT_TIERS = ["Exceptional", "Very Good", "Good", "Fair", "Poor"]
PROPERTY_TYPES = ["Single Family", "Condo", "Townhouse", "Multi-Family"]
VEHICLE_TYPES = ["New", "Used", "Certified Pre-Owned"]
LOAN_STATUSES = ["Current", "Paid Off", "30 DPD", "60 DPD", "90+ DPD", "Default", "Charged Off"]
LOAN_ID_PATTERN = r"^(MRD-[A-Z]{3}-\d{4}-\d{7}|LN\d{8})$"
LOAN_ID_PREFIX = "MRD"
OBSERVATION_END = "2024-12-31"
DAYS_PER_MONTH = 30

# --- text that means "no value" in the raw files
NULL_MARKERS = ["NULL", "null", "NA", ""]

# --- model inputs, in column order
MODEL_FEATURES = [
    "credit_score", "dti_ratio", "ltv_ratio", "interest_rate",
    "loan_to_income_ratio", "payment_to_income_ratio", "rate_spread",
    "risk_score", "num_delinquencies", "num_inquiries_12m",
    "employment_years", "is_self_employed", "fed_funds_rate",
    "is_high_risk", "credit_score_bucket", "dti_bucket",
    "income_bucket", "is_mortgage", "is_covid_period", "is_rate_hike_period",
]
CORRELATED_FEATURES = [
    "credit_score", "dti_ratio", "ltv_ratio", "risk_score",
    "loan_to_income_ratio", "rate_spread", "num_delinquencies",
]

# --- example rows of the performance log
SAMPLE_PERFORMANCE = [
    ("XGBoost", "v1.0", "TEST", 50000, 5512, 0.9421, 0.8103, 0.9124, 0.8234, 0.7891, 0.8045, 0.7234),
    ("LogisticRegression", "v1.0", "TEST", 50000, 5512, 0.8912, 0.7543, 0.8934, 0.7823, 0.7234, 0.7519, 0.6821),
    ("XGBoost", "v1.0", "TRAIN", 200000, 22048, 0.9634, 0.8891, 0.9312, 0.8734, 0.8123, 0.8417, 0.7892),
]

#: Columns that order loans of one risk score that have no id.
LOAN_TIES = ["loan_amount", "annual_income", "dti_ratio", "ltv_ratio"]
