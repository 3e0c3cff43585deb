"""The eight reporting views over the clean loan table and the model tables.

Each view is one hash aggregation (with a window on its small result where needed) or, for early
warning, a map-side rank cut followed by one join.  ``ordered=True`` adds the presentation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import money_mean, money_total, percent_of_rows, rate_mean, round_half_up
from riskweave.functions.risk import total_flags, warning_flags
from riskweave.operators.lookups import loans_with_scores
from riskweave.operators.positions import with_positions
from riskweave.operators.ranking import ntile_descending

def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _default_rate() -> Column:
    return round_half_up(percent_of_rows("is_default"), 2).alias("default_rate_pct")


def _score() -> Column:
    return round_half_up(F.avg("credit_score"), 0).alias("avg_credit_score")


def _mean(column: str, digits: int, name: str) -> Column:
    return round_half_up(rate_mean(column), digits).alias(name)


def _defaulted_amount() -> Column:
    return money_total(F.when(F.col("is_default") == 1, F.col("loan_amount")).otherwise(0))


def _millions(total: Column, name: str) -> Column:
    return round_half_up(total / 1000000, 2).alias(name)


def _present(df: DataFrame, ordered: bool, *order) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def portfolio_overview(loans: DataFrame, ordered: bool = False) -> DataFrame:
    high_risk = F.sum("is_high_risk")
    view = loans.groupBy("loan_type", "origination_year").agg(
        _rows("total_loans"),
        round_half_up(money_total("loan_amount"), 2).alias("total_exposure"),
        round_half_up(money_mean("loan_amount"), 2).alias("avg_loan_amount"),
        F.sum("is_default").alias("total_defaults"),
        _default_rate(), _score(),
        _mean("dti_ratio", 1, "avg_dti"),
        _mean("interest_rate", 2, "avg_interest_rate"),
        _mean("ltv_ratio", 1, "avg_ltv"),
        high_risk.alias("high_risk_loans"),
        _mean("risk_score", 1, "avg_risk_score"),
        round_half_up(high_risk / F.count(F.lit(1)) * 100, 2).alias("high_risk_pct"),
        round_half_up(_defaulted_amount(), 2).alias("exposure_at_risk"),
    )
    return _present(view, ordered, "origination_year", "loan_type")


def default_by_credit_tier(loans: DataFrame, ordered: bool = False) -> DataFrame:
    view = loans.groupBy("origination_year", "credit_tier", "credit_score_bucket", "loan_type").agg(
        _rows("loan_count"), F.sum("is_default").alias("defaults"), _default_rate(), _score(),
        round_half_up(money_mean("loan_amount"), 2).alias("avg_loan_amount"),
        round_half_up(money_total("loan_amount"), 2).alias("total_exposure"),
        round_half_up(_defaulted_amount(), 2).alias("defaulted_exposure"),
    )
    return _present(view, ordered, "origination_year", "credit_score_bucket", "credit_tier", "loan_type")


def risk_segmentation(loans: DataFrame, ordered: bool = False) -> DataFrame:
    view = loans.groupBy("dti_bucket", "ltv_bucket", "loan_type").agg(
        _rows("loan_count"), _default_rate(), _score(),
        _mean("risk_score", 1, "avg_risk_score"),
        _mean("interest_rate", 2, "avg_interest_rate"),
        _millions(money_total("loan_amount"), "total_exposure_millions"),
    )
    return _present(view, ordered, F.desc("default_rate_pct"), "dti_bucket", "ltv_bucket", "loan_type")


def geographic_risk(loans: DataFrame, ordered: bool = False) -> DataFrame:
    view = loans.groupBy("state", "loan_type").agg(
        _rows("loan_count"), _default_rate(),
        _millions(money_total("loan_amount"), "total_exposure_millions"),
        _score(), _mean("dti_ratio", 1, "avg_dti"), _mean("risk_score", 1, "avg_risk_score"),
        F.sum("is_default").alias("total_defaults"),
        _millions(_defaulted_amount(), "defaulted_exposure_millions"),
    )
    return _present(view, ordered, F.desc("default_rate_pct"), "state", "loan_type")


def economic_regime(loans: DataFrame, ordered: bool = False) -> DataFrame:
    """Quarterly figures with the change of the default rate against the product's previous row."""
    quarters = loans.groupBy("origination_year", "origination_quarter", "loan_type").agg(
        _mean("fed_funds_rate", 2, "avg_fed_rate"), _rows("originations"),
        _millions(money_total("loan_amount"), "volume_millions"),
        percent_of_rows("is_default").alias("_rate"),
        _mean("interest_rate", 2, "avg_rate"), _score(),
        F.max("is_covid_period").alias("is_covid_quarter"),
        F.max("is_rate_hike_period").alias("is_rate_hike_quarter"),
    )
    history = Window.partitionBy("loan_type").orderBy("origination_year", "origination_quarter")
    view = quarters.select(
        "origination_year", "origination_quarter", "loan_type", "avg_fed_rate", "originations",
        "volume_millions", round_half_up("_rate", 2).alias("default_rate_pct"), "avg_rate",
        "avg_credit_score", "is_covid_quarter", "is_rate_hike_quarter",
        round_half_up(F.col("_rate") - F.lag("_rate").over(history), 2).alias("default_rate_qoq_change"),
    )
    return _present(view, ordered, "origination_year", "origination_quarter", "loan_type")


def sector_risk(loans: DataFrame, ordered: bool = False) -> DataFrame:
    view = loans.groupBy("employment_sector", "loan_type").agg(
        _rows("loan_count"), _default_rate(),
        round_half_up(money_mean("annual_income"), 0).alias("avg_income"),
        _score(), _mean("dti_ratio", 1, "avg_dti"),
        _millions(money_total("loan_amount"), "exposure_millions"),
    )
    return _present(view, ordered, F.desc("default_rate_pct"), "employment_sector", "loan_type")


def early_warning(loans: DataFrame, scores: DataFrame, version: str = "v1.0",
                  ordered: bool = False) -> DataFrame:
    """The riskiest three deciles by risk score, with scores and seven warning flags.

    Deciles are taken over all loans.  Since the score join neither adds nor drops a loan, the cut
    is made first and only the remaining 30 % of the rows are joined.
    """
    riskiest = ntile_descending(
        loans, "risk_score", V.WARNING_DECILES, ["loan_id"], "risk_decile",
        at_most=V.WARNING_DECILE_LIMIT, ties=V.LOAN_TIES,
    )
    flags = warning_flags()
    view = (
        loans_with_scores(riskiest, scores, version)
        .withColumns(flags)
        .select(
            "loan_id", "loan_type", "origination_date", "loan_amount", "credit_score",
            "credit_tier", "dti_ratio", "ltv_ratio", "risk_score", "risk_decile", "risk_tier",
            "xgb_default_prob", "ensemble_default_prob", "if_is_anomaly", "loan_status",
            "is_default", *flags, total_flags(list(flags)).alias("total_flags"),
        )
    )
    return _present(view, ordered, F.desc("risk_score"), "loan_id")


def model_performance_view(performance: DataFrame, ordered: bool = False) -> DataFrame:
    """Logged metrics at four decimals and each model's rank by AUC inside its dataset."""
    by_auc = Window.partitionBy("dataset").orderBy(F.desc("auc_roc"))
    ranked = performance.withColumn("auc_rank", F.rank().over(by_auc))
    rounded = ["auc_roc", "auc_pr", "f1_score", "precision_score", "recall_score",
               "ks_statistic", "gini_coefficient"]
    if ordered:
        ranked = ranked.orderBy("dataset", F.desc("auc_roc"), "model_name", "model_version", "eval_date")
    return ranked.select(
        "model_name", "model_version", "eval_date", "dataset", "n_samples",
        round_half_up("default_rate", 6).alias("default_rate"),
        *[round_half_up(c, 4).alias(c) for c in rounded], "auc_rank",
    )


def performance_listing(performance: DataFrame) -> DataFrame:
    """All logged rows by model and dataset, with their position."""
    return with_positions(performance, F.col("model_name"), F.col("dataset"), F.col("model_version"), F.col("eval_date"))


def portfolio_positions(loans: DataFrame) -> DataFrame:
    """The portfolio overview with each row's position in the order it is shown in."""
    return with_positions(portfolio_overview(loans), F.col("loan_type"), F.col("origination_year"))


LOAN_VIEWS = {
    "vw_portfolio_overview": portfolio_overview,
    "vw_default_by_credit_tier": default_by_credit_tier,
    "vw_risk_segmentation": risk_segmentation,
    "vw_geographic_risk": geographic_risk,
    "vw_economic_regime": economic_regime,
    "vw_sector_risk": sector_risk,
}


def register_views(spark: SparkSession, loans: DataFrame, scores: DataFrame | None = None,
                   performance: DataFrame | None = None) -> list[str]:
    """Create or replace the reporting views in the session; returns their names."""
    for name, view in LOAN_VIEWS.items():
        view(loans, ordered=True).createOrReplaceTempView(name)
    names = list(LOAN_VIEWS)
    if scores is not None:
        early_warning(loans, scores, ordered=True).createOrReplaceTempView("vw_early_warning")
        names.append("vw_early_warning")
    if performance is not None:
        model_performance_view(performance, ordered=True).createOrReplaceTempView("vw_model_performance")
        names.append("vw_model_performance")
    return names


def list_objects(spark: SparkSession) -> DataFrame:
    """(kind, name) of the databases, tables and views the session knows."""
    rows = [("database", d.name) for d in spark.catalog.listDatabases()]
    rows += [("view" if t.isTemporary or t.tableType == "VIEW" else "table", t.name)
             for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "kind string, name string")
