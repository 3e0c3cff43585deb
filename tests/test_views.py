import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave import catalog
from riskweave.operators import lookups, summaries
from riskweave.operators.features import engineer_features
from riskweave.plans import dashboards, report, views
from riskweave.session import staged


@pytest.fixture(scope="module")
def book(spark, sf):
    return staged(catalog.loans(spark, sf), "test-loans")


@pytest.fixture(scope="module")
def scores(spark, sf):
    return staged(catalog.scores(spark, sf), "test-scores")


def test_all_rollups_agree_on_totals(book):
    n, bad = book.count(), book.agg(F.sum("is_default")).first()[0]
    for view, rows, defaults in [
        (views.portfolio_overview(book), "total_loans", "total_defaults"),
        (views.default_by_credit_tier(book), "loan_count", "defaults"),
        (views.geographic_risk(book), "loan_count", "total_defaults"),
    ]:
        assert tuple(view.agg(F.sum(rows), F.sum(defaults)).first()) == (n, bad)
    for view, rows in [(views.risk_segmentation(book), "loan_count"), (views.sector_risk(book), "loan_count"),
                       (views.economic_regime(book), "originations")]:
        assert view.agg(F.sum(rows)).first()[0] == n


def test_extract_shapes(book):
    assert len(views.portfolio_overview(book).columns) == 15
    assert len(views.default_by_credit_tier(book).columns) == 11
    assert len(views.geographic_risk(book).columns) == 10


def test_first_quarter_has_no_change_and_gaps_are_skipped(loan):
    rows = [{"origination_date": dt.date(y, m, 1), "origination_year": y, "origination_quarter": q, "is_default": d}
            for y, m, q, d in [(2020, 1, "Q1", 0), (2020, 1, "Q1", 1), (2021, 7, "Q3", 1)]]
    got = views.economic_regime(engineer_features(loan(*rows), "sql"), ordered=True).collect()
    assert [r["default_rate_qoq_change"] for r in got] == [None, 50.0]


def test_exposure_at_risk_sums_defaulted_amounts(loan):
    df = engineer_features(loan({"is_default": 1, "loan_amount": 100.25}, {"loan_amount": 50.0}), "sql")
    row = views.portfolio_overview(df).first()
    assert (row["exposure_at_risk"], row["total_exposure"], row["default_rate_pct"]) == (100.25, 150.25, 50.0)


def test_early_warning(book, scores):
    keyed = book.where(F.col("loan_id").isNotNull())
    got = views.early_warning(keyed, scores)
    assert len(got.columns) == 24
    n = keyed.count()
    expected = sum(n // 10 + (1 if i < n % 10 else 0) for i in range(3))
    assert got.count() == expected
    flags = [c for c in got.columns if c.startswith("flag_")]
    total = sum((F.col(c) for c in flags[1:]), F.col(flags[0]))
    assert got.where(F.col("total_flags") != total).count() == 0
    assert got.where("xgb_default_prob IS NULL").count() > 0  # unscored loans stay


def test_unscored_loans_survive_and_other_versions_do_not_match(loan, spark):
    loans = loan({}, {})
    scores = spark.createDataFrame(
        [("LN00000001", "v0.9", 0.9, 0.9, "CRITICAL", 1)],
        "loan_id string, model_version string, xgb_default_prob double, ensemble_default_prob double, "
        "risk_tier string, if_is_anomaly int")
    assert lookups.loans_with_scores(loans, scores, "v1.0").where("risk_tier IS NULL").count() == 2
    assert lookups.loans_with_scores(loans, scores, "v0.9").where("risk_tier IS NULL").count() == 1


def test_model_rank_has_gaps_on_ties(spark):
    rows = [("a", "v1", "TEST", .8), ("b", "v1", "TEST", .8), ("c", "v1", "TEST", .7), ("a", "v1", "TRAIN", .5)]
    metrics = ["auc_pr", "f1_score", "precision_score", "recall_score", "ks_statistic", "gini_coefficient"]
    df = spark.createDataFrame(rows, "model_name string, model_version string, dataset string, auc_roc double").withColumns(
        {m: F.lit(0.5) for m in metrics} | {"eval_date": F.lit("2024-01-01").cast("date"), "n_samples": F.lit(1),
                                            "default_rate": F.lit(0.1)})
    got = {(r["model_name"], r["dataset"]): r["auc_rank"] for r in views.model_performance_view(df, True).collect()}
    assert got == {("a", "TEST"): 1, ("b", "TEST"): 1, ("c", "TEST"): 3, ("a", "TRAIN"): 1}


def test_register_and_list(spark, book, scores):
    names = views.register_views(spark, book.where("loan_id IS NOT NULL"), scores)
    assert len(names) == 7
    listed = {r["name"] for r in views.list_objects(spark).where("kind = 'view'").collect()}
    assert set(names) <= listed
    assert spark.table("vw_portfolio_overview").count() == views.portfolio_overview(book.where("loan_id IS NOT NULL")).count()


def test_dashboard_rates(book):
    tiers = views.default_by_credit_tier(book)
    row = dashboards.dashboard_tier(tiers).where("credit_score_bucket = '<580' AND loan_type = 'Auto'").first()
    part = tiers.where("credit_score_bucket = '<580' AND loan_type = 'Auto'").toPandas()
    assert row["avg_default_rate_pct"] == pytest.approx(part["default_rate_pct"].mean(), abs=1e-4)
    assert row["weighted_default_rate_pct"] == pytest.approx(100 * part["defaults"].sum() / part["loan_count"].sum(), abs=0.005)


def test_report_rows(book, scores):
    rows = {r["metric"]: r["value"] for r in report.risk_report(book, scores, "2024-06-30").collect()}
    assert len(rows) == 8 and rows["Report Date"] == "2024-06-30"
    assert rows["Total Loans"] == str(book.count())
    assert "E" not in rows["Total Exposure ($M)"]


def test_report_defaults_to_today(book, scores):
    rows = {r["metric"]: r["value"] for r in report.risk_report(book, scores).collect()}
    assert dt.date.fromisoformat(rows["Report Date"]) <= dt.date.today() + dt.timedelta(days=1)


def test_value_counts_descend(book):
    rows = summaries.value_counts(book, ["loan_status"], ordered=True).collect()
    counts = [r["rows"] for r in rows]
    assert counts == sorted(counts, reverse=True) and sum(counts) == book.count()


def test_describe_matches_pandas(book):
    got = {r["is_default"]: r for r in summaries.describe_by(book, "is_default", "risk_score").collect()}
    expected = book.select("is_default", "risk_score").toPandas().groupby("is_default")["risk_score"].describe()
    for key, row in expected.iterrows():
        assert [got[key][c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(
            row.tolist(), abs=1e-4)


def test_union_and_shuffle_keep_all_rows(book):
    keyed = book.where("loan_id IS NOT NULL").select("loan_id", "loan_type")
    parts = [keyed.where(F.col("loan_type") == t) for t in ("Mortgage", "Auto")] + [keyed.where("loan_type IS NULL")]
    assert summaries.union_products(*parts).exceptAll(keyed).count() == 0
    once = [r["loan_id"] for r in summaries.shuffle_rows(keyed, 1).collect()]
    assert once == [r["loan_id"] for r in summaries.shuffle_rows(keyed.repartition(5), 1).collect()]
    assert once != [r["loan_id"] for r in summaries.shuffle_rows(keyed, 2).collect()]
    assert sorted(once) == sorted(r["loan_id"] for r in keyed.collect())
