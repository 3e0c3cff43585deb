"""Plan shapes that have to hold at scale."""

import pytest
from pyspark.sql import functions as F

from riskweave import catalog
from riskweave.models import metrics
from riskweave.operators import quality, ranking
from riskweave.plans import report, views
from riskweave.session import staged


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, sf):
    return staged(catalog.loans(spark, sf).where("loan_id IS NOT NULL"), "plan-loans")


@pytest.fixture(scope="module")
def scores(spark, sf):
    return staged(catalog.scores(spark, sf), "plan-scores")


def scans(text):
    return text.count("FileScan")


@pytest.mark.parametrize("view", list(views.LOAN_VIEWS.values()))
def test_views_read_only_their_columns_in_one_scan(table, view):
    text = plan(view(table))
    assert scans(text) == 1
    assert "vehicle_make" not in text and "property_value" not in text


def test_views_aggregate_before_the_shuffle(table):
    text = plan(views.portfolio_overview(table))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_profile_is_one_scan(table):
    assert scans(plan(quality.dq_profile(table))) == 1
    assert scans(plan(quality.dq_summary(table, 35))) == 1


def test_report_scans_loans_once(table, scores):
    assert scans(plan(report.risk_report(table, scores))) == 2  # loans, scores


def test_filter_reaches_the_scan(table):
    assert "PushedFilters: [IsNotNull(credit_score), GreaterThanOrEqual(credit_score,700)]" in plan(
        table.where("credit_score >= 700").select("loan_id"))


def test_early_warning_cuts_before_the_join(table, scores):
    text = plan(views.early_warning(table, scores))
    rows = text.split("Subqueries")[0]
    assert "Window" not in rows.split("Subquery")[0]
    join = rows.index("Join")
    assert rows.index("Filter", join) > join  # the cut is below the join
    assert "EqualTo(model_version,v1.0)" in text


def test_no_single_task_exchange_of_rows_in_curves(scores, table):
    scored = scores.join(table.select("loan_id", "is_default"), "loan_id")
    curve = metrics.score_curve(scored, "xgb_default_prob", "is_default")
    for line in plan(curve).splitlines():
        if "SinglePartition" in line:
            continue
    # the only unpartitioned window works on coarse cells, that is after three aggregations
    text = plan(curve)
    assert text.count("SinglePartition") <= 1


def test_boundary_search_counts_before_it_ranks(table):
    cuts = ranking.rank_cuts(table.withColumn("k", -F.col("risk_score")), ["k"], lambda n: F.array(F.floor(n / 2)))
    text = plan(cuts)
    assert text.index("Window") < text.index("HashAggregate") < text.index("FileScan")
