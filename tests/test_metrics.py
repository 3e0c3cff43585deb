import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.models import metrics


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(rng.normal(0.4 + 0.15 * y, 0.2), 0, 1), 2)  # many ties
    s[::3] = 0.37
    return s, y


@pytest.fixture(scope="module")
def frame(spark, sample):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(*sample)], "s double, is_default int")


def brute(s, y):
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    cuts = np.unique(s)
    ks = max(abs((pos <= c).mean() - (neg <= c).mean()) for c in cuts)
    ap, last = 0.0, 0.0
    for c in cuts[::-1]:
        hit = s >= c
        recall = y[hit].sum() / y.sum()
        ap += (recall - last) * y[hit].mean()
        last = recall
    return auc, ap, ks


def test_ranking_metrics_equal_brute_force(frame, sample):
    auc, ap, ks = brute(*sample)
    row = metrics.ranking_metrics(frame, "s").first()
    assert row["auc_roc"] == pytest.approx(auc, abs=1e-6)
    assert row["auc_pr"] == pytest.approx(ap, abs=1e-6)
    assert row["ks_statistic"] == pytest.approx(ks, abs=1e-6)
    assert row["gini_coefficient"] == pytest.approx(2 * auc - 1, abs=1e-6)


def test_metrics_do_not_depend_on_partitioning(spark, frame):
    once = metrics.ranking_metrics(frame, "s").collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert metrics.ranking_metrics(frame.repartition(17), "s").collect() == once
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_continuous_scores(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 300)
    s = 0.5 + 1e-9 * rng.normal(y, 1)  # all in one coarse cell
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, is_default int")
    auc, ap, ks = brute(s, y)
    row = metrics.ranking_metrics(df, "s").first()
    assert [row["auc_roc"], row["auc_pr"], row["ks_statistic"]] == pytest.approx([auc, ap, ks], abs=1e-6)


def test_one_class_gives_null_not_an_error(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0)], "s double, is_default int")
    assert metrics.ranking_metrics(df, "s").first()["auc_roc"] is None


def test_confusion_and_sweep(frame, sample):
    s, y = sample
    row = metrics.confusion_metrics(frame, "s").first()
    hit = s >= 0.5
    assert (row["tp"], row["fp"]) == ((hit & (y == 1)).sum(), (hit & (y == 0)).sum())
    precision, recall = y[hit].mean(), y[hit].sum() / y.sum()
    assert row["precision_score"] == pytest.approx(precision, abs=1e-6)
    assert row["f1_score"] == pytest.approx(2 * precision * recall / (precision + recall), abs=1e-6)
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(frame, "s", [0.3, 0.5]).collect()}
    assert sweep[0.5]["recall_score"] == row["recall_score"]
    assert sweep[0.3]["tp"] >= sweep[0.5]["tp"]


def test_no_predicted_positive_gives_zero(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "s double, is_default int")
    row = metrics.confusion_metrics(df, "s").first()
    assert (row["precision_score"], row["recall_score"], row["f1_score"]) == (0.0, 0.0, 0.0)


def test_summary_per_model(frame):
    df = frame.withColumn("t", 1 - F.col("s"))
    rows = {r["model_name"]: r for r in metrics.performance_summary(df, {"up": "s", "down": "t"}).collect()}
    assert rows["up"]["auc_roc"] + rows["down"]["auc_roc"] == pytest.approx(1.0, abs=1e-6)


def test_ensemble(spark):
    df = spark.createDataFrame([(0.4, 0.6), (0.2, 0.4), (None, 0.4)], "lr_default_prob double, xgb_default_prob double")
    rows = metrics.ensemble(df).collect()
    assert [(r["ensemble_default_prob"], r["ensemble_prediction"]) for r in rows][0] == (0.5, 1)
    assert rows[1]["ensemble_prediction"] == 0 and rows[2]["ensemble_prediction"] is None


def test_the_rows_behind_a_curve_are_read_once(frame):
    marked = frame.where("s + 0.0 >= -12345")
    plan = metrics.performance_summary(marked, {"m": "s"})._jdf.queryExecution().optimizedPlan().toString()
    assert "12345" not in plan  # the totals read the staged scores
