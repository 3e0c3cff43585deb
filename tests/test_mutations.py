import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskweave.operators import lookups, mutations
from riskweave.schemas import INCOMING_SCORES, MODEL_SCORES


@pytest.fixture()
def target(spark):
    rows = [("A", "v1", None, .1, 0, .1, 0, .10, 0, -.4, 0, "LOW"), ("B", "v1", None, .5, 1, .5, 1, .50, 1, -.5, 1, "HIGH"),
            ("A", "v0", None, .9, 1, .9, 1, .90, 1, -.6, 1, "CRITICAL")]
    return spark.createDataFrame(rows, MODEL_SCORES)


@pytest.fixture()
def delivered(spark):
    return spark.createDataFrame([("A", .7, 1, .7, 1, .70, 1, -.7, 1), ("C", .2, 0, .2, 0, .20, 0, -.3, 0)], INCOMING_SCORES)


def by_key(df):
    return {(r["loan_id"], r["model_version"]): r for r in df.collect()}


def test_merge_updates_inserts_and_keeps(target, delivered):
    got = by_key(mutations.merge_scores(target, delivered, "v1"))
    assert set(got) == {("A", "v1"), ("B", "v1"), ("C", "v1"), ("A", "v0")}
    assert got["A", "v1"]["risk_tier"] == "CRITICAL" and got["A", "v1"]["lr_prediction"] == 1
    assert got["C", "v1"]["risk_tier"] == "MEDIUM" and got["C", "v1"]["scored_at"] is not None
    assert got["B", "v1"]["ensemble_default_prob"] == .5 and got["B", "v1"]["scored_at"] is None
    assert got["A", "v0"]["ensemble_default_prob"] == .9


def test_strict_merge_leaves_old_predictions(target, delivered):
    got = by_key(mutations.merge_scores(target, delivered, "v1", keep_predictions=True))
    row = got["A", "v1"]
    assert (row["lr_default_prob"], row["lr_prediction"], row["ensemble_prediction"]) == (.7, 0, 0)
    assert row["if_is_anomaly"] == 1 and got["C", "v1"]["lr_prediction"] == 0


def test_merge_is_idempotent(target, delivered):
    once = mutations.merge_scores(target, delivered, "v1").drop("scored_at")
    twice = mutations.merge_scores(mutations.merge_scores(target, delivered, "v1"), delivered, "v1").drop("scored_at")
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0


def test_merge_overwrites_with_null(target, spark):
    delivered = spark.createDataFrame([("A", None, 0, .3, 0, None, 0, None, 0)], INCOMING_SCORES)
    row = by_key(mutations.merge_scores(target, delivered, "v1"))["A", "v1"]
    assert row["lr_default_prob"] is None and row["risk_tier"] == "LOW"


def test_duplicate_delivery_is_rejected(target, delivered):
    with pytest.raises(PySparkException, match="more than one incoming score"):
        mutations.merge_scores(target, delivered.unionByName(delivered), "v1").collect()


def test_merge_summary(target, delivered):
    message = mutations.merge_summary(mutations.merge_scores(target, delivered, "v1"), "v1").first()["message"]
    assert message == "Loaded 3 scores for model version v1"


def test_incoming_view(spark, delivered):
    assert spark.table(mutations.incoming_view(delivered)).count() == 2


def test_log_performance(spark):
    rows = mutations.sample_performance(spark)
    log = mutations.log_performance(mutations.performance_rows(rows, "2024-01-01"), rows.limit(0), "2024-01-02")
    assert log.count() == 3
    first = log.where("model_name = 'XGBoost' AND dataset = 'TEST'").first()
    assert first["gini_coefficient"] == pytest.approx(2 * 0.9421 - 1)
    assert first["default_rate"] == pytest.approx(5512 / 50000)
    better = rows.where("dataset = 'TRAIN'").withColumn("auc_roc", F.lit(0.99)).withColumn("n_samples", F.lit(0))
    log = mutations.log_performance(log, better, "2024-01-02")
    row = log.where("dataset = 'TRAIN'").first()
    assert log.count() == 3 and row["auc_roc"] == 0.99 and row["default_rate"] is None
    assert str(row["eval_date"]) == "2024-01-02"
    message = mutations.performance_message(rows).where("dataset = 'TRAIN'").first()["message"]
    assert message == "Logged performance for XGBoost vv1.0 (TRAIN): AUC=0.9634, F1=0.8417"


def test_log_performance_computes_the_metrics_once(spark):
    rows = mutations.sample_performance(spark)
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    seen = rows.mapInArrow(count, rows.schema)
    log = mutations.log_performance(mutations.performance_rows(rows.limit(0), "2024-01-01"), seen, "2024-01-02")
    assert log.count() == 3 and counted.value == 3
    log = mutations.log_performance(mutations.performance_rows(rows, "2024-01-01"), seen, "2024-01-02")
    assert {str(r["eval_date"]) for r in log.collect()} == {"2024-01-02"} and counted.value == 6


def test_refresh_tiers(target):
    stale = target.withColumn("risk_tier", F.lit("LOW"))
    refreshed, summary = mutations.refresh_risk_tiers(stale)
    assert {r["risk_tier"] for r in refreshed.collect()} == {"LOW", "HIGH", "CRITICAL"}
    assert summary.first()["message"] == (
        "Risk tiers refreshed for 3 loans. CRITICAL: 1 | HIGH: 1 | MEDIUM: 0 | LOW: 1")


def test_insert_missing(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert sorted(map(tuple, lookups.insert_missing(target, source, ["k"]).collect())) == [(1, "a"), (2, "c")]


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    mutations.replace_table(a, path, ["p"])
    mutations.append_rows(spark.createDataFrame([(3, "x")], "v int, p string"), path, ["p"])
    assert spark.read.parquet(path).count() == 3
    mutations.replace_partitions(spark.createDataFrame([(9, "x")], "v int, p string"), path, ["p"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 9]
    mutations.replace_table(spark.createDataFrame([(7, "z")], "v int, p string"), path, ["p"])
    assert spark.read.parquet(path).count() == 1


def test_leakage_and_key_sets(spark):
    a = spark.createDataFrame([("A",), ("B",)], "loan_id string")
    b = spark.createDataFrame([("B",), ("C",)], "loan_id string")
    row = lookups.check_no_leakage(a, b).first()
    assert (row["train_rows"], row["test_rows"], row["shared_keys"]) == (2, 2, 1)
    assert lookups.shared_rows(a, b).count() == lookups.shared_keys(a, b).count() == 1
