"""Acceptance gates of a trained model set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.models.metrics import long_scores, ranking_metrics
from riskweave.operators.summaries import tier_separation

PROBABILITIES = ["lr_default_prob", "xgb_default_prob", "ensemble_default_prob"]


def validation_gates(scores: DataFrame, split: DataFrame, label: str = "is_default") -> DataFrame:
    """(gate, value, passed) for a score frame and the split it came from."""
    auc = ranking_metrics(
        long_scores(scores, {"lr": "lr_default_prob", "xgb": "xgb_default_prob"}, ["actual_default"]),
        "score", "actual_default", ["model_name"],
    ).groupBy().pivot("model_name", ["lr", "xgb"]).agg(F.max("auc_roc"))
    model_gates = auc.selectExpr(
        "stack(3, 'boosted AUC above 0.5', xgb, xgb > 0.5D, 'boosted AUC minus logistic AUC above 0', "
        "xgb - lr, xgb > lr, 'Gini above 0', 2 * xgb - 1, 2 * xgb - 1 > 0) AS (gate, value, passed)"
    )
    outside = F.count_if(F.greatest(*PROBABILITIES) > 1) + F.count_if(F.least(*PROBABILITIES) < 0)
    row_gates = scores.agg(
        outside.cast("double").alias("outside"), F.avg("if_is_anomaly").alias("anomalies")
    ).selectExpr(
        "stack(2, 'probabilities outside [0, 1]', outside, outside = 0D, "
        "'anomaly rate within 2-10 %', anomalies, anomalies BETWEEN 0.02 AND 0.10) AS (gate, value, passed)"
    )
    rate = lambda part: F.avg(F.when(F.col("split") == part, F.col(label)))
    split_gates = split.agg(
        F.avg(label).alias("r"), F.abs(rate("train") - rate("test")).alias("gap")
    ).selectExpr(
        "stack(2, 'default rate within 5-25 %', r, r BETWEEN 0.05 AND 0.25, "
        "'train and test rates within 0.02', gap, gap < 0.02) AS (gate, value, passed)"
    )
    tiers = tier_separation(scores, "actual_default").select(
        F.lit("CRITICAL default rate above LOW").alias("gate"), F.col("separation").alias("value"),
        F.col("separates").alias("passed"),
    )
    return model_gates.unionByName(row_gates).unionByName(split_gates).unionByName(tiers)
