"""Table changes as pure functions: old snapshot in, new snapshot out.

Files cannot be updated in place, so a merge is a join that yields the next snapshot;
:func:`replace_partitions` puts it where the table lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import ratio
from riskweave.functions.risk import risk_tier
from riskweave.operators.summaries import tier_distribution, with_risk_tier
from riskweave.schemas import MODEL_PERFORMANCE, MODEL_SCORES
from riskweave.session import staged

_PREDICTIONS = ["lr_prediction", "xgb_prediction", "ensemble_prediction"]


def incoming_view(scores: DataFrame, name: str = "incoming_scores") -> str:
    """Register scores about to be merged as a session view and return its name."""
    scores.createOrReplaceTempView(name)
    return name


def _one_row_per_loan(incoming: DataFrame) -> DataFrame:
    """The frame itself; the job fails if a loan occurs twice (a merge would be ambiguous)."""
    others = [c for c in incoming.columns if c != "loan_id"]
    # max() of a single row is that row; on numeric columns it keeps the hash aggregate
    packed = incoming.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in others]
    )
    error = F.raise_error(F.concat(F.lit("more than one incoming score for loan "), F.col("loan_id")))
    return packed.select(
        F.when(F.col("_n") > 1, error).otherwise(F.col("loan_id")).alias("loan_id"), *others
    )


def merge_scores(target: DataFrame, incoming: DataFrame, version: str,
                 keep_predictions: bool = False) -> DataFrame:
    """Upsert one model version's scores by loan.

    A known loan gets new probabilities, anomaly values, tier and time; a new loan gets all
    columns.  With ``keep_predictions`` a known loan keeps its old class predictions, as the
    original procedure leaves them; otherwise they follow the new scores.  Other versions pass
    through untouched and are not shuffled.
    """
    incoming = _one_row_per_loan(incoming).withColumns({
        "model_version": F.lit(version), "scored_at": F.current_timestamp(),
        "risk_tier": risk_tier("ensemble_default_prob"),
    })
    columns = [c for c in MODEL_SCORES.fieldNames() if c in target.columns]
    same_version = F.col("model_version") == version
    joined = (
        target.where(same_version).withColumn("_old", F.lit(True)).alias("t")
        .join(incoming.withColumn("_new", F.lit(True)).alias("s"), "loan_id", "full")
    )
    kept = _PREDICTIONS if keep_predictions else []

    def merged(c: str):
        if c == "loan_id":
            return F.col("loan_id")
        new, old = F.col(f"s.{c}"), F.col(f"t.{c}")
        if c in kept:
            return F.when(F.col("_old"), old).otherwise(new).alias(c)
        return F.when(F.col("_new"), new).otherwise(old).alias(c)

    changed = joined.select(*[merged(c) for c in columns])
    return target.where(~F.coalesce(same_version, F.lit(False))).select(*columns).unionByName(changed)


def merge_summary(scores: DataFrame, version: str) -> DataFrame:
    """One text row with the number of scores now held for a version."""
    return scores.where(F.col("model_version") == version).agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("Loaded "), F.col("n").cast("string"),
                 F.lit(f" scores for model version {version}")).alias("message")
    )


def performance_rows(metrics: DataFrame, eval_date=None) -> DataFrame:
    """Metric rows with the derived columns: Gini, default rate and evaluation date."""
    day = F.current_date() if eval_date is None else F.lit(eval_date).cast("date")
    return metrics.withColumns({
        "eval_date": day,
        "default_rate": ratio(F.col("n_defaults").cast("double"), F.col("n_samples").cast("double")),
        "gini_coefficient": 2 * F.col("auc_roc") - 1,
    }).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MODEL_PERFORMANCE.fields])


def log_performance(target: DataFrame, metrics: DataFrame, eval_date=None) -> DataFrame:
    """Upsert metric rows by (model_name, model_version, dataset).

    The rows are used twice and staged, so that the metrics are computed once.
    """
    keys = ["model_name", "model_version", "dataset"]
    rows = staged(performance_rows(metrics, eval_date), "performance-rows")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return target.alias("t").join(rows.alias("r"), same, "left_anti").unionByName(rows)


def performance_message(metrics: DataFrame) -> DataFrame:
    """One text line per logged metric row."""
    text = F.format_string(
        "Logged performance for %s v%s (%s): AUC=%s, F1=%s",
        "model_name", "model_version", "dataset",
        F.col("auc_roc").cast("string"), F.col("f1_score").cast("string"),
    )
    return metrics.select("model_name", "model_version", "dataset", text.alias("message"))


def sample_performance(spark: SparkSession) -> DataFrame:
    """The three example rows of the performance log."""
    return spark.createDataFrame(
        V.SAMPLE_PERFORMANCE,
        "model_name string, model_version string, dataset string, n_samples long, n_defaults long, "
        "auc_roc double, auc_pr double, accuracy double, precision_score double, "
        "recall_score double, f1_score double, ks_statistic double",
    )


def refresh_risk_tiers(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scores with tiers recomputed from the ensemble probability, one-row summary)."""
    refreshed = with_risk_tier(scores)
    per_tier = tier_distribution(refreshed)
    count_of = lambda t: F.coalesce(F.sum(F.when(F.col("risk_tier") == t, F.col("loans"))), F.lit(0))
    summary = per_tier.agg(
        F.coalesce(F.sum("loans"), F.lit(0)).alias("total"),
        *[count_of(t).alias(t.lower()) for t in V.RISK_TIERS],
    )
    text = F.concat(
        F.lit("Risk tiers refreshed for "), F.col("total").cast("string"), F.lit(" loans. "),
        F.concat_ws(" | ", *[F.concat(F.lit(f"{t}: "), F.col(t.lower()).cast("string")) for t in V.RISK_TIERS]),
    )
    return refreshed, summary.withColumn("message", text)


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy(*(partition_by or [])).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that occur in the frame."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition_by).parquet(path)
