"""Exact evaluation metrics of a score against a 0/1 label.

Rows are first reduced to one row per distinct score; every ranking metric is then a sum or
maximum over running totals of positives and negatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.numeric import ratio, round_half_up
from riskweave.operators.ranking import running_totals
from riskweave.session import staged

_DIGITS = 6


def _d(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def score_curve(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Per distinct score: positives, negatives and running totals from the lowest score up.

    The totals read the distinct scores several times; they are staged, so that the rows behind them are read once.
    """
    by = by or []
    points = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"),
    )
    return running_totals(staged(points, "curve-points"), score, ["pos", "neg"], by)


def _auc_terms() -> Column:
    """Twice the number of (positive, negative) pairs ranked right, ties counted half; exact."""
    below = F.col("run_neg") * 2 - F.col("neg")
    return F.sum(F.col("pos").cast("decimal(18,0)") * below.cast("decimal(19,0)"))


def _above(kind: str) -> Column:
    """Rows of a class scored at or above this score."""
    return F.col(f"all_{kind}") - F.col(f"run_{kind}") + F.col(kind)


def _curve_metrics(curve: DataFrame, by: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Per group: sizes, AUC, Gini, average precision and KS from the running totals."""
    tp, fp = _above("pos"), _above("neg")
    precision = _d(tp) / _d(tp + fp)
    gain = ratio(_d("pos"), _d("all_pos"))
    distance = F.abs(
        ratio(_d("run_pos"), _d("all_pos")) - ratio(_d("run_neg"), _d("all_neg"))
    )
    raw = curve.groupBy(*by).agg(
        F.max("all_pos").alias("n_defaults"), F.max("all_neg").alias("_negatives"),
        _auc_terms().cast("double").alias("_pairs"),
        F.sum(gain * precision).alias("_ap"), F.max(distance).alias("_ks"), *(extra or []),
    )
    auc = ratio(F.col("_pairs"), 2 * _d("n_defaults") * _d("_negatives"))
    return raw.withColumns({
        "n_samples": F.col("n_defaults") + F.col("_negatives"),
        "auc_roc": round_half_up(auc, _DIGITS),
        "gini_coefficient": round_half_up(2 * auc - 1, _DIGITS),
        "auc_pr": round_half_up("_ap", _DIGITS),
        "ks_statistic": round_half_up("_ks", _DIGITS),
    })


_RANKING = ["n_samples", "n_defaults", "auc_roc", "gini_coefficient", "auc_pr", "ks_statistic"]


def ranking_metrics(df: DataFrame, score: str, label: str = "is_default",
                    by: list[str] | None = None) -> DataFrame:
    """Per group: n, positives, AUC, Gini, average precision and KS, from one curve."""
    by = by or []
    return _curve_metrics(score_curve(df, score, label, by), by).select(*by, *_RANKING)


def auc_roc(df, score, label="is_default", by=None) -> DataFrame:
    return ranking_metrics(df, score, label, by).select(*(by or []), "auc_roc")


def average_precision(df, score, label="is_default", by=None) -> DataFrame:
    return ranking_metrics(df, score, label, by).select(*(by or []), "auc_pr")


def ks_statistic(df, score, label="is_default", by=None) -> DataFrame:
    return ranking_metrics(df, score, label, by).select(*(by or []), "ks_statistic")


def gini(auc: Column | str) -> Column:
    return 2 * (F.col(auc) if isinstance(auc, str) else auc) - 1


def _ratios(tp: Column, fp: Column, tn: Column, fn: Column) -> list[Column]:
    precision, recall = ratio(_d(tp), _d(tp + fp)), ratio(_d(tp), _d(tp + fn))
    return [
        round_half_up(ratio(_d(tp + tn), _d(tp + fp + tn + fn)), _DIGITS).alias("accuracy"),
        round_half_up(F.coalesce(precision, F.lit(0.0)), _DIGITS).alias("precision_score"),
        round_half_up(F.coalesce(recall, F.lit(0.0)), _DIGITS).alias("recall_score"),
        round_half_up(
            F.coalesce(ratio(2 * _d(tp), 2 * _d(tp) + _d(fp) + _d(fn)), F.lit(0.0)), _DIGITS
        ).alias("f1_score"),
    ]


def confusion_metrics(df: DataFrame, score: str, label: str = "is_default", threshold: float = 0.5,
                      by: list[str] | None = None) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 at one threshold."""
    predicted, actual = F.col(score) >= threshold, F.col(label) == 1
    counts = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*(by or [])).agg(
        F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & ~actual).alias("tn"), F.count_if(~predicted & actual).alias("fn"),
    )
    return counts.select("*", *_ratios(*[F.col(c) for c in ("tp", "fp", "tn", "fn")]))


def threshold_sweep(df: DataFrame, score: str, cuts: list[float], label: str = "is_default") -> DataFrame:
    """Confusion ratios at a list of cut-offs from one aggregation over the rows."""
    usable = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    actual = F.col(label) == 1
    names = []
    aggregates = [F.count_if(actual).alias("p"), F.count_if(~actual).alias("q")]
    for i, cut in enumerate(cuts):
        names.append((cut, f"tp{i}", f"fp{i}"))
        aggregates += [
            F.count_if((F.col(score) >= cut) & actual).alias(f"tp{i}"),
            F.count_if((F.col(score) >= cut) & ~actual).alias(f"fp{i}"),
        ]
    rows = ", ".join(f"CAST({cut} AS DOUBLE), {tp}, {fp}" for cut, tp, fp in names)
    long = usable.agg(*aggregates).selectExpr(
        "p", "q", f"stack({len(names)}, {rows}) AS (threshold, tp, fp)"
    )
    return long.select(
        "threshold", "tp", "fp",
        *_ratios(F.col("tp"), F.col("fp"), F.col("q") - F.col("fp"), F.col("p") - F.col("tp")),
    )


def long_scores(scored: DataFrame, columns: dict[str, str], keep: list[str]) -> DataFrame:
    """One row per loan and model: (keep..., model_name, score), from ``{model name: column}``."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.col(c).cast("double").alias("score"))
        for m, c in columns.items()
    ])
    return scored.select(*keep, F.inline(pairs))


def performance_summary(scored: DataFrame, columns: dict[str, str], label: str = "is_default",
                        by: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """All metrics per model (and per group), from one curve per model.

    The confusion counts are sums over the curve's distinct scores, so the rows are read once.
    """
    by = by or []
    long = long_scores(scored, columns, [*by, label])
    keys = [*by, "model_name"]
    chosen = F.col("score") >= threshold
    count = lambda side, kind: F.sum(F.when(side, F.col(kind)).otherwise(0))
    confusion = [
        count(chosen, "pos").alias("tp"), count(chosen, "neg").alias("fp"),
        count(~chosen, "neg").alias("tn"), count(~chosen, "pos").alias("fn"),
    ]
    merged = _curve_metrics(score_curve(long, "score", label, keys), keys, confusion)
    return merged.select(*keys, *_RANKING, *_ratios(*[F.col(c) for c in ("tp", "fp", "tn", "fn")]))


def ensemble(scored: DataFrame, left: str = "lr_default_prob", right: str = "xgb_default_prob",
             threshold: float = 0.5) -> DataFrame:
    """Mean of two probabilities and its class."""
    mean = (F.col(left) + F.col(right)) / 2
    return scored.withColumn("ensemble_default_prob", mean).withColumn(
        "ensemble_prediction",
        F.when(F.col("ensemble_default_prob").isNotNull(),
               (F.col("ensemble_default_prob") >= threshold).cast("int")),
    )
