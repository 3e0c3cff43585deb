"""Default models: scaled logistic regression, boosted trees, anomaly forest, and their scores."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.numeric import round_half_even, round_half_up
from riskweave.functions.risk import risk_tier
from riskweave.models import boosting
from riskweave.models.boosting import BoostedTrees
from riskweave.models.isolation import IsolationForest, fit_isolation_forest
from riskweave.models.smote import smote
from riskweave.models.split import stratified_split
from riskweave.session import scratch_path, staged


def feature_vector(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features")


def positive(probability: str) -> Column:
    """Probability of class 1 from a probability vector column."""
    return vector_to_array(probability)[1]


def fit_scaler(train: DataFrame, column: str = "features") -> StandardScalerModel:
    """Mean 0 and standard deviation 1, learnt on the training part only."""
    return StandardScaler(inputCol=column, outputCol="scaled", withMean=True, withStd=True).fit(train)


def fit_logistic(train: DataFrame, label: str = "is_default", column: str = "scaled",
                 max_iter: int = 1000) -> LogisticRegressionModel:
    """L2 logistic regression with balanced class weights.

    The penalty is one over the total weight, which is a unit penalty on the summed loss.
    """
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}  # two classes
    total = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for value, n in sizes.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(sizes) * n))).otherwise(weight)
    fitted = LogisticRegression(
        featuresCol=column, labelCol=label, weightCol="_weight", maxIter=max_iter, elasticNetParam=0.0,
        regParam=1.0 / total, standardization=False, probabilityCol="lr_vector",
        rawPredictionCol="lr_raw", predictionCol="lr_class",
    ).fit(train.withColumn("_weight", weight))
    # a freshly fitted model carries its training summary and with it the session, which cannot be
    # sent to tasks once the session has observed a query; the stored model carries only itself
    path = scratch_path(train.sparkSession, "logistic-model")
    fitted.write().save(path)
    return LogisticRegressionModel.load(path)


def logistic_gradient(model: LogisticRegressionModel, scaled: DataFrame, features: list[str], label: str = "is_default") -> DataFrame:
    """(feature, gradient, rows): derivative of the penalised mean loss by each coefficient, 0 at the optimum."""
    sizes = {r[label]: r["count"] for r in scaled.groupBy(label).count().collect()}  # two classes
    total = sum(sizes.values())
    weight = F.create_map(*[x for y, n in sizes.items() for x in (F.lit(y), F.lit(total / (len(sizes) * n)))])[F.col(label)]
    x = vector_to_array("scaled")
    rest = weight * (positive("lr_vector") - F.col(label))
    sums = model.transform(scaled).agg(
        *[F.sum(rest * x[j]).alias(f"g{j}") for j in range(len(features))], F.count(F.lit(1)).alias("rows"))
    rows = ", ".join(f"'{f}', g{j} / {total} + {float(model.coefficients[j])!r}D / {total}" for j, f in enumerate(features))
    return sums.selectExpr("rows", f"stack({len(features)}, {rows}) AS (feature, gradient)").select("feature", "gradient", "rows")


def score_frame_violations(frame: DataFrame) -> DataFrame:
    """One row: rows, keys, and rows whose mean, class predictions, tier or range disagree with the probabilities."""
    lr, xgb, both = (F.col(f"{m}_default_prob") for m in ("lr", "xgb", "ensemble"))
    predicted = [F.col(f"{m}_prediction") != (p >= 0.5).cast("int") for m, p in (("lr", lr), ("xgb", xgb), ("ensemble", both))]
    near = F.abs(F.round(both * 10_000) / 10_000 - 0.5) < 0.0001  # rounded after the class was set
    return frame.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("loan_id").alias("loans"),
        F.count_if(F.abs((lr + xgb) / 2 - both) > 0.0001 + 1e-9).alias("off_mean"),
        F.count_if((predicted[0] & (F.abs(lr - 0.5) > 0.0001)) | (predicted[1] & (F.abs(xgb - 0.5) > 0.0001)) | (predicted[2] & ~near)).alias("off_class"),
        F.count_if((F.greatest(lr, xgb, both) > 1) | (F.least(lr, xgb, both) < 0)).alias("off_range"),
        F.count_if(F.array_position(F.array(*[F.lit(t) for t in V.RISK_TIERS]), F.col("risk_tier")) == 0).alias("off_tier"))


def feature_importances(spark: SparkSession, model: BoostedTrees, top: int | None = None) -> DataFrame:
    """(feature, importance) adding up to 1, highest first: the mean gain of the feature's splits."""
    rows = list(zip(model.features, model.importances()))
    out = spark.createDataFrame(rows, "feature string, importance double")
    out = out.orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


@dataclass
class TrainedModels:
    features: list[str]
    split: DataFrame           # key, label, features, split
    balanced: DataFrame        # key, label, x after synthetic balancing
    scaler: StandardScalerModel
    logistic: LogisticRegressionModel
    boosted: BoostedTrees
    forest: IsolationForest

    @property
    def train(self) -> DataFrame:
        return self.split.where(F.col("split") == "train").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.split.where(F.col("split") == "test").drop("split")

    def predict(self, df: DataFrame) -> DataFrame:
        """Add probabilities of both models, their mean, the anomaly score and the flag.

        All models run over the same rows one after the other, so nothing has to be joined.
        """
        out = feature_vector(self.features).transform(df)
        out = PipelineModel([self.scaler, self.logistic]).transform(out)
        out = out.withColumns({
            "lr_default_prob": positive("lr_vector"), "xgb_default_prob": self.boosted.probability(),
        }).select(*df.columns, "lr_default_prob", "xgb_default_prob")
        out = out.withColumn("ensemble_default_prob", (F.col("lr_default_prob") + F.col("xgb_default_prob")) / 2)
        return self.forest.score(out)


def train_models(frame: DataFrame, features: list[str] | None = None, label: str = "is_default",
                 key: str = "loan_id", trees: int = 300, depth: int = 6, isolation_trees: int = 200,
                 seed: int = 42) -> TrainedModels:
    """Split, balance, scale and fit everything on ``frame`` (key, label and feature columns).

    The boosted trees grow while the other models are fitted: their many small jobs leave cores idle.
    """
    features = features or V.MODEL_FEATURES
    numeric = [F.col(f).cast("double").alias(f) for f in features]
    rows = staged(frame.select(key, label, *numeric), "model-frame")
    split = staged(stratified_split(rows, key, label, seed=seed), "model-split")
    train = split.where(F.col("split") == "train")
    with ThreadPoolExecutor(1) as beside:
        boosted = beside.submit(inheritable_thread_target(frame.sparkSession)(
            lambda: boosting.fit(train, features, label, key, trees, depth, seed=seed)))
        balanced = staged(smote(train, features, label, key, seed=seed), "model-balanced")
        vectors = balanced.select(label, array_to_vector("x").alias("features"))
        scaler = fit_scaler(vectors)
        logistic = fit_logistic(scaler.transform(vectors), label)
        forest = fit_isolation_forest(train, features, key, isolation_trees, seed=seed)
        return TrainedModels(list(features), split, balanced, scaler, logistic, boosted.result(), forest)


def score_frame(predicted: DataFrame, version: str = "v1.0", key: str = "loan_id",
                label: str = "is_default", threshold: float = 0.5) -> DataFrame:
    """The 12 columns handed to the score table, probabilities at four decimals."""
    decided = lambda c: (F.col(c) >= threshold).cast("int")
    return predicted.select(
        key, F.lit(version).alias("model_version"),
        round_half_even("lr_default_prob", 4).alias("lr_default_prob"),
        decided("lr_default_prob").alias("lr_prediction"),
        round_half_even("xgb_default_prob", 4).alias("xgb_default_prob"),
        decided("xgb_default_prob").alias("xgb_prediction"),
        round_half_even("ensemble_default_prob", 4).alias("ensemble_default_prob"),
        decided("ensemble_default_prob").alias("ensemble_prediction"),
        round_half_even("if_anomaly_score", 4).alias("if_anomaly_score"), "if_is_anomaly",
        risk_tier("ensemble_default_prob").alias("risk_tier"),
        F.col(label).alias("actual_default"),
    )


def balance_report(models: TrainedModels, label: str = "is_default") -> DataFrame:
    """Sizes and default rates of the train, test and balanced train parts."""
    parts = models.split.select(F.col("split").alias("part"), label).unionByName(
        models.balanced.select(F.lit("train balanced").alias("part"), label))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).cast("bigint").alias("defaults"),
        round_half_up(F.avg(label), 6).alias("default_rate"),
    )
