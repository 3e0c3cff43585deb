"""Isolation forest (Liu, Ting and Zhou 2008) with tree building and scoring spread over tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.ranking import exact_percentiles
from riskweave.session import staged

_NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int"
_OVERSAMPLE = 1.3
_UNIT = 2 ** 32


def average_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, size) of one random tree; feature -1 is a leaf."""
    nodes: list[list] = []
    stack = [(np.arange(len(points)), 0, -1, 0)]
    while stack:
        rows, depth, parent, side = stack.pop()
        index = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = index
        part = points[rows]
        open_axes = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(open_axes) == 0:
            nodes.append([-1, 0.0, -1, -1, len(rows)])
            continue
        axis = int(rng.choice(open_axes))
        low, high = part[:, axis].min(), part[:, axis].max()
        cut = rng.uniform(low, high)
        left = part[:, axis] <= cut
        nodes.append([axis, float(cut), -1, -1, len(rows)])
        stack.append((rows[~left], depth + 1, index, 1))
        stack.append((rows[left], depth + 1, index, 0))
    return nodes


def _point(features: list[str]) -> Column:
    """The features as one struct, which a pandas function receives as a frame."""
    return F.struct(*[F.col(f).cast("double").alias(f) for f in features])


@dataclass
class IsolationForest:
    """Trees as padded arrays (trees x nodes), the sample size and the flagging threshold."""

    features: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    sample: int
    cutoff: float | None = None

    def full_trees(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The trees in heap order, all of one depth: feature, threshold (trees x inner nodes) and mean path by leaf.

        The children of node i are 2 i + 1 and 2 i + 2; what stood above a leaf of a shorter branch leads there either way.
        """
        trees = np.arange(self.feature.shape[0])[:, None]
        node, depth = np.zeros((len(trees), 1), np.int32), np.zeros((len(trees), 1))
        features, thresholds = [], []
        while (inner := self.feature[trees, node] >= 0).any():
            features.append(np.maximum(self.feature[trees, node], 0))
            thresholds.append(np.where(inner, self.threshold[trees, node], 0.0))
            children = [np.where(inner, side[trees, node], node) for side in (self.left, self.right)]
            node = np.stack(children, axis=2).reshape(len(trees), -1)
            depth = np.repeat(depth + inner, 2, axis=1)
        empty = np.zeros((len(trees), 0))
        return (np.hstack([empty.astype(np.int64), *features]), np.hstack([empty, *thresholds]), depth + self.path[trees, node])

    def anomaly_scores(self, points: np.ndarray, full: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Minus the anomaly score of each row; lower is more anomalous. ``full`` are the :meth:`full_trees`, if at hand."""
        features, thresholds, paths = full or self.full_trees()
        flat, rows = np.ascontiguousarray(points.T).ravel(), np.arange(len(points))
        found = np.empty((len(points), len(paths)))
        for t, path in enumerate(paths):
            start, node = features[t] * len(points), np.zeros(len(points), np.int64)  # where the node's column begins
            for _ in range(path.size.bit_length() - 1):
                node = 2 * node + 2 - (flat[start[node] + rows] <= thresholds[t][node])
            found[:, t] = path[node - start.size]
        return -np.power(2.0, -found.mean(axis=1) / average_path(self.sample))

    def score(self, df: DataFrame, name: str = "if_anomaly_score", flag: str = "if_is_anomaly") -> DataFrame:
        """Add the score and, once a cutoff is known, the 0/1 flag."""
        forest = self  # trees x (2 * sample - 1) nodes, sent along with the function
        features, columns = self.features, df.columns

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            full = forest.full_trees()
            for part in batches:
                points = part.to_numpy(dtype=float)
                step = 8192
                out = [forest.anomaly_scores(points[i:i + step], full) for i in range(0, len(points), step)]
                yield pd.Series(np.concatenate(out) if out else np.zeros(0))

        scored = df.select(*columns, scores(_point(features)).alias(name))
        if self.cutoff is None:
            return scored
        return scored.withColumn(flag, (F.col(name) < F.lit(self.cutoff)).cast("int"))


def _draws(df: DataFrame, key: str, n: int, trees: int, sample: int, seed: int) -> DataFrame:
    """(row, tree) pairs, ``min(n, sample)`` distinct rows a tree (a few less may occur for tiny samples).

    About 1.3 x sample distinct rows are drawn per tree and cut to the sample by hash. Drawing with
    repeats needs more draws the smaller the table; below twice the sample every tree sees all rows.
    """
    order = Window.partitionBy("tree").orderBy(F.xxhash64(F.col(key), F.col("tree"), F.lit(seed)), key)
    if n <= 2 * sample:
        drawn = df.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        return drawn.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= sample).drop("_r")
    expected = -trees * float(np.log1p(-sample * _OVERSAMPLE / n))
    whole, part = int(expected), expected - int(expected)
    chance = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_UNIT)) / F.lit(float(_UNIT))
    count = F.lit(whole) + (chance < F.lit(part)).cast("int")
    drawn = (
        df.withColumn("_n", count).where("_n > 0")
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .withColumn("tree", F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1), F.col("_i")), F.lit(trees)).cast("int"))
        .drop("_n", "_i").dropDuplicates([key, "tree"])
    )
    return drawn.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= sample).drop("_r")


def fit_isolation_forest(df: DataFrame, features: list[str], key: str = "loan_id", trees: int = 200,
                         sample: int = 256, contamination: float = 0.05, seed: int = 42) -> IsolationForest:
    """Grow the trees and set the cutoff at the contamination quantile of the training scores."""
    rows = df.select(key, *features)
    n = rows.count()
    sample = min(sample, n)
    limit = int(np.ceil(np.log2(max(sample, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = pdf.sort_values(key)[features].to_numpy(dtype=float)
        nodes = _grow(points, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "size"])
        return out.assign(tree=tree, node=range(len(out)))[["tree", "node", "feature", "threshold", "left", "right", "size"]]

    # one group holds at most ``sample`` rows; the driver gets trees x (2 * sample - 1) small rows
    nodes = _draws(rows, key, n, trees, sample, seed).groupBy("tree").applyInPandas(build, _NODE_SCHEMA).toPandas()
    grown = sorted(nodes["tree"].unique())
    width = int(nodes["node"].max()) + 1
    shape = (len(grown), width)
    row = nodes["tree"].map({t: i for i, t in enumerate(grown)}).to_numpy()
    col = nodes["node"].to_numpy()

    def padded(name, fill, dtype):
        out = np.full(shape, fill, dtype=dtype)
        out[row, col] = nodes[name].to_numpy()
        return out

    forest = IsolationForest(
        list(features), padded("feature", -1, np.int32), padded("threshold", 0.0, float),
        padded("left", 0, np.int32), padded("right", 0, np.int32),
        average_path(padded("size", 0, np.int32)), sample,
    )
    scores = staged(forest.score(rows).select("if_anomaly_score"), "isolation-scores")
    name = f"p{round(contamination * 100)}"
    forest.cutoff = float(exact_percentiles(scores, "if_anomaly_score", [contamination]).first()[name])
    return forest
