"""Additive feature contributions of boosted trees (path-dependent TreeSHAP, Lundberg et al. 2018).

For every leaf only the features on its path matter: a row meets or fails each one's interval (m = 1 or
0), and a share s of the cover follows the path there. The Shapley weights of subsets of the others are
Beta integrals, so feature j's part of leaf value v is

    v (m_j - s_j) * integral over t in [0, 1] of the product over the others of (s (1 - t) + m t),

a polynomial in t that Gauss-Legendre points integrate exactly. A leaf with d features on its path costs
about d * d / 2 multiplications, whatever the depth; no subset is ever listed.

Rows differ to a leaf only in the intervals they meet, so a tree is cut into small subtrees: the answers of a
subtree's cuts and of those above it, a bit each, number the sums of its leaves' contributions. These are tabled
once per tree and many rows; a row looks them up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.numeric import correlation, round_half_up
from riskweave.models.boosting import BoostedTrees, Tree

#: Rows explained at once, and rows for which a tree is tabled.
_ROWS, _TABLED_ROWS = 8192, 200_000
#: Levels of a subtree, and cuts whose answers number its sums, at most.
_LEVELS, _BITS = 3, 12


@dataclass
class _Leaf:
    features: np.ndarray   # distinct features on the path
    low: np.ndarray        # interval (low, high] each of them must fall in
    high: np.ndarray
    share: np.ndarray      # part of the cover that follows the path, per feature
    value: float

    def add(self, points: np.ndarray, out: np.ndarray) -> None:
        part = points[:, self.features]
        out[:, self.features] += self.parts((part > self.low) & (part <= self.high))

    def parts(self, met: np.ndarray) -> np.ndarray:
        """Contributions of the leaf's features where these intervals are met (rows x features)."""
        d = len(self.features)
        at, weight = np.polynomial.legendre.leggauss(-(-d // 2))
        at, weight = (at + 1) / 2, weight / 2
        # rows x features x integration points; never 0, since 0 < share and t < 1
        factors = self.share[None, :, None] * (1 - at) + met[:, :, None] * at
        others = factors.prod(axis=1, keepdims=True) / factors
        return self.value * (met - self.share) * (others @ weight)


def _leaves(tree: Tree) -> tuple[list[_Leaf], float]:
    """Leaves with features on their path, and the tree's expected value."""
    leaves, expected = [], 0.0
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, path = stack.pop()
        if tree.feature[node] < 0:
            features = np.array(sorted(path), dtype=int)
            low, high, share = (np.array([path[f][i] for f in features]) for i in range(3))
            expected += float(tree.value[node]) * float(np.prod(share))
            if len(features):
                leaves.append(_Leaf(features, low, high, share, float(tree.value[node])))
            continue
        f, cut = int(tree.feature[node]), float(tree.threshold[node])
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        left, right = 2 * node + 1, 2 * node + 2
        for child, bounds in ((left, (low, min(high, cut))), (right, (max(low, cut), high))):
            part = tree.cover[child] / (tree.cover[left] + tree.cover[right])
            stack.append((child, path | {f: (*bounds, share * part)}))
    return leaves, expected


@dataclass
class _Subtree:
    """Sums of contributions of a subtree's leaves by the answers (value above threshold) of some cuts, a bit each."""

    cuts: list[int]        # nodes, the first is bit 0
    features: list[int]
    sums: np.ndarray       # features x answers


def _subtrees(tree: Tree) -> list[_Subtree] | None:
    """Subtrees that hold all leaves, or nothing if too many cuts lie above them."""
    depth = len(tree.feature).bit_length() - 1
    tops, found = [(0, [])], []
    for _ in range(max(0, depth - _LEVELS)):
        tops = [(child, [*cuts, node]) if tree.feature[node] >= 0 else (child, cuts)
                for node, cuts in tops for child in ((2 * node + 1, 2 * node + 2) if tree.feature[node] >= 0 else (node,))]
    for top, above in tops:
        paths, below = [(top, [])], []
        leaves = []
        while paths:
            node, path = paths.pop()
            if tree.feature[node] < 0:
                leaves.append(node)
                continue
            below.append(node)
            paths += [(child, [*path, node]) for child in (2 * node + 1, 2 * node + 2)]
        cuts = above + below
        if len(cuts) > _BITS:
            return None
        answers = np.arange(1 << len(cuts))
        by_cut = {node: answers >> k & 1 for k, node in enumerate(cuts)}
        features = sorted({int(tree.feature[node]) for node in cuts})
        sums = np.zeros((len(features), answers.size))
        for node in leaves:
            met: dict[int, np.ndarray] = {}
            share: dict[int, float] = {}
            value = float(tree.value[node])
            while node:
                parent, right = (node - 1) // 2, node % 2 == 0
                f = int(tree.feature[parent])
                met[f] = met.get(f, True) & (by_cut[parent] == right)
                share[f] = share.get(f, 1.0) * tree.cover[node] / (tree.cover[2 * parent + 1] + tree.cover[2 * parent + 2])
                node = parent
            if not met:
                continue
            own = sorted(met)
            leaf = _Leaf(np.array(own), None, None, np.array([share[f] for f in own]), value)
            kinds = np.arange(1 << len(own))  # which of the leaf's intervals are met
            parts = leaf.parts((kinds[:, None] >> np.arange(len(own)) & 1).astype(bool))
            kind = sum(met[f].astype(np.int64) << k for k, f in enumerate(own))
            for k, f in enumerate(own):
                sums[features.index(f)] += parts[kind, k]
        if features:
            found.append(_Subtree(cuts, features, sums))
    return found


@dataclass
class TreeContributions:
    """Trees of a boosted model with their leaves; contributions are in log-odds of default."""

    features: list[str]
    trees: list[Tree]
    base: float

    def explain(self, points: np.ndarray) -> np.ndarray:
        points = np.where(np.isnan(points), np.finfo(float).max, points)  # above all others, as in training
        blocks = [np.ascontiguousarray(points[k : k + _ROWS].T) for k in range(0, len(points), _ROWS)]
        sums = [np.zeros_like(block) for block in blocks]
        for tree in self.trees:
            tabled = _subtrees(tree)
            for block, out in zip(blocks, sums):
                if tabled is None:
                    rows, apart = np.ascontiguousarray(block.T), np.zeros(block.T.shape)
                    for leaf in _leaves(tree)[0]:
                        leaf.add(rows, apart)
                    out += apart.T
                    continue
                answers = {node: (block[tree.feature[node]] > tree.threshold[node]).astype(np.uint16)
                           for node in {node for part in tabled for node in part.cuts}}
                for part in tabled:
                    code = np.zeros(block.shape[1], np.uint16)
                    for k, node in enumerate(part.cuts):
                        code |= answers[node] << np.uint16(k)
                    code = code.astype(np.int64)
                    for f, values in zip(part.features, part.sums):
                        out[f] += values[code]
        return np.hstack(sums).T if sums else np.zeros((0, len(self.features)))


def tree_contributions(model: BoostedTrees) -> TreeContributions:
    """The number of leaves is bounded by the model's size (trees x 2^depth), not by the data."""
    return TreeContributions(list(model.features), list(model.trees), sum(_leaves(tree)[1] for tree in model.trees))


def shap_values(contributions: TreeContributions, df: DataFrame) -> DataFrame:
    """Add ``shap`` (one value per feature) and ``shap_base``; their sum is the log-odds."""
    features = contributions.features

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        waiting: list[np.ndarray] = []

        def explained() -> Iterator[pd.Series]:
            found = contributions.explain(np.concatenate(waiting)) if waiting else []
            for k in range(0, len(found), _ROWS):
                yield pd.Series(list(found[k : k + _ROWS]))
            waiting.clear()

        for part in batches:
            waiting.append(part.to_numpy(dtype=float))
            if sum(map(len, waiting)) >= _TABLED_ROWS:
                yield from explained()
        yield from explained()

    point = F.struct(*[F.col(f).cast("double").alias(f) for f in features])
    return df.select(
        "*", explain(point).alias("shap"),
        F.lit(contributions.base).alias("shap_base"),
    )


def _per_feature(explained: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean_abs_shap, r) from one aggregation."""
    wide = explained.agg(*[
        c for i, f in enumerate(features) for c in (
            F.avg(F.abs(F.get("shap", F.lit(i)))).alias(f"m{i}"),
            correlation(f, F.get("shap", F.lit(i))).alias(f"r{i}"),
        )
    ])
    rows = ", ".join(f"'{f}', m{i}, r{i}" for i, f in enumerate(features))
    return wide.selectExpr(f"stack({len(features)}, {rows}) AS (feature, mean_abs_shap, r)")


def shap_importance(explained: DataFrame, features: list[str], ordered: bool = False) -> DataFrame:
    """(feature, mean_abs_shap), highest first."""
    out = _per_feature(explained, features).select(
        "feature", round_half_up("mean_abs_shap", 6).alias("mean_abs_shap"))
    return out.orderBy(F.desc("mean_abs_shap"), "feature") if ordered else out


def shap_direction(explained: DataFrame, features: list[str], top: int = 3) -> DataFrame:
    """Whether a higher value of the most important features raises or lowers the risk."""
    strongest = _per_feature(explained, features).orderBy(F.desc("mean_abs_shap"), "feature").limit(top)
    direction = F.when(F.col("r") > 0, "increases default risk").otherwise("decreases default risk")
    return strongest.select("feature", round_half_up("mean_abs_shap", 6).alias("mean_abs_shap"),
                            direction.alias("direction"))


def additivity_violations(explained: DataFrame, probability: str, tolerance: float = 1e-6) -> DataFrame:
    """One row (explained_rows, violations): rows whose contributions and base do not add up to the log-odds."""
    p = F.col(probability)
    total = F.aggregate("shap", F.lit(0.0), lambda a, x: a + x) + F.col("shap_base")
    off = F.abs(total - F.log(p / (1 - p))) > tolerance * F.greatest(F.lit(1.0), F.abs(total))
    return explained.agg(
        F.count(F.lit(1)).alias("explained_rows"), F.count_if(F.coalesce(off, F.lit(True))).alias("violations"))
