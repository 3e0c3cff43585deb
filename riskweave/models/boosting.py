"""Gradient-boosted trees on histograms of first and second derivatives.

Rows are binned once and packed into blocks that also hold each row's margin, the sum of the trees so
far. A tree's values enter it once, when the tree is grown. The rows drawn for a tree, with the derivatives of
the logistic loss at their margin, stay with the executors while it grows, on disk where memory ends. One pass
per level then adds up the derivatives per node, feature and bin, of two children only over the one with less
weight: the other's sums are those of their parent without it. Features of few values are counted together, by the cells of their
product. Sums of many tasks are merged in tasks; the driver sees one table of sums and finds the cuts. Growth
always goes on from the trees there are: round k costs the same whether it is part of a fit of k or of 300
rounds.

Derivatives are summed as whole numbers, so that a model depends neither on the order in which tasks end
nor on how rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.ranking import lowest_hashed
from riskweave.session import discard, scratch_path, staged

#: Bins of a feature, at most; one byte a value.
BINS = 256
#: Rows whose values set the edges of the bins; all rows are then binned and counted.
EDGE_ROWS = 200_000
#: Rows of a block and of a task, about.
BLOCK_ROWS, TASK_ROWS = 32_768, 2_000_000
#: Rows up to which one task grows the trees: fewer than it takes to outweigh the jobs of the levels.
HERE_ROWS = 1_500_000
#: Rounds after which the blocks are written to the shared folder and read from there.
STAGED_ROUNDS = 10
#: Derivatives are counted in units of 1 / _UNIT.
_UNIT = float(1 << 20)
#: Cells of [0, 1] in which held rows are counted for their AUC.
_CELLS = 1 << 16
#: Bytes of sums of all tasks that the driver adds up itself.
_MERGED_BYTES = 64 << 20
#: Marks of a row: its class, whether it is held back.
_LABEL, _HELD = 1, 2

_BLOCK = "n int, bins binary, marks binary, draw binary, margin binary"


@dataclass
class Tree:
    """One tree in heap order: the children of node i are 2 i + 1 and 2 i + 2; feature -1 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray        # rows whose bin is at most this go left
    threshold: np.ndarray  # the same as a value
    value: np.ndarray      # of leaves, learning rate included
    cover: np.ndarray      # sum of second derivatives
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        zeros = lambda: np.zeros(n)
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), zeros(), zeros(), zeros(), zeros())

    def nodes(self, columns: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Node that each row of ``columns`` (rows x features) ends in."""
        node, rows = np.zeros(len(columns), np.int64), np.arange(len(columns))
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            right = columns[rows, np.maximum(feature, 0)] > cuts[node]
            node = np.where(inner, 2 * node + 1 + right, node)


@dataclass
class BoostedTrees:
    """A fitted model; the margin is the log-odds of class 1."""

    features: list[str]
    trees: list[Tree]
    history: list[float] = field(default_factory=list)  # AUC of the held slice after every round grown

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def margin(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points))
        columns = np.ascontiguousarray(np.where(np.isnan(points), np.inf, points).T)  # as they were binned
        for tree in self.trees:
            _add_values(out, columns, tree, tree.threshold)
        return out

    def probability(self) -> Column:
        """Probability of class 1 from the feature columns; a missing value counts as above all others."""
        @F.pandas_udf("double")
        def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(1 / (1 + np.exp(-self.margin(part.to_numpy(dtype=float)))))

        return score(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features]))

    def importances(self) -> list[float]:
        """Mean gain of the splits of each feature, adding up to 1."""
        total, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(splits, tree.feature[inner], 1)
        mean = total / np.maximum(splits, 1)
        return (mean / (mean.sum() or 1.0)).tolist()


def bin_edges(rows: DataFrame, features: list[str], bins: int = BINS, most: int = EDGE_ROWS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, at most ``bins - 1`` values that occur: equally spaced ranks of
    the (at most ``most``) rows of lowest hash, every value where there are fewer. No edge is a missing value."""
    drawn = lowest_hashed(rows, ["draw"], lambda n: F.least(n, F.lit(most)), "edges").where("chosen")
    points = drawn.select([F.col(f).cast("double") for f in features]).toArrow()  # at most ``most`` rows
    edges = []
    for column in points.columns:
        values = column.to_numpy().astype(float)
        values = np.sort(values[~np.isnan(values)])
        distinct = np.unique(values)
        if distinct.size >= bins:
            distinct = np.unique(values[np.arange(1, bins) * values.size // bins])
        edges.append(distinct)
    return edges


def _blocks(rows: DataFrame, features: list[str], edges: list[np.ndarray]) -> DataFrame:
    """Rows (label, held, draw, features) as blocks of some ``BLOCK_ROWS``, bins by feature, margins 0."""
    def block(batches):
        rows = pa.Table.from_batches(batches)
        columns = [rows.column(3 + i).to_numpy().astype(float) for i in range(len(features))]
        bins = [np.searchsorted(e, np.where(np.isnan(c), np.inf, c), side="left").astype(np.uint8) for e, c in zip(edges, columns)]
        label, held, draw = (rows.column(i).to_numpy() for i in range(3))
        marks = (label * _LABEL + held * _HELD).astype(np.uint8)
        values = (np.stack(bins), marks, draw.astype(np.int64), np.zeros(rows.num_rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([rows.num_rows], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in values)],
            ["n", "bins", "marks", "draw", "margin"])

    def pack(batches):
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(waiting)
                waiting, n = [], 0
        if n:
            yield block(waiting)

    wide = rows.select("label", "held", "draw", *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    return wide.mapInArrow(pack, _BLOCK)


def _add_values(margin: np.ndarray, columns: np.ndarray, tree: Tree, cuts: np.ndarray) -> None:
    """Add to each row's margin the value of its leaf; ``columns`` is features x rows."""
    ends = np.flatnonzero(tree.feature < 0)
    leaf = np.zeros(margin.size, np.min_scalar_type(len(tree.feature)))
    for node, rows in _reached(columns, np.ones(margin.size, bool), tree, cuts, ends.tolist()):
        np.putmask(leaf, rows, node)
    margin += tree.value[leaf]


def _reached(columns: np.ndarray, rows: np.ndarray, tree: Tree, cuts: np.ndarray, nodes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Of some nodes, none of them above another, those that are in the tree, with the marks of the rows that reach them."""
    wanted, above = set(nodes), set()
    for node in nodes:
        while node and (node - 1) // 2 not in above:
            node = (node - 1) // 2
            above.add(node)
    stack = [(0, rows)]
    while stack:
        node, rows = stack.pop()
        if node in wanted:
            yield node, rows
        elif node in above and tree.feature[node] >= 0:
            right = columns[tree.feature[node]] > cuts[node]
            stack += [(2 * node + 2, rows & right), (2 * node + 1, rows & ~right)]


def _drawn(draw: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Rows of a tree: a hash of the row's key and the tree below the share."""
    x = draw.view(np.uint64) + np.uint64(seed) * np.full(1, 0x9E3779B97F4A7C15, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)) < np.uint64(int(share * 2 ** 53))


def _moved(trees: list[Tree], width: int):
    """Blocks with the values of more trees in their margins."""
    def move(block):
        n, bins, marks, draw, margin = block
        columns, sums = np.frombuffer(bins, np.uint8).reshape(width, n), np.frombuffer(margin, float).copy()
        for tree in trees:
            _add_values(sums, columns, tree, tree.cut)
        return n, bins, marks, draw, sums.tobytes()

    return move


def _level_rows(columns: list[int], width: int, weight: float, seed: int, share: float, wide: bool):
    """What the levels of one tree need of a block: number, bins and derivatives of the rows drawn for the tree, its
    features only, and the held rows' cells of probability by class."""
    def rows(block):
        n, bins, marks, draw, margin = block
        bins, marks, margin = np.frombuffer(bins, np.uint8).reshape(width, n), np.frombuffer(marks, np.uint8), np.frombuffer(margin, float)
        at = np.flatnonzero((marks & _HELD == 0) & _drawn(np.frombuffer(draw, np.int64), seed, share))
        label, p = (marks[at] & _LABEL).astype(float), 1 / (1 + np.exp(-margin[at]))
        w = np.where(label == 1, weight, 1.0) * _UNIT
        derivatives = np.stack([np.rint(w * (p - label)), np.rint(w * p * (1 - p))]).astype(np.int64 if wide else np.int32)
        held = np.flatnonzero(marks & _HELD)
        cell = np.minimum((1 / (1 + np.exp(-margin[held])) * _CELLS).astype(np.int64), _CELLS - 1)
        cell = (marks[held] & _LABEL) * np.int64(_CELLS) + cell
        return at.size, np.stack([bins[f][at] for f in columns]).tobytes(), derivatives.tobytes(), cell.astype(np.int32).tobytes()

    return rows


def _bundles(columns: list[int], sizes: list[int], most: int = BINS) -> list[list[int]]:
    """The features in groups whose numbers of bins multiply to at most ``most``; a feature of many bins is alone."""
    groups: list[list[int]] = []
    cells: list[int] = []
    for f in sorted(columns, key=lambda f: (-sizes[f], f)):
        k = next((k for k, n in enumerate(cells) if n * sizes[f] <= most), None)
        if k is None:
            groups.append([f])
            cells.append(sizes[f])
        else:
            groups[k].append(f)
            cells[k] *= sizes[f]
    return groups


def _sums(tree: Tree, nodes: list[int], columns: list[int], groups: list[list[int]], sizes: list[int], wide: bool, count_held: bool):
    """Sums of a task's rows of a tree as one array: derivatives per kind, group of features, node and cell; counts of
    held rows per class and cell of their probability behind them."""
    def add_up(blocks):
        totals = np.zeros((len(groups), len(nodes) * BINS), complex)
        held = np.zeros(2 * _CELLS if count_held else 0, np.int64)
        for n, bins, derivatives, cell in blocks:
            if count_held:
                held += np.bincount(np.frombuffer(cell, np.int32), minlength=2 * _CELLS)
            by_feature = dict(zip(columns, np.frombuffer(bins, np.uint8).reshape(len(columns), n)))
            parts = {node: np.flatnonzero(rows) for node, rows in _reached(by_feature, np.ones(n, bool), tree, tree.cut, nodes)}
            if not any(at.size for at in parts.values()):
                continue
            at = np.concatenate([parts[node] for node in nodes])
            # two whole numbers to a complex one: both are added at once, exactly
            pairs = np.empty(at.size, complex)
            pairs.real, pairs.imag = (d[at] for d in np.frombuffer(derivatives, np.int64 if wide else np.int32).reshape(2, n))
            base = np.repeat(np.arange(len(nodes)) * BINS, [parts[node].size for node in nodes])
            for total, group in zip(totals, groups):
                code, step = by_feature[group[0]], sizes[group[0]]
                for f in group[1:]:
                    code, step = code + by_feature[f] * np.uint8(step), step * sizes[f]
                np.add.at(total, base + code[at], pairs)
        yield np.concatenate([totals.real.ravel().astype(np.int64), totals.imag.ravel().astype(np.int64), held])

    return add_up


def _by_feature(total: np.ndarray, groups: list[list[int]], columns: list[int], sizes: list[int]) -> np.ndarray:
    """Sums of one node by kind, feature and bin, from those by kind, group and cell."""
    out = np.zeros((2, len(columns), max(sizes)), np.int64)
    for k, group in enumerate(groups):
        shape = [sizes[f] for f in reversed(group)]  # the first feature's bins are next to each other
        cells = total[:, k, : int(np.prod(shape))].reshape(2, *shape)
        for i, f in enumerate(group):
            axes = tuple(a for a in range(1, len(shape) + 1) if a != len(shape) - i)
            out[:, columns.index(f), : sizes[f]] = cells.sum(axis=axes)
    return out


def _best_cuts(node: int, sums: np.ndarray, columns: list[int], penalty: float, min_weight: float) -> list[dict]:
    """The best cut of every feature at a node, -1 where none gains."""
    left = np.cumsum(sums, axis=2)
    (g, h), (left_g, left_h) = left[:, :, -1:], left[:, :, :-1]
    part = lambda a, b: (a / _UNIT) ** 2 / (b / _UNIT + penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (part(left_g, left_h) + part(g - left_g, h - left_h) - part(g, h))
    gain[np.minimum(left_h, h - left_h) < min_weight * _UNIT] = -np.inf
    found = []
    for k, f in enumerate(columns):
        row = {"node": node, "feature": f, "cut": -1, "gain": 0.0, "left_g": 0, "left_h": 0, "g": int(g[k, 0]), "h": int(h[k, 0])}
        at = int(np.argmax(gain[k])) if gain.shape[1] else 0
        if gain.shape[1] and gain[k, at] > 0:
            row |= {"cut": at, "gain": float(gain[k, at]), "left_g": int(left_g[k, at]), "left_h": int(left_h[k, at])}
        found.append(row)
    return found


def _auc(cells: np.ndarray) -> float | None:
    """AUC from counts of held rows by class and cell of their probability, ties of a cell counted half."""
    negative, positive = (int(c.sum()) for c in cells)
    if not negative or not positive:
        return None
    below = np.cumsum(cells[0]) - cells[0]
    return float((cells[1] * (below + cells[0] / 2)).sum() / (negative * positive))


@dataclass
class _Growth:
    """One fit: its parameters, and the rounds over blocks that may be anywhere."""

    features: list[str]
    edges: list[np.ndarray]
    weight: float              # of class 1
    trees: int
    depth: int
    learning_rate: float
    row_share: float
    column_share: float
    min_weight: float
    penalty: float
    patience: int
    seed: int
    grown: list[Tree]
    history: list[float]

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    @property
    def wide(self) -> bool:
        """Whether a derivative may need more than 32 bits."""
        return max(self.weight, 1.0) * _UNIT >= 2 ** 31

    def columns(self) -> list[int]:
        """Features that the next tree may use."""
        width = len(self.features)
        drawn = np.random.default_rng([self.seed, len(self.grown)]).permutation(np.arange(width))
        return sorted(drawn[: max(1, round(self.column_share * width))].tolist())

    def move(self, new: list[Tree]):
        return _moved(new, len(self.features))

    def rows(self):
        """Function that gives a block's rows of the next tree."""
        seed = self.seed * 100_003 + len(self.grown)
        return _level_rows(self.columns(), len(self.features), self.weight, seed, self.row_share, self.wide)

    def add_up(self, tree: Tree, nodes: list[int], groups: list[list[int]], count_held: bool):
        return _sums(tree, nodes, self.columns(), groups, self.sizes, self.wide, count_held)

    def run(self, begin, summed) -> BoostedTrees:
        """Rounds until the model is whole. ``begin(new)`` adds trees to the margins of all blocks and gets their rows
        of the next tree ready, ``summed(tree, nodes, groups, count_held)`` is the sum of ``add_up`` over all of them."""
        sizes, grown, history = self.sizes, self.grown, self.history
        begin(list(grown))
        while True:
            columns = self.columns()
            groups = _bundles(columns, sizes)
            tree, nodes, last = Tree.empty(self.depth), [0], len(grown) >= self.trees
            sums: dict[int, np.ndarray] = {}
            for d in range(self.depth):
                # of two children the one of less weight is counted, the other has what is left of their parent
                light = nodes if d == 0 else [min(pair, key=lambda c: (tree.cover[c], c)) for pair in zip(nodes[::2], nodes[1::2])]
                wanted = [] if last else light
                total = summed(tree, wanted, groups, d == 0)
                n = 2 * len(groups) * len(wanted) * BINS
                if d == 0 and grown and len(history) < len(grown):
                    auc = _auc(total[n:].reshape(2, -1))
                    history.append(float("nan") if auc is None else auc)
                best = int(np.nanargmax(history)) + 1 if history and not np.isnan(history).all() else len(grown)
                if last or len(grown) - best >= self.patience:
                    return BoostedTrees(list(self.features), grown[:best], history)
                counted = total[:n].reshape(2, len(groups), len(light), BINS).transpose(2, 0, 1, 3)
                above, sums = sums, dict(zip(light, counted))
                if d:
                    for node, own in list(sums.items()):
                        sums[node + 1 if node % 2 else node - 1] = above[(node - 1) // 2] - own
                found = [r for node in nodes if sums[node][1].any() for r in _best_cuts(
                    node, _by_feature(sums[node], groups, columns, sizes), columns, self.penalty, self.min_weight)]
                nodes = _split(tree, found, self.edges, self.penalty, self.learning_rate)
                if not nodes:
                    break
            grown.append(tree)
            begin([tree])


def _grown_here(growth: _Growth, blocks: list[tuple]) -> BoostedTrees:
    """The rounds over blocks at hand."""
    rows: list[tuple] = []

    def begin(new: list[Tree]) -> None:
        blocks[:] = map(growth.move(new), blocks)
        rows[:] = map(growth.rows(), blocks)

    return growth.run(begin, lambda *level: next(growth.add_up(*level)(rows)))


def _grown_by_tasks(growth: _Growth, packed: DataFrame, tasks: int, path: str) -> BoostedTrees:
    """The rounds over blocks that stay with the executors: a job per level of a tree."""
    spark, context = packed.sparkSession, packed.sparkSession.sparkContext
    kept: list[RDD] = []  # the present round's blocks and their rows come last
    folder, staged_rounds = path, len(growth.grown)

    def keep(rdd: RDD) -> RDD:
        kept.append(rdd.persist(StorageLevel.MEMORY_AND_DISK_DESER))
        return rdd

    def release(most: int) -> None:
        while len(kept) > most:
            kept.pop(0).unpersist()

    def begin(new: list[Tree]) -> None:
        nonlocal folder, staged_rounds
        before = kept[-2] if kept else packed.repartition(tasks).rdd.map(tuple)
        blocks = keep(before.map(growth.move(new)))
        if len(growth.grown) - staged_rounds >= STAGED_ROUNDS:
            old, folder, staged_rounds = folder, scratch_path(spark, "boosting-blocks"), len(growth.grown)
            blocks.saveAsPickleFile(folder)
            release(0)
            discard(spark, old)
            blocks = keep(context.pickleFile(folder, tasks).coalesce(tasks))
        keep(blocks.map(growth.rows()))

    def summed(tree: Tree, nodes: list[int], groups: list[list[int]], count_held: bool) -> np.ndarray:
        parts = kept[-1].mapPartitions(growth.add_up(tree, nodes, groups, count_held))
        if tasks * 16 * (len(groups) * len(nodes) * BINS + _CELLS * count_held) > _MERGED_BYTES:
            total = parts.treeReduce(np.add)
        else:
            total = np.sum(parts.collect(), axis=0)
        release(2)  # the round's own are computed now
        return total

    try:
        return growth.run(begin, summed)
    finally:
        release(0)
        discard(spark, folder)


def fit(train: DataFrame, features: list[str], label: str = "is_default", key: str = "loan_id", trees: int = 300,
        depth: int = 6, learning_rate: float = 0.05, row_share: float = 0.8, column_share: float = 0.8,
        min_weight: float = 5.0, penalty: float = 1.0, validation: float = 0.1, patience: int = 20, seed: int = 42,
        start: BoostedTrees | None = None, here_rows: int = HERE_ROWS) -> BoostedTrees:
    """Boosted trees on the unbalanced training part, class 1 weighted by negatives / positives.

    A slice of the training part, the rows of lowest seeded hash of each class, is held back. Growing ends once its
    AUC has not improved for ``patience`` rounds, or at ``trees``; the trees up to the best round are kept.
    ``min_weight`` is the least sum of second derivatives of a child. Rows and features are drawn per tree.
    ``start`` is a model of the same features to go on from; its trees count as rounds.

    A slice without both classes has no AUC: then all rounds are grown and kept. Missing feature values count
    as above all others; rows without label are left out. Up to ``here_rows`` rows one task grows all trees, beyond
    that the tasks' sums meet at every level; the model is the same.
    """
    spark = train.sparkSession
    usable = train.where(F.col(label).isNotNull())
    sizes = {r[label]: r["count"] for r in usable.groupBy(label).count().collect()}  # two classes
    if set(sizes) != {0, 1}:
        raise ValueError(f"label {label!r} must have the classes 0 and 1, found {sorted(sizes)}")
    marked = lowest_hashed(usable, [key], lambda n: F.ceil(n * F.lit(validation)), f"validation-{seed}", [label], "_held")
    rows = staged(marked.select(
        F.col(label).cast("int").alias("label"), F.col("_held").cast("int").alias("held"),
        F.xxhash64(F.col(key), F.lit(seed)).alias("draw"), *features), "boosting-rows")
    edges = bin_edges(rows, features)
    path = scratch_path(spark, "boosting-blocks")
    _blocks(rows, features, edges).write.parquet(path)
    packed = spark.read.parquet(path)
    growth = _Growth(
        list(features), edges, sizes[0] / sizes[1], trees, depth, learning_rate, row_share, column_share, min_weight,
        penalty, patience, seed, list(start.trees) if start else [], list(start.history) if start else [])
    if sum(sizes.values()) <= here_rows:
        # one task has all the rows: no sums have to meet, and no round waits for a job
        def whole(blocks):
            model = _grown_here(growth, list(blocks))
            return [([vars(tree) for tree in model.trees], model.history)]  # as arrays: the task has copies of the classes

        grown, history = packed.coalesce(1).rdd.map(tuple).mapPartitions(whole).collect()[0]  # one model
        discard(spark, path)
        return BoostedTrees(list(features), [Tree(**arrays) for arrays in grown], history)
    slots = spark.sparkContext.defaultParallelism
    tasks = min(packed.count(), slots * -(-sum(sizes.values()) // (TASK_ROWS * slots)))  # the same number for every slot
    return _grown_by_tasks(growth, packed, tasks, path)


def _split(tree: Tree, found, edges: list[np.ndarray], penalty: float, learning_rate: float) -> list[int]:
    """Cut every open node at its best candidate and set the values of its children; the children are open next."""
    best: dict[int, tuple] = {}
    for r in found:
        if r["node"] >= 0:
            rank = (-r["gain"], r["feature"], r["cut"])
            if r["node"] not in best or rank < best[r["node"]][0]:
                best[r["node"]] = (rank, r)
    opened = []
    value = lambda g, h: -learning_rate * (g / _UNIT) / (h / _UNIT + penalty)
    for node, (_, r) in sorted(best.items()):
        tree.cover[node] = r["h"] / _UNIT
        if r["cut"] < 0:
            tree.value[node] = value(r["g"], r["h"])
            continue
        tree.feature[node], tree.cut[node], tree.gain[node] = r["feature"], r["cut"], r["gain"]
        tree.threshold[node] = edges[r["feature"]][r["cut"]]
        sides = ((r["left_g"], r["left_h"]), (r["g"] - r["left_g"], r["h"] - r["left_h"]))
        for child, (g, h) in zip((2 * node + 1, 2 * node + 2), sides):
            tree.value[child], tree.cover[child] = value(g, h), h / _UNIT
            opened.append(child)
    return [n for n in opened if 2 * n + 2 < len(tree.feature)]
