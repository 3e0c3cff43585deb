"""Nearest neighbours by inner product with vantage-point trees, one per shard.

Vectors are dealt to the cells of pivots drawn from them, cells to shards of bounded size. A query is
answered first by the shards of its own cell; what it found there says which other cells, seen as balls,
cannot improve it, and they are skipped whole. Inner products have no triangle inequality; with one more coordinate that brings every vector to the length of the longest, the order
of distances is the order of inner products, and a vantage-point tree applies. A shard has a tree per
class of lengths, longest first, so that a few long vectors do not set the scale for the others. A
subtree is skipped if it is further away than ``relax`` times the distance of the k-th neighbour found
so far: 1 is exact, less is faster but loses neighbours where all distances are alike. Queries go to
every shard in blocks of bounded size; each shard answers with its k best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import lean
from riskweave.session import staged

K = 20
#: Production factor: exact.
RELAX = 1.0
CELL_ROWS, SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 32768, 65536, 128
#: Most pivots, which the driver and every task hold, and most partitions of a search.
PIVOTS, MOST_TASKS = 1024, 20_000


def length_classes(vectors: np.ndarray, leaf: int = LEAF_ROWS) -> list[np.ndarray]:
    """Rows by length, longest class first: a class spans a factor of two in length, or at least a leaf."""
    square = np.einsum("ij,ij->i", vectors, vectors)
    order = np.argsort(-square, kind="stable")
    out, at = [], 0
    while at < order.size:
        alike = int(np.searchsorted(-square[order], -square[order[at]] / 4, side="right"))
        end = max(alike, at + leaf)
        out.append(order[at:end])
        at = end
    return out


class VantageTree:
    """Tree over rows of one shard; searches run for many queries at once."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS):
        self.ids, self.vectors, self.leaf = ids, vectors, leaf
        square = np.einsum("ij,ij->i", vectors, vectors)
        self.longest = square.max()
        lift = np.sqrt(self.longest - square)
        self.points = np.column_stack([vectors, lift])
        self.root, self.scanned = self._build(np.arange(len(ids))), 0

    def _build(self, rows: np.ndarray):
        if rows.size <= self.leaf:
            return rows
        points = self.points[rows]
        spread = ((points - points.mean(axis=0)) ** 2).sum(axis=1)
        vantage = points[spread.argmax()]
        away = np.sqrt(((points - vantage) ** 2).sum(axis=1))
        radius = np.median(away)
        inside = away <= radius
        if inside.all():
            inside = away < radius
            if not inside.any():
                return rows  # all at one distance: nothing to split
        return vantage, away[inside].max(), away[~inside].min(), self._build(rows[inside]), self._build(rows[~inside])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, relax: float,
               best: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best rows per query other than its own; -inf and -1 where there are fewer.

        ``best`` is what other trees have found, to be improved.
        """
        self.q_ids, self.queries, self.k, self.relax = ids, queries, k, relax
        self.lifted = np.column_stack([queries, np.zeros(len(queries))])
        own = np.einsum("ij,ij->i", queries, queries)
        self.square = own + self.longest
        self.scores, self.found = best or (np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1, np.int64))
        self.home, self.homes = np.full(len(ids), -1), []
        # no product is above that of the lengths
        who = np.flatnonzero(np.sqrt(own * self.longest) * (1 + 1e-9) >= self.scores[:, -1])
        self._descend(self.root, who)
        self._visit(self.root, who)
        return self.scores, self.found

    def _reach(self, who: np.ndarray) -> np.ndarray:
        # the rounding of a small difference of large squares is up to the scale of the squares
        room = 1e-13 * self.square[who]
        return self.relax * np.sqrt(np.maximum(self.square[who] - 2 * self.scores[who, -1], 0.0) + room) + 1e-9

    def _descend(self, node, who: np.ndarray) -> None:
        """Take every query to the leaf on its side, for a first bound."""
        if isinstance(node, tuple) and who.size:
            vantage, inner, outer, near, far = node
            first = self._away(vantage, who) <= (inner + outer) / 2
            self._descend(near, who[first])
            self._descend(far, who[~first])
        elif who.size:
            self.home[who] = len(self.homes)
            self.homes.append(node)
            self._scan(node, who)

    def _visit(self, node, who: np.ndarray) -> None:
        """Every node once, with all queries that may have neighbours below it."""
        if not who.size:
            return
        if isinstance(node, np.ndarray):
            home = next((k for k, leaf in enumerate(self.homes) if leaf is node), -1)
            self._scan(node, who[self.home[who] != home])
            return
        vantage, inner, outer, near, far = node
        away = self._away(vantage, who)
        self._visit(near, who[away - inner <= self._reach(who)])
        self._visit(far, who[outer - away <= self._reach(who)])

    def _away(self, vantage: np.ndarray, who: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((self.lifted[who] - vantage) ** 2).sum(axis=1), 0.0))

    def _scan(self, leaf: np.ndarray, who: np.ndarray) -> None:
        for at in range(0, leaf.size if who.size else 0, 1024):  # a leaf of equal distances may be large
            rows = leaf[at : at + 1024]
            self.scanned += who.size * rows.size
            # products in any order of additions choose pairs, with room for their rounding
            rough = self.queries[who] @ self.vectors[rows].T
            slack = 1e-12 * (1 + np.abs(rough).max())
            i, j = np.nonzero(rough >= self.scores[who, -1, None] - slack)
            other = self.ids[rows[j]] != self.q_ids[who[i]]
            i, j = i[other], j[other]
            if not i.size:
                continue
            exact = np.zeros(i.size)
            for d in range(self.vectors.shape[1]):  # one order of additions: equal vectors score equal
                exact += self.queries[who[i], d] * self.vectors[rows[j], d]
            some, place = np.unique(i, return_inverse=True)
            scores = np.full((some.size, rows.size), -np.inf)
            scores[place, j] = exact
            some = who[some]
            scores = np.concatenate([self.scores[some], scores], axis=1)
            ids = np.concatenate([self.found[some], np.broadcast_to(self.ids[rows], (some.size, rows.size))], axis=1)
            order = np.lexsort((ids, -scores), axis=1)[:, : self.k]
            self.scores[some] = np.take_along_axis(scores, order, axis=1)
            self.found[some] = np.where(
                np.isneginf(self.scores[some]), -1, np.take_along_axis(ids, order, axis=1))


def usable(embeddings: DataFrame) -> DataFrame:
    """Distinct (vec_id, vector) whose vector is not null, empty or zero and has finite components only."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where("vec_id IS NOT NULL AND vector IS NOT NULL")
        .where(finite & F.exists("vector", lambda x: x != 0.0))
        .distinct()
    )


def _pivots(rows: DataFrame, cell_rows: int) -> list[np.ndarray]:
    """Some rows as centres of cells: one for ``cell_rows`` rows, at most ``PIVOTS``."""
    n = min(PIVOTS, rows.count() // cell_rows + 1)
    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").select("vector").limit(n).collect()
    return [np.array(r["vector"], np.float64) for r in drawn]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _placed(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Rows with the cell of their nearest pivot and their distance from it; cell -1 where no pivot has their length."""
    by_dim = {d: [k for k, p in enumerate(pivots) if p.size == d] for d in {p.size for p in pivots}}
    shared = rows.sparkSession.sparkContext.broadcast((pivots, by_dim))

    def place(batches):
        centres, of_dim = shared.value
        for batch in batches:
            dims = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int32)
            cell, away = np.full(dims.size, -1, np.int32), np.zeros(dims.size)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) not in of_dim:
                    continue
                numbers = np.array(of_dim[int(d)])
                points, near = _matrix(batch.column(1).take(pa.array(at)), d), np.array([centres[k] for k in numbers])
                best = ((near ** 2).sum(axis=1) - 2 * points @ near.T).argmin(axis=1)
                cell[at], away[at] = numbers[best], np.sqrt(((points - near[best]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims), pa.array(cell), pa.array(away)],
                ["vec_id", "vector", "dim", "cell", "away"])

    return rows.mapInArrow(lean(place), "vec_id long, vector array<double>, dim int, cell int, away double")


def _elsewhere(queries: DataFrame, pivots: list[np.ndarray], radius: dict[int, float], relax: float) -> DataFrame:
    """Cells other than its own in which a query may find more: (vec_id, vector, dim, cell, floor).

    No inner product with a row of a ball is above that with its centre plus the query's length times the
    radius, which ``relax`` shrinks; a cell below the query's floor is skipped as a whole.
    """
    by_dim = {}
    for k in radius:
        by_dim.setdefault(pivots[k].size, []).append(k)
    balls = {d: (np.array(ks), np.array([pivots[k] for k in ks]), np.array([radius[k] for k in ks])) for d, ks in by_dim.items()}
    shared = queries.sparkSession.sparkContext.broadcast(balls)

    def route(batches):
        for batch in batches:
            dims, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            floor = pc.fill_null(batch.column(4), -np.inf).to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                if int(d) not in shared.value:
                    continue
                at = np.flatnonzero(dims == d)
                cells, centres, radii = shared.value[int(d)]
                asked = _matrix(batch.column(1).take(pa.array(at)), d)
                lengths = np.sqrt((asked ** 2).sum(axis=1))[:, None]
                room = 1e-9 * (1 + lengths * (np.sqrt((centres ** 2).sum(axis=1)) + radii))
                reach = asked @ centres.T + relax * lengths * radii + room
                for j, cell in enumerate(cells):
                    to = at[~(reach[:, j] < floor[at]) & (home[at] != cell)]
                    if to.size:
                        picked = batch.take(pa.array(to))
                        yield pa.RecordBatch.from_arrays(
                            [picked.column(0), picked.column(1), picked.column(2), pa.array(np.full(to.size, cell, np.int32)),
                             pa.array(floor[to])], ["vec_id", "vector", "dim", "cell", "floor"])

    return queries.select("vec_id", "vector", "dim", "cell", "floor").mapInArrow(
        lean(route), "vec_id long, vector array<double>, dim int, cell int, floor double")


def _answers(placed: DataFrame, cells: DataFrame, asked: DataFrame, k: int, relax: float, shard_rows: int,
             query_rows: int, name: str) -> DataFrame:
    """What the trees of the cells that queries are sent to find above each query's floor: (query_id, vec_id, score).

    A cell is dealt to shards of about ``shard_rows`` rows. A shard's rows come first in its task, then the
    queries, batch by batch, so its trees are built once and no more than a shard is held. Only where
    more than ``query_rows`` queries ask a cell does a second task take a copy of the shard.
    """
    asking = asked.groupBy(F.col("dim").alias("a_dim"), F.col("cell").alias("a_cell")).agg(F.count("*").alias("asked"))
    layout = staged(
        cells.join(asking, (F.col("dim") == F.col("a_dim")) & (F.col("cell") == F.col("a_cell"))).select(
            "a_dim", "a_cell", (F.floor(F.col("rows") / shard_rows) + 1).cast("int").alias("shards"),
            (F.floor(F.col("asked") / query_rows) + 1).cast("int").alias("blocks")), f"{name}-layout")
    tasks = layout.agg(F.sum(F.col("shards") * F.col("blocks")).alias("n")).first()["n"] or 1
    here = (F.col("dim") == F.col("a_dim")) & (F.col("cell") == F.col("a_cell"))

    def part(salt: int, of: str):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(of)).cast("int")

    def every(of: str):
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    keys = ["dim", "cell", "shard", "block"]
    points = placed.join(layout, here).withColumn("shard", part(0, "shards")).select(
        "dim", "cell", "shard", every("blocks").alias("block"), F.lit(False).alias("query"), "vec_id", "vector",
        F.lit(None).cast("double").alias("floor"))
    queries = asked.join(layout, here).withColumn("block", part(1, "blocks")).select(
        "dim", "cell", every("shards").alias("shard"), "block", F.lit(True).alias("query"), "vec_id", "vector", "floor"
    ).select(points.columns)
    # a number of its own, since the work of a task does not show in its bytes
    dealt = points.unionAll(queries).repartition(min(4 * tasks, MOST_TASKS), *keys).sortWithinPartitions(*keys, "query")

    def search(batches):
        key, ids, vectors, trees = None, [], [], []
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)], axis=1)
            ends = [*(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), len(marks)]
            for a, b in zip([0, *ends], ends):
                if key != tuple(marks[a, :4]):
                    key, ids, vectors, trees = tuple(marks[a, :4]), [], [], []
                own = batch.column(5).slice(a, b - a).to_numpy()
                held = _matrix(batch.column(6).slice(a, b - a), key[0])
                if not marks[a, 4]:
                    ids.append(own)
                    vectors.append(held)
                    continue
                if ids:
                    rows_ids, rows = np.concatenate(ids), np.concatenate(vectors)
                    trees = [VantageTree(rows_ids[c], rows[c]) for c in length_classes(rows)]
                    ids, vectors = [], []
                floor = pc.fill_null(batch.column(7).slice(a, b - a), -np.inf).to_numpy(zero_copy_only=False)
                # equal scores must still get in: their id may be smaller
                best = np.repeat(np.nextafter(floor, -np.inf)[:, None], k, axis=1), np.full((b - a, k), -1, np.int64)
                for tree in trees:
                    best = tree.search(own, held, k, relax, best)
                scores, found = best
                there = scores > np.nextafter(floor, -np.inf)[:, None]
                if there.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.broadcast_to(own[:, None], found.shape)[there]), pa.array(found[there]), pa.array(scores[there])],
                        ["query_id", "vec_id", "score"])

    return staged(dealt.mapInArrow(lean(search), "query_id long, vec_id long, score double"), name)


def nearest(embeddings: DataFrame, is_query, k: int = K, relax: float = RELAX, shard_rows: int = SHARD_ROWS,
            query_rows: int = QUERY_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The k rows of largest inner product per query: (query_id, rank, vec_id, score).

    ``is_query`` is a condition on vec_id. Rows whose vector is null, empty, zero or holds a null or
    non-finite component take no part, nor do rows without id; repeated rows count once; vectors are
    compared with those of their own length. A row is no neighbour of its own id. Ties go to the
    smaller id. With ``relax`` 1 the result is exact.
    """
    rows = staged(usable(embeddings), "vectors")
    pivots = _pivots(rows, cell_rows)
    placed = staged(_placed(rows, pivots), "vector-cells")
    cells = staged(placed.groupBy("dim", "cell").agg(F.count("*").alias("rows"), F.max("away").alias("radius")), "cells")
    queries = placed.where(is_query)
    at_home = _answers(placed, cells, queries.withColumn("floor", F.lit(None).cast("double")), k, relax, shard_rows,
                       query_rows, "home-neighbours")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    floors = top(at_home).where(F.col("rank") == k).select(F.col("query_id").alias("f_id"), F.col("score").alias("floor"))
    # at most PIVOTS cells have a pivot
    radius = {r["cell"]: r["radius"] for r in cells.where("cell >= 0").select("cell", "radius").collect()}
    asked = staged(
        _elsewhere(queries.join(floors, F.col("vec_id") == F.col("f_id"), "left"), pivots, radius, relax), "routed-queries")
    found = at_home.unionAll(_answers(placed, cells, asked, k, relax, shard_rows, query_rows, "further-neighbours"))
    return top(found).select("query_id", "rank", "vec_id", "score")
