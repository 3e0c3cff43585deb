"""k nearest neighbours of every row among all rows, as a hash-table neighbour join.

1. Each table projects the rows on a few random directions and interleaves the bits of the projected
   values to one code, so that rows with close codes are close in space.
2. Rows are ranked by (table, code, id) with one range sort; every ``window`` rows of a table are a bucket.
   Buckets do not grow with the table, and copies of one point fall into as many buckets as they need.
3. Each bucket is searched exactly; a row's candidates from all tables are merged by (distance, id).
4. Neighbours of neighbours are compared with the row, a few times: a neighbour collects the points of its own
   neighbours once, rows send their point to their neighbours, and what is nearer than the row knows comes back.

Ids are numbered in their order first; lists of neighbours travel as packed numbers, and rows are dealt to
tasks by ranges of numbers, so that no list is taken apart row by row.

The result depends on the rows, the seed and the parameters alone, never on how rows are partitioned. It is
exact where all rows fit into one bucket, and otherwise nearly so: two rows that no table deals together can
still meet through a common neighbour.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.positions import with_positions
from riskweave.session import staged

#: Directions of a table, and bits of the code that each gets.
DIRECTIONS, DIRECTION_BITS = 4, 15
_ROUNDING = 1e-9
_CELLS_PER_STEP = 4_000_000
#: Numbers of rows that are looked at together, and pairs of rows that are measured at once.
_RANGE, _PAIRS_PER_STEP = 4096, 100_000

#: A row's neighbours: distances and numbers of rows, 8 bytes each.
_NEAR = "id long, gaps binary, others binary"


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of ``a`` to the row or rows of ``b``; one formula, so equal pairs get equal values."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Lists of numbers of 8 bytes as binary values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * 8
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _lists(column, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of packed lists, and how many each list has."""
    parts = [c.cast(pa.large_binary()) for c in (column.chunks if isinstance(column, pa.ChunkedArray) else [column])]
    values, counts = [np.empty(0, kind)], [np.empty(0, np.int64)]
    for part in parts:
        if len(part):
            offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
            data = part.buffers()[2]
            if data is not None:
                values.append(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].copy().view(kind))
            counts.append(np.diff(offsets) // 8)
    return np.concatenate(values), np.concatenate(counts)


def _first_of_each(ids: np.ndarray, most: int) -> np.ndarray:
    """Marks of the first ``most`` entries of each run of equal ids."""
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if ids.size else np.empty(0, np.int64)
    rank = np.arange(ids.size) - np.repeat(starts, np.diff(np.append(starts, ids.size)))
    return rank < most


def _nearest(points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's k nearest other rows, ties to the smaller id: distances and ids row by row, and how many a row has."""
    moved = points - points.mean(axis=0)
    size = (moved ** 2).sum(axis=1)
    step = max(1, _CELLS_PER_STEP // len(points))
    gaps, others, counts = [], [], []
    for start in range(0, len(points), step):
        part = moved[start : start + step]
        # squared distances by one matrix product; off by less than the slack, so they only choose
        # the candidates whose distance is then computed from the coordinates
        rough = size[start : start + step, None] + size[None, :] - 2.0 * (part @ moved.T)
        slack = _ROUNDING * (size[start : start + step] + size.max())
        index = np.arange(len(part))
        rough[index, start + index] = np.inf
        far = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(points) > k else np.full(len(part), np.inf)
        close = rough <= (far + 2 * slack)[:, None]
        close[index, start + index] = False
        row, near = np.nonzero(close)
        gap = np.concatenate([np.empty(0), *(
            distances(points[near[i : i + _PAIRS_PER_STEP]], points[start + row[i : i + _PAIRS_PER_STEP]])
            for i in range(0, row.size, _PAIRS_PER_STEP))])
        order = np.lexsort((ids[near], gap, row))
        order = order[_first_of_each(row[order], k)]
        gaps.append(gap[order])
        others.append(ids[near[order]])
        counts.append(np.bincount(row[order], minlength=len(part)))
    return np.concatenate(gaps), np.concatenate(others), np.concatenate(counts)


def _directions(width: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).normal(size=(width, tables * DIRECTIONS))


def _projected(points: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Projections added up in one order, whatever the number of rows, so that codes repeat bit by bit."""
    out = np.zeros((len(points), directions.shape[1]))
    for j in range(points.shape[1]):
        out += points[:, j, None] * directions[j]
    return out


def _codes(projected: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """rows x tables: bits of the places between the least and the greatest projection, interleaved."""
    wide = np.where(high > low, high - low, 1.0)
    place = ((projected - low) / wide * (1 << DIRECTION_BITS)).astype(np.int64)
    place = np.clip(place, 0, (1 << DIRECTION_BITS) - 1).reshape(len(projected), -1, DIRECTIONS)
    code = np.zeros(place.shape[:2], np.int64)
    for bit in range(DIRECTION_BITS):
        for j in range(DIRECTIONS):
            code |= (place[:, :, j] >> bit & 1) << (bit * DIRECTIONS + j)
    return code


def _points(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bounds(rows: DataFrame, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest projection of all rows on each direction."""
    def extremes(batches):
        for batch in batches:
            if batch.num_rows:
                p = _projected(_points(batch.column(0)), directions)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(p.shape[1])), pa.array(p.min(axis=0)), pa.array(p.max(axis=0))], ["at", "low", "high"])

    found = rows.select("x").mapInArrow(extremes, "at long, low double, high double").groupBy("at").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("at").toPandas()  # a row per direction
    return found["low"].to_numpy(), found["high"].to_numpy()


def _dealt(rows: DataFrame, total: int, tables: int, window: int, seed: int) -> DataFrame:
    """(bucket, id, x): each row once per table."""
    width = rows.select(F.size("x").alias("n")).first()["n"]
    directions = _directions(width, tables, seed)
    low, high = _bounds(rows, directions)

    def coded(batches):
        for batch in batches:
            codes = _codes(_projected(_points(batch.column(1)), directions), low, high)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t)), pa.array(codes[:, t]), batch.column(0), batch.column(1)], ["t", "code", "id", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    spread = rows.select("id", "x").mapInArrow(coded, f"t long, code long, id {kind}, x array<double>")
    placed = with_positions(spread, F.col("t"), F.col("code"), F.col("id"))
    # the tables' buckets begin at different places, so that the same two rows are not parted again and again
    shift = F.floor(F.col("t") * window / tables)
    bucket = F.floor((F.col("position") - F.col("t") * total + shift) / window)
    return placed.select((F.col("t") * F.lit(2 ** 40) + bucket).cast("long").alias("bucket"), "id", "x")


def _by_range(df: DataFrame, column: str = "id"):
    return df.groupBy(F.floor(F.col(column) / _RANGE).alias("range"))


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k first different candidates of each id by (distance, number)."""
    def merge(rows: pa.Table) -> pa.Table:
        gaps, counts = _lists(rows["gaps"], float)
        others, _ = _lists(rows["others"], np.int64)
        known = np.unique(rows["id"].to_numpy())
        ids = np.repeat(rows["id"].to_numpy(), counts)
        order = np.lexsort((others, gaps, ids))
        ids, gaps, others = ids[order], gaps[order], others[order]
        new = np.ones(ids.size, bool)
        new[1:] = (ids[1:] != ids[:-1]) | (gaps[1:] != gaps[:-1]) | (others[1:] != others[:-1])
        ids, gaps, others = ids[new], gaps[new], others[new]
        first = _first_of_each(ids, k)
        counts = np.bincount(np.searchsorted(known, ids[first]), minlength=known.size)
        return pa.table([pa.array(known), _packed(gaps[first], counts), _packed(others[first], counts)], ["id", "gaps", "others"])

    return _by_range(candidates).applyInArrow(merge, _NEAR)


def _matches(asked: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places with equal numbers in ``asked`` and in ``held``, which is sorted."""
    low, high = np.searchsorted(held, asked), np.searchsorted(held, asked, side="right")
    counts = high - low
    pairs = np.repeat(np.arange(asked.size), counts)
    return pairs, np.arange(pairs.size) - np.repeat(np.cumsum(counts) - counts, counts) + low[pairs]


def _refined(near: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Compare each row with its neighbours' neighbours."""
    def ask(batches):
        for batch in batches:
            others, counts = _lists(batch.column(1), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(others), pa.array(np.repeat(batch.column(0).to_numpy(), counts))], ["at", "id"])

    def answer(rows: pa.Table) -> pa.Table:
        is_point = rows["x"].is_valid().to_numpy()
        at, ids = rows["at"].to_numpy(), rows["id"].to_numpy(zero_copy_only=False)
        held = np.flatnonzero(is_point)
        held = held[np.argsort(at[held], kind="stable")]
        asking = np.flatnonzero(~is_point)
        pairs, found = _matches(at[asking], at[held])
        x = rows["x"].take(pa.array(held[found]))
        return pa.table([pa.array(ids[asking[pairs]].astype(np.int64)), pa.array(at[asking[pairs]]), x], ["at", "other", "x"])

    asked = near.select("id", "others").mapInArrow(ask, "at long, id long").withColumn("x", F.lit(None).cast("binary"))
    # the points of a row's neighbours, with the row
    reach = _by_range(asked.unionByName(points.select(F.col("id").alias("at"), F.lit(None).cast("long").alias("id"), "x")), "at").applyInArrow(
        answer, "at long, other long, x binary")

    def send(batches):
        for batch in batches:
            others, counts = _lists(batch.column(2), np.int64)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(others), *(batch.column(i).take(rows) for i in (0, 1, 2, 3))], ["at", "other", "x", "others", "gaps"])

    def measure(rows: pa.Table) -> pa.Table:
        is_sent = rows["others"].is_valid().to_numpy()
        at, other = rows["at"].to_numpy(), rows["other"].to_numpy()
        x = _lists(rows["x"], float)[0].reshape(len(at), -1)
        held = np.flatnonzero(~is_sent)
        held = held[np.argsort(at[held], kind="stable")]
        sent = np.flatnonzero(is_sent)
        own = rows.select(["others", "gaps"]).take(pa.array(sent))
        (known, counts), (gaps, _) = _lists(own["others"], np.int64), _lists(own["gaps"], float)
        ends = np.cumsum(counts)
        table = np.full((sent.size, k), -1, np.int64)  # no number is negative
        table[np.repeat(np.arange(sent.size), counts), np.arange(known.size) - np.repeat(ends - counts, counts)] = known
        full = counts == k
        last = np.where(full, gaps[np.maximum(ends - 1, 0)] if gaps.size else np.inf, np.inf)
        ids, found, distant = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        # a row has at most k neighbours, so a step has at most that many times its rows as pairs
        for start in range(0, sent.size, max(1, _PAIRS_PER_STEP // k)):
            some = np.arange(start, min(sent.size, start + max(1, _PAIRS_PER_STEP // k)))
            pairs, to = _matches(at[sent[some]], at[held])
            row, new = some[pairs], other[held[to]]
            fresh = (new != other[sent[row]]) & ~(table[row] == new[:, None]).any(axis=1)
            row, new, to = row[fresh], new[fresh], to[fresh]
            gap = distances(x[held[to]], x[sent[row]])
            nearer = ~(gap > last[row])
            ids.append(other[sent[row[nearer]]])
            found.append(new[nearer])
            distant.append(gap[nearer])
        ids, found, distant = (np.concatenate(c) for c in (ids, found, distant))
        order = np.argsort(ids, kind="stable")
        each, counts = np.unique(ids, return_counts=True)
        return pa.table([pa.array(each), _packed(distant[order], counts), _packed(found[order], counts)], ["id", "gaps", "others"])

    none = F.lit(None).cast("binary")
    sent = near.join(points, "id").select("id", "x", "others", "gaps").mapInArrow(
        send, "at long, other long, x binary, others binary, gaps binary")
    met = sent.unionByName(reach.withColumns({"others": none, "gaps": none}))
    return _best(near.unionByName(_by_range(met, "at").applyInArrow(measure, _NEAR)), k)


def nearest_neighbours(rows: DataFrame, k: int = 5, seed: int = 42, tables: int = 10, window: int = 512,
                       rounds: int = 2) -> DataFrame:
    """(id, neighbours) for ``rows(id string, x array<double>)`` with distinct ids: the k nearest other rows found,
    nearest first, ties to the smaller id. ``rounds`` is how often neighbours of neighbours are tried."""
    rows = staged(rows.select("id", "x"), "knn-rows")
    total = rows.count()
    if total == 0:
        return rows.select("id", F.lit(None).cast("array<string>").alias("neighbours"))
    held = 2 * k  # more than are asked for, as stepping stones
    if total <= window:
        tables, rounds = 1, 0  # one bucket, which is exact
    names = staged(with_positions(rows.select(F.col("id").alias("name")).distinct(), F.col("name"), name="id"), "knn-ids")
    numbered = staged(rows.withColumnRenamed("id", "name").alias("r").join(names.alias("n"), F.col("r.name").eqNullSafe(F.col("n.name")))
                      .select(F.col("n.id").alias("id"), "x"), "knn-numbered")

    def within(bucket: pa.Table) -> pa.Table:
        ids = bucket["id"].to_numpy()
        gaps, others, counts = _nearest(_points(bucket["x"].combine_chunks()), ids, held)
        return pa.table([pa.array(ids), _packed(gaps, counts), _packed(others, counts)], ["id", "gaps", "others"])

    def pack(batches):
        for batch in batches:
            x = _points(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(x, np.full(len(x), x.shape[1]))], ["id", "x"])

    near = staged(_best(_dealt(numbered, total, tables, window, seed).groupBy("bucket").applyInArrow(within, _NEAR), held), "knn-found")
    points = staged(numbered.mapInArrow(pack, "id long, x binary"), "knn-points") if rounds else None
    for _ in range(rounds):
        near = staged(_refined(near, points, held), "knn-refined")

    def listed(batches):
        for batch in batches:
            others, counts = _lists(batch.column(1), np.int64)
            ids = np.repeat(np.arange(batch.num_rows), counts)
            place = np.arange(others.size) - np.repeat(np.cumsum(counts) - counts, counts)
            first = place < k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids[first])), pa.array(others[first]), pa.array(place[first])], ["id", "other", "place"])

    found = near.select("id", "others").mapInArrow(listed, "id long, other long, place long").join(
        names.select(F.col("id").alias("other"), F.col("name").alias("other_name")), "other")
    found = found.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "other_name"))).alias("found"))
    return names.join(found, "id", "left").select(
        F.col("name").alias("id"), F.coalesce(F.col("found.other_name"), F.array().cast("array<string>")).alias("neighbours"))
