"""Ranks and running totals over a whole table without a single-task sort.

A window without partition keys moves every row to one task.  The operators here work on counts
instead.  A total order is given as a list of key columns from coarse to fine; counts per coarse
cell locate the cell in which a wanted rank lies, and only the rows of that cell are looked at
with the next key.  Rows that do not sit at a cut are never shuffled, so a sort value shared by a
third of the table costs one partial count, not one huge window partition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.numeric import order_key
from riskweave.functions.risk import row_hash
from riskweave.session import staged

_HASH_PREFIX = 4  # 65,536 cells below one sort value

#: Low bits of a number's order key that the coarse and the fine cells leave out. A table has at most
#: 2^20 coarse cells, each of them at most 2^22 fine ones, each of these at most 2^22 numbers.
_SHIFTS = (44, 22)

#: Wanted ranks of all groups together up to which their cuts are sent to all tasks.
_SENT_CUTS = 100_000


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def rank_cuts(df: DataFrame, keys: list[str], ranks: Callable[[Column], Column],
              by: list[str] | None = None) -> DataFrame:
    """Key values found at wanted 1-based ranks, per group of ``by``.

    ``keys`` order the rows ascending, NULL first, coarse to fine.  ``ranks`` maps the group size
    to an array of ranks.  The result has one row per group and wanted rank: ``by``, ``cut``
    (0-based position in the array), ``cut_rank``, ``group_rows`` and the keys.

    Cuts are sent to all tasks while there are at most ``_SENT_CUTS``; the rows of many groups are
    counted per cell first and their counts joined by group and cell.
    """
    by = by or []
    first, *finer = keys
    order = F.col(first).asc_nulls_first()
    cells = df.groupBy(*by, first).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        cells.withColumn("_end", F.sum("_n").over(upto))
        .withColumn("group_rows", F.sum("_n").over(Window.partitionBy(*by)))
        .select(*by, first, "_n", "_end", "group_rows",
                F.posexplode(ranks(F.col("group_rows"))).alias("cut", "cut_rank"))
        .where((F.col("cut_rank") <= F.col("_end")) & (F.col("cut_rank") > F.col("_end") - F.col("_n")))
        .withColumn("_rest", F.col("cut_rank") - F.col("_end") + F.col("_n"))
        .select(*by, "cut", "cut_rank", "group_rows", first, "_rest")
    )
    known = [first]
    for key in finer:
        cuts = _refine(df, staged(cuts, "cuts") if by else cuts, by, known, key)
        known = [*known, key]
    return staged(cuts.drop("_rest"), "cuts") if by else cuts.drop("_rest")


def _refine(df: DataFrame, cuts: DataFrame, by: list[str], known: list[str], key: str) -> DataFrame:
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*by, *known]]
    carried = [*by, "cut", "cut_rank", "group_rows", *known, "_rest"]
    if not by or few(cuts):  # without groups there is one row per wanted rank
        cells, found, size = df.select(*by, *known, key), F.broadcast(cuts), F.count(F.lit(1))
    else:
        cells, found, size = df.groupBy(*by, *known, key).agg(F.count(F.lit(1)).alias("_size")), cuts, F.sum("r._size")
    counted = (
        cells.alias("r").join(found.alias("c"), _all(same))
        .groupBy(*[F.col(f"c.{c}").alias(c) for c in carried], F.col(f"r.{key}").alias(key)).agg(size.alias("_n"))
    )
    upto = (
        Window.partitionBy(*by, "cut").orderBy(F.col(key).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counted.withColumn("_end", F.sum("_n").over(upto))
        .where((F.col("_rest") <= F.col("_end")) & (F.col("_rest") > F.col("_end") - F.col("_n")))
        .withColumn("_rest", F.col("_rest") - F.col("_end") + F.col("_n"))
        .select(*carried[:-1], key, "_rest")
    )


def few(cuts: DataFrame) -> bool:
    """Whether a staged table of cuts is small enough to be sent to all tasks."""
    return cuts.limit(_SENT_CUTS + 1).count() <= _SENT_CUTS


def value_cells(value: Column) -> list[Column]:
    """Two nested cell numbers of a number, coarse and fine, ascending with it on any scale."""
    key = order_key(value)
    return [F.shiftright(key, n) for n in _SHIFTS]


def _with_hash_keys(df: DataFrame, id_cols: list[str], seed: int | str | None, ties: list[str] = ()) -> DataFrame:
    """Two tie-break keys: a hash prefix, then hash and id together.

    Without a seed, rows without any id come after the others, in the order of the hash of ``ties``.
    """
    ids = F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols])
    digest = F.md5(ids) if seed is None else row_hash(*id_cols, seed=seed)
    if seed is None:
        nameless = F.concat(F.lit("~"), F.md5(F.concat_ws("|", F.lit(""), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ties])))
        digest = F.when(_all([F.col(c).isNull() for c in id_cols]), nameless).otherwise(digest)
    return (
        df.withColumn("_digest", digest)
        .withColumn("_k1", F.substring("_digest", 1, _HASH_PREFIX))
        .withColumn("_k2", F.concat("_digest", ids))
        .drop("_digest")
    )


def ntile_descending(df: DataFrame, score: str, tiles: int, id_cols: list[str],
                     name: str = "tile", nulls_first: bool = True, at_most: int | None = None, ties: list[str] = ()) -> DataFrame:
    """NTILE(tiles) over (order by score desc), ties ordered by md5(id), rows without id last by the columns ``ties``.

    The ``tiles - 1`` boundary rows are found with :func:`rank_cuts` over the scores and ids, which are
    staged; the whole rows are then labelled, and with ``at_most`` also filtered, in a map-only pass.
    Scores of any scale and number of digits are narrowed down through nested cells. NULL scores
    come first or last as ``nulls_first`` says.
    """
    place = F.when(F.col(score).isNull(), -1 if nulls_first else 1).otherwise(0)
    value = -F.col(score)
    levels = [F.struct(place.alias("place"), c.alias("value")) for c in [*value_cells(value), value]]
    sort_keys = [f"_s{i}" for i in range(len(levels))]
    narrow = staged(df.select(score, *id_cols, *ties), "rank-scores")
    keyed = _with_hash_keys(narrow.withColumns(dict(zip(sort_keys, levels))), id_cols, None, ties)

    def last_rank_of_tile(n: Column) -> Column:
        size, extra = F.floor(n / tiles), n % tiles
        return F.transform(
            F.sequence(F.lit(1), F.lit(tiles - 1)),
            lambda t: (t * size + F.least(t.cast("bigint"), extra)).cast("bigint"),
        )

    order = [sort_keys[-1], "_k1", "_k2"]
    found = (
        rank_cuts(keyed, [*sort_keys, "_k1", "_k2"], last_rank_of_tile)
        .groupBy().agg(F.sort_array(F.collect_list(F.struct("cut", F.struct(*order).alias("at")))).alias("b"))
        .select(F.transform("b", lambda c: c["at"]).alias("b"))
    )
    bounds = staged(found, "rank-bounds").scalar()  # one row
    rows = _with_hash_keys(df.withColumn(sort_keys[-1], levels[-1]), id_cols, None, ties)
    row = F.struct(*order)
    wanted = tiles if at_most is None else at_most
    if at_most is not None and at_most < tiles:
        # with fewer rows than tiles there is no such boundary, and all rows are before it
        last = F.try_element_at(bounds, F.lit(at_most))
        rows = rows.where(last.isNull() | (row <= last))
    passed = [
        F.coalesce((row > F.try_element_at(bounds, F.lit(i))).cast("int"), F.lit(0))
        for i in range(1, min(wanted, tiles))
    ]
    return rows.withColumn(name, reduce(lambda a, b: a + b, passed, F.lit(1))).drop(*order)


def lowest_hashed(df: DataFrame, id_cols: list[str], wanted: Callable[[Column], Column],
                  seed: int | str, by: list[str] | None = None,
                  name: str = "chosen") -> DataFrame:
    """Mark, in each group of ``by``, exactly ``wanted(group_rows)`` rows: those of lowest hash.

    A seeded, repeatable random choice of an exact number of rows; a retried task chooses the same
    rows again.  Adds the boolean column ``name``.
    """
    by = by or []
    keyed = _with_hash_keys(df, id_cols, seed)
    keys = ["_k1", "_k2"]
    cuts = rank_cuts(keyed, keys, lambda n: F.array(wanted(n).cast("bigint")), by)
    if not by:
        bound = cuts.groupBy().agg(F.max(F.struct(*keys))).scalar()
        return keyed.withColumn(name, F.coalesce(F.struct(*keys) <= bound, F.lit(False))).drop(*keys)
    cuts = cuts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.struct(*keys).alias("_bound"))
    same = _all([F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return (
        keyed.join(F.broadcast(cuts) if few(cuts) else cuts, same, "left")
        .withColumn(name, F.coalesce(F.struct(*keys) <= F.col("_bound"), F.lit(False)))
        .drop("_bound", *keys, *[f"_by_{c}" for c in by])
    )


def exact_percentiles(df: DataFrame, value: str, fractions: list[float],
                      by: list[str] | None = None) -> DataFrame:
    """Linear-interpolated percentiles per group, exact, as columns ``p<percent>``.

    The wanted ranks are located in nested cells before values themselves are compared.  The
    built-in exact percentile keeps every distinct value of a group in one task's memory; this
    one keeps counts per cell, for any number of groups.  NULL and NaN are no values and take no part.
    """
    by = by or []
    cells = value_cells(F.col(value))
    keyed = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value))).select(
        *by, value, *[c.alias(f"_g{i}") for i, c in enumerate(cells)]
    )
    positions = lambda n: [(n - 1) * F.lit(float(f)) for f in fractions]

    def both_neighbours(n: Column) -> Column:
        return F.array(*[
            edge for p in positions(n)
            for edge in (F.floor(p).cast("bigint") + 1, F.ceil(p).cast("bigint") + 1)
        ])

    cuts = rank_cuts(keyed, [*[f"_g{i}" for i in range(len(cells))], value], both_neighbours, by)
    at = lambda i: F.max(F.when(F.col("cut") == i, F.col(value)))
    wide = cuts.groupBy(*by, "group_rows").agg(*[at(i).alias(f"_v{i}") for i in range(2 * len(fractions))])
    out = []
    for i, (f, p) in enumerate(zip(fractions, positions(F.col("group_rows")))):
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        out.append((low + (high - low) * (p - F.floor(p))).alias(f"p{round(f * 100)}"))
    return wide.select(*by, *out)


def running_totals(points: DataFrame, key: str, measures: list[str], by: list[str] | None = None) -> DataFrame:
    """Running and total sums of ``measures`` in ascending order of a numeric key.

    ``points`` has one row per group and key.  Keys of any scale fall into nested cells of their order
    key (:func:`value_cells`): sums per coarse cell are accumulated over the coarse cells, sums per
    fine cell inside one coarse cell, points inside one fine cell.  No window sees more than the cells of
    one level.  Adds ``run_<m>`` (inclusive) and ``all_<m>`` for each measure.
    """
    by = by or []
    coarse, fine = value_cells(F.col(key))
    gridded = points.withColumn("_c", coarse).withColumn("_f", fine)
    before = (Window.unboundedPreceding, -1)

    def preceding(window):
        return {m: F.coalesce(F.sum(f"_s_{m}").over(window.rowsBetween(*before)), F.lit(0)) for m in measures}

    sums = [F.sum(m).alias(f"_s_{m}") for m in measures]
    fine_cells = gridded.groupBy(*by, "_c", "_f").agg(*sums)
    coarse_cells = fine_cells.groupBy(*by, "_c").agg(*[F.sum(f"_s_{m}").alias(f"_s_{m}") for m in measures])
    offsets = preceding(Window.partitionBy(*by).orderBy("_c"))
    coarse_cells = coarse_cells.select(
        *by, "_c",
        *[offsets[m].alias(f"_base_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(Window.partitionBy(*by)).alias(f"all_{m}") for m in measures],
    )
    inner = preceding(Window.partitionBy(*by, "_c").orderBy("_f"))
    fine_cells = fine_cells.select(*by, "_c", "_f", *[inner[m].alias(f"_in_{m}") for m in measures])

    def same(left: str, right: str, cols: list[str]) -> Column:
        return _all([F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])

    located = (
        fine_cells.alias("f").join(coarse_cells.alias("k"), same("f", "k", [*by, "_c"]))
        .select(*[F.col(f"f.{c}").alias(c) for c in [*by, "_c", "_f"]],
                *[(F.col(f"_in_{m}") + F.col(f"_base_{m}")).alias(f"_base_{m}") for m in measures],
                *[f"all_{m}" for m in measures])
    )
    upto = (
        Window.partitionBy(*by, "_c", "_f").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = gridded.select("*", *[F.sum(m).over(upto).alias(f"_run_{m}") for m in measures])
    return (
        summed.alias("p").join(located.alias("l"), same("p", "l", [*by, "_c", "_f"]))
        .select(*[F.col(f"p.{c}").alias(c) for c in points.columns],
                *[(F.col(f"_run_{m}") + F.col(f"_base_{m}")).alias(f"run_{m}") for m in measures],
                *[F.col(f"all_{m}") for m in measures])
    )
