"""Positions of rows in a total order, without sorting the table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import staged

#: Bits that Spark's row numbers within a partition take.
_ROW_BITS = 33


def with_positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """All rows with their position, from 0, in the given order.

    The table is range partitioned and sorted once and staged; the rows of each partition are counted,
    and running totals over one row a partition give each partition's first position. Rows that are
    equal in the whole order stand together in any order; add a key as the last sort column where that
    matters, also for the ranges, which cannot split equal rows.
    """
    at, part, first = f"_{name}_at", f"_{name}_part", f"_{name}_first"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(ranged.withColumn(at, F.monotonically_increasing_id()), "positions")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (rows.groupBy(F.shiftright(at, _ROW_BITS).alias(part)).count()
              .select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).cast("long").alias(first)))
    in_part = F.col(at).bitwiseAND((1 << _ROW_BITS) - 1)
    return (rows.withColumn(part, F.shiftright(at, _ROW_BITS)).join(firsts, part)
            .withColumn(name, F.col(first) + in_part).drop(at, part, first))
