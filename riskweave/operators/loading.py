"""Loading a table under its contract: rows that break a constraint are set apart, with the reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.schemas import Contract
from riskweave.session import staged

_REASONS = "reasons"


def _rules(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """What breaks a constraint of a row of its own, by name; NULL breaks none."""
    rules = {f"null_{c}": F.col(c).isNull() for c in contract.not_null}
    rules |= {f"null_{c}": F.col(c).isNull() for c in contract.primary_key}
    return rules | {f"too_long_{c}": F.length(c) > n for c, n in contract.max_length.items() if c in df.columns}


def broken_constraints(df: DataFrame, contract: Contract) -> Column:
    """Array of the constraints of a row of its own that it breaks: null_<column>, too_long_<column>."""
    rules = _rules(df, contract)
    return F.filter(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]), lambda x: x.isNotNull())


def accepted_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break no constraint of their own, in a map-only pass; repeated keys are not looked for.

    Plain conditions compile with the rest of the pass; the array of reasons would be interpreted for every row.
    """
    return df.where(reduce(lambda a, b: a & b, [~F.coalesce(broken, F.lit(False)) for broken in _rules(df, contract).values()], F.lit(True)))


def load_checked(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects): rejects have all columns and ``reasons``; every row is in exactly one of the two.

    Of rows with one key the first in column order is accepted, the others are rejected as repeated_key.
    The rows are marked in one pass over the source and staged; keys are counted with map-side
    combining, so that a key held by a third of the rows is one partial count per task.
    """
    marked = staged(df.withColumn(_REASONS, broken_constraints(df, contract)), "load-marked")
    broken = marked.where(F.size(_REASONS) > 0)
    sound = marked.where(F.size(_REASONS) == 0).drop(_REASONS)
    keys = contract.primary_key
    repeated = staged(sound.groupBy(*keys).count().where("count > 1").select(*keys), "load-repeated")
    if repeated.isEmpty():
        return sound, broken
    several = sound.join(repeated, keys, "left_semi")
    first = several.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.struct(*sound.columns)).alias("row")).select("row.*")
    surplus = several.exceptAll(first).withColumn(_REASONS, F.array(F.lit("repeated_key")))
    return sound.join(repeated, keys, "left_anti").unionByName(first), broken.unionByName(surplus)


def reject_counts(accepted: DataFrame, rejects: DataFrame) -> DataFrame:
    """(outcome, rows): accepted, rejected, and rows per reason; a row may have several reasons."""
    total = lambda df, name: df.agg(F.lit(name).alias("outcome"), F.count(F.lit(1)).alias("rows"))
    reasons = rejects.select(F.explode(_REASONS).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))
    return reduce(DataFrame.unionByName, (total(accepted, "accepted"), total(rejects, "rejected"), reasons))
