"""Class balancing by synthetic minority rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.models.neighbours import nearest_neighbours
from riskweave.operators.ranking import lowest_hashed
from riskweave.session import staged

_UNIT = 2 ** 32


def smote(df: DataFrame, features: list[str], label: str = "is_default", key: str = "loan_id",
          k: int = 5, seed: int = 42) -> DataFrame:
    """(key, label, x): all rows, plus synthetic rows until both classes are equally frequent.

    A synthetic row lies on the segment from a minority row to one of its k nearest minority rows.
    Every minority row gives the same number of them, the remainder going to the rows of lowest
    hash.  The neighbour and the position on the segment are hashes of (key, number, seed), so a
    retried task makes the same rows.
    """
    x = F.array(*[F.col(f).cast("double") for f in features])
    base = staged(df.select(F.col(key).alias("id"), F.col(label).alias("y"), x.alias("x")), "smote-base")
    sizes = {r["y"]: r["count"] for r in base.groupBy("y").count().collect()}  # two classes
    out = base.select(F.col("id").alias(key), F.col("y").cast("int").alias(label), "x")
    if len(sizes) != 2:
        raise ValueError(f"label {label!r} must have two classes, found {sorted(sizes)}")
    minority = min(sizes, key=sizes.get)
    need = max(sizes.values()) - sizes[minority]
    if need == 0:
        return out
    each, rest = divmod(need, sizes[minority])
    rows = base.where(F.col("y") == minority).select("id", "x")
    near = nearest_neighbours(rows, k, seed=seed)
    quota = lowest_hashed(rows.select("id"), ["id"], lambda n: F.lit(rest), seed) if rest else \
        rows.select("id", F.lit(False).alias("chosen"))
    wanted = (
        near.join(quota, "id")
        .withColumn("n", F.lit(each) + F.col("chosen").cast("int"))
        .where("n > 0 AND size(neighbours) > 0")
        .select("id", "neighbours", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("j"))
    )
    pick = F.pmod(F.xxhash64("id", "j", F.lit(seed)), F.size("neighbours").cast("bigint")).cast("int")
    place = F.pmod(F.xxhash64("id", "j", F.lit(seed + 1)), F.lit(_UNIT)) / F.lit(float(_UNIT))
    requests = wanted.select("id", "j", F.get("neighbours", pick).alias("other"), place.alias("u"))
    start = rows.select("id", F.col("x").alias("a"))
    end = rows.select(F.col("id").alias("other"), F.col("x").alias("b"))
    # the row's own point and its neighbour's point, each by key
    placed = requests.join(start, "id").join(end, "other")
    point = F.zip_with("a", "b", lambda p, q: p + F.col("u") * (q - p))
    synthetic = placed.select(
        F.concat("id", F.lit("#"), F.col("j").cast("string")).alias(key),
        F.lit(minority).cast("int").alias(label), point.alias("x"),
    )
    return out.unionByName(synthetic)


def segment_violations(balanced: DataFrame, minority: DataFrame, key: str = "loan_id", k: int = 5, seed: int = 42,
                       tolerance: float = 1e-9) -> DataFrame:
    """One row (synthetic_rows, off_segment): synthetic rows of ``balanced(key, x)``, and those that lie on no
    segment from their row of ``minority(id, x)`` to one of its k neighbours."""
    made = balanced.where(F.col(key).contains("#")).select(
        F.col(key).alias("name"), F.substring_index(key, "#", 1).alias("id"), "x")
    gap = lambda p, q: F.sqrt(F.aggregate(F.zip_with(p, q, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))
    near = nearest_neighbours(minority, k, seed=seed).select("id", F.explode("neighbours").alias("other"))
    a = minority.select("id", F.col("x").alias("a"))
    b = minority.select(F.col("id").alias("other"), F.col("x").alias("b"))
    # a row's few neighbours meet their points once, not once per synthetic row
    ends = near.join(b, "other").groupBy("id").agg(F.collect_list("b").alias("ends"))
    beyond = F.transform("ends", lambda q: F.col("first") + gap("x", q) - gap("a", q) - tolerance * (1 + gap("a", q)))
    least = made.join(a, "id").join(ends, "id").withColumn("first", gap("a", "x")).groupBy("name").agg(
        F.min(F.array_min(beyond)).alias("excess"))
    return made.select("name").join(least, "name", "left").agg(
        F.count(F.lit(1)).alias("synthetic_rows"), F.count_if(F.coalesce(F.col("excess") > 0, F.lit(True))).alias("off_segment"))
