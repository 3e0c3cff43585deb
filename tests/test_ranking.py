import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweave.functions.numeric import order_key
from riskweave.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score; some scores are NULL."""
    score = (
        F.when(F.col("id") % 3 == 0, 50.0).when(F.col("id") % 97 == 1, None)
        .otherwise(F.round(F.pmod(F.xxhash64("id"), F.lit(10000)) / 100, 2))
    )
    loan_id = F.concat(F.lit("LN"), F.lpad(F.col("id").cast("string"), 8, "0"))
    return spark.range(5003).select(loan_id.alias("loan_id"), score.alias("score"))


@pytest.mark.parametrize("tiles", [2, 7, 10])
@pytest.mark.parametrize("nulls_first, scale", [(True, 1.0), (False, 1.0), (True, 1 / 3e9)])
def test_ntile_equals_the_window_function(skewed, tiles, nulls_first, scale):
    skewed = skewed.withColumn("score", F.col("score") * F.lit(scale))
    order = F.desc_nulls_first("score") if nulls_first else F.desc_nulls_last("score")
    expected = skewed.select("loan_id", F.ntile(tiles).over(
        Window.orderBy(order, F.md5("loan_id"), "loan_id")).alias("e"))
    got = ranking.ntile_descending(skewed, "score", tiles, ["loan_id"], "t", nulls_first)
    both = got.join(expected, "loan_id")
    assert both.count() == 5003
    assert both.where(F.col("t") != F.col("e")).count() == 0


def test_ntile_cut_keeps_exactly_the_first_tiles(skewed):
    whole = ranking.ntile_descending(skewed, "score", 10, ["loan_id"], "t")
    cut = ranking.ntile_descending(skewed, "score", 10, ["loan_id"], "t", at_most=3)
    assert cut.exceptAll(whole.where("t <= 3")).count() == 0
    assert cut.count() == whole.where("t <= 3").count() == 1503


def test_ntile_sizes_differ_by_at_most_one(skewed):
    sizes = [r["count"] for r in ranking.ntile_descending(skewed, "score", 10, ["loan_id"], "t")
             .groupBy("t").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_ntile_splits_rows_without_id_after_the_others(spark):
    rows = [(f"L{i}" if i % 5 else None, 1.0 if i < 40 else 2.0, i) for i in range(60)]
    df = spark.createDataFrame(rows, "loan_id string, score double, amount int")
    got = ranking.ntile_descending(df, "score", 4, ["loan_id"], "t", ties=["amount"]).collect()
    assert sorted(r["t"] for r in got) == [t for t in (1, 2, 3, 4) for _ in range(15)]
    assert {r["t"] for r in got if r["loan_id"] is None and r["score"] == 1.0} == {4}


def test_ntile_of_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "loan_id string, score double")
    got = {r["loan_id"]: r["t"] for r in ranking.ntile_descending(df, "score", 10, ["loan_id"], "t").collect()}
    assert got == {"b": 1, "c": 2, "a": 3}


def test_ntile_of_no_rows(spark):
    df = spark.createDataFrame([], "loan_id string, score double")
    assert ranking.ntile_descending(df, "score", 10, ["loan_id"], "t").count() == 0


def test_ntile_plan_has_no_single_task_sort(skewed):
    plan = ranking.ntile_descending(skewed, "score", 10, ["loan_id"])._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.split("Subquery")[0]
    assert "Window" not in rows_side and "Exchange" not in rows_side


def test_lowest_hashed_takes_exact_counts_and_is_repeatable(skewed):
    marked = ranking.lowest_hashed(skewed, ["loan_id"], lambda n: F.floor(n / 10), 7)
    first = {r["loan_id"] for r in marked.where("chosen").collect()}
    again = ranking.lowest_hashed(skewed.repartition(13), ["loan_id"], lambda n: F.floor(n / 10), 7)
    assert len(first) == 500 and first == {r["loan_id"] for r in again.where("chosen").collect()}
    other = ranking.lowest_hashed(skewed, ["loan_id"], lambda n: F.floor(n / 10), 8)
    assert first != {r["loan_id"] for r in other.where("chosen").collect()}


def test_lowest_hashed_can_take_none(skewed):
    assert ranking.lowest_hashed(skewed, ["loan_id"], lambda n: F.lit(0), 7).where("chosen").count() == 0


def test_percentiles_equal_numpy(spark):
    values = np.random.default_rng(3).normal(0, 2, 701)
    values[::3] = 0.25  # a third of the rows share one value
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "g int, v double")
    rows = ranking.exact_percentiles(df, "v", [0.05, 0.25, 0.5, 0.99], ["g"]).collect()
    assert len(rows) == 2
    for row in rows:
        expected = np.percentile(values[row["g"]::2], [5, 25, 50, 99])
        assert [row["p5"], row["p25"], row["p50"], row["p99"]] == pytest.approx(list(expected), abs=1e-12)


def test_percentile_of_one_value(spark):
    df = spark.createDataFrame([(1.5,)], "v double")
    assert ranking.exact_percentiles(df, "v", [0.25]).first()["p25"] == 1.5


@pytest.mark.parametrize("scale", [1.0, 1e-9, 2e6, 1e-300])
def test_running_totals_equal_a_global_window(spark, scale):
    df = spark.range(400).select(
        F.lit("g").alias("g"), ((F.col("id") * 37 % 401 - 100) * F.lit(0.01 * scale)).alias("k"), "id")
    got = ranking.running_totals(df, "k", ["id"], ["g"])
    expected = df.select("id", F.sum("id").over(Window.orderBy("k")).alias("e"))
    both = got.join(expected, "id")
    assert both.count() == 400 and both.where(F.col("run_id") != F.col("e")).count() == 0
    assert got.select("all_id").distinct().collect()[0][0] == sum(range(400))


def test_order_keys_are_the_bits_of_the_number(spark):
    rng = np.random.default_rng(8)
    values = np.concatenate([
        rng.integers(0, 2 ** 64, 4000, dtype=np.uint64).view(float), rng.normal(size=500), 2.0 ** np.arange(-1074, 1024),
        np.nextafter(2.0 ** np.arange(-1022, 1024), 0), [0.0, np.inf, -np.inf, 5e-324, -5e-324, 1.7976931348623157e308]])
    values = values[~np.isnan(values)]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r[0] for r in frame.select(order_key("v")).collect()]
    bits = np.abs(values).view(np.int64)
    assert got == np.where(values < 0, -bits, bits).tolist()
    nan = spark.createDataFrame([(float("nan"),), (-0.0,)], "v double").select(order_key("v")).collect()
    assert nan[0][0] > max(got) and nan[1][0] == 0


def test_cells_are_nested_ascending_and_bounded(spark):
    frame = spark.range(20000).select((F.pow(F.lit(10.0), F.col("id") % 16 - 9) * (F.col("id") + 1)).alias("v")).orderBy("v")
    rows = frame.select("v", *ranking.value_cells(F.col("v"))).collect()
    for level in (1, 2):
        assert [r[level] for r in rows] == sorted(r[level] for r in rows)
    assert all(r[2] >> 22 == r[1] for r in rows) and len({r[1] for r in rows}) < 256 * 70


def test_percentiles_of_many_groups(spark, monkeypatch):
    """More groups than may be sent to all tasks, one of them with a third of the rows."""
    monkeypatch.setattr(ranking, "_SENT_CUTS", 10)
    rng = np.random.default_rng(4)
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i % 97, float(np.round(rng.normal(), 2))) for i in range(3000)]
    got = {r["g"]: r for r in ranking.exact_percentiles(spark.createDataFrame(rows, "g int, v double"), "v", [0.1, 0.5, 0.95], ["g"]).collect()}
    assert len(got) == len({g for g, _ in rows})
    for g, r in got.items():
        want = np.percentile([v for h, v in rows if h == g], [10, 50, 95])
        assert [r["p10"], r["p50"], r["p95"]] == pytest.approx(list(want), abs=1e-12)


def test_nan_takes_no_part_in_percentiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert ranking.exact_percentiles(df, "x", [0.5]).first()["p50"] == 2.0
