from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskweave import catalog
from riskweave.models import boosting, gates, isolation, metrics, neighbours, shapley, smote, split, training
from riskweave.operators import mutations
from riskweave.operators.lookups import check_no_leakage
from riskweave.plans import views
from riskweave.schemas import INCOMING_SCORES, MODEL_SCORES
from riskweave.session import staged


def points_frame(spark, points):
    return spark.createDataFrame([(f"r{i:05d}", [float(v) for v in p]) for i, p in enumerate(points)],
                                 "id string, x array<double>")


def exact_neighbours(points, k):
    gaps = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    return gaps, np.array([np.lexsort((np.arange(len(points)), g))[:k] for g in gaps])


def found_neighbours(spark, points, k, partitions=3, **options):
    frame = points_frame(spark, points).repartition(partitions)
    return {r["id"]: r["neighbours"] for r in neighbours.nearest_neighbours(frame, k, **options).collect()}


@pytest.mark.parametrize("n, width", [(120, 4), (4, 2), (2, 1), (1, 3)])
def test_neighbours_in_one_bucket_are_exact(spark, n, width):
    points = np.random.default_rng(n).normal(size=(n, width))
    got = found_neighbours(spark, points, 5)
    _, want = exact_neighbours(points, min(5, n - 1))
    assert got == {f"r{i:05d}": [f"r{j:05d}" for j in row] for i, row in enumerate(want)}


@pytest.mark.parametrize("scale", [np.ones(6), np.logspace(0, 5, 20)])
def test_neighbours_over_buckets_find_nine_of_ten_and_repeat(spark, scale):
    points = np.random.default_rng(1).normal(size=(1500, len(scale))) * scale
    got = found_neighbours(spark, points, 5, window=100)
    gaps, want = exact_neighbours(points, 5)
    hits = 0
    for i in range(len(points)):
        found = [int(x[1:]) for x in got[f"r{i:05d}"]]
        assert len(set(found)) == 5 and i not in found and list(gaps[i, found]) == sorted(gaps[i, found])
        hits += len(set(found) & set(want[i]))
    assert hits >= 0.9 * 5 * len(points)
    assert got == found_neighbours(spark, points, 5, partitions=7, window=100)


def test_neighbours_with_a_third_of_the_rows_identical(spark):
    points = np.random.default_rng(2).normal(size=(600, 3))
    points[::3] = 0.1
    got = found_neighbours(spark, points, 5, window=40)
    for i in range(0, 600, 3):
        assert all(int(x[1:]) % 3 == 0 for x in got[f"r{i:05d}"]) and len(got[f"r{i:05d}"]) == 5


def test_buckets_do_not_grow(spark):
    points = np.random.default_rng(3).normal(size=(1000, 3))
    points[:400] = 7.0
    rows = points_frame(spark, points)
    sizes = [r["count"] for r in neighbours._dealt(rows, 1000, 4, 64, 1).groupBy("bucket").count().collect()]
    assert max(sizes) <= 64 and sum(sizes) == 4000


def test_smote_balances_on_segments_and_repeats(spark):
    rng = np.random.default_rng(4)
    rows = [(f"L{i:04d}", int(i < 37), *map(float, rng.normal(size=3))) for i in range(300)]
    df = spark.createDataFrame(rows, "loan_id string, is_default int, a double, b double, c double")
    out = smote.smote(df, ["a", "b", "c"], seed=9)
    sizes = {r["is_default"]: r["count"] for r in out.groupBy("is_default").count().collect()}
    assert sizes == {0: 263, 1: 263}
    minority = np.array([r[2:] for r in rows if r[1] == 1])
    gaps = np.sqrt(((minority[:, None] - minority[None]) ** 2).sum(axis=2))
    new = {r["loan_id"]: np.array(r["x"]) for r in out.where("loan_id LIKE '%#%'").collect()}
    assert len(new) == 263 - 37
    for name, x in new.items():
        i = int(name[1:5])
        near = np.argsort(gaps[i])[1:6]
        on_segment = [
            abs(np.linalg.norm(x - minority[i]) + np.linalg.norm(minority[j] - x) - gaps[i, j]) < 1e-9 for j in near]
        assert any(on_segment)
    again = {r["loan_id"]: r["x"] for r in smote.smote(df.repartition(7), ["a", "b", "c"], seed=9)
             .where("loan_id LIKE '%#%'").collect()}
    assert {k: list(v) for k, v in new.items()} == again


def test_smote_of_balanced_or_single_class(spark):
    even = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 2.0)], "loan_id string, is_default int, v double")
    assert smote.smote(even, ["v"]).count() == 2
    with pytest.raises(ValueError):
        smote.smote(even.where("is_default = 0"), ["v"]).count()


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1013).select(F.col("id").cast("string").alias("loan_id"), (F.col("id") % 9 == 0).cast("int").alias("is_default"))
    marked = split.stratified_split(df)
    counts = {(r["split"], r["is_default"]): r["count"] for r in marked.groupBy("split", "is_default").count().collect()}
    assert counts["test", 1] == -(-113 // 5) and counts["test", 0] == 900 // 5
    test, train = marked.where("split = 'test'"), marked.where("split = 'train'")
    assert check_no_leakage(train, test).first()["shared_keys"] == 0
    again = split.stratified_split(df.repartition(11)).where("split = 'test'")
    assert again.exceptAll(test).count() == test.exceptAll(again).count() == 0
    rates = {r["split"]: r["default_rate"] for r in split.class_balance_report(marked).collect()}
    assert abs(rates["train"] - rates["test"]) < 0.02


def test_isolation_flags_outliers_at_the_contamination_rate(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(2000, 3))
    points[:20] += 9
    df = spark.createDataFrame([(f"L{i:05d}", *map(float, p)) for i, p in enumerate(points)],
                               "loan_id string, a double, b double, c double")
    forest = isolation.fit_isolation_forest(df, ["a", "b", "c"], trees=60)
    got = {r["loan_id"]: r for r in forest.score(df).collect()}
    flagged = [k for k, r in got.items() if r["if_is_anomaly"] == 1]
    assert len(flagged) == 100
    assert all(got[f"L{i:05d}"]["if_is_anomaly"] == 1 for i in range(20))
    assert all(-1 <= r["if_anomaly_score"] < 0 for r in got.values())
    again = isolation.fit_isolation_forest(df.repartition(5), ["a", "b", "c"], trees=60)
    assert np.array_equal(forest.threshold, again.threshold)


def test_isolation_of_few_and_constant_rows(spark):
    df = spark.createDataFrame([(f"L{i}", 1.0) for i in range(10)], "loan_id string, a double")
    forest = isolation.fit_isolation_forest(df, ["a"], trees=5)
    assert forest.sample == 10
    assert {r["if_is_anomaly"] for r in forest.score(df).collect()} == {0}


def test_average_path_values():
    assert isolation.average_path([1, 2]).tolist() == [0.0, 1.0]
    assert isolation.average_path(256) == pytest.approx(10.244, abs=1e-3)


def brute_shapley(tree, point, n):
    """Shapley values of the path-dependent expectation, by subset enumeration."""
    def expectation(node, known):
        feature = tree.feature[node]
        if feature < 0:
            return tree.value[node]
        children = (2 * node + 1, 2 * node + 2)
        if feature in known:
            return expectation(children[int(point[feature] > tree.threshold[node])], known)
        total = sum(tree.cover[c] for c in children)
        return sum(tree.cover[c] / total * expectation(c, known) for c in children)

    out = np.zeros(n)
    for j in range(n):
        others = [f for f in range(n) if f != j]
        for size in range(n):
            weight = factorial(size) * factorial(n - 1 - size) / factorial(n)
            for subset in combinations(others, size):
                out[j] += weight * (expectation(0, {*subset, j}) - expectation(0, set(subset)))
    return out


def random_tree(rng, depth, features):
    tree = boosting.Tree.empty(depth)

    def grow(node, level, cover):
        tree.cover[node] = cover
        if level == depth or cover < 4:
            tree.value[node] = rng.normal()
            return
        left = int(rng.integers(1, cover))
        tree.feature[node], tree.threshold[node] = rng.integers(0, features), rng.normal()
        grow(2 * node + 1, level + 1, left)
        grow(2 * node + 2, level + 1, cover - left)

    grow(0, 0, 4000)
    return tree


@pytest.mark.parametrize("depth, features", [(1, 2), (4, 4), (7, 6)])
def test_contributions_equal_brute_force_shapley_values(depth, features):
    rng = np.random.default_rng(depth)
    trees = [random_tree(rng, depth, features) for _ in range(2)]
    model = boosting.BoostedTrees([f"f{i}" for i in range(features)], trees)
    points = rng.normal(size=(12, features))
    contributions = shapley.tree_contributions(model)
    got = contributions.explain(points)
    expected = np.array([sum(brute_shapley(t, p, features) for t in trees) for p in points])
    assert np.allclose(got, expected, atol=1e-11)
    assert np.allclose(got.sum(axis=1) + contributions.base, model.margin(points), atol=1e-11)


def test_contributions_of_deep_paths():
    """Twenty features on one path: subsets would be a million rows a leaf."""
    rng = np.random.default_rng(5)
    tree = boosting.Tree.empty(1)
    tree.feature, tree.threshold = np.array([0, -1, -1], np.int32), np.zeros(3)
    tree.value, tree.cover = np.array([0.0, 1.0, 2.0]), np.array([4.0, 1.0, 3.0])
    leaf = shapley._Leaf(np.arange(20), np.full(20, -np.inf), np.zeros(20), rng.uniform(0.1, 0.9, 20), 1.5)
    points = rng.normal(size=(5, 20))
    out = np.zeros((5, 20))
    leaf.add(points, out)
    met = (points <= 0).all(axis=1)
    assert np.allclose(out.sum(axis=1), 1.5 * (met - np.prod(leaf.share)), atol=1e-12)


@pytest.fixture(scope="module")
def trained(spark, sf):
    return training.train_models(catalog.model_frame(spark, sf), trees=8, isolation_trees=50)


def test_training_parts(trained):
    n = trained.split.count()
    assert trained.test.count() + trained.train.count() == n
    sizes = {r["is_default"]: r["count"] for r in trained.balanced.groupBy("is_default").count().collect()}
    assert sizes[0] == sizes[1]
    report = {r["part"]: r for r in training.balance_report(trained).collect()}
    assert report["train balanced"]["default_rate"] == 0.5
    nulls = [F.count_if(F.col(f).isNull()) for f in trained.features]
    assert sum(trained.split.select(*nulls).first()) == 0 and len(trained.features) == 20


def test_models_beat_chance_and_scores_are_probabilities(trained, spark):
    frame = training.score_frame(trained.predict(trained.test))
    assert len(frame.columns) == 12 and frame.count() == trained.test.count()
    low, high = frame.select(F.min(F.least(*gates.PROBABILITIES)), F.max(F.greatest(*gates.PROBABILITIES))).first()
    assert 0 <= low <= high <= 1
    rows = metrics.long_scores(frame, {"lr": "lr_default_prob", "gbt": "xgb_default_prob"}, ["actual_default"])
    for row in metrics.auc_roc(rows, "score", "actual_default", ["model_name"]).collect():
        assert row["auc_roc"] > 0.5
    checks = {r["gate"]: r["passed"] for r in gates.validation_gates(frame, trained.split).collect()}
    assert len(checks) == 8
    assert checks["probabilities outside [0, 1]"] and checks["train and test rates within 0.02"]
    assert checks["default rate within 5-25 %"] and checks["anomaly rate within 2-10 %"]


def test_models_score_in_a_session_that_observed_a_query(trained, spark):
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    vectors = trained.scaler.transform(training.feature_vector(trained.features).transform(trained.train))
    fitted = training.fit_logistic(vectors, max_iter=5)
    assert fitted.transform(vectors).agg(F.max(training.positive("lr_vector"))).first()[0] <= 1


def test_from_score_frame_to_early_warning(trained, spark, sf):
    """Scores are merged into an empty table, logged and shown by the views."""
    frame = training.score_frame(trained.predict(trained.test))
    empty = spark.createDataFrame([], MODEL_SCORES)
    table = mutations.merge_scores(empty, frame.select(*INCOMING_SCORES.fieldNames()), "v2.0")
    assert table.count() == trained.test.count()
    merged = table.join(frame.select("loan_id", F.col("risk_tier").alias("t"), "ensemble_default_prob"), "loan_id")
    # rounding to four decimals happens before the table's tier is derived
    near_edge = F.col("t") != F.col("risk_tier")
    assert merged.where(near_edge).count() <= 1
    book = staged(catalog.loans(spark, sf).where("loan_id IS NOT NULL"), "e2e")
    warned = views.early_warning(book, table, "v2.0")
    assert 0 < warned.where("ensemble_default_prob IS NOT NULL").count() < warned.count()
    measured = metrics.performance_summary(
        frame, {"LogisticRegression": "lr_default_prob", "BoostedTrees": "xgb_default_prob"}, "actual_default"
    ).withColumns({"model_version": F.lit("v2.0"), "dataset": F.lit("TEST")})
    log = mutations.log_performance(mutations.performance_rows(measured.limit(0)), measured)
    ranks = sorted(r["auc_rank"] for r in views.model_performance_view(log).collect())
    assert ranks == [1, 2]


def test_importances_sum_to_one(trained, spark):
    rows = training.feature_importances(spark, trained.boosted).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert training.feature_importances(spark, trained.boosted, 10).count() == 10


def test_contributions_add_up_to_the_log_odds(trained):
    scored = trained.test.withColumn("p", trained.boosted.probability())
    explained = shapley.shap_values(shapley.tree_contributions(trained.boosted), scored)
    row = shapley.additivity_violations(explained, "p", 1e-9).first()
    assert row["explained_rows"] == trained.test.count() and row["violations"] == 0
    moved = explained.withColumn("shap_base", F.col("shap_base") + 0.001)
    assert shapley.additivity_violations(moved, "p").first()["violations"] == row["explained_rows"]


def test_importance_and_direction(trained, spark):
    explained = shapley.shap_values(shapley.tree_contributions(trained.boosted), trained.test)
    importance = shapley.shap_importance(explained, trained.features, ordered=True).collect()
    assert len(importance) == 20 and importance[0]["mean_abs_shap"] >= importance[-1]["mean_abs_shap"] >= 0
    directions = shapley.shap_direction(explained, trained.features).collect()
    assert len(directions) == 3
    by_name = {r["feature"]: r["direction"] for r in directions}
    assert by_name.get("credit_score", "decreases default risk") == "decreases default risk"


@pytest.fixture(scope="module")
def learnable(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 4))
    y = rng.uniform(size=3000) < 1 / (1 + np.exp(2 - 2 * x[:, 0] + 3 * (x[:, 1] > 0.5) * (x[:, 2] > 0)))
    x[::50, 3] = np.nan
    rows = [(f"L{i:05d}", int(v), *map(float, p)) for i, (v, p) in enumerate(zip(y, x))]
    return staged(spark.createDataFrame(rows, "loan_id string, is_default int, a double, b double, c double, d double").repartition(4), "learnable")


def exact_boosting(rows, names, rounds, depth, rate, min_weight, penalty):
    """Boosting on all distinct values, rows and features, in plain arrays: the margin of every row."""
    x, y = np.array([[r[n] for n in names] for r in rows], float), np.array([r["is_default"] for r in rows])
    x = np.where(np.isnan(x), np.inf, x)
    weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    margin = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)

        def grow(at, level):
            best = (0.0, None)
            for f in range(len(names) if level < depth else 0):
                for cut in np.unique(x[at, f]):
                    left = at & (x[:, f] <= cut)
                    right = at & ~left
                    if min(h[left].sum(), h[right].sum()) >= min_weight:
                        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + penalty)
                        gain = 0.5 * (score(left) + score(right) - score(at))
                        if gain > best[0] + 1e-9:
                            best = (gain, (left, right))
            if best[1] is None:
                margin[at] += -rate * g[at].sum() / (h[at].sum() + penalty)
            else:
                grow(best[1][0], level + 1)
                grow(best[1][1], level + 1)

        grow(np.ones(len(y), bool), 0)
    return margin


def test_boosting_equals_exact_boosting_on_few_values(spark):
    rng = np.random.default_rng(2)
    rows = [(f"L{i:04d}", int(rng.uniform() < (0.7 if a + b > 6 else 0.2)), float(a), float(b))
            for i, (a, b) in enumerate(rng.integers(0, 8, (400, 2)))]
    frame = spark.createDataFrame(rows, "loan_id string, is_default int, a double, b double")
    model = boosting.fit(frame, ["a", "b"], trees=3, depth=3, learning_rate=0.3, row_share=1.0, column_share=1.0,
                         min_weight=1.0, validation=0.0)
    want = exact_boosting(frame.collect(), ["a", "b"], 3, 3, 0.3, 1.0, 1.0)
    assert np.allclose(model.margin(np.array([r[2:] for r in rows])), want, atol=1e-4)


def test_boosting_learns_and_repeats_on_other_partitions(learnable):
    names = ["a", "b", "c", "d"]
    model = boosting.fit(learnable, names, trees=14, depth=4, learning_rate=0.3, patience=14)
    again = boosting.fit(learnable.repartition(7), names, trees=14, depth=4, learning_rate=0.3, patience=14)
    assert model.history == again.history and max(model.history) > 0.85
    points = np.array([[r[n] for n in names] for r in learnable.collect()], float)
    assert np.array_equal(model.margin(points), again.margin(points))
    scored = learnable.withColumn("p", model.probability()).collect()
    assert np.allclose([r["p"] for r in scored], 1 / (1 + np.exp(-model.margin(points))))
    assert sum(model.importances()) == pytest.approx(1) and np.argmax(model.importances()) < 3


def test_boosting_goes_on_from_a_model(learnable):
    options = {"depth": 3, "learning_rate": 0.2, "patience": 100, "validation": 0.2}
    whole = boosting.fit(learnable, ["a", "b", "c"], trees=12, **options)
    part = boosting.fit(learnable, ["a", "b", "c"], trees=5, **options)
    part = boosting.BoostedTrees(part.features, part.trees, part.history[: part.rounds])
    rest = boosting.fit(learnable, ["a", "b", "c"], trees=12, start=part, **options)
    assert 0 < part.rounds <= 5 and rest.history == whole.history and rest.rounds == whole.rounds


def test_boosting_stops_by_patience_and_keeps_the_best_round(learnable):
    model = boosting.fit(learnable, ["a", "b"], trees=200, depth=3, learning_rate=0.6, patience=4)
    best = model.history.index(max(model.history)) + 1
    assert model.rounds == best and len(model.history) == best + 4 < 200


def test_boosting_needs_two_classes(learnable):
    with pytest.raises(ValueError):
        boosting.fit(learnable.where("is_default = 0"), ["a"])


@pytest.mark.parametrize("n", [100, 300, 600])
def test_every_isolation_tree_gets_its_sample(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "loan_id")
    drawn = isolation._draws(rows, "loan_id", n, 40, min(256, n), 42).dropDuplicates(["loan_id", "tree"])
    counts = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert counts == [min(256, n)] * 40


def test_boosting_of_one_task_and_of_many_is_the_same(learnable, monkeypatch):
    """Features of few and many values, tasks whose sums the driver adds up or tasks merge, blocks written again."""
    names = ["a", "b", "c", "d", "few", "two", "more"]
    rows = staged(learnable.withColumns({
        "few": F.floor(F.col("a") * 2), "two": (F.col("b") > 0.5).cast("int"), "more": F.round(F.col("c") * 3)}), "many-features")
    options = {"trees": 13, "depth": 4, "learning_rate": 0.3, "patience": 20}
    here = boosting.fit(rows, names, **options)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 500)
    for merged in (boosting._MERGED_BYTES, 0):
        monkeypatch.setattr(boosting, "_MERGED_BYTES", merged)
        spread = boosting.fit(rows, names, here_rows=0, **options)
        assert spread.history == here.history and len(spread.trees) == len(here.trees)
        for one, other in zip(here.trees, spread.trees):
            assert all(np.array_equal(x, vars(other)[name]) for name, x in vars(one).items())


def test_features_of_few_values_are_counted_together():
    sizes = [256, 2, 7, 20, 2, 10]
    groups = boosting._bundles([0, 1, 2, 3, 4, 5], sizes)
    assert sorted(f for g in groups for f in g) == list(range(6)) and len(groups) < 6
    assert all(np.prod([sizes[f] for f in g]) <= boosting.BINS for g in groups)
    rng = np.random.default_rng(1)
    bins = np.array([rng.integers(0, s, 500) for s in sizes])
    total = np.zeros((2, len(groups), boosting.BINS), np.int64)
    for k, group in enumerate(groups):
        code, step = np.zeros(500, np.int64), 1
        for f in group:
            code, step = code + bins[f] * step, step * sizes[f]
        total[:, k] = np.bincount(code, minlength=boosting.BINS)
    found = boosting._by_feature(total, groups, [0, 1, 2, 3, 4, 5], sizes)
    for f, size in enumerate(sizes):
        assert found[0, f].tolist() == np.bincount(bins[f], minlength=256).tolist()


def test_a_level_reads_the_rows_of_its_tree_alone():
    """The rows drawn and the features of one tree, and of two children only the lighter one."""
    rng = np.random.default_rng(3)
    n, width = 4000, 20
    block = (n, rng.integers(0, 256, (width, n)).astype(np.uint8).tobytes(), rng.integers(0, 2, n).astype(np.uint8).tobytes(),
             rng.integers(-2 ** 62, 2 ** 62, n).tobytes(), np.zeros(n).tobytes())
    columns = [1, 3, 5]
    m, bins, derivatives, held = boosting._level_rows(columns, width, 2.0, 7, 0.5, False)(block)
    assert 0.45 * n < m < 0.55 * n and len(bins) == 3 * m and len(derivatives) == 8 * m and not held


def test_subtrees_of_leaves_at_any_depth_and_of_many_cuts():
    rng = np.random.default_rng(8)
    for depth in (0, 1, 3, 9):
        tree = random_tree(rng, depth, 5)
        points = rng.normal(size=(50, 5))
        want = np.zeros((50, 5))
        for leaf in shapley._leaves(tree)[0]:
            leaf.add(points, want)
        model = boosting.BoostedTrees(list("abcde"), [tree])
        assert (shapley._subtrees(tree) is None) == (depth == 9)
        assert np.allclose(shapley.tree_contributions(model).explain(points), want, atol=1e-12)


def test_contributions_of_rows_beyond_one_table(spark, monkeypatch):
    rng = np.random.default_rng(6)
    model = boosting.BoostedTrees(["a", "b"], [random_tree(rng, 3, 2)])
    points = rng.normal(size=(700, 2))
    frame = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, a double, b double").repartition(2)
    monkeypatch.setattr(shapley, "_TABLED_ROWS", 150)
    monkeypatch.setattr(shapley, "_ROWS", 40)
    contributions = shapley.tree_contributions(model)
    got = {r["id"]: r["shap"] for r in shapley.shap_values(contributions, frame).collect()}
    assert np.allclose([got[i] for i in range(700)], contributions.explain(points), atol=1e-12)


def test_anomaly_scores_follow_the_trees():
    """Against a walk from node to node, with missing values, constant samples and trees of unequal depth."""
    rng = np.random.default_rng(4)
    grown = [isolation._grow(rng.normal(size=(n, 3)), rng, 5) for n in (20, 7, 2, 1)]
    width = max(map(len, grown))
    nodes = np.zeros((5, 4, width))
    nodes[0] = -1
    for t, tree in enumerate(grown):
        nodes[:, t, : len(tree)] = np.array(tree, float).T
    forest = isolation.IsolationForest(
        ["a", "b", "c"], nodes[0].astype(np.int32), nodes[1], nodes[2].astype(np.int32), nodes[3].astype(np.int32),
        isolation.average_path(nodes[4]), 20)
    points = rng.normal(size=(60, 3))
    points[::7, 1] = np.nan
    want = []
    for p in points:
        lengths = []
        for t in range(4):
            node, depth = 0, 0
            while forest.feature[t, node] >= 0:
                side = forest.left if p[forest.feature[t, node]] <= forest.threshold[t, node] else forest.right
                node, depth = side[t, node], depth + 1
            lengths.append(depth + forest.path[t, node])
        want.append(-2.0 ** (-np.mean(lengths) / isolation.average_path(20)))
    assert np.allclose(forest.anomaly_scores(points), want, rtol=1e-13)
    assert forest.anomaly_scores(points[:0]).size == 0


def test_neighbours_of_repeated_ids_and_of_packed_lists(spark):
    """Ids that come twice list themselves, as in a search of all pairs; packed lists keep their numbers."""
    points = np.random.default_rng(7).normal(size=(40, 3))
    frame = points_frame(spark, points)
    got = {r["id"]: r["neighbours"] for r in neighbours.nearest_neighbours(frame.unionAll(frame.limit(40)), 3).collect()}
    once = {r["id"]: r["neighbours"] for r in neighbours.nearest_neighbours(frame, 3).collect()}
    assert got == {name: [name, *near[:2]] for name, near in once.items()}
    counts = np.array([2, 0, 3])
    column = neighbours._packed(np.arange(5.0), counts)
    values, sizes = neighbours._lists(column.slice(1), float)
    assert values.tolist() == [2.0, 3.0, 4.0] and sizes.tolist() == [0, 3]


def test_neighbours_move_no_pairs_of_points(spark):
    """A round of neighbours of neighbours sends lists and points once per neighbour, no joined pair of points."""
    points = points_frame(spark, np.random.default_rng(9).normal(size=(300, 3)))
    near = spark.createDataFrame([], neighbours._NEAR)
    packed = points.select(F.monotonically_increasing_id().alias("id"), F.lit(b"").alias("x"))
    plan = neighbours._refined(near, packed, 4)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1 and "Generate" not in plan


def test_points_off_their_segments_are_counted(spark):
    rng = np.random.default_rng(14)
    rows = [(f"L{i:03d}", int(i < 20), *map(float, rng.normal(size=2))) for i in range(70)]
    df = spark.createDataFrame(rows, "loan_id string, is_default int, a double, b double")
    made = staged(smote.smote(df, ["a", "b"], seed=3), "made")
    minority = df.where("is_default = 1").select(F.col("loan_id").alias("id"), F.array("a", "b").alias("x"))
    assert smote.segment_violations(made, minority, seed=3).first()[:] == (30, 0)
    moved = made.withColumn("x", F.when(F.col("loan_id").contains("#") & F.col("loan_id").startswith("L000"),
                                        F.transform("x", lambda v: v + 5)).otherwise(F.col("x")))
    off = made.where("loan_id LIKE 'L000#%'").count()
    assert off and smote.segment_violations(moved, minority, seed=3).first()[:] == (30, off)
