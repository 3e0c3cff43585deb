"""Registered queries: name -> function (spark, table folder) -> DataFrame.

Every query starts from the given tables; the loan book and the scores are derived from them by
:mod:`riskweave.sources.sample_book`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions import risk
from riskweave.functions.numeric import round_half_up
from riskweave.models import gates, isolation, metrics, shapley, smote, split, training
from riskweave.operators import (
    cleaning, features, loading, lookups, mutations, quality, ranking, summaries,
)
from riskweave.operators.positions import with_positions
from riskweave.plans import dashboards, etl, report, views
from riskweave.schemas import (
    INCOMING_SCORES, LOANS_CLEAN_CONTRACT, MODEL_PERFORMANCE_CONTRACT, MODEL_SCORES_CONTRACT, RAW_LOANS, RAW_LOANS_CONTRACT,
)
from riskweave.session import scratch_path, staged
from riskweave.sources import arrivals, files, sample_book
from riskweave.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = V.OBSERVATION_END
#: The book has names of countries for states.
CLEAN_CONTRACT = replace(LOANS_CLEAN_CONTRACT, max_length=LOANS_CLEAN_CONTRACT.max_length | {"state": 30})
VERSION = "v1.0"
MODEL_COLUMNS = {
    "Logistic Regression": "lr_default_prob", "XGBoost": "xgb_default_prob",
    "Ensemble": "ensemble_default_prob",
}
SWEEP_CUTS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


# ---------------------------------------------------------------- base frames

def _built_once(function: Query) -> Query:
    """Keep the plan (not the rows) of a base frame per application and folder.

    Putting together these wide plans takes longer than planning them; every query shares them.
    """
    plans: dict[tuple[str, str], DataFrame] = {}

    @wraps(function)
    def build(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf)
        if key not in plans:
            plans[key] = function(spark, sf)
        return plans[key]

    return build


@_built_once
def raw(spark: SparkSession, sf: str) -> DataFrame:
    return sample_book.loans_raw(spark, sf)


@_built_once
def scores(spark: SparkSession, sf: str) -> DataFrame:
    return sample_book.model_scores(spark, sf)


@_built_once
def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_loans(quality.dq_filter(raw(spark, sf)))


@_built_once
def features_etl(spark: SparkSession, sf: str) -> DataFrame:
    return features.engineer_features(cleaned(spark, sf), "etl")


@_built_once
def loans(spark: SparkSession, sf: str) -> DataFrame:
    """The clean loan table in its warehouse form: every loan that passes the quality filter."""
    return features.engineer_features(quality.dq_filter_sql(raw(spark, sf)), "sql")


@_built_once
def accepted(spark: SparkSession, sf: str) -> DataFrame:
    """What a load of the clean loan table under its contract takes."""
    return loading.accepted_rows(loans(spark, sf), CLEAN_CONTRACT)


@_built_once
def model_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Key, label and the 20 model features."""
    frame = features.engineer_features(cleaned(spark, sf), "notebook")
    return frame.select("loan_id", "is_default", *V.MODEL_FEATURES)


def scored(spark: SparkSession, sf: str, version: str | None = VERSION, book: Query = loans) -> DataFrame:
    """Scores joined to the label of their loan."""
    table = scores(spark, sf)
    if version is not None:
        table = table.where(F.col("model_version") == version)
    return lookups.attach_keys(table, book(spark, sf), ["is_default"])


def performance(spark: SparkSession, sf: str, book: Query = accepted) -> DataFrame:
    """The performance log: the example rows, then the metrics of this book's scores."""
    measured = metrics.performance_summary(
        scored(spark, sf, None, book), MODEL_COLUMNS, by=["model_version"]
    ).withColumn("dataset", F.lit("TEST"))
    log = mutations.performance_rows(mutations.sample_performance(spark), AS_OF)
    return mutations.log_performance(log, measured, AS_OF)


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """The v1.0 scores as if they had just been delivered."""
    table = scores(spark, sf).where(F.col("model_version") == VERSION)
    return table.select(*INCOMING_SCORES.fieldNames())


# ---------------------------------------------------------------- quality and cleaning

def _quarantine(spark, sf):
    _, rejects = quality.dq_quarantine(raw(spark, sf))
    return rejects.select(
        "loan_id", "loan_type", "loan_amount", "credit_score", "dti_ratio", "is_default",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def _scorecard(spark, sf):
    date = F.col("origination_date")
    return cleaned(spark, sf).select(
        "loan_id", risk.rule_default_probability(date).alias("rule_probability"),
        risk.credit_tier().alias("tier"),
        risk.format_loan_id(F.col("loan_type"), F.col("origination_year"),
                            F.substring("loan_id", 3, 8).cast("bigint")).alias("long_id"),
        risk.economic_regime_label(date).alias("regime"),
    )


def _loan_outcome(spark, sf):
    return cleaned(spark, sf).select(
        "loan_id", risk.loan_outcome(F.col("origination_date")).alias("o")
    ).select("loan_id", "o.*")


def _fed_rate_lookup(spark, sf):
    book = cleaned(spark, sf).select("loan_id", "origination_date")
    both = lookups.with_fed_rate(book)
    both = lookups.with_fed_rate(both, grain="year", name="fed_rate_by_year")
    return both.drop("origination_date")


# ---------------------------------------------------------------- ranks, joins, mutations

def _risk_decile(spark, sf):
    table = loans(spark, sf).select("loan_id", "risk_score", *V.LOAN_TIES)
    return ranking.ntile_descending(table, "risk_score", 10, ["loan_id"], "risk_decile", ties=V.LOAN_TIES).drop(*V.LOAN_TIES)


def _unrounded_decile(spark, sf):
    """Deciles of a score with all its digits, on another scale."""
    table = accepted(spark, sf).select("loan_id", (F.col("risk_score") * F.lit(1e-7) + F.col("loan_amount") / F.lit(7e13)).alias("score"))
    return ranking.ntile_descending(table, "score", 10, ["loan_id"], "decile").select("loan_id", "decile")


def _curves_by_scale(spark, sf):
    """Ranking metrics of one score spread to 2e6 and squeezed to 1e-9."""
    scales = F.explode(F.array(*[F.struct(F.lit(n).alias("scale"), F.lit(x).alias("factor")) for n, x in (("wide", 2e6), ("narrow", 1e-9))]))
    table = scored(spark, sf, book=accepted).select("is_default", "ensemble_default_prob", scales.alias("s")).select(
        "is_default", "s.scale", (F.col("ensemble_default_prob") * F.col("s.factor")).alias("score"))
    return metrics.ranking_metrics(table, "score", by=["scale"])


def _amounts_by_customer_group(spark, sf):
    """Quartiles of the loan amount in many groups, one of which holds a third of the loans."""
    number = F.substring("loan_id", 3, 8).cast("bigint")
    group = F.when(number % 3 == 0, 0).otherwise(number % 997).cast("int")
    found = ranking.exact_percentiles(accepted(spark, sf).select(group.alias("grp"), "loan_amount"), "loan_amount", [0.25, 0.5, 0.75], ["grp"])
    return found.select("grp", *[round_half_up(p, 4).alias(p) for p in ("p25", "p50", "p75")])


def _load_outcome(spark, sf):
    """Accepted and rejected rows of the load into the clean table, by reason."""
    return loading.reject_counts(*loading.load_checked(loans(spark, sf), CLEAN_CONTRACT))


def _load_rejects(spark, sf):
    rejects = loading.load_checked(loans(spark, sf), CLEAN_CONTRACT)[1]
    return rejects.select("loan_id", "loan_type", "loan_amount", "credit_score", "risk_score", F.array_join("reasons", ",").alias("reasons"))


def _repeated_load(spark, sf):
    """Outcome of a load of two score deliveries that overlap, into a table keyed by loan alone."""
    contract = replace(MODEL_SCORES_CONTRACT, primary_key=["loan_id"])
    return loading.reject_counts(*loading.load_checked(scores(spark, sf), contract))


def _merge(strict):
    def run(spark, sf):
        return mutations.merge_scores(scores(spark, sf), incoming(spark, sf), "v0.9", strict)
    return run


def _versions(spark, sf):
    table = scores(spark, sf)
    return [table.where(F.col("model_version") == v) for v in ("v0.9", VERSION)]


def _insert_missing(spark, sf):
    return lookups.insert_missing(*_versions(spark, sf), ["loan_id"])


def _append_rows(spark, sf):
    path = scratch_path(spark, "append")
    for part in _versions(spark, sf):
        mutations.append_rows(part, path)
    return spark.read.parquet(path)


def _replace_table(spark, sf):
    path = scratch_path(spark, "replace")
    for part in _versions(spark, sf):
        mutations.replace_table(part, path)
    return spark.read.parquet(path)


def _view(name):
    """Content of one of the registered views, read by its name."""
    def run(spark, sf):
        views.register_views(
            spark, accepted(spark, sf), scores(spark, sf).where(F.col("model_version") == VERSION), performance(spark, sf))
        return spark.table(name)
    return run


def _describe(spark, sf):
    table = staged(scored(spark, sf).select("is_default", "if_anomaly_score"), "anomaly")
    return summaries.describe_by(table, "is_default", "if_anomaly_score")


def _metric(function):
    def run(spark, sf):
        return function(scored(spark, sf, None), "ensemble_default_prob", by=["model_version"])
    return run


def _split(spark, sf):
    table = staged(cleaned(spark, sf).select("loan_id", "is_default"), "labels")
    return split.stratified_split(table)


def _leakage(spark, sf):
    marked = _split(spark, sf)
    parts = (marked.where(F.col("split") == p) for p in ("train", "test"))
    return lookups.check_no_leakage(*parts)


def _planted_leakage(spark, sf):
    """The leakage check where test loans were put into the training part: those whose id ends in 7."""
    marked = _split(spark, sf)
    train, test = (marked.where(F.col("split") == p) for p in ("train", "test"))
    return lookups.check_no_leakage(train.unionByName(test.where(F.col("loan_id").endswith("7"))), test)


def _merged_view(spark, sf):
    """A merge that takes the incoming scores from the session view they were registered as."""
    name = mutations.incoming_view(incoming(spark, sf), "incoming_scores")
    return mutations.merge_scores(scores(spark, sf), spark.table(name), "v0.9")


def _listed_objects(spark, sf):
    """The reporting views as the session lists them."""
    names = views.register_views(
        spark, accepted(spark, sf), scores(spark, sf).where(F.col("model_version") == VERSION), performance(spark, sf))
    return views.list_objects(spark).where(F.col("name").isin(names) & (F.col("kind") == "view"))


def _union(spark, sf):
    book = cleaned(spark, sf)
    return summaries.union_products(*[book.where(F.col("loan_type") == p.upper()) for p in V.PRODUCTS])


def _registered_views(spark, sf):
    """(view, rows) of the session views, read by name."""
    names = views.register_views(spark, loans(spark, sf))
    return summaries.union_products(*[
        spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("view_name"), "rows")
        for name in names
    ])


# ---------------------------------------------------------------- files and streams

def _csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(raw(spark, sf), path)
    return files.read_raw_loans(spark, path)


def _csv_partitioned(spark, sf):
    path = scratch_path(spark, "csv-by-year")
    files.write_raw_partitioned(raw(spark, sf), path)
    return files.read_raw_loans(spark, path)


def _load_audit(spark, sf):
    """Rows per year folder a file lay in, with those that carry its name and the time they were read."""
    path = scratch_path(spark, "csv-audit")
    files.write_raw_partitioned(raw(spark, sf), path)
    rows = files.read_raw_loans(spark, path, metadata=True)
    folder = F.regexp_extract("source_file", r"/year=([^/]+)/", 1).cast("int").alias("file_year")
    return rows.groupBy(folder).agg(
        F.count(F.lit(1)).alias("rows"), F.count("ingested_at").alias("rows_with_time"),
        F.count_if(F.col("source_file").endswith(".csv")).alias("rows_with_file"))


def _rejected_lines(spark, sf):
    """Bad rows of a tolerant load over files of two column orders, with their cells and reasons."""
    root = _two_headers(spark, sf)
    bad = files.load_tolerant(spark, f"{root}/*")[1]
    return bad.select("loan_id", "loan_type", "origination_date", F.array_join("reasons", ",").alias("reasons"))


def _load_tolerant(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(raw(spark, sf), path)
    good, bad = files.load_tolerant(spark, path)
    reason = bad.select(F.explode("reasons").alias("reason")).groupBy("reason")
    loaded = good.select(F.lit("loaded").alias("reason")).groupBy("reason")
    return loaded.agg(F.count(F.lit(1)).alias("rows")).unionByName(reason.agg(F.count(F.lit(1)).alias("rows")))


def _partitioned_write(spark, sf):
    path = scratch_path(spark, "clean")
    files.write_clean(features_etl(spark, sf), path)
    return files.read_clean(spark, path)


def _filter_year(spark, sf):
    return files.filter_year(_partitioned_write(spark, sf), 2020)


def _product_subsets(spark, sf):
    folders = files.write_product_subsets(raw(spark, sf), scratch_path(spark, "subsets"))
    parts = [
        files.read_raw_loans(spark, folder).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("file_set"), "rows")
        for name, folder in folders.items()
    ]
    return summaries.union_products(*parts)


def _extract(spark, sf):
    path = scratch_path(spark, "extract")
    files.export_extract(views.geographic_risk(loans(spark, sf)), path)
    schema = "STATE string, LOAN_TYPE string, LOAN_COUNT bigint, DEFAULT_RATE_PCT double, TOTAL_EXPOSURE_MILLIONS double, AVG_CREDIT_SCORE double, AVG_DTI double, AVG_RISK_SCORE double, TOTAL_DEFAULTS bigint, DEFAULTED_EXPOSURE_MILLIONS double"
    return spark.read.option("header", True).option("enforceSchema", False) \
        .option("ignoreLeadingWhiteSpace", False).schema(schema).csv(path)


def _etl_job(spark, sf):
    """Summary row of the batch job run over the book's CSV files."""
    root = scratch_path(spark, "etl")
    files.write_csv(raw(spark, sf), f"{root}/raw")
    summary = etl.run_etl(spark, f"{root}/raw", f"{root}/clean")
    issues = ";".join(f"{rule}={n}" for rule, n in summary["issues"].items())
    columns = ["raw_rows", "clean_rows", "removed_rows", "n_columns", "total_issues"]
    written = files.read_clean(spark, summary["target"]).agg(F.count(F.lit(1)).alias("written_rows"))
    return written.select(
        *[F.lit(summary[c]).cast("bigint").alias(c) for c in columns], F.lit(issues).alias("issues"), "written_rows")


def _two_headers(spark, sf):
    """A folder of files in two column orders."""
    root = scratch_path(spark, "mixed")
    table = raw(spark, sf)
    auto = F.col("loan_type") == "Auto"
    files.write_csv(table.where(auto), f"{root}/a")
    files.write_csv(table.where(~auto | auto.isNull()).select(*reversed(table.columns)), f"{root}/b")
    return root


def _mixed_headers(spark, sf):
    """Good rows of a tolerant load over files with two column orders."""
    return files.load_tolerant(spark, f"{_two_headers(spark, sf)}/*")[0]


def _etl_rerun(spark, sf):
    """The clean table after a full run over all loans and another over one product's."""
    root = scratch_path(spark, "rerun")
    files.write_csv(raw(spark, sf), f"{root}/raw")
    files.write_csv(raw(spark, sf).where(F.col("loan_type") == "Auto"), f"{root}/auto")
    for source in ("raw", "auto"):
        etl.run_etl(spark, f"{root}/{source}", f"{root}/clean")
    return files.read_clean(spark, f"{root}/clean").select(*features_etl(spark, sf).columns)


def _etl_year(spark, sf):
    """What a run of one year writes."""
    root = scratch_path(spark, "one-year")
    files.write_csv(raw(spark, sf), f"{root}/raw")
    etl.run_etl(spark, f"{root}/raw", f"{root}/clean", year=2020)
    return files.read_clean(spark, f"{root}/clean").select(*features_etl(spark, sf).columns)


def _audit_columns(spark, sf):
    """Rows per job name, and whether all carry a time."""
    table = cleaning.with_audit_columns(cleaned(spark, sf), "loan-data-transform")
    return table.groupBy("etl_job_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("etl_processed_at").alias("rows_with_time"))


def _ingest(spark, sf):
    root = scratch_path(spark, "ingest")
    files.write_csv(raw(spark, sf), f"{root}/landing")
    ingest.ingest_arrivals(spark, f"{root}/landing", f"{root}/checkpoint", f"{root}/clean")
    return ingest.read_ingested(spark, f"{root}/clean")


def _ingest_compacted(spark, sf):
    """Content of the ingested table after several batches, a replay and a compaction."""
    out = scratch_path(spark, "ingest")
    text = raw(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in RAW_LOANS.fieldNames()])
    for batch in (0, 1, 2, 2):
        ingest.store_batch(text.where(F.pmod(F.crc32(F.coalesce("loan_id", F.lit("")).cast("binary")), F.lit(3)) == batch), batch, out)
    ingest.compact(spark, out)
    return ingest.read_ingested(spark, out).select(*features_etl(spark, sf).columns)


def _arrival_events(spark, sf):
    events = sample_book.table(spark, sf, "events")
    return arrivals.parse_arrival_events(arrivals.sample_events(events), "event", ["event_id"])


# ---------------------------------------------------------------- models

_trained: dict[tuple[str, str], training.TrainedModels] = {}


def models(spark: SparkSession, sf: str) -> training.TrainedModels:
    """Models trained on this book; kept per application, since several queries report on them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        _trained[key] = training.train_models(model_frame(spark, sf))
    return _trained[key]


def _score_frame(spark, sf):
    trained = models(spark, sf)
    return training.score_frame(trained.predict(trained.test))


def _model_scores_of(column):
    def run(spark, sf):
        trained = models(spark, sf)
        return trained.predict(trained.test).select("loan_id", "is_default", column)
    return run


def _explained(spark, sf):
    trained = models(spark, sf)
    return shapley.shap_values(shapley.tree_contributions(trained.boosted), trained.test)


def _shap_additivity(spark, sf):
    """Explained rows, and those whose contributions miss the log-odds of the model's probability."""
    trained = models(spark, sf)
    explained = shapley.shap_values(
        shapley.tree_contributions(trained.boosted), trained.test.withColumn("p", trained.boosted.probability()))
    return shapley.additivity_violations(explained, "p")


def _logistic_gradient(spark, sf):
    trained = models(spark, sf)
    vectors = trained.scaler.transform(trained.balanced.select("is_default", array_to_vector("x").alias("features")))
    found = training.logistic_gradient(trained.logistic, vectors, trained.features)
    return found.select("feature", (F.round("gradient", 3) + F.lit(0.0)).alias("gradient"), "rows")


def _smote_properties(spark, sf):
    trained = models(spark, sf)
    minority = trained.train.where("is_default = 1").select(
        F.col("loan_id").alias("id"), F.array(*trained.features).alias("x"))
    return smote.segment_violations(trained.balanced, minority)


def _isolation_properties(spark, sf):
    """Rows per tree, and whether the flagged share of the training part keeps to the contamination."""
    trained = models(spark, sf)
    train = trained.train.select("loan_id")
    drawn = isolation._draws(train, "loan_id", train.count(), len(trained.forest.feature), trained.forest.sample, 42)
    per_tree = drawn.groupBy("tree").count().agg(
        F.count(F.lit(1)).alias("trees"), F.min("count").alias("fewest_rows"), F.max("count").alias("most_rows"))
    share = trained.forest.score(trained.train).agg(F.sum("if_is_anomaly").alias("flagged"), F.count(F.lit(1)).alias("n"))
    return per_tree.crossJoin(share).select(  # one row each
        "trees", "fewest_rows", "most_rows", F.col("flagged").between(0.02 * F.col("n"), F.ceil(0.05 * F.col("n"))).alias("share_kept"))


def _importance_properties(spark, sf):
    """Features, their total, negative values, and rows out of order in the listing."""
    rows = training.feature_importances(spark, models(spark, sf).boosted)
    placed = with_positions(rows, F.desc("importance"), F.col("feature"))
    after = placed.select((F.col("position") - 1).alias("position"), F.col("importance").alias("next"))
    return placed.join(after, "position", "left").agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"), F.count_if(F.col("next") > F.col("importance")).alias("out_of_order"))


def _split_gates(spark, sf):
    """The gates that look at the split alone, which SQL can repeat."""
    found = _gates(spark, sf).where(F.col("gate").isin("default rate within 5-25 %", "train and test rates within 0.02"))
    return found.select("gate", F.round("value", 9).alias("value"), "passed")


def _boosting_rounds(spark, sf):
    """AUC of the held slice per round that was grown, and whether the model keeps the round."""
    boosted = models(spark, sf).boosted
    rows = [(k, auc, k <= boosted.rounds) for k, auc in enumerate(boosted.history, start=1)]
    return spark.createDataFrame(rows, "round int, held_auc double, kept boolean")


def _boosting_stop(spark, sf):
    """How growth ended: by patience after the best round, or at the 300 rounds allowed."""
    boosted = models(spark, sf).boosted
    beyond = len(boosted.history) - boosted.rounds
    return spark.createDataFrame(
        [(boosted.rounds >= 1, beyond == 20 or len(boosted.history) == 300, len(boosted.history) <= 300)],
        "grew boolean, stopped_by_rule boolean, within_allowed boolean")


def _gates(spark, sf):
    trained = models(spark, sf)
    return gates.validation_gates(staged(_score_frame(spark, sf), "score-frame"), trained.split)


def _model_summary(spark, sf):
    trained = models(spark, sf)
    predicted = staged(trained.predict(trained.test), "predicted")
    return metrics.performance_summary(predicted, MODEL_COLUMNS)


QUERIES: dict[str, Query] = {
    "loans_raw": raw,
    "model_scores": scores,
    "dq_profile": lambda s, d: quality.dq_profile(raw(s, d)),
    "dq_extended": lambda s, d: quality.dq_extended(raw(s, d)),
    "dq_domains": lambda s, d: quality.dq_domains(raw(s, d)),
    "dq_quarantine": _quarantine,
    "dq_summary": lambda s, d: quality.dq_summary(raw(s, d), len(RAW_LOANS.fields)),
    "contract_check": lambda s, d: quality.check_contract(loans(s, d), LOANS_CLEAN_CONTRACT),
    "contract_check_raw": lambda s, d: quality.check_contract(raw(s, d), RAW_LOANS_CONTRACT),
    "contract_check_scores": lambda s, d: quality.check_contract(scores(s, d), MODEL_SCORES_CONTRACT),
    "contract_check_performance": lambda s, d: quality.check_contract(performance(s, d), MODEL_PERFORMANCE_CONTRACT),
    "load_outcome": _load_outcome,
    "load_rejects": _load_rejects,
    "repeated_load": _repeated_load,
    "unrounded_decile": _unrounded_decile,
    "curves_by_scale": _curves_by_scale,
    "percentiles_of_many_groups": _amounts_by_customer_group,
    "portfolio_positions": lambda s, d: views.portfolio_positions(accepted(s, d)).select("loan_type", "origination_year", "total_loans", "position"),
    "performance_listing": lambda s, d: views.performance_listing(performance(s, d)).select(
        "model_name", "dataset", "model_version", "n_samples", "position"),
    "clean_loans": cleaned,
    "dq_filter_sql": lambda s, d: quality.dq_filter_sql(raw(s, d)),
    "features_etl": features_etl,
    "features_sql": loans,
    "features_notebook": model_frame,
    "scorecard": _scorecard,
    "loan_outcome": _loan_outcome,
    "fed_rate_lookup": _fed_rate_lookup,
    "verify_load": lambda s, d: quality.verify_load(cleaning.parse_origination_date(raw(s, d))),
    "verify_clean": lambda s, d: quality.verify_clean(loans(s, d)),
    "dataset_summary": lambda s, d: summaries.dataset_summary(loans(s, d)),
    "value_counts": lambda s, d: summaries.value_counts(loans(s, d), ["loan_status", "credit_tier"]),
    "portfolio_overview": lambda s, d: views.portfolio_overview(loans(s, d)),
    "default_by_credit_tier": lambda s, d: views.default_by_credit_tier(loans(s, d)),
    "risk_segmentation": lambda s, d: views.risk_segmentation(loans(s, d)),
    "geographic_risk": lambda s, d: views.geographic_risk(loans(s, d)),
    "economic_regime": lambda s, d: views.economic_regime(loans(s, d)),
    "sector_risk": lambda s, d: views.sector_risk(loans(s, d)),
    "risk_decile": _risk_decile,
    "early_warning": lambda s, d: views.early_warning(loans(s, d), scores(s, d), VERSION),
    "model_performance_view": lambda s, d: views.model_performance_view(performance(s, d)),
    "log_performance": lambda s, d: performance(s, d, loans).withColumns({
        "default_rate": F.round(F.col("default_rate").cast("decimal(28,8)"), 8).cast("double"),
        "gini_coefficient": F.round(F.col("gini_coefficient").cast("decimal(28,8)"), 6).cast("double"),
    }),
    "dashboard_trend": lambda s, d: dashboards.dashboard_trend(views.portfolio_overview(loans(s, d))),
    "dashboard_tier": lambda s, d: dashboards.dashboard_tier(views.default_by_credit_tier(loans(s, d))),
    "dashboard_state": lambda s, d: dashboards.dashboard_state(views.geographic_risk(loans(s, d))),
    "dashboard_relate": lambda s, d: dashboards.dashboard_relate(
        views.portfolio_overview(loans(s, d)), views.default_by_credit_tier(loans(s, d)),
        views.geographic_risk(loans(s, d))),
    "risk_report": lambda s, d: report.risk_report(accepted(s, d), scores(s, d), AS_OF),
    "merge_scores": _merge(False),
    "merge_scores_strict": _merge(True),
    "insert_missing": _insert_missing,
    "refresh_risk_tiers": lambda s, d: mutations.refresh_risk_tiers(scores(s, d))[1],
    "tier_distribution": lambda s, d: summaries.tier_distribution(
        scores(s, d).where(F.col("model_version") == VERSION)),
    "default_rate_by_tier": lambda s, d: summaries.default_rate_by_tier(scored(s, d)),
    "tier_separation": lambda s, d: summaries.tier_separation(scored(s, d)),
    "describe_by": _describe,
    "feature_correlation": lambda s, d: summaries.feature_correlation(model_frame(s, d)),
    "anomaly_overlap": lambda s, d: summaries.anomaly_overlap(scored(s, d)),
    "auc_roc": _metric(metrics.auc_roc),
    "average_precision": _metric(metrics.average_precision),
    "ks_statistic": _metric(metrics.ks_statistic),
    "confusion_metrics": _metric(metrics.confusion_metrics),
    "threshold_sweep": lambda s, d: metrics.threshold_sweep(scored(s, d), "ensemble_default_prob", SWEEP_CUTS),
    "performance_summary": lambda s, d: metrics.performance_summary(
        scored(s, d, None), MODEL_COLUMNS, by=["model_version"]),
    "ensemble": lambda s, d: metrics.ensemble(scores(s, d)).select(
        "loan_id", "model_version", "ensemble_default_prob", "ensemble_prediction"),
    "stratified_split": _split,
    "leakage_check": _leakage,
    "planted_leakage": _planted_leakage,
    "merge_from_view": _merged_view,
    "list_objects": _listed_objects,
    "load_audit": _load_audit,
    "rejected_lines": _rejected_lines,
    "union_products": _union,
    "domain_check": lambda s, d: quality.outside_domain(
        raw(s, d), "employment_sector", ["BUILDING", "AUTOMOBILE", "MACHINERY"]),
    "head_preview": lambda s, d: summaries.head(
        loans(s, d).select("loan_id", "loan_type", "loan_amount", "risk_score"), ["loan_id"]),
    "csv_round_trip": _csv_round_trip,
    "csv_partitioned": _csv_partitioned,
    "load_tolerant": _load_tolerant,
    "partitioned_write": _partitioned_write,
    "filter_year": _filter_year,
    "product_subsets": _product_subsets,
    "export_extract": _extract,
    "ingest_arrivals": _ingest,
    "ingest_compacted": _ingest_compacted,
    "arrival_events": _arrival_events,
    "logistic_scores": _model_scores_of("lr_default_prob"),
    "boosted_scores": _model_scores_of("xgb_default_prob"),
    "isolation_forest": lambda s, d: models(s, d).forest.score(models(s, d).test).select(
        "loan_id", "is_default", "if_anomaly_score", "if_is_anomaly"),
    "smote_balance": lambda s, d: models(s, d).balanced,
    "class_balance_report": lambda s, d: training.balance_report(models(s, d)),
    "importances": lambda s, d: training.feature_importances(s, models(s, d).boosted),
    "top_features": lambda s, d: training.feature_importances(s, models(s, d).boosted, top=10),
    "score_frame": _score_frame,
    "model_summary": _model_summary,
    "shap_values": lambda s, d: _explained(s, d).select("loan_id", "shap", "shap_base"),
    "shap_importance": lambda s, d: shapley.shap_importance(_explained(s, d), models(s, d).features),
    "shap_direction": lambda s, d: shapley.shap_direction(_explained(s, d), models(s, d).features),
    "validation_gates": _gates,
    "boosting_rounds": _boosting_rounds,
    "boosting_stop": _boosting_stop,
    "logistic_gradient": _logistic_gradient,
    "smote_properties": _smote_properties,
    "isolation_properties": _isolation_properties,
    "importance_properties": _importance_properties,
    "split_gates": _split_gates,
    "score_frame_properties": lambda s, d: training.score_frame_violations(_score_frame(s, d)),
    "shap_additivity": _shap_additivity,
    "quarantine_clean": lambda s, d: quality.dq_quarantine(raw(s, d))[0],
    "mixed_headers": _mixed_headers,
    "etl_rerun": _etl_rerun,
    "etl_year": _etl_year,
    "shared_keys": lambda s, d: lookups.shared_keys(*_versions(s, d)),
    "append_rows": _append_rows,
    "replace_table": _replace_table,
    "audit_columns": _audit_columns,
    "view_early_warning": _view("vw_early_warning"),
    "view_model_performance": _view("vw_model_performance"),
    "etl_job": _etl_job,
    "merge_summary": lambda s, d: mutations.merge_summary(
        mutations.merge_scores(scores(s, d), incoming(s, d), "v0.9"), "v0.9"),
    "performance_message": lambda s, d: mutations.performance_message(performance(s, d)),
    "loans_clean": lambda s, d: features.to_loans_clean(loans(s, d)).drop("processed_at"),
    "register_views": _registered_views,
    "shuffle_rows": lambda s, d: summaries.shuffle_rows(cleaned(s, d).select("loan_id", "loan_type")),
}
