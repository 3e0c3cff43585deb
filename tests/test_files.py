import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave import catalog
from riskweave.__main__ import main
from riskweave.plans import etl
from riskweave.schemas import RAW_LOANS
from riskweave.sources import arrivals, files
from riskweave.streaming import ingest


@pytest.fixture(scope="module")
def raw(spark, sf):
    return catalog.raw(spark, sf)


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


HEADER = ",".join(RAW_LOANS.fieldNames())


def line(**cells):
    base = {"loan_id": "LN00000001", "loan_type": "Auto", "origination_date": "2020-05-01", "loan_amount": "10.5"}
    return ",".join((base | cells).get(f, "") for f in RAW_LOANS.fieldNames())


def test_quotes_and_null_markers(spark, tmp_path):
    put(tmp_path, "b.csv", HEADER.upper() + "\n" + line(
        loan_amount="NA", credit_score="x", state="null", employment_sector='"Health, care"') + "\n")
    row = files.read_raw_loans(spark, str(tmp_path)).first()
    assert row["loan_amount"] is None and row["credit_score"] is None and row["state"] is None
    assert row["employment_sector"] == "Health, care"


def test_metadata(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER + "\n" + line() + "\n")
    row = files.read_raw_loans(spark, str(tmp_path), metadata=True).first()
    assert row["source_file"].endswith("a.csv") and row["ingested_at"] is not None


def test_tolerant_load(spark, tmp_path):
    good = line()
    rows = [good, line(loan_id="LN2", loan_amount="abc"), line(loan_id=""), "too,short", line(loan_id="LN3", origination_date="2020-13-45")]
    put(tmp_path, "a.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    loaded, bad = files.load_tolerant(spark, str(tmp_path))
    assert [r["loan_id"] for r in loaded.collect()] == ["LN00000001"]
    reasons = sorted(x for r in bad.collect() for x in r["reasons"])
    assert "malformed_row" in reasons and "bad_loan_amount" in reasons
    assert "null_loan_id" in reasons and "bad_origination_date" in reasons
    assert bad.count() == 4 and (tmp_path / "a.csv").exists()


def test_other_column_order_is_matched_by_name_or_refused(spark, tmp_path):
    names = list(reversed(RAW_LOANS.fieldNames()))
    put(tmp_path / "r", "a.csv", ",".join(names) + "\n" + ",".join("L9" if n == "loan_id" else "" for n in names) + "\n")
    assert files.read_raw_loans(spark, str(tmp_path / "r")).first()["loan_id"] == "L9"


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    names = RAW_LOANS.fieldNames()
    swapped = [{"dti_ratio": "ltv_ratio", "ltv_ratio": "dti_ratio"}.get(n, n) for n in names]
    cells = {"loan_id": "L2", "loan_type": "Auto", "origination_date": "2020-05-01", "dti_ratio": "30", "ltv_ratio": "80"}
    put(tmp_path / "a b", "1.csv", HEADER + "\n" + line(dti_ratio="30", ltv_ratio="80") + "\n")
    put(tmp_path / "a b", "2.csv", ",".join(swapped) + "\n" + ",".join(cells.get(n, "") for n in swapped) + "\n")
    path = str(tmp_path / "a b")
    good, bad = files.load_tolerant(spark, path)
    for loaded in (good, files.read_raw_loans(spark, path)):
        assert [(r["dti_ratio"], r["ltv_ratio"]) for r in loaded.collect()] == [(30.0, 80.0)] * 2
    assert bad.count() == 0
    names = [n for n in names if n != "state"]
    put(tmp_path / "a b", "3.csv", ",".join(names) + "\n" + ",".join(cells.get(n, "") for n in names) + "\n")
    good, bad = files.load_tolerant(spark, path)
    assert good.count() == 2 and [r["reasons"] for r in bad.collect()] == [["missing_column"]]
    sources = {r["source_file"][-5:] for r in files.read_raw_loans(spark, path, metadata=True).collect()}
    assert sources == {"1.csv", "2.csv", "3.csv"}


def test_one_year_is_the_same_year_of_a_full_run(spark, tmp_path):
    base = {"credit_score": "700", "dti_ratio": "30", "is_default": "0", "origination_year": "2020"}
    rows = [line(**base), line(**base | {"loan_id": "LN2", "origination_date": "bad"}),
            line(**base | {"loan_id": "LN3", "origination_year": "2019"}), line(**base | {"loan_id": "LN4", "origination_date": "2019-01-01"})]
    put(tmp_path / "raw", "a.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    full = etl.run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "full"))
    one = etl.run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "one"), year=2020)
    ids = [sorted(r["loan_id"] for r in files.filter_year(files.read_clean(spark, str(tmp_path / p)), 2020).collect()) for p in ("full", "one")]
    assert ids[0] == ids[1] == ["LN00000001", "LN3"]
    assert (full["other_year_rows"], one["other_year_rows"], one["raw_rows"]) == (0, 2, 2)


def test_partitioned_csv_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "p")
    files.write_raw_partitioned(raw, path)
    typed = files.typed_loans(raw)
    back = files.read_raw_loans(spark, path)
    assert back.columns == RAW_LOANS.fieldNames()
    assert back.exceptAll(typed).count() == typed.exceptAll(back).count() == 0
    one = files.read_raw_loans(spark, path, year=2020)
    assert one.count() == typed.where("origination_year = 2020").count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_clean_write_prunes_years_and_replaces_partitions(spark, sf, tmp_path):
    path = str(tmp_path / "c")
    df = catalog.features_etl(spark, sf)
    files.write_clean(df, path)
    year = files.filter_year(files.read_clean(spark, path), 2020)
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(origination_year" in plan
    n, of_year = df.count(), year.count()
    files.write_clean(df.where("origination_year = 2020").limit(10), path)
    types = df.where("origination_year = 2020").limit(10).select("loan_type").distinct().count()
    left = files.read_clean(spark, path)
    assert left.where("origination_year <> 2020 OR origination_year IS NULL").count() == n - of_year
    if types == 2:
        assert left.where("origination_year = 2020").count() == 10
    files.write_clean(df, path, mode="static")
    assert files.read_clean(spark, path).count() == n


def test_product_subsets(spark, raw, tmp_path):
    folders = files.write_product_subsets(raw, str(tmp_path / "s"))
    counts = {k: files.read_raw_loans(spark, v).count() for k, v in folders.items()}
    missing = raw.where("loan_type IS NULL").count()
    assert counts["loans_mortgage"] + counts["loans_auto"] + missing == counts["loans_raw"] == raw.count()


def test_export_has_upper_case_header(spark, sf, tmp_path):
    from riskweave.plans.views import portfolio_overview
    path = tmp_path / "x"
    files.export_extract(portfolio_overview(catalog.loans(spark, sf)), str(path))
    head = next(p for p in sorted(path.glob("*.csv"))).read_text().splitlines()[0]
    assert head.startswith("LOAN_TYPE,ORIGINATION_YEAR,TOTAL_LOANS") and head == head.upper()


def test_arrival_events(spark):
    def record(key, size=None):
        obj = {"key": key} | ({"size": size} if size is not None else {})
        return {"s3": {"bucket": {"name": "b"}, "object": obj}}

    events = [{"Records": [record("raw/loans/a.csv", 5), record("raw/loans/b.json", 7)]}, {"Records": []}, {},
              {"Records": [record("c.csv")]}]
    df = spark.createDataFrame([(json.dumps(e),) for e in events] + [("not json",)], "e string")
    got = [tuple(r) for r in arrivals.parse_arrival_events(df, "e").collect()]
    assert got == [("b", "raw/loans/a.csv", 5), ("b", "c.csv", 0)]


def test_etl_job_summary_and_output(spark, raw, sf, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    files.write_csv(raw, source)
    summary = etl.run_etl(spark, source, target, job_name="nightly")
    batch = catalog.features_etl(spark, sf)
    assert summary["raw_rows"] == raw.count() and summary["clean_rows"] == batch.count()
    assert summary["removed_rows"] == summary["raw_rows"] - summary["clean_rows"]
    assert set(summary["issues"]) == {"invalid_loan_amount", "invalid_credit_score", "invalid_dti",
                                      "null_key_fields", "invalid_target"}
    out = files.read_clean(spark, target)
    assert out.select("etl_job_name").distinct().first()[0] == "nightly"
    same = out.select(*batch.columns)
    assert same.exceptAll(batch).count() == batch.exceptAll(same).count() == 0
    only = etl.run_etl(spark, source, str(tmp_path / "one"), year=2020)
    assert files.read_clean(spark, only["target"]).select("origination_year").distinct().count() == 1


def test_each_arriving_file_is_ingested_once(spark, raw, sf, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    files.write_csv(raw.where("loan_type = 'Auto'"), str(landing / "one"))
    landing_args = (spark, str(landing), str(tmp_path / "ckpt"), out)
    ingest.ingest_arrivals(*landing_args, profile_out=str(tmp_path / "dq"))
    first = ingest.read_ingested(spark, out).count()
    ingest.ingest_arrivals(*landing_args)
    assert ingest.read_ingested(spark, out).count() == first > 0
    files.write_csv(raw.where("loan_type = 'Mortgage'"), str(landing / "two"))
    ingest.ingest_arrivals(*landing_args)
    got = ingest.read_ingested(spark, out)
    batch = catalog.features_etl(spark, sf)
    same = got.select(*batch.columns)
    assert same.exceptAll(batch).count() == batch.exceptAll(same).count() == 0
    assert spark.read.parquet(str(tmp_path / "dq")).count() == 5


def test_replayed_batch_replaces_itself(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    ingest.store_batch(text, 0, out)
    n = ingest.read_ingested(spark, out).count()
    ingest.store_batch(text, 0, out)
    assert ingest.read_ingested(spark, out).count() == n


def files_by_partition(out):
    found = Counter()
    for p in out.glob("batches=*/*/*/*.parquet"):
        found[p.parent.parent.name, p.parent.name] += 1
    return found


def test_compaction_bounds_files_and_survives_a_crash(spark, raw, sf, tmp_path, monkeypatch):
    out = tmp_path / "out"
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    parts = [text.where(F.pmod(F.crc32("loan_id"), F.lit(6)) == k) for k in range(6)]
    whole = catalog.features_etl(spark, sf)
    same = lambda: (lambda got: got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0)(
        ingest.read_ingested(spark, str(out)).select(*whole.columns))
    for k, part in enumerate(parts[:4]):
        ingest.store_batch(part, k, str(out))
    for k, part in enumerate(parts[4:], start=4):
        ingest.store_batch(part, k, str(out))
    before = files_by_partition(out)
    assert same() and max(before.values()) > 2
    # dies after writing the joined rows, before they count
    with monkeypatch.context() as m:
        m.setattr(ingest, "_LISTS", "absent/\0")
        with pytest.raises(Exception):
            ingest.compact(spark, str(out))
    assert same()
    # dies before the joined batches are deleted
    with monkeypatch.context() as m:
        m.setattr(ingest, "discard", lambda *_: None)
        assert ingest.compact(spark, str(out)) == 1
    assert same() and ingest.compact(spark, str(out)) == 1
    ingest.store_batch(parts[5], 5, str(out))  # a replay of a batch that the range covers
    assert same()
    for k in (6, 7):
        ingest.store_batch(parts[k - 6], k, str(out))
    assert ingest.compact(spark, str(out)) == 2
    year = ingest.read_ingested(spark, str(out)).where("origination_year = 2020 AND loan_type = 'AUTO'")
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(origination_year" in plan
    monkeypatch.setattr(ingest, "MOST_RANGES", 2)
    for k in (8, 9):
        ingest.store_batch(parts[k - 6], k, str(out))
    n = ingest.read_ingested(spark, str(out)).count()
    assert ingest.compact(spark, str(out)) == 1 and max(files_by_partition(out).values()) <= 2
    ingest.store_batch(text.limit(0), 10, str(out))  # a batch without rows
    assert ingest.compact(spark, str(out)) == 1 and ingest.read_ingested(spark, str(out)).count() == n


def test_jobs(spark, raw, sf, tmp_path, capsys):
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    files.write_csv(raw, source)
    main(["etl", "--source", source, "--target", target, "--year", "2021"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["raw_rows"] == raw.where("origination_year = 2021").count()
    assert files.read_clean(spark, target).count() == summary["clean_rows"]
    scores = str(tmp_path / "scores")
    catalog.scores(spark, sf).write.parquet(scores)
    main(["report", "--loans", target, "--scores", scores, "--target", str(tmp_path / "report"), "--as-of", "2024-06-30"])
    rows = {r["METRIC"]: r["VALUE"] for r in spark.read.option("header", True).csv(str(tmp_path / "report")).collect()}
    assert rows["Report Date"] == "2024-06-30" and rows["Total Loans"] == str(summary["clean_rows"])
    main(["ingest", "--source", source, "--target", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "ck")])
    assert ingest.read_ingested(spark, str(tmp_path / "in")).count() == catalog.features_etl(spark, sf).count()
