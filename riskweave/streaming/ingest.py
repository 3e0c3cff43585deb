"""Incremental ingestion: each new loan file is cleaned, enriched and stored exactly once."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.cleaning import clean_loans
from riskweave.operators.features import engineer_features
from riskweave.operators.quality import basic_rules, dq_filter
from riskweave.schemas import RAW_LOANS_TEXT
from riskweave.session import discard, on_storage
from riskweave.sources.files import CSV_DIALECT, typed_loans

_BATCH = "ingest_batch"
_KEYS = ["origination_year", "loan_type"]
_LISTS = "_ranges"
_FOLDER = re.compile(r"batches=(\d+)-(\d+)")

#: Compacted ranges of batches that are kept side by side.
MOST_RANGES = 8


def arrivals(spark: SparkSession, src: str, max_files: int | None = None) -> DataFrame:
    """Stream of raw text rows from the CSV files that appear anywhere below ``src``.

    Directory keys are not read: an arriving file holds all raw fields.  A file with another
    header stops the run instead of being read into the wrong columns.
    """
    reader = spark.readStream.options(**CSV_DIALECT).schema(RAW_LOANS_TEXT)
    reader = reader.option("pathGlobFilter", "*.csv").option("enforceSchema", False)
    reader = reader.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(src)


def store_batch(rows: DataFrame, batch_id: int, out: str, profile_out: str | None = None) -> None:
    """Clean, enrich and write one micro-batch to a folder of its own, by year and product.

    A batch that is replayed after a failure replaces what its first attempt left, so a file never
    counts twice. Rule counts are observed while the rows flow to the writer.
    """
    raw, rules, seen = typed_loans(rows, parse_date=False), basic_rules(), Observation(f"batch-{batch_id}")
    if profile_out:
        raw = raw.observe(seen, *[F.count_if(c).alias(r) for r, c in rules.items()])
    _write(engineer_features(clean_loans(dq_filter(raw)), "etl"), f"{out}/{_name(batch_id, batch_id)}")
    if profile_out:
        counts = seen.get
        profile = rows.sparkSession.createDataFrame([(r, counts[r]) for r in rules], "rule string, violations long")
        profile.coalesce(1).write.mode("overwrite").parquet(f"{profile_out}/{_BATCH}={batch_id}")


def _name(first: int, last: int) -> str:
    return f"batches={first:012d}-{last:012d}"


def _write(df: DataFrame, path: str) -> None:
    df.hint("rebalance", *_KEYS).write.mode("overwrite").partitionBy(*_KEYS).parquet(path)


def _folders(spark: SparkSession, out: str) -> dict[tuple[int, int], str]:
    """Folders of ``out`` that were written to their end and hold rows, by their first and last batch."""
    path, system = on_storage(spark, out)
    found = {}
    for status in system.listStatus(path) if system.exists(path) else []:
        if m := _FOLDER.fullmatch(status.getPath().getName()):
            inside = {s.getPath().getName() for s in system.listStatus(status.getPath())}  # a folder per year
            if "_SUCCESS" in inside and len(inside) > 1:
                found[int(m[1]), int(m[2])] = m[0]
    return found


def _ranges(spark: SparkSession, out: str) -> list[tuple[int, int]]:
    """Compacted ranges that count, from the newest list."""
    path, system = on_storage(spark, f"{out}/{_LISTS}")
    if not system.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName().isdigit())
    if not names:
        return []
    lines = spark.read.text(f"{out}/{_LISTS}/{names[-1]}").collect()  # a line per range, at most MOST_RANGES
    return [tuple(map(int, line["value"].split("-"))) for line in lines]


def _live(spark: SparkSession, out: str) -> list[tuple[int, int]]:
    """Compacted ranges, and batches that none of them covers."""
    ranges, folders = _ranges(spark, out), _folders(spark, out)
    return ranges + sorted(f for f in folders if f[0] == f[1] and f not in ranges and not any(a <= f[0] <= b for a, b in ranges))


def compact(spark: SparkSession, out: str, least: int = 2) -> int:
    """Join the batches since the last compaction, if at least ``least``; returns how many folders count now.

    Their rows are written anew as one folder, in files of the advised size, and a new list of ranges makes it
    count. Until the list is in place the batches count, from then on only the range does, whatever has been
    deleted of them: a run that dies in between loses and doubles nothing. Beyond ``MOST_RANGES``
    ranges all are joined, so a partition holds at most that many sets of files, besides new batches.
    Call it between runs of the stream, by one caller at a time.
    """
    live, ranges = _live(spark, out), _ranges(spark, out)
    batches = [f for f in live if f not in ranges]
    if len(batches) < least:
        return len(live)
    joined = live if len(ranges) >= MOST_RANGES else batches
    new = (min(f[0] for f in joined), max(f[1] for f in joined))
    if new in live:  # one folder only
        return len(live)
    _write(_read(spark, out, joined), f"{out}/{_name(*new)}")
    kept = [r for r in ranges if r not in joined] + [new]
    path, system = on_storage(spark, f"{out}/{_LISTS}")
    system.mkdirs(path)
    number = 1 + max((int(s.getPath().getName()) for s in system.listStatus(path) if s.getPath().getName().isdigit()), default=0)
    draft, place = (on_storage(spark, f"{out}/{_LISTS}/{n}")[0] for n in (f"_{number:012d}", f"{number:012d}"))
    stream = system.create(draft, True)
    stream.write(bytearray("\n".join(f"{a}-{b}" for a, b in kept).encode()))
    stream.close()
    if not system.rename(draft, place):
        raise RuntimeError(f"another compaction of {out} came first")
    live = _live(spark, out)
    for f in _folders(spark, out):
        if f not in live:  # joined now, or left by a run that died
            discard(spark, f"{out}/{_name(*f)}")
    return len(live)


def _read(spark: SparkSession, out: str, folders: list[tuple[int, int]]) -> DataFrame:
    return spark.read.option("basePath", out).parquet(*[f"{out}/{_name(*f)}" for f in folders]).drop("batches")


def ingest_arrivals(spark: SparkSession, src: str, checkpoint: str, out: str,
                    profile_out: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Process every file not seen before and stop; the checkpoint remembers the files.

    Only one run can hold a checkpoint, so overlapping runs exclude each other.
    """
    query = (
        arrivals(spark, src, max_files).writeStream
        .foreachBatch(lambda rows, batch_id: store_batch(rows, batch_id, out, profile_out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """All rows ingested so far; filters on year and product read their folders only."""
    return _read(spark, out, _live(spark, out))
