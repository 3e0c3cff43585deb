"""Reading and writing loan files: tolerant CSV input, partitioned CSV and Parquet output."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V
from riskweave.schemas import RAW_LOANS, RAW_LOANS_CONTRACT

#: One record per line, comma separated, optional double quotes, first line is the header.
CSV_DIALECT = {"header": True, "sep": ",", "lineSep": "\n", "quote": '"', "escape": '"', "multiLine": False}

#: Text is written as it is; the writer would otherwise strip blanks at both ends.
_WRITE = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

_CORRUPT, _FILE, _LACKING = "_corrupt_record", "_file", "_lacking"
_CLEAN_PARTITIONS = ["origination_year", "loan_type"]


def null_markers_to_null(c: Column) -> Column:
    """Text that stands for a missing value becomes NULL."""
    return F.when(~c.isin(V.NULL_MARKERS), c)


def _cast(name: str, target: T.DataType) -> Column:
    text = null_markers_to_null(F.col(name).cast("string"))
    if isinstance(target, T.DateType):
        return F.try_to_date(text, "yyyy-MM-dd")
    return text if isinstance(target, T.StringType) else text.try_cast(target)


def typed_loans(df: DataFrame, parse_date: bool = True) -> DataFrame:
    """Text fields to the declared types; a cell that does not fit becomes NULL."""
    columns = []
    for f in RAW_LOANS.fields:
        keep_text = f.name == "origination_date" and not parse_date
        columns.append(_cast(f.name, T.StringType() if keep_text else f.dataType).alias(f.name))
    return df.select(*columns)


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Column names in the files' headers, and the files that have them.

    A task per file takes its first line and reads no further than the reader's buffer; what comes to
    the driver is the file listing, which it holds anyway.
    """
    apart = spark.newSession()  # with settings of its own: no file is split or shares a task, one row at a time
    for name, value in (("files.maxPartitionBytes", 1 << 50), ("files.openCostInBytes", 1 << 50),
                        ("execution.arrow.maxRecordsPerBatch", 1)):
        apart.conf.set(f"spark.sql.{name}", value)

    def first_line(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch
                return

    lines = apart.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    first = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header")).mapInArrow(
        first_line, "file string, header string")
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("file").collect():
        names = tuple(name.strip().strip('"').lower() for name in r["header"].split(","))
        found.setdefault(names, []).append(unquote(r["file"]))
    if not found:
        raise ValueError(f"no CSV file below {path}")
    return found


def _text_schema(names: list[str], extra: list[str] | None = None) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, *(extra or [])]])


def _scan(spark: SparkSession, path: str, mode: str, corrupt: bool) -> DataFrame:
    """All fields as text, each file in its own column order.

    CSV columns are matched by position, so files are grouped by header, each group is one scan
    and the scans are united by name.  Columns that a file lacks are NULL; columns beyond the
    declared ones are kept.  Fields that exist only as directory keys come from there.
    """
    groups = _files_by_header(spark, path)
    if len(groups) == 1:
        return _scan_files(spark, [path], next(iter(groups)), mode, corrupt)
    # directory keys are those below the part of the path without wildcards
    base = re.split(r"[*?\[{]", path)[0]
    base = base if base == path else base.rpartition("/")[0]
    scans = [_scan_files(spark, found, names, mode, corrupt, base) for names, found in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan_files(spark: SparkSession, paths: list[str], names: tuple[str, ...], mode: str, corrupt: bool,
                base: str | None = None) -> DataFrame:
    schema = _text_schema(list(names), [_CORRUPT] if corrupt else None)
    reader = spark.read.options(**CSV_DIALECT).schema(schema).option("mode", mode)
    if base:
        reader = reader.option("basePath", base)
    reader = reader.option("enforceSchema", corrupt).option("pathGlobFilter", "*.csv")
    if corrupt:
        # without pruning every field of a line is parsed, whatever columns are asked for later;
        # otherwise a short line would pass unnoticed in a plain count
        reader = reader.option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False)
    scan = reader.csv(paths)
    # file details belong to a scan and are lost in a union
    scan = scan.withColumn(_FILE, F.col("_metadata.file_path"))
    lacking = [f for f in RAW_LOANS.fieldNames() if f not in scan.columns]
    return scan.withColumns({f: F.lit(None).cast("string") for f in lacking}).withColumn(
        _LACKING, F.lit(",".join(lacking)))


def read_raw_loans(spark: SparkSession, path: str, metadata: bool = False, parse_date: bool = True,
                   year: int | None = None) -> DataFrame:
    """Typed raw loans from CSV files, flat or laid out as ``year=Y/loan_type=T``.

    ``year`` keeps one origination year; with the directory layout only its folders are read.
    """
    scan = _scan(spark, path, "PERMISSIVE", corrupt=False)
    if year is not None and "year" in scan.columns:
        scan = scan.where(F.col("year") == year)
    if not metadata:
        return filter_year(typed_loans(scan, parse_date), year)
    scan = with_ingest_metadata(scan)
    columns = [_cast(f.name, f.dataType).alias(f.name) for f in RAW_LOANS.fields]
    return filter_year(scan.select(*columns, "ingested_at", "source_file"), year)


def with_ingest_metadata(scan: DataFrame) -> DataFrame:
    """When a row was read and from which file."""
    return scan.withColumns({
        "ingested_at": F.current_timestamp(), "source_file": F.col(_FILE),
    })


def load_tolerant(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): typed rows, and rows that do not fit with the reasons; the source stays.

    A row is bad when its line has the wrong number of fields, its file lacks a declared column, a
    non-empty cell does not fit its type, or a required key is missing.  Bad rows keep their cells
    as text.
    """
    scan = _scan(spark, path, "PERMISSIVE", corrupt=True)
    reasons = [F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed_row")),
               F.when(F.col(_LACKING) != "", F.lit("missing_column"))]
    for f in RAW_LOANS.fields:
        value = null_markers_to_null(F.col(f.name).cast("string"))
        if not isinstance(f.dataType, T.StringType):
            unfit = value.isNotNull() & _cast(f.name, f.dataType).isNull()
            reasons.append(F.when(unfit, F.lit(f"bad_{f.name}")))
        if f.name in RAW_LOANS_CONTRACT.not_null:
            reasons.append(F.when(value.isNull(), F.lit(f"null_{f.name}")))
    marked = scan.withColumn("reasons", F.filter(F.array(*reasons), lambda x: x.isNotNull()))
    good = typed_loans(marked.where(F.size("reasons") == 0))
    bad = marked.drop(_FILE, _LACKING).where(F.size("reasons") > 0)
    return good, bad


def filter_year(df: DataFrame, year: int | None = None) -> DataFrame:
    """One origination year, or everything; on the partitioned table this prunes directories."""
    return df if year is None else df.where(F.col("origination_year") == year)


def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of one output partition together, in files of the advised size.

    The rebalance lets adaptive execution split a partition value that holds a third of the rows
    over several tasks and merge small ones; a plain repartition by these few keys would leave
    one task per key.
    """
    return df.hint("rebalance", *keys)


def write_raw_partitioned(df: DataFrame, path: str) -> None:
    """CSV files below ``year=Y/loan_type=T``."""
    out = df.withColumn("year", F.col("origination_year"))
    _spread(out, ["year", "loan_type"]).write.mode("overwrite").options(**_WRITE).partitionBy(
        "year", "loan_type").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_WRITE).csv(path)


def write_product_subsets(df: DataFrame, path: str) -> dict[str, str]:
    """The full file set and one set per product; returns their folders."""
    folders = {"loans_raw": df}
    for product in V.PRODUCTS:
        folders[f"loans_{product.lower()}"] = df.where(F.upper(F.trim("loan_type")) == product.upper())
    for name, part in folders.items():
        write_csv(part, f"{path}/{name}")
    return {name: f"{path}/{name}" for name in folders}


def write_clean(df: DataFrame, path: str, mode: str = "dynamic") -> None:
    """Clean table as Parquet by year and product; replaces the partitions it writes.

    ``mode="static"`` replaces the whole table.
    """
    (
        _spread(df, _CLEAN_PARTITIONS).sortWithinPartitions(*_CLEAN_PARTITIONS)
        .write.mode("overwrite").option("partitionOverwriteMode", mode)
        .partitionBy(*_CLEAN_PARTITIONS).parquet(path)
    )


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_extract(df: DataFrame, path: str) -> None:
    """A small view as one CSV file set with upper-case headers."""
    df.toDF(*[c.upper() for c in df.columns]).write.mode("overwrite").options(**_WRITE).csv(path)
