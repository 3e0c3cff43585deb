"""Words, table access and small Arrow helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import shingles

#: A word: a run of bytes that are no ASCII white space (the same class ``bytes.split`` uses).
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled by one round of array operations.
CHUNK_BYTES = 1 << 20


#: Rows that Spark hands to Python at once. Texts are long: the default of 10,000 rows is tens of MB, held
#: several times over by the JVM's buffers and the workers.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, in a session that moves texts in batches of ``BATCH_ROWS``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """Names a document by id and text, so that null or repeated ids with other texts stay apart."""
    none = F.lit("-")
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), none), F.coalesce(F.md5(F.col("text").cast("string")), none))


def documents_of(documents: DataFrame) -> DataFrame:
    """(doc_id, text, row_key) whatever other columns there are."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row_key"))


def without(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents, all columns whatever their names, whose row key is not among those of ``gone``."""
    keys = gone.select(F.col("row_key").alias("gone")).distinct()
    rows = documents.select(F.struct("*").alias("whole"), row_key().alias("key"))
    return rows.join(keys, F.col("key") == F.col("gone"), "left_anti").select("whole.*")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as bytes; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of an Arrow column in ranges of about ``size`` bytes: (first row, texts).

    Only one range is held as Python objects; a longer text stands alone.
    """
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(column):
        done = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield first, utf8(column.slice(first, last - first))
        first = last


def _give_back() -> None:
    """Return what the allocators of this worker keep, though nothing uses it, to the system."""
    shingles.powers.cache_clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(task):
    """A ``mapInArrow`` function that gives its memory back at its end.

    Workers outlive their tasks and wait for the next ones, several to a core where a stage has
    several Python steps; what they keep meanwhile counts against the executor.
    """
    def run(batches):
        try:
            yield from task(batches)
        finally:
            _give_back()

    return run


def lean_group(task):
    """The same for an ``applyInPandas`` function, group by group."""
    def run(group):
        out = task(group)
        _give_back()
        return out

    return run


#: Bits of the filter by which tasks recognise wanted ids (1 MB, whatever the number of ids).
FILTER_BITS = 23


def low_bits(ids: DataFrame, column: str) -> np.ndarray:
    """A bit for every value of the low bits of an id column, set for the ids present.

    Its size is fixed, so it can be sent to all tasks; what it lets through by chance is removed by a
    join afterwards.
    """
    low = f"({column} & {(1 << FILTER_BITS) - 1})"
    words = ids.selectExpr(f"cast(shiftright({low}, 5) as int) AS word", f"shiftleft(1L, cast({low} & 31 as int)) AS bit")
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        bits[r["word"]] = r["bits"]
    return bits


def may_hold(bits: np.ndarray, value: int) -> bool:
    low = value & ((1 << FILTER_BITS) - 1)
    return bool(int(bits[low >> 5]) >> (low & 31) & 1)
