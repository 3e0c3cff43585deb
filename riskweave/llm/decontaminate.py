"""Documents that contain benchmark items: size-partitioned MinHash containment search.

An item is contained when a document holds at least ``threshold`` of its distinct word shingles. A
MinHash sketch of a whole long document would hardly ever show a short item, so the sketch is taken of
the items: of an item with n shingles any document that contains it must hold one of the n - need + 1
shingles of smallest hash (need = shingles that containment asks for). Items are partitioned by size;
a partition's largest sketch value bounds the document hashes that it has to look at. Candidates are
therefore complete, and each is verified by counting the item's shingles in the document.

The items are taken in slices of bounded size, each slice one map-only pass over the documents, so no
document moves and what is sent to the tasks does not grow with either table.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import shingles
from riskweave.llm.common import documents_of, lean, text_chunks, utf8, without
from riskweave.session import staged

THRESHOLD = 0.75

#: Shingles of benchmark items that one pass holds in a task (16 bytes each).
SLICE_SHINGLES = 2_000_000

RESULT = "doc_id long, item_id long, item_shingles long, shared_shingles long, containment double, row_key string"


def needed(n: int, threshold: float) -> int:
    """Fewest shared shingles at which an item of ``n`` shingles counts as contained."""
    return max(1, int(np.ceil(n * threshold - 1e-9)))


def item_sets(benchmark: DataFrame) -> DataFrame:
    """Shingles per item: (item_id, width, n, hashes). Items without words are left out."""
    def sets(batches):
        for batch in batches:
            ids, widths, counts, hashes = [], [], [], []
            texts = utf8(batch.column(1))
            for item, text, own in zip(batch.column(0).to_pylist(), texts, shingles.shingle_sets(texts)):
                if own.size:
                    ids.append(item)
                    widths.append(min(shingles.WIDTH, len(text.split())))
                    counts.append(own.size)
                    hashes.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(counts, pa.int64()),
                 pa.array(hashes, pa.binary())], ["item_id", "width", "n", "hashes"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(sets, "item_id long, width int, n long, hashes binary")


class ItemIndex:
    """Sketches of the items of one slice, by shingle width and size class."""

    def __init__(self, rows, threshold: float):
        self.items = [(r["item_id"], np.frombuffer(r["hashes"], np.uint64)) for r in rows]
        self.need = [needed(own.size, threshold) for _, own in self.items]
        parts = defaultdict(lambda: ([], []))
        for k, (r, (_, own)) in enumerate(zip(rows, self.items)):
            sketch = own[: own.size - self.need[k] + 1]  # sorted, so these are the smallest
            values, owners = parts[r["width"], int(own.size).bit_length()]
            values.append(sketch)
            owners.append(np.full(sketch.size, k))
        self.parts = defaultdict(list)
        for (width, _), (values, owners) in parts.items():
            values, owners = np.concatenate(values), np.concatenate(owners)
            order = np.argsort(values, kind="stable")
            self.parts[width].append((values[order], owners[order]))

    def widths(self) -> list[int]:
        return sorted(self.parts)

    def contained(self, own: np.ndarray, width: int) -> list[tuple[int, int, int]]:
        """(item_id, shingles of the item, shared) for every item that the set contains."""
        found = set()
        for values, owners in self.parts[width]:
            low = own[: np.searchsorted(own, values[-1], side="right")]
            left, right = np.searchsorted(values, low, side="left"), np.searchsorted(values, low, side="right")
            for a, b in zip(left[hit := right > left].tolist(), right[hit].tolist()):
                found.update(owners[a:b].tolist())
        out = []
        for k in sorted(found):
            item, wanted = self.items[k]
            place = np.minimum(np.searchsorted(own, wanted), own.size - 1)
            shared = int((own[place] == wanted).sum())
            if shared >= self.need[k]:
                out.append((item, wanted.size, shared))
        return out


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 slice_shingles: int = SLICE_SHINGLES) -> DataFrame:
    """Every (document, item) with containment of at least ``threshold``, exactly.

    Words are runs without ASCII white space, A-Z in lower case; shingles have five words, an item of
    fewer words is one shingle of all its words and is sought at that length. Null or empty texts on
    either side match nothing; null ids are kept; repeated rows of a table give repeated pairs.
    """
    return _contaminated(documents_of(documents), benchmark, threshold, slice_shingles).drop("row_key")


def _contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float, slice_shingles: int) -> DataFrame:
    spark = docs.sparkSession
    items = staged(item_sets(benchmark), "benchmark-items")
    total = items.agg(F.sum("n")).first()[0] or 0
    slices = total // slice_shingles + 1
    parts = []
    for s in range(slices):
        rows = items.where(F.pmod(F.xxhash64("hashes"), F.lit(slices)) == s).collect()
        if rows:
            index = spark.sparkContext.broadcast(ItemIndex(rows, threshold))
            parts.append(docs.mapInArrow(lean(_search(index)), RESULT))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], RESULT)


def _search(index):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
    names = [f.split()[0] for f in RESULT.split(", ")]

    def search(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            rows = []
            for first, texts in text_chunks(batch.column(1)):
                for width in index.value.widths():
                    sets = shingles.shingle_sets(texts, width)
                    for row, own in enumerate(sets, start=first):
                        if own.size:
                            rows += [(ids[row].as_py(), i, n, k, k / n, keys[row].as_py()) for i, n, k in index.value.contained(own, width)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return search


def clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents, all columns, without those that contain a benchmark item."""
    return without(documents, _contaminated(documents_of(documents), benchmark, threshold, SLICE_SHINGLES))
