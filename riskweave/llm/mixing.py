"""Mixing sources to target weights without sorting documents.

Every document has a fixed 60-bit hash. A source's share is met by taking the documents whose hash
lies below a threshold. Thresholds come from nested histograms: words are summed by source and the
leading hash digit, running totals find the digit where the budget ends, and only that bucket is
opened at the next digit. A histogram has at most 4,096 rows per source whatever the corpus holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import WORD
from riskweave.session import staged

DIGIT_BITS, DIGITS = 12, 5

#: Weights in the order of the sources, repeating; words wanted per word held; most copies of a document.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_COPIES = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 over the id and the text's md5; equal rows share it."""
    none = F.lit("-")
    key = F.concat_ws("/", F.coalesce(doc_id.cast("string"), none), F.coalesce(F.md5(text), none))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """Words wanted of each source: (source, source_size, target).

    ``sizes`` has one row per source (source, source_size); a null source is a source of its own and
    comes last. The budget is shared by weight; a target stops at ``most`` times the source's size and
    the excess is shared again by weight until none is above. In the order of size per weight the
    stopped sources come first, so running totals find them in one pass over this small table.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_code_point) - 1) % len(weights)
    named = sizes.withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1),
        "cap": (F.col("source_size") * most).cast("double"),
    })
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    to_here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = named.withColumns({
        "cap_before": F.sum("cap").over(to_here) - F.col("cap"),
        "weight_left": F.sum("weight").over(everything) - F.sum("weight").over(to_here) + F.col("weight"),
        "wanted": F.sum("source_size").over(everything) * F.lit(float(budget)),
    })
    stopped = F.col("cap") / F.col("weight") * F.col("weight_left") + F.col("cap_before") <= F.col("wanted")
    level = (F.col("wanted") - F.sum(F.when(F.col("stopped"), F.col("cap")).otherwise(0.0)).over(everything)) / F.sum(
        F.when(F.col("stopped"), 0.0).otherwise(F.col("weight"))).over(everything)
    return totals.withColumn("stopped", stopped).select(
        "source", "source_size",
        F.when(F.col("stopped"), F.col("cap")).otherwise(F.col("weight") * level).alias("target"),
    )


def _same_source(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """Hash thresholds per source: (source, cut); documents with hash below ``cut`` meet ``rest`` words.

    ``docs`` has (source, size, hash), ``budgets`` (source, rest). Documents are taken in hash order;
    rows sharing the hash at the boundary are taken together if that brings the total nearer.
    """
    b = budgets.select(F.col("source").alias("b_source"), F.col("rest"), F.lit(0).cast("long").alias("prefix"))
    for level in range(DIGITS):
        shift = DIGIT_BITS * (DIGITS - 1 - level)
        digit = F.shiftright("hash", shift)
        inside = docs.join(b, _same_source(F.col("source"), F.col("b_source")) & (
            F.shiftright("hash", shift + DIGIT_BITS) == F.col("prefix")))
        histogram = inside.groupBy("b_source", "rest", digit.alias("digit")).agg(F.sum("size").alias("words"))
        to_here = Window.partitionBy("b_source").orderBy("digit")
        before = F.sum("words").over(to_here) - F.col("words")
        opened = (
            histogram.withColumns({"before": before})
            # the first bucket that the budget does not fill; the last one if it fills them all
            .withColumn("full", (F.col("before") + F.col("words") <= F.col("rest")).cast("int"))
            .groupBy("b_source", "rest")
            .agg(
                F.min(F.when(F.col("full") == 0, F.struct("digit", "before", "words"))).alias("open"),
                F.max(F.struct("digit", "before", "words")).alias("last"),
            )
            .withColumn("at", F.coalesce("open", "last"))
        )
        b = staged(opened.select(
            "b_source", (F.col("rest") - F.col("at.before")).alias("rest"), F.col("at.digit").alias("prefix"),
            F.col("at.words").alias("words")), "mix-level")
    nearer = 2 * F.col("rest") >= F.col("words")
    return b.select(F.col("b_source").alias("source"), (F.col("prefix") + nearer.cast("long")).alias("cut"))


def mix(documents: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """How many words of each document the mix takes: (doc_id, size, source_size, target, taken).

    A null or empty text has size 0. Whole copies of a source come first, the rest of its target is met
    by the documents below its threshold; a document is taken ``most`` times at most. Null ids and
    sources are kept; equal rows are decided alike; a source without words has target 0.
    """
    docs = staged(documents.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        document_hash(F.col("doc_id"), F.col("text")).alias("hash"),
    ), "mix-docs")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, budget, most), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    shares = targets.withColumn("whole", whole.cast("long"))
    rest = shares.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).where("rest > 0")
    cuts = thresholds(docs.select("source", "size", "hash"), rest.select("source", "rest"))
    per_source = shares.join(
        cuts.withColumnRenamed("source", "c_source"), _same_source(F.col("source"), F.col("c_source")), "left"
    ).select(F.col("source").alias("t_source"), "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))
    taken = F.col("size") * (F.col("whole") + (F.col("hash") < F.col("cut")).cast("long"))
    return docs.join(per_source, _same_source(F.col("source"), F.col("t_source"))).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"))
