"""Connected components of an undirected graph given as pairs of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import staged

_EDGE = "u long, v long"


def _forest(batches):
    """Edges of a batch as a star per local component: fewer edges, the same components."""
    for batch in batches:
        u, v = (batch.column(k).to_numpy() for k in (0, 1))
        nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
        label = np.arange(nodes.size)
        a, b = ends[: u.size], ends[u.size :]
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        other = label != np.arange(nodes.size)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[label[other]])], ["u", "v"])


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest id of each component, for every node that has an edge.

    ``edges`` has two id columns. Alternates two star steps until only stars are left: first every
    node's larger neighbours are hung on its smallest one, then its smaller ones. A node's minimum is
    taken before its neighbours are joined to it, so no neighbour list is ever gathered.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    current = staged(pairs.mapInArrow(_forest, _EDGE).distinct(), "component-edges")
    while not _all_stars(current):
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "m_u"))
        large = both.join(least, F.col("u") == F.col("m_u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "component-large")
        least = large.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("m_u"))
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("m_u"), "m"))
        current = staged(hung.where("u <> v").distinct(), "component-small")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def merged(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """The components once ``edges`` are added to the graph that ``groups`` are the components of.

    Each group counts as one node, so the star steps see only groups that the new edges touch.
    """
    a, b = edges.columns[:2]
    x, y = (groups.select(F.col("node").alias(f"{s}_node"), F.col("component").alias(f"{s}_group")) for s in "xy")
    between = edges.join(x, F.col(a) == F.col("x_node"), "left").join(y, F.col(b) == F.col("y_node"), "left").select(
        F.coalesce("x_group", a).alias("u"), F.coalesce("y_group", b).alias("v"))
    joined = components(between).select(F.col("node").alias("j_node"), F.col("component").alias("j_component"))
    old = groups.join(joined, F.col("component") == F.col("j_node"), "left").select(
        "node", F.coalesce("j_component", "component").alias("component"))
    fresh = joined.join(groups, F.col("j_node") == F.col("node"), "left_anti").select("j_node", "j_component")
    return old.unionAll(fresh)
