"""Documents whose word shingles overlap: exact Jaccard links and the groups they form.

Equal shingle sets are one node. Nodes meet in blocks: two sets of Jaccard at least t share one of the
first n - ceil(t n) + 1 shingles in any common order of shingles, here rare before frequent by a sketch
of fixed size over all documents, so a frequent shingle brings together only sets that hold little else.

Inside a block nodes are points: shingles hash to groups and a point holds the count per group. The sum
of the smaller counts bounds the overlap of two sets, and for a box of points the sum against the box's
upper corner bounds the overlap with all of them. An R-tree of such boxes finds the pairs that may link;
these are verified on the shingles themselves.

Groups are wanted, not all pairs. So each block's nodes are first compared with one of them, in large
blocks with a few, and only pairs that are still in different groups are searched: a block of thousands
of near copies costs a few comparisons per copy. No link between different groups is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import shingles
from riskweave.llm.common import documents_of, lean, lean_group, low_bits, may_hold, row_key, text_chunks
from riskweave.llm.components import components, merged
from riskweave.session import staged

#: Linked if PERCENT of the union is shared, in whole numbers.
PERCENT = 75
#: Groups that shingles hash to, coordinates of a point: fewest and most.
GROUPS, MOST_GROUPS = 128, 1 << 15
#: Entries of the frequency sketch in bits, fewest and most; it has one for about 200 bytes of text, as far
#: as the bound goes. It only orders shingles. Entries are summed in pieces.
SKETCH_BITS, PIECE_BITS = (16, 24), 12
#: Prefix keys that a task holds before it deals them to the buckets (16 bytes each).
HELD_KEYS = 400_000
#: Bits of a key below the 32 that are sent. The highest are alike, as prefixes of one level are the lowest
#: shingles; those from 20 on choose the bucket.
KEY_SHIFT = 28
#: Keys per bucket of the block search, members per row of a block, nodes of a leaf and of a search task.
BUCKET_KEYS = 500_000
BLOCK_ROW = 512
LEAF_NODES, SEARCH_NODES = 64, 2048
#: Nodes of a large block that all others are first compared with.
LEADERS = 8
#: Large blocks that a node names, so that a pair is listed in one of those it shares and not in all.
NAMED_BLOCKS = 32
FANOUT = 16


def overlap_needed(a, b, percent: int = PERCENT):
    """Fewest shared shingles at which sets of ``a`` and ``b`` link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def node_id(own: np.ndarray) -> int:
    """Id of a shingle set; documents of equal sets share it."""
    salted = shingles.mix(own * np.uint64(0x9E3779B97F4A7C15) + np.uint64(own.size))
    return int(shingles.mix(np.add.reduce(salted, keepdims=True))[0].view(np.int64))


def _sets(batch, column: int):
    """(row, shingle set) for every text of an Arrow column."""
    for first, texts in text_chunks(batch.column(column)):
        yield from enumerate(shingles.shingle_sets(texts), start=first)


def _point(own: np.ndarray) -> bytes:
    """Counts of a set's shingles by group, a byte each where that is enough.

    Larger sets have more groups, four times as many for four times the size, so that sets of other
    shingles stay apart; fewer groups are the sums of more.
    """
    groups = GROUPS
    while own.size >= 8 * groups and groups < MOST_GROUPS:
        groups *= 4
    counts = np.bincount((own >> np.uint64(40)).astype(np.int64) % groups, minlength=groups)
    return (b"\0" + counts.astype(np.uint8).tobytes()) if counts.max() < 256 else (b"\1" + counts.astype(np.uint32).tobytes())


def _points(packed: list[bytes], groups: int | None = None) -> np.ndarray:
    """Points as rows, summed to ``groups`` or to the fewest groups among them."""
    rows = [np.frombuffer(p, np.uint32 if p[0] else np.uint8, offset=1) for p in packed]
    groups = groups or min(r.size for r in rows)
    return np.stack([r if r.size == groups else r.reshape(-1, groups).sum(axis=0, dtype=np.uint32) for r in rows]).astype(np.uint32)


def _packed(counts: np.ndarray) -> bytes:
    """A piece of a task's sketch, most of it small counts, with the width of an entry before it.

    Every task sends a whole sketch, so what it takes uncompressed grows with the tasks and with the entries.
    """
    kind = np.uint8 if counts.max() < 256 else np.uint16
    return bytes([np.dtype(kind).itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(piece: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(piece[1:]), np.uint8 if piece[0] == 1 else np.uint16)


def _nodes(documents: DataFrame, bits: int) -> DataFrame:
    """Rows of two kinds: a document's set size, node and point; or a piece of the frequency sketch."""
    schema = "doc_id long, row_key string, n long, node long, point binary, piece int, counts binary"
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    names = [f.split()[0] for f in schema.split(", ")]

    mask = np.uint64((1 << bits) - 1)

    def read(batches):
        sketch = np.zeros(1 << bits, np.uint16)
        for batch in batches:
            ids, sizes, nodes, points = batch.column(0).to_pylist(), [], [], []
            for _, own in _sets(batch, 1):
                sizes.append(own.size)
                nodes.append(node_id(own) if own.size else None)
                points.append(_point(own) if own.size else None)
                at = (own & mask).astype(np.int64)
                sketch[at] += sketch[at] < 65535
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, batch.column(2).to_pylist(), sizes, nodes, points, none, none), types)], names)
        pieces = [(k, _packed(p)) for k, p in enumerate(sketch.reshape(-1, 1 << PIECE_BITS)) if p.any()]
        if pieces:
            none = [None] * len(pieces)
            columns = (none, none, none, none, none, *zip(*pieces))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return documents.mapInArrow(lean(read), schema)


def _levels(pieces: DataFrame, bits: int) -> np.ndarray:
    """How much more frequent than the mean each entry of the sketch is, in powers of two."""
    def total(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << PIECE_BITS, np.int64)
        for c in group["counts"]:
            counts += _unpacked(c)
        return pd.DataFrame({"piece": [group["piece"].iloc[0]], "counts": [counts.tobytes()]})

    sketch = np.zeros((1 << (bits - PIECE_BITS), 1 << PIECE_BITS), np.int64)
    for r in pieces.groupBy("piece").applyInPandas(total, "piece int, counts binary").collect():
        sketch[r["piece"]] = np.frombuffer(r["counts"], np.int64)
    relative = (sketch.reshape(-1) + 1) / (sketch.mean() + 1)
    return np.maximum(np.floor(np.log2(relative)), 0).astype(np.uint8)


def _blocks(documents: DataFrame, levels: np.ndarray, keys: int, percent: int) -> DataFrame:
    """Nodes that share a prefix shingle: (block, leaders, members), members in rows of bounded length.

    Keys travel packed, a row per HELD_KEYS keys and bucket, as 32 of their bits: shingles of one bucket that
    agree in these share a block, which adds candidates and loses none. Blocks of equal members are one block.
    """
    buckets = keys // BUCKET_KEYS + 1
    shared = documents.sparkSession.sparkContext.broadcast(levels)
    mask = np.uint64(levels.size - 1)

    def dealt(keys, nodes):
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        bucket = ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, nodes, bucket = (keys[order] >> np.uint64(KEY_SHIFT)).astype(np.uint32), nodes[order], bucket[order]
        names, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], bucket.size)
        return pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([keys[a:b].tobytes() for a, b in zip(first, ends)]),
             pa.array([nodes[a:b].tobytes() for a, b in zip(first, ends)])], ["bucket", "keys", "nodes"])

    def deal(batches):
        keys, nodes, seen, held = [], [], set(), 0
        for batch in batches:
            for _, own in _sets(batch, 1):
                if own.size and (node := node_id(own)) not in seen:
                    seen.add(node)
                    level = shared.value[(own & mask).astype(np.int64)]
                    first = prefix_length(own.size, percent)
                    keys.append(own[np.argsort(level, kind="stable")[:first]] if level.any() else own[:first].copy())
                    nodes.append(np.full(first, node, np.int64))
                    held += first
                    if held >= HELD_KEYS:
                        yield dealt(keys, nodes)
                        keys, nodes, seen, held = [], [], set(), 0
        if keys:
            yield dealt(keys, nodes)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint32)
        nodes = np.frombuffer(b"".join(group["nodes"]), np.int64)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        fresh = np.ones(keys.size, bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[fresh], nodes[fresh]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(first, keys.size))
        many = np.flatnonzero(size > 1)
        sums = np.add.reduceat(shingles.mix(nodes.view(np.uint64)), first)[many] if many.size else np.empty(0, np.uint64)
        _, one = np.unique(sums, return_index=True)  # a block of the same members once
        blocks, leaders, members = [], [], []
        for k, name in zip(many[one].tolist(), sums[one].view(np.int64).tolist()):
            own = nodes[first[k] : first[k] + size[k]]
            # the same nodes lead in every block that holds them
            lead = own[np.argsort(shingles.mix(own.view(np.uint64)))[: LEADERS if own.size > LEAF_NODES else 1]].tolist()
            for at in range(0, own.size, BLOCK_ROW):
                blocks.append(name)
                leaders.append(lead)
                members.append(own[at : at + BLOCK_ROW].tolist())
        return pd.DataFrame({"block": pd.Series(blocks, dtype="int64"), "leaders": pd.Series(leaders, dtype=object),
                             "members": pd.Series(members, dtype=object)})

    packed = documents.mapInArrow(lean(deal), "bucket long, keys binary, nodes binary")
    return packed.groupBy("bucket").applyInPandas(lean_group(meet), "block long, leaders array<long>, members array<long>").dropDuplicates(["block", "members"])


def _within_bound(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose points allow enough overlap."""
    def keep(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = _points([x, y])
                good.append(int(np.minimum(p, q).sum()) >= overlap_needed(int(p.sum()) + int(q.sum()), 0, percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    p, q = (points.select(F.col("node").alias(f"{x}_node"), F.col("n").alias(f"{x}_n"), F.col("point").alias(f"{x}_point")) for x in "pq")
    sized = pairs.join(p, F.col("a") == F.col("p_node")).join(q, F.col("b") == F.col("q_node")).where(
        (F.least("p_n", "q_n") * 100 >= F.greatest("p_n", "q_n") * percent))
    return sized.select("a", "b", "p_point", "q_point").mapInArrow(lean(keep), "a long, b long")


class CountTree:
    """R-tree of points with non-negative counts; boxes keep their upper corner and least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            top, low, high = self.levels[-1]
            starts = np.arange(0, len(top), FANOUT)
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Rows that may share enough with the point."""
        rows = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = (x[rows] for x in self.levels[depth])
            fits = (high * 100 >= size * percent) & (low * percent <= size * 100)
            rows, corner, low = rows[fits], corner[fits], low[fits]
            # the least overlap needed with any size in the box
            least = overlap_needed(size, np.maximum(low, -(-size * percent // 100)), percent)
            rows = rows[np.minimum(corner, point).sum(axis=1, dtype=np.int64) >= least]
            if depth:
                rows = (rows[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
                rows = rows[rows < len(self.levels[depth - 1][0])]
        return self.order[rows]


def _pairs_between_groups(blocks: DataFrame, groups: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a block that are in different groups and whose points allow enough overlap.

    Blocks of one group are left out before any point is moved. Small blocks are one leaf: their pairs
    are listed by size and group, and each distinct pair is bounded once.
    """
    member = blocks.select("block", F.explode("members").alias("node")).join(
        groups.withColumnRenamed("node", "g_node"), F.col("node") == F.col("g_node"), "left"
    ).select("block", "node", F.coalesce("component", "node").alias("group"))
    mixed = member.groupBy(F.col("block").alias("m_block")).agg(
        F.count("*").alias("members"), F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high and members > 2")
    open_members = staged(member.join(mixed, F.col("block") == F.col("m_block")).select("block", "node", "group", "members"), "join-open")
    large = _search_large(open_members.where(F.col("members") > LEAF_NODES), points, percent)
    sizes = points.select(F.col("node").alias("p_node"), "n")
    # at most LEAF_NODES members a block
    listed = open_members.where(F.col("members") <= LEAF_NODES).join(sizes, F.col("node") == F.col("p_node")).groupBy("block").agg(
        F.collect_list(F.struct("node", "group", "n")).alias("m"))
    fits = f"y.node > x.node AND y.group <> x.group AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent}"
    pairs = listed.select(F.explode(F.expr(
        f"flatten(transform(m, x -> transform(filter(m, y -> {fits}), y -> named_struct('a', x.node, 'b', y.node))))")).alias("pair"))
    return _within_bound(pairs.select("pair.a", "pair.b").unionAll(large).distinct(), points, percent)


def _search_large(open_members: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The same for large blocks by R-tree; a very large one is cut into parts, every two parts one task.

    Near copies share many blocks. A node names the first of its blocks by id; where both nodes of a
    pair name one before the present block, the pair is left to that one. The first block that two
    nodes share never leaves a pair to another, so each is listed at least once.
    """
    # as many blocks as the node has prefix shingles, at most
    named = open_members.groupBy(F.col("node").alias("b_node")).agg(F.slice(F.sort_array(F.collect_set("block")), 1, NAMED_BLOCKS).alias("named"))
    parts = F.floor((F.col("members") - 1) / SEARCH_NODES).cast("int")
    own = F.pmod(F.xxhash64("node"), parts + 1).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts))
    dealt = open_members.select("block", "node", "group", own.alias("own"), other.alias("other")).select(
        "block", "node", "group", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    rows = dealt.join(points.withColumnRenamed("node", "p_node"), F.col("node") == F.col("p_node")).join(
        named, F.col("node") == F.col("b_node")).select("block", "x", "y", "own", "node", "group", "n", "point", "named")

    def search(g: pd.DataFrame) -> pd.DataFrame:
        node, group, n, part = (g[c].to_numpy() for c in ("node", "group", "n", "own"))
        block, across = g["block"].iloc[0], g["x"].iloc[0] != g["y"].iloc[0]
        out = []
        if (group != group[0]).any():
            point = _points(g["point"].tolist(), GROUPS)
            before = np.full((len(g), NAMED_BLOCKS), block)
            for row, own in zip(before, g["named"]):
                row[: len(own)] = own
            # pairs inside the largest group need no search, all others have a node outside it
            names, place, sizes = np.unique(group, return_inverse=True, return_counts=True)
            tree = CountTree(point, n)
            for k in np.flatnonzero(place != sizes.argmax()):
                hit = tree.search(point[k], n[k], percent)
                hit = hit[group[hit] != group[k]]
                if across:  # pairs of one part belong to that part's own task
                    hit = hit[part[hit] != part[k]]
                hit = hit[~np.isin(before[hit], before[k][before[k] < block]).any(axis=1)]
                out += [(min(node[k], x), max(node[k], x)) for x in node[hit].tolist()]
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"], dtype="int64")

    return rows.groupBy("block", "x", "y").applyInPandas(search, "a long, b long")


def _verified(documents: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that do link, by their shingles. Only documents of candidate nodes send theirs."""
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "join-wanted")
    wanted_bits = documents.sparkSession.sparkContext.broadcast(low_bits(wanted, "node"))

    def send(batches):
        for batch in batches:
            seen, found, size = set(), {}, 0
            for row, own in _sets(batch, 1):
                if own.size:
                    node = node_id(own)
                    if node not in seen and may_hold(wanted_bits.value, node):
                        seen.add(node)
                        found[node] = own.tobytes()
                        size += own.nbytes
                if found and (size > 1 << 22 or row == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "shingles"])
                    found, size = {}, 0

    sent = documents.mapInArrow(lean(send), "node long, shingles binary").join(wanted.withColumnRenamed("node", "w_node"), F.col("node") == F.col("w_node"), "left_semi")
    # one shuffle by node serves both joins: only the pairs move to it, the second time with one set each
    sets = sent.groupBy("node").agg(F.first("shingles").alias("shingles"))
    p, q = (sets.select(F.col("node").alias(f"{x}_node"), F.col("shingles").alias(f"{x}_set")) for x in "pq")
    both = pairs.join(q, F.col("b") == F.col("q_node")).join(p, F.col("a") == F.col("p_node")).select("a", "b", "p_set", "q_set")

    def link(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = np.intersect1d(x, y, assume_unique=True).size
                good.append(100 * shared >= percent * (x.size + y.size - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(lean(link), "a long, b long")


def linked_groups(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Groups of documents that link directly or through others: (doc_id, n_shingles, component_id).

    Texts are whole. component_id is the smallest doc_id of the group. Null and empty texts have no
    shingles and stand alone, as does a text that links with nothing; documents of equal sets are
    linked. Null ids are kept and do not count for the smallest id unless a group has no other; repeated
    rows are returned as often as they occur.
    """
    return _linked(documents_of(documents), percent).drop("row_key", "stands")


def _linked(docs: DataFrame, percent: int) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(np.clip(round(np.log2(size / 200 + 1)), *SKETCH_BITS))
    read = staged(_nodes(docs, bits), "join-nodes")
    rows = read.where("piece IS NULL").select("doc_id", "row_key", "n", "node")
    points = staged(
        read.where("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("point").alias("point")), "join-points")
    levels = _levels(read.where("piece IS NOT NULL").select("piece", "counts"), bits)
    keys = (rows.agg(F.sum("n")).first()[0] or 0) * (100 - percent) // 100
    blocks = staged(_blocks(docs, levels, keys, percent), "join-blocks")

    # first every member of a block against its leaders
    star = blocks.select(F.explode("leaders").alias("lead"), "members").select("lead", F.explode("members").alias("node")).where(
        "lead <> node").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    star = staged(_within_bound(star, points, percent), "join-star")
    links = staged(_verified(docs, star, percent), "join-links")
    groups = staged(components(links), "join-groups")

    # then what is still apart
    rest = staged(_pairs_between_groups(blocks, groups, points, percent), "join-rest")
    more = _verified(docs, rest, percent)
    return _smallest(rows, merged(groups, more))


def _smallest(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Smallest document id per group, for every row."""
    linked = rows.where("node IS NOT NULL").join(groups.withColumnRenamed("node", "g_node"), F.col("node") == F.col("g_node"), "left").select(
        "doc_id", "row_key", "n", F.coalesce("component", "node").alias("group"))
    # the smallest id, and of null or equal ids the first key, names the document that stands for its group
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    least = linked.groupBy(F.col("group").alias("l_group")).agg(F.min(order).alias("least"))
    grouped = linked.join(least, F.col("group") == F.col("l_group")).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"), "row_key",
        (F.col("row_key") == F.col("least.row_key")).alias("stands"))
    alone = rows.where("node IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "row_key", F.lit(True).alias("stands"))
    return grouped.unionAll(alone)


def one_per_group(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Documents, all columns whatever their names, with one of each group: that of the smallest id, null ids last.

    Repeated rows of one id and text are one document.
    """
    kept = _linked(documents_of(documents), percent).where("stands").select(F.col("row_key").alias("kept")).distinct()
    rows = documents.select(F.struct("*").alias("whole"), row_key().alias("key"))
    return rows.join(kept, F.col("key") == F.col("kept"), "left_semi").dropDuplicates(["key"]).select("whole.*")
