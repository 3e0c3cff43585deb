"""Prefix trie of conversations: which openings they share, and what sharing them saves.

Turns are named by digests, a conversation is the string of its turns' names, and equal conversations
are merged before anything else. The strings are range partitioned; each range is a shard that
dictionary-encodes its turns and inserts its strings, the median first, into a ternary search tree, so
that the trees stay balanced. Nodes are created after their parents, so one pass from the last node to
the first adds up members, leaves and savings without recursion. Only nodes on the paths of a shard's
first and last string can occur in another shard; they are merged afterwards (``_merged``).

No group grows with the table: positions within conversations come from a range partition, a
conversation's turns are taken in blocks of ``BLOCK``, copies are one string, a shard holds some
``SHARD_TURNS`` turns. Blocks below the first hang under the node where the first ends; they are
worked from the deepest up, each giving its totals to the one above.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import WORD
from riskweave.operators.positions import with_positions
from riskweave.session import staged

#: Turns of a conversation that stand in one string.
BLOCK = 1 << 16

#: Turns of the strings of one shard.
SHARD_TURNS = 200_000

#: Conversation ids joined into one piece before digests of id lists are taken.
IDS_AT_ONCE = 4096

#: Opening turns come from the conversation at the start of the group of this many ids.
GROUP = 20

#: Characters of a turn's name (an MD5 in hexadecimal digits).
_NAME = 32

NODE = ("key string, parent string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, words long, edge boolean, seq string, "
        "shard int, first_keys array<string>, first_words array<long>, last_keys array<string>")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, name, words): the named turns in order, from 1. Rows without conv_id take no part.

    Order is by turn, null first; turns of equal number go by their digest. Null role and text are empty.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    placed = with_positions(named, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("name"))
    firsts = placed.groupBy("conv_id").agg(F.min("position").alias("begin"))
    return placed.join(firsts, "conv_id").select("conv_id", (F.col("position") - F.col("begin") + 1).alias("i"), "name", "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, name, words) and conversations (conv_id, length), opened by another's turns.

    Conversation c gets the first h turns of conversation c - c % GROUP (all if fewer, none if absent) and then
    its own turns after its first h; h is the unsigned crc32 of its decimal id, modulo 4.
    """
    turns = staged(turns_of(conversations), "turns")
    own = turns.groupBy("conv_id").agg(F.max("i").alias("n")).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4)
    openers = own.select(F.col("conv_id").alias("opener"), F.col("n").alias("opener_n"))
    convs = (own.withColumn("opener", F.col("conv_id") - F.col("conv_id") % GROUP).join(openers, "opener", "left")
             .withColumn("opening", F.least("h", F.coalesce("opener_n", F.lit(0))))
             .withColumn("length", F.col("opening") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    convs = staged(convs.select("conv_id", "h", "opener", "opening", "length"), "rebuilt-lengths")
    rest = turns.join(convs.select("conv_id", "h", "opening"), "conv_id").where("i > h")
    first = turns.where(f"conv_id % {GROUP} = 0 AND i < 4").withColumnRenamed("conv_id", "opener")
    opening = first.join(convs.select("conv_id", "opener", "opening"), "opener").where("i <= opening")
    columns = ["conv_id", "depth", "name", "words"]
    both = rest.withColumn("depth", F.col("i") - F.col("h") + F.col("opening")).select(columns).unionAll(
        opening.withColumn("depth", F.col("i")).select(columns))
    return both, convs.select("conv_id", "length")


def strings(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Conversations as strings of names, a row per block of turns.

    (conv_id, block, root, path, words, after, last): ``root`` and ``after`` name the node before and after the
    block, ``last`` marks the block that ends the conversation. A conversation without turns has one empty block.
    """
    at = F.struct("depth", "name", "words")
    rows = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / block).alias("block")).agg(F.array_sort(F.collect_list(at)).alias("t"))
    rows = rows.select("conv_id", "block", F.array_join("t.name", "").alias("path"), F.col("t.words").alias("words"))
    none = convs.where("length = 0").select("conv_id", F.lit(0).cast("long"), F.lit(""), F.array().cast("array<bigint>"))
    rows = rows.unionAll(none)
    order = Window.partitionBy("conv_id").orderBy("block")
    rows = rows.withColumn("after", F.md5(F.array_join(F.collect_list(F.md5("path")).over(order), "")))
    return (rows.withColumn("root", F.coalesce(F.lag("after").over(order), F.lit("")))
            .withColumn("last", F.lead("block").over(order).isNull()))


def end_digests(ends: DataFrame) -> DataFrame:
    """(seq, ends_sha256): SHA-256 of the ids of each seq, ascending and joined by commas.

    Ids are first joined in pieces of a range of ``IDS_AT_ONCE``; a task then feeds the pieces of a seq to the
    digest one after another and holds one at a time, however many ids a seq has.
    """
    pieces = ends.groupBy("seq", F.floor(F.col("conv_id") / IDS_AT_ONCE).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def digests(batches):
        seq = digest = None
        for batch in batches:
            done = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != seq:
                    if seq is not None:
                        done.append((seq, digest.hexdigest()))
                    seq, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["seq", "ends_sha256"])
        if seq is not None:
            yield pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([digest.hexdigest()])], ["seq", "ends_sha256"])

    dealt = pieces.repartition("seq").sortWithinPartitions("seq", "piece").select("seq", "ids")
    return dealt.mapInArrow(digests, "seq string, ends_sha256 string")


class Trie:
    """Ternary search tree over strings of integers; node 0 stands above all first symbols."""

    def __init__(self):
        self.symbol, self.low, self.high, self.down, self.up = [-1], [-1], [-1], [-1], [-1]

    def _node(self, symbol: int, above: int) -> int:
        for values, value in ((self.symbol, symbol), (self.low, -1), (self.high, -1), (self.down, -1), (self.up, above)):
            values.append(value)
        return len(self.symbol) - 1

    def insert(self, string: list[int]) -> list[int]:
        """The nodes of the string, its last symbol's node last."""
        above, path = 0, []
        for s in string:
            at = self.down[above]
            if at < 0:
                at = self.down[above] = self._node(s, above)
            while self.symbol[at] != s:
                side = self.low if s < self.symbol[at] else self.high
                if side[at] < 0:
                    side[at] = self._node(s, above)
                at = side[at]
            path.append(at)
            above = at
        return path


def medians(n: int):
    """0 to n - 1, the median of every range before its halves."""
    waiting = [(0, n)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(middle + 1, high), (low, middle)]


def shard_nodes(rows: list[dict], block: int, depth: int, shard: int) -> list[tuple]:
    """Nodes of the sorted strings of one shard, and a row on its edges."""
    split = [[r["path"][i : i + _NAME] for i in range(0, len(r["path"]), _NAME)] for r in rows]
    roots = sorted({r["root"] for r in rows})
    names = np.unique(np.array([x for s in split for x in s], f"U{_NAME}")).tolist()
    codes = {x: k for k, x in enumerate(names)}
    root_codes = {x: k for k, x in enumerate(roots)}
    trie, paths = Trie(), {}
    for k in medians(len(rows)):
        path = trie.insert([root_codes[rows[k]["root"]], *(codes[x] for x in split[k])])
        paths[k] = path[-1], (path if k in (0, len(rows) - 1) else None)
    n = len(trie.symbol)
    members, children, leaves, saved, words = ([0] * n for _ in range(5))
    key, level, least, seq = [""] * n, [-1] * n, [None] * n, [None] * n
    for k, r in enumerate(rows):
        end = paths[k][0]
        members[end], least[end] = r["n"], r["conv_id"]
        children[end], leaves[end], saved[end] = r["tail_children"], r["tail_leaves"], r["tail_saved"]
        if r["n_ends"]:
            seq[end] = r["seq"]
        at = end
        for w in reversed(r["words"]):
            if words[at]:
                break
            words[at] = w
            at = trie.up[at]
    for t in range(1, n):
        up = trie.up[t]
        level[t] = level[up] + 1
        key[t] = roots[trie.symbol[t]] if level[t] == 0 else hashlib.md5((key[up] + names[trie.symbol[t]]).encode()).hexdigest()
    for k, r in enumerate(rows):
        if len(split[k]) == block:
            key[paths[k][0]] = r["after"]
    for t in range(n - 1, 0, -1):
        up = trie.up[t]
        saved[t] += (members[t] - 1) * words[t]
        leaves[t] += children[t] == 0
        if up:
            members[up] += members[t]
            least[up] = least[t] if least[up] is None else min(least[up], least[t])
            children[up] += 1
            leaves[up] += leaves[t]
            saved[up] += saved[t]
    first, last = paths[0][1], paths[len(rows) - 1][1]
    edge = {*first, *last}
    out = []
    for t in range(1, n):
        up = trie.up[t]
        inside = up and up not in edge and level[up]
        out.append((key[t], key[up] if up else None, depth + level[t], least[t], least[up] if inside else None, members[t], children[t],
                    leaves[t], saved[t], words[t], t in edge or level[t] in (0, block), seq[t], None, None, None, None))
    out.append((None,) * 12 + (shard, [key[t] for t in first], [words[t] for t in first], [key[t] for t in last]))
    return out


def _shards(strings: DataFrame, shards: int, block: int, depth: int) -> DataFrame:
    schema = pa.schema([(name, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
                                "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}[kind])
                        for name, kind in (f.split() for f in NODE.split(", "))])

    def build(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            nodes = shard_nodes(rows, block, depth, TaskContext.get().partitionId())
            for k in range(0, len(nodes), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*nodes[k : k + 20_000]), schema)], schema=schema)

    ordered = strings.repartitionByRange(shards, "root", "path").sortWithinPartitions("root", "path")
    return ordered.mapInArrow(build, NODE)


def _merged(found: DataFrame) -> DataFrame:
    """Nodes on the edges of shards as one row each; ``found`` has the rows of all shards.

    Each shard counts a node it holds as if it were the first to hold it. A node that the previous shard's
    last string also passes is then counted again: as a child, with its words as spent, and, where
    that string ends at it, as a leaf. These are taken back along the shared nodes, all others add up.
    """
    edges = found.where("shard IS NOT NULL").select("shard", "first_keys", "first_words", "last_keys")
    previous = edges.withColumn("previous", F.lag("last_keys").over(Window.orderBy("shard"))).where("previous IS NOT NULL")
    shared = previous.withColumn("shared", F.array_intersect("first_keys", "previous")).where("size(shared) > 0")
    n = F.size("shared")
    back = shared.select(
        F.posexplode("shared").alias("j", "key"), n.alias("n"), "first_words",
        (F.size("previous") == n).cast("long").alias("ended"))
    back = back.select(
        "key", F.when(F.col("j") + 1 < F.col("n"), -1).otherwise(0).cast("long").alias("n_children"),
        (-F.col("ended")).alias("n_leaves"),
        F.aggregate(F.slice("first_words", F.col("j") + 1, F.col("n") - F.col("j")), F.lit(0).cast("long"), lambda a, x: a + x).alias("saved_tokens"))
    nodes = found.where("edge").select("key", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "seq")
    return nodes.unionByName(back, allowMissingColumns=True).groupBy("key").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.max("parent_conv_id").alias("parent_conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("seq").alias("seq"))


def prefix_trie(conversations: DataFrame, block: int = BLOCK, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct sequence of first turns (role, text) of the rebuilt conversations (``rebuilt``).

    conv_id (least member), depth, parent_conv_id (the parent's conv_id, null at the root), n_convs (members),
    n_children, n_leaves (nodes without children below or at it), saved_tokens (over the nodes below and at it,
    members but one times the words of the last text), ends_sha256 (of the members that end there).

    Null role or text counts as empty, a null turn comes first, turns of one number go by their digest,
    repeated rows are turns of their own. Rows without conv_id take no part; without any other row the
    result is empty, else it has a root, of which conversations without turns are members. Negative ids
    keep Spark's sign of the remainder. Other columns are ignored.
    """
    turns, convs = rebuilt(conversations)
    rows = strings(turns, convs, block).withColumn("seq", F.md5(F.concat("root", F.lit("/"), "path")))
    rows = staged(rows, "strings")
    distinct = staged(
        rows.groupBy("block", "root", "path", "after", "seq").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.sum(F.col("last").cast("long")).alias("n_ends"),
            F.first("words").alias("words")), "distinct-strings")
    blocks = {r["block"]: r["turns"] for r in distinct.groupBy("block").agg(F.sum(F.size("words") + 1).alias("turns")).collect()}
    tails, parts = None, []
    for b in sorted(blocks, reverse=True):
        own = distinct.where(F.col("block") == b)
        if tails is None:
            own = own.withColumns({c: F.lit(0).cast("long") for c in ("tail_children", "tail_leaves", "tail_saved")})
        else:
            own = own.join(tails, "after", "left").fillna(0, ["tail_children", "tail_leaves", "tail_saved"])
        found = staged(_shards(own, max(1, -(-blocks[b] // shard_turns)), block, b * block), "trie")
        merged = staged(_merged(found), "trie-edges")
        tails = merged.where(F.col("depth") == b * block).select(
            F.col("key").alias("after"), F.col("n_children").alias("tail_children"), F.col("n_leaves").alias("tail_leaves"),
            F.col("saved_tokens").alias("tail_saved"))
        if b:
            merged = merged.where(F.col("depth") > b * block)
        parts.append((found.where("NOT edge").select(merged.columns), merged))
    if not parts:
        return conversations.sparkSession.createDataFrame([], RESULT)
    nodes, heads = parts[0]
    for inner, merged in parts[1:]:
        nodes, heads = nodes.unionAll(inner), heads.unionAll(merged)
    nodes = nodes.unionAll(heads)
    above = heads.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv_id"))
    # rows that look for nothing get keys of their own, which meet nothing and spread evenly
    nodes = nodes.withColumn("wanted", F.when(F.col("parent_conv_id").isNull(), F.col("parent")).otherwise(F.concat(F.lit("/"), "key")))
    digests = end_digests(rows.where("last").select("seq", "conv_id"))
    out = (nodes.withColumn("seq", F.coalesce("seq", F.concat(F.lit("/"), "key"))).join(above, F.col("wanted") == F.col("above"), "left")
           .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv_id")).join(digests, "seq", "left"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string")
