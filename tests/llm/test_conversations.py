"""The prefix trie of conversations against SQL and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from riskweave.llm import conversations, queries, sql

CONV = "conv_id long, turn long, role string, text string, depth int, key string, n_convs long"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5((f"{len(role.encode())}:{role}{text}").encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode().split()) if node else 0
    return Counter(
        (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node)).encode()).hexdigest())
        for node, convs in members.items())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [None, "", "hello there", "hello  there", "a b c d", "é ü", "x " * 3000, "one\ttwo\nthree"]
    out = []
    for c in [*range(0, 130), 200, 213, 10**12, 10**12 + 5]:
        if c % 17 == 3 or c == 40:
            continue
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            out.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", None]) if t > 3 else "user", rng.choice(texts[: 2 + t])))
    out += [(7, 2, "user", "tie"), (7, 2, "user", "other tie"), (7, 2, "user", "tie"), (None, 0, "user", "nobody")]
    out += [(c, t, "user", "same") for c in range(300, 360) for t in range(12)]  # a group of copies
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", 5) for r in rows], CONV).repartition(3)


@pytest.mark.parametrize("block, shard_turns", [(1 << 16, 200_000), (1 << 16, 40), (3, 60)])
def test_trie_equals_brute_force(table, rows, block, shard_turns):
    got = conversations.prefix_trie(table, block, shard_turns)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_trie_equals_sql(table, spark, sf):
    con = duckdb.connect()
    frame = table.select("conv_id", "turn", "role", "text").toPandas()
    con.register("raw", frame)
    con.execute("CREATE VIEW conversations AS SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM raw")
    order = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert Counter(con.sql(f"SELECT {order} FROM ({sql.OP12})").fetchall()) == Counter(
        map(tuple, conversations.prefix_trie(table).collect()))
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = queries.op12_conversation_trie(spark, sf)
    assert ", ".join(got.columns) == order
    assert Counter(con.sql(f"SELECT {order} FROM ({sql.OP12})").fetchall()) == Counter(map(tuple, got.collect()))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], CONV)
    assert conversations.prefix_trie(empty).collect() == []
    nobody = spark.createDataFrame([(None, 1, "user", "x", 1, "", 0)], CONV)
    assert conversations.prefix_trie(nobody).collect() == []


def test_conversations_without_turns(spark):
    """Turns skipped, and no opening conversation to take others from: only the root is left."""
    rows = [(c, 0, "user", "x", 1, "", 0) for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    got = conversations.prefix_trie(spark.createDataFrame(rows, CONV)).collect()
    ids = ",".join(str(r[0]) for r in rows)
    assert [tuple(r) for r in got] == [(rows[0][0], 0, None, len(rows), 0, 1, 0, hashlib.sha256(ids.encode()).hexdigest())]


def test_median_first():
    assert sorted(conversations.medians(10)) == list(range(10)) and next(conversations.medians(9)) == 4
    trie = conversations.Trie()
    for k in conversations.medians(1023):
        trie.insert([k])
    height = lambda t: 0 if t < 0 else 1 + max(height(trie.low[t]), height(trie.high[t]))
    assert height(trie.down[0]) == 10
