"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from riskweave.llm import periodic, queries, shingles
from riskweave.llm.recompression import Grammar

DOC = "doc_id long, text string, h string, n_words string"


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)  # periods ascend, so the smallest stays
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text, tails):
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if tails and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), *top, None if top[2] is None else 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t", "a", "a " * 23, "a " * 24, "a " * 25 + "A " * 30, "é x " * 40, "ab c " * 12, "a b c d e f g h i " * 3,
           "x " * 5000 + "y " + "x " * 200]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts += [rng.choice("abc") for _ in range(rng.randint(0, 30))]
            unit = [rng.choice("ab") if rng.random() < 0.7 else "w%d" % rng.randrange(9) for _ in range(rng.randint(1, 40))]
            whole = unit * rng.randint(1, 9)
            parts += whole[rng.randint(0, 3) : len(whole) - rng.randint(0, 3)]
        out.append(" ".join(parts))
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    out += [" ".join(fib[-1]), " ".join(fib[-1] * 3), " ".join("word%d" % rng.randrange(10**6) for _ in range(4000))]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if i == 40 else i, t, "clash", None) for i, t in enumerate(texts)] + [(15, texts[15], "clash", None)] * 2
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.mark.parametrize("tails", [False, True])
def test_runs_equal_brute_force(docs, tails):
    got = periodic.find_runs(docs, tails).drop("n_words", "n_dropped")
    assert Counter(map(tuple, got.collect())) == Counter(brute_row(r.doc_id, r.text, tails) for r in docs.collect())


def test_short_texts_of_few_words():
    """Grids cross the ends of texts; what they find there is no run."""
    rng = np.random.default_rng(2)
    for _ in range(30):
        sequences = [rng.integers(1, 3, rng.integers(20, 60)).astype(np.uint64) for _ in range(40)]
        want = [sorted(brute_runs(s.tolist()), key=lambda r: (r[0], r[2])) for s in sequences]
        assert periodic.runs(sequences) == want


def test_empty_table(spark):
    got = periodic.find_runs(spark.createDataFrame([], DOC))
    assert got.collect() == [] and got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                       "runs_sha256", "collapsed_sha256"]


def test_grammar_extensions():
    rng = np.random.default_rng(4)
    for size, letters in ((5000, 2), (5000, 3), (3000, 1), (70, 2)):
        x = rng.integers(0, letters, size)
        x[size // 2 :] = x[: size - size // 2]  # a long repeat
        x[100 : min(size, 400)] = np.resize([0, 0, 1], max(0, min(size, 400) - 100)) % letters
        x = np.append(x, 99)
        i, j = rng.integers(0, size, (2, 3000))
        i, j = np.minimum(i, j), np.maximum(i, j) + 1
        want = []
        for a, b in zip(i.tolist(), j.tolist()):
            k = 0
            while b + k <= size and x[a + k] == x[b + k]:
                k += 1
            want.append(k)
        assert Grammar(shingles.mix(x.astype(np.uint64) + np.uint64(5))).extensions(i, j).tolist() == want


def test_long_repeat_takes_few_levels():
    names = shingles.mix(np.append(np.resize(np.arange(1, 1001), 300_000), 10**6).astype(np.uint64))
    grammar = Grammar(names)
    assert grammar.extensions(np.array([0]), np.array([1000])).tolist() == [299_000]
    assert sum(level.names.size for level in grammar.levels) < 12 * names.size


def test_query_over_the_given_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_periodic_runs(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(brute_row(r.doc_id, r.text, True) for r in rows)
