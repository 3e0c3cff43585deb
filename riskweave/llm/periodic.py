"""Periodic runs of words: stretches that repeat a group of words three times or more.

A run of period q and at least three periods holds three neighbouring points of the grid 0, q, 2q, ...
whose words are equal. The grids of all periods have about n log n points for n words, and comparing
neighbours on them leaves few candidates; the grammar of the words (``recompression``) tells how far each
candidate extends to both sides. Texts are handled in ranges of bounded size, with a name of its own
after every text, so that no run crosses texts. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import text_chunks
from riskweave.llm.recompression import Grammar
from riskweave.llm.shingles import Words, mix

#: A run has at least so many words and periods.
MIN_WORDS, MIN_PERIODS = 24, 3

#: Candidates whose extensions are sought at once.
AT_ONCE = 1 << 20

RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")


def candidates(names: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid points (place, period) equal to the next two points of their grid.

    The sequences of ``lengths`` names end before ``ends`` and stand from the longest to the shortest;
    a period is sought where a sequence is long enough for it.
    """
    places, periods = [], []
    longest = int(lengths[0]) if lengths.size else 0
    need = np.maximum(MIN_WORDS, MIN_PERIODS * np.arange(1, longest // MIN_PERIODS + 1))
    enough = np.searchsorted(-lengths, -need, side="right")  # sequences of at least that length
    for q, n in enumerate(enough.tolist(), start=1):
        if n == 0:
            break
        grid = names[: ends[n - 1] : q]
        same = grid[1:] == grid[:-1]
        found = np.flatnonzero(same[1:] & same[:-1])
        if found.size:
            places.append(found * q)
            periods.append(np.full(found.size, q))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs(sequences: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each sequence of names, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in sequences]
    order = sorted((k for k, s in enumerate(sequences) if s.size >= MIN_WORDS), key=lambda k: -sequences[k].size)
    if not order:
        return out
    words, own = np.unique(np.concatenate([sequences[k] for k in order]), return_inverse=True)
    lengths = np.array([sequences[k].size for k in order])
    ends = np.cumsum(lengths + 1) - 1
    names = np.empty(int(ends[-1]) + 1, np.uint64)
    names[ends] = words.size + np.arange(len(order))
    inside = np.ones(names.size, bool)
    inside[ends] = False
    names[inside] = own
    place, period = candidates(names, ends, lengths)
    if not place.size:
        return out
    # only sequences with a candidate, three points within it, go into the grammars
    text = np.searchsorted(ends, place)
    within = place + 2 * period < ends[text]
    place, period, text = place[within], period[within], text[within]
    if not place.size:
        return out
    wanted = np.unique(text)
    kept = np.concatenate([np.arange(ends[t] - lengths[t], ends[t] + 1) for t in wanted.tolist()])
    moved = np.cumsum(lengths[wanted] + 1) - lengths[wanted] - 1
    place = place - (ends - lengths)[text] + moved[np.searchsorted(wanted, text)]
    held = names[kept]
    hashed = mix(held + np.uint64(1))
    forward = Grammar(hashed)
    backward = Grammar(np.append(hashed[::-1][1:], hashed[-1]))  # the last, unlike any other, ends both
    found = set()
    last = held.size - 2
    for k in range(0, place.size, AT_ONCE):
        p, q = place[k : k + AT_ONCE], period[k : k + AT_ONCE]
        after = forward.extensions(p, p + q)
        before = backward.extensions(last - (p + q), last - p) - 1  # both grid points themselves are equal
        length = q + after + before
        good = length >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
        found.update(zip((p - before)[good].tolist(), length[good].tolist(), q[good].tolist()))
    least: dict[tuple[int, int], int] = {}
    for start, length, q in found:  # a multiple of a period extends just as far
        least[start, length] = min(q, least.get((start, length), q))
    stops = moved + lengths[wanted]
    for (start, length), q in sorted(least.items(), key=lambda x: (x[0][0], x[1])):
        t = int(np.searchsorted(stops, start))
        _verify(held, start, length, q)
        out[order[int(wanted[t])]].append((start - int(moved[t]), length, q))
    return out


def _verify(names: np.ndarray, start: int, length: int, q: int) -> None:
    end = start + length
    whole = np.array_equal(names[start : end - q], names[start + q : end])
    if not whole or names[end] == names[end - q] or start and names[start - 1] == names[start - 1 + q]:
        raise ArithmeticError("two names of a grammar collided")


def best(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties go to the smallest start, then period."""
    top = None
    for run in found:  # in order of start and period
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    return top


def dropped(found: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Marks of the words that a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, q in found:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def periodic_tail(n: int, h: int) -> np.ndarray:
    """Places of the words of a text of n words, whose tail repeats if the hash h of its id is a multiple of ten."""
    at, g = np.arange(n), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def find_runs(documents: DataFrame, tails: bool = False) -> DataFrame:
    """Per document its runs, the run of greatest exponent, and what is left when repeats collapse.

    Words are runs without ASCII white space, case counts. A run is a stretch of smallest period q and
    at least max(24, 3 q) words that cannot be longer on either side; all runs are found, overlapping ones
    and runs inside runs too. A word that some run holds after its first q words is dropped from the
    collapsed text (kept words joined by one space). ``tails`` first makes the texts whose crc32 of the decimal
    doc_id is a multiple of ten periodic from some word on (``periodic_tail``); a null id leaves its text as it is.

    One row per row of the input, repeated rows included; a null or empty text has no words and no run.
    A text is held by one task with some 100 bytes a word. Ties: see ``best``. Other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")).alias("h"))
    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in RESULT.split(", ")])

    def search(batches):
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2)
            rows = []
            for first, texts in text_chunks(batch.column(1)):
                words = Words(texts, fold=False)
                all_names = words.hashes()
                places, sequences = [], []
                for k in range(len(texts)):
                    low, high = int(words.at[k]), int(words.at[k + 1])
                    h = hashes[first + k].as_py() if tails else None
                    places.append(np.arange(high - low) if h is None else periodic_tail(high - low, h))
                    sequences.append(all_names[low + places[-1]])
                for k, found in enumerate(runs(sequences)):
                    gone = dropped(found, sequences[k].size)
                    own = texts[k].split()
                    kept = b" ".join([own[w] for w in places[k][~gone].tolist()])
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                    s, n, q = best(found) or (None, None, None)
                    rows.append((ids[first + k].as_py(), len(found), s, n, q, None if q is None else 1000 * n // q,
                                 hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                                 sequences[k].size, int(gone.sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(search, RESULT)
