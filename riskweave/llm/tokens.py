"""Token counts under a byte-level BPE vocabulary, mostly without merging.

Before the job every vocabulary string is encoded alone once; those that come out as one token form a
table that is proven, not assumed. A text is cut into pre-tokens; a pre-token of the table counts one,
and only the rest is merged, each distinct one once per worker while the cache holds it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Merged pre-tokens a worker remembers, and the longest it remembers.
CACHE, CACHED_CHARS = 300_000, 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself, or the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in shown else next(other)) for b in range(256)]


def _charset(points: Iterable[int]) -> str:
    """Code points as ranges of a character class."""
    ranges: list[list[int]] = []
    for p in points:
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def pretoken_pattern(tokenizer: Tokenizer) -> str:
    """The pre-token pattern with letters, numbers and white space as the library itself knows them.

    Unicode versions differ between libraries, so each candidate is shown to the tokenizer between
    characters of known kind and the cuts around it tell its class.
    """
    kinds: dict[str, list[int]] = {"letter": [], "number": [], "space": []}
    candidate = regex.compile(r"[\p{L}\p{N}\p{White_Space}]")
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and candidate.match(chr(c))]
    for at in range(0, len(points), 4096):
        part = points[at : at + 4096]
        shown = "".join(f"!{chr(c)}1{chr(c)}a\n" for c in part)
        starts = {span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(shown)}
        for k, c in enumerate(part):
            cut_before, cut_after, joins_a = 6 * k + 1 in starts, 6 * k + 2 in starts, 6 * k + 4 not in starts
            if chr(c) == " " or cut_before and cut_after and not joins_a:
                kinds["space"].append(c)
            elif cut_before and cut_after:
                kinds["letter"].append(c)
            elif cut_before:
                kinds["number"].append(c)
    letter, number, space = (_charset(kinds[k]) for k in ("letter", "number", "space"))
    return (
        f" ?[{letter}]+| ?[{number}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


class Vocabulary:
    """What tasks need of a tokenizer file: its text, pre-token pattern, specials and proven strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        tokenizer = Tokenizer.from_str(self.spec)
        self.pattern = pretoken_pattern(tokenizer)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        back = {c: b for b, c in enumerate(byte_letters())}
        alone = tokenizer.model.tokenize
        self.single: dict[str, int] = {}
        for word in tokenizer.get_vocab(with_added_tokens=False):
            if all(c in back for c in word) and len(alone(word)) == 1:
                try:
                    self.single[bytes(back[c] for c in word).decode("utf-8")] = 1
                except UnicodeDecodeError:
                    pass  # part of a character: no pre-token is equal to it


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Counts(dict):
    """Tokens per pre-token: the proven table, and what was merged since."""

    def __init__(self, v: Vocabulary, cache: int = CACHE):
        super().__init__(v.single)
        self.single, self.most = v.single, len(v.single) + cache
        self.letters, self.merge = byte_letters(), Tokenizer.from_str(v.spec).model.tokenize

    def __missing__(self, token: str) -> int:
        n = len(self.merge("".join([self.letters[b] for b in token.encode("utf-8")])))
        if len(token) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.single)
            self[token] = n
        return n


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, v: Vocabulary, cache: int = CACHE):
        self.look, self.find = Counts(v, cache).__getitem__, re.compile(v.pattern).findall
        self.special = v.special
        self.split = re.compile("|".join(map(re.escape, sorted(v.special, key=len, reverse=True)))).split

    def __call__(self, text: str) -> int:
        if any(s in text for s in self.special):
            pieces = self.split(text)
            return len(pieces) - 1 + sum(sum(map(self.look, self.find(p))) for p in pieces)
        return sum(map(self.look, self.find(text)))


def count_tokens(documents: DataFrame, path: str, limit: int = 512, cache: int = CACHE) -> DataFrame:
    """Tokens of every text: (doc_id, n_bytes, n_tokens, over_limit).

    Texts are whole; null counts as empty and has no tokens. A special string of the vocabulary inside
    a text is one token, as the tokenizer library reads it. Null ids are kept, repeated rows counted
    each. The file is read by the driver and sent to the tasks; its size does not depend on the data.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def count(batches):
        tokens_of = Counter(shared.value, cache)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [tokens_of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
