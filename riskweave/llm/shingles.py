"""Word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WIDTH = 5

_SEED = np.random.default_rng(20)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: One random value per byte, A-Z as a-z; white space is 0.
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64)
_CASED = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[SPACE] = _CASED[SPACE] = 0
_PLACE = _SEED.integers(1, 2**63, WIDTH, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_ODD), -1, 2**64))
    both = []
    for base in (_ODD, inverse):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers, dtype=np.uint64))
    return both[0], both[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Words of many texts: runs of bytes outside ``space``, A-Z lower-cased if ``fold``.

    ``starts`` and ``ends`` are positions in the joined texts; the words of text i are those from
    ``at[i]`` to ``at[i + 1]``.
    """

    def __init__(self, texts: list[bytes], space: np.ndarray = SPACE, fold: bool = True):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        up, self._down = powers(1 << max(21, int(data.size).bit_length()))
        word = np.zeros(data.size + 1, np.int8)
        word[1:] = ~space[data]
        edges = np.flatnonzero(np.diff(word))
        self.data, self.starts, self.ends = data, edges[::2], edges[1::2]
        self._total = np.zeros(data.size + 1, np.uint64)
        np.cumsum((_BYTE if fold else _CASED)[data] * up[: data.size], out=self._total[1:])
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.at = np.searchsorted(self.starts, begins)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """Hash of every word, or of its first ``prefix`` bytes."""
        ends = self.ends if prefix is None else np.minimum(self.ends, self.starts + prefix)
        return mix((self._total[ends] - self._total[self.starts]) * self._down[self.starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one entry more than texts)."""
    words = Words(texts)
    return words.hashes(), words.at


def combined(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (1 to 5)."""
    n = max(0, words.size - width + 1)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += words[k : k + n] * _PLACE[k]
    return mix(total)


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words than ``width`` has its whole sequence as one shingle, one without words none.
    """
    words, at = word_hashes(texts)
    runs = combined(words, width)
    none = np.empty(0, np.uint64)
    out = []
    for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
        if last - first >= width:
            out.append(np.unique(runs[first : last - width + 1]))
        elif last > first:
            out.append(combined(words[first:last], last - first))
        else:
            out.append(none)
    return out
