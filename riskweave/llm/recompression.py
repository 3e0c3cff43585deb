"""Run-length grammars by recompression, and longest common extensions answered on them.

A sequence of names is shortened in rounds. Block compression gives every maximal repetition of one
name a new name; pair compression deals the names to a left and a right side and gives every left name
followed by a right one a new name. Both decide by the names alone, so equal stretches are parsed alike
but for their edges, and a query climbs while its two places agree and comes down where they differ:
a few array operations per level for all queries at once, whatever the length of the extension.

New names are 64-bit hashes of what they stand for. Two different things of one name would make an
extension too long, never too short; users verify what they report.
"""

from __future__ import annotations

import numpy as np

from riskweave.llm.shingles import mix

#: Sequences up to this length are compared name by name.
SHORT = 64

_BLOCK, _PAIR, _SIDE = (np.uint64(x) for x in np.random.default_rng(31).integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1))


class _Level:
    """Names of one level, the block of the level above that each belongs to, and each block's first name.

    ``left`` is None where maximal repetitions are the blocks (``ends``: where the repetition around each
    place ends); otherwise it tells the names of the left side.
    """

    def __init__(self, names: np.ndarray, first: np.ndarray, left: np.ndarray | None = None):
        self.names, self.first, self.left = names, first, left
        begins = np.zeros(names.size, np.int64)
        begins[first] = 1
        self.up = np.cumsum(begins) - 1
        self.ends = None if left is not None else np.append(first[1:], names.size)[self.up]

    def steps(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far two places of equal names agree for certain: to the end of the shorter repetition, or by one."""
        return np.minimum(self.ends[i] - i, self.ends[j] - j) if self.left is None else np.ones(i.size, np.int64)


class Grammar:
    """Grammar of a sequence whose last name occurs nowhere else."""

    def __init__(self, names: np.ndarray):
        self.levels: list[_Level] = []
        names, turn = names.astype(np.uint64), 0
        while names.size > SHORT:
            turn += 1
            first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            if first.size < names.size:
                self.levels.append(_Level(names, first))
                lengths = np.diff(first, append=names.size).astype(np.uint64)
                names = np.where(lengths == 1, names[first], mix(mix(names[first] ^ _BLOCK) + lengths))
            left = (mix(names ^ mix(_SIDE + np.full(1, turn, np.uint64))) & np.uint64(1)).astype(bool)
            starts = np.flatnonzero(left[:-1] & ~left[1:])
            if starts.size:
                first = np.delete(np.arange(names.size), starts + 1)
                self.levels.append(_Level(names, first, left))
                joined = names.copy()
                joined[starts] = mix(mix(names[starts] ^ _PAIR) * _PAIR + names[starts + 1])
                names = joined[first]
        self.top = names

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many names agree from the places i and j (i < j) on."""
        i, j = i.astype(np.int64), j.astype(np.int64)
        begin, stopped = i.copy(), np.full(i.size, len(self.levels))
        climbing = np.arange(i.size)
        for depth, level in enumerate(self.levels):
            a, b = i[climbing], j[climbing]
            same = level.names[a] == level.names[b]
            # past a repetition, or past a right name, both stand at the start of a block
            move = same if level.left is None else same & ~level.left[a]
            step = np.zeros(a.size, np.int64)
            step[move] = level.steps(a[move], b[move])
            if level.left is None:  # repetitions of unequal lengths differ where the shorter one ends
                same &= level.ends[a] - a == level.ends[b] - b
            a, b = a + step, b + step
            i[climbing], j[climbing] = a, b
            stopped[climbing[~same]] = depth
            climbing = climbing[same]
            i[climbing], j[climbing] = level.up[i[climbing]], level.up[j[climbing]]
        while climbing.size:
            climbing = climbing[self.top[i[climbing]] == self.top[j[climbing]]]
            i[climbing] += 1
            j[climbing] += 1
        for depth in range(len(self.levels) - 1, -1, -1):
            level, down = self.levels[depth], np.flatnonzero(stopped > depth)
            if down.size:
                a, b = level.first[i[down]], level.first[j[down]]
                same = level.names[a] == level.names[b]
                step = np.zeros(a.size, np.int64)
                step[same] = level.steps(a[same], b[same])
                i[down], j[down] = a + step, b + step
        return i - begin
