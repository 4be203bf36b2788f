"""Hashes of words and word runs, computed over whole byte buffers with numpy."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes to doubles in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


KEPT = 1 << 19  # powers of a base that a task keeps
_POWERS: dict[int, np.ndarray] = {}


def _known_powers(base: np.uint64, n: int) -> np.ndarray:
    """``powers``, the same array again for shorter buffers."""
    if n > KEPT:
        return powers(base, n)
    if int(base) not in _POWERS:
        _POWERS[int(base)] = powers(base, KEPT)
    return _POWERS[int(base)][:n]


class Rolling:
    """Hash of any byte range of one buffer in constant time."""

    def __init__(self, data: np.ndarray):
        terms = (data.astype(np.uint64) + np.uint64(1)) * _known_powers(BASE, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.back = _known_powers(INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw ^ ((end - start).astype(np.uint64) << np.uint64(48)))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, owner) of each run of non-space bytes; owners are row numbers."""
    low, high = int(offsets[0]), int(offsets[-1])
    solid = ~SPACE[data[low:high]]
    if not len(solid):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(len(solid) + 1, dtype=bool)
    cut[offsets - low] = True
    starts = np.flatnonzero(solid & (np.concatenate([[True], ~solid[:-1]]) | cut[:-1]))
    ends = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]]) | cut[1:])) + 1
    owner = np.searchsorted(offsets - low, starts, side="right") - 1
    return starts + low, ends + low, owner


def runs(h: np.ndarray, owner: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, owner) of every run of k words of one owner; word hashes are in order of owner.

    An owner of fewer than k words but at least one has a single run of all its words.
    """
    first = np.searchsorted(owner, np.arange(rows + 1))
    count = np.diff(first)
    full = len(h) - k + 1
    out, whose = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if full > 0:
        rolled = np.zeros(full, np.uint64)
        for step in range(k):
            rolled = rolled * BASE + h[step : step + full]
        inside = owner[:full] == owner[k - 1 :]
        out, whose = mix(rolled[inside]), owner[:full][inside]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        rolled = np.zeros(len(short), np.uint64)
        for step in range(k - 1):
            there = count[short] > step
            at = np.minimum(first[short] + step, len(h) - 1)
            rolled = np.where(there, rolled * BASE + h[at], rolled)
        out = np.concatenate([out, mix(rolled + count[short].astype(np.uint64))])
        whose = np.concatenate([whose, short])
        order = np.argsort(whose, kind="stable")
        out, whose = out[order], whose[order]
    return out, whose


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``runs`` of the words of each row of a byte buffer."""
    starts, ends, owner = words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    base = int(offsets[0])
    h = Rolling(data[base : int(offsets[-1])]).of(starts - base, ends - base)
    return runs(h, owner, len(offsets) - 1, k)


def weighted(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, hash) with their counts, ordered by owner, then hash."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if not len(h):
        return h, owner, np.zeros(0, np.int64)
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(new)
    return h[at], owner[at], np.diff(np.concatenate([at, [len(h)]]))


def sequences(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word sequence; ``first`` has the place of each one's first word."""
    turn = _known_powers(BASE, len(h))[np.arange(len(h)) - np.repeat(first, np.diff(np.concatenate([first, [len(h)]])))]
    return mix(np.add.reduceat(h * turn, first)), mix(np.add.reduceat(mix(h + INVERSE) * turn, first))


def contents(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with words, two hashes of each one's word sequence)."""
    starts, ends, owner = words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none
    base = int(offsets[0])
    h = Rolling(data[base : int(offsets[-1])]).of(starts - base, ends - base)
    at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return owner[at], *sequences(h, at)
