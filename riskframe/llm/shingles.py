"""Word shingles of many texts at once, as 64-bit hashes, with array operations on their bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mixed(x: np.ndarray, key: int = 0) -> np.ndarray:
    """64-bit finalizer: every bit of the input reaches every bit of the output."""
    x = x + np.uint64((key * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = pow(_BASE, -1, 2**64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per byte a random value, equal for A-Z and a-z, and whether it is part of a word."""
    values = mixed(np.arange(256, dtype=np.uint64), 1)
    values[65:91] = values[97:123]
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return values, word


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``k`` words, A-Z lower-cased.

    A word is a run of bytes other than ASCII white space. A text of fewer than ``k`` words is one shingle, a
    text without words (or null) has none.
    """
    raw = [b"" if t is None else t.encode() for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    values, word = _tables()
    inside = word[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))  # ends with a space: starts and ends alternate
    starts, stops = edges[0::2], edges[1::2]
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in texts]
    # every byte at every place of a word has a value of its own: no structure of a word can cancel out, as it could in a
    # polynomial modulo a power of two
    place = np.arange(len(data))
    place[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    sums = np.cumsum(mixed(values[data] + place.astype(np.uint64) * _STEP), dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    words = mixed(sums[stops - 1] - before + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    last = np.searchsorted(starts, ends)
    first = np.concatenate([[0], last[:-1]])
    windows = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for place in range(k):
        windows += words[place:len(words) - k + 1 + place] * _PLACES[place]
    windows = mixed(windows, k)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= k:
            out.append(np.unique(windows[a:b - k + 1]))
        elif b > a:
            out.append(mixed((words[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64, keepdims=True), b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out
