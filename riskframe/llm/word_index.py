"""FM-index over the word ids of a shard, with bidirectional interval extension.

A shard is a sequence of word numbers above 0 in which 0 ends every run. The index keeps, for the sequence and for its
reverse, the Burrows-Wheeler transform of the suffixes ordered by their first ``depth`` words; an n-gram is an interval in
both. Extending all intervals of a level by one word on either side is a few array operations, and no n-gram crosses a 0.
"""

from __future__ import annotations

import numpy as np


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0] .. first[0]+size[0]-1, first[1] .. and so on."""
    begin = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - begin, size)


class _Side:
    """The transform of one direction; ``starts`` counts as C and Occ in one sorted array."""

    def __init__(self, words: np.ndarray, depth: int) -> None:
        self.n, self.base = len(words), int(words.max(initial=0)) + 1
        ranks, inside = words, words > 0
        for length in range(2, depth + 1):
            order = words.astype(np.int64)
            order *= int(ranks.max(initial=0)) + 1
            order[:-1] += ranks[1:]
            order *= inside
            if length < depth:
                ranks = np.unique(order, return_inverse=True)[1].astype(np.int32)
        self.suffixes = np.argsort(order).astype(np.int32)
        del order, ranks
        self.front = words[self.suffixes - 1]  # in front of the first word stands the 0 at the end
        starts = self.front.astype(np.int64)
        starts *= self.n + 1
        starts += np.arange(self.n)
        starts.sort()
        self.starts = starts

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Backward search: first suffix that begins with ``symbol`` and goes on with a suffix from ``place`` on."""
        return np.searchsorted(self.starts, symbol.astype(np.int64) * (self.n + 1) + place)


class WordIndex:
    """n-grams of a shard as synchronised intervals of its two transforms."""

    def __init__(self, words: np.ndarray, depth: int) -> None:
        self.words, self.depth = words, depth
        # the first extension goes to the left, so the reverse is needed from three words on
        self.sides = [_Side(words, depth)] + [_Side(words[::-1], depth) for _ in range(depth > 2)]

    def _extend(self, side: int, first: tuple[np.ndarray, np.ndarray], size: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """All intervals one word longer: on the left by the transform of the sequence (0), on the right by its reverse (1)."""
        here = self.sides[side]
        keys = np.repeat(np.arange(len(size)) * here.base, size)
        keys += here.front[ranges(first[side], size)]
        keys, count = np.unique(keys, return_counts=True)
        parent, symbol = np.divmod(keys, here.base)
        smaller = np.cumsum(count) - count  # of the whole level; less what lies before the parent
        smaller -= (np.cumsum(size) - size)[parent]
        real = symbol > 0
        parent, symbol, smaller, count = parent[real], symbol[real], smaller[real], count[real]
        stepped, moved = here.step(symbol, first[side][parent]), first[1 - side][parent] + smaller
        return ((stepped, moved) if side == 0 else (moved, stepped)), count

    def ngrams(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, size) of the interval of every n-gram of ``depth`` words in the order of their suffixes."""
        symbols, size = np.unique(self.words, return_counts=True)
        first = np.cumsum(size) - size
        first, size = first[symbols > 0], size[symbols > 0]
        both = (first, first)
        for length in range(2, self.depth + 1):
            both, size = self._extend(length % 2, both, size)
        order = np.argsort(both[0], kind="stable")
        return both[0][order], size[order]

    def places(self, first: np.ndarray) -> np.ndarray:
        """Where the suffix at each place of the order begins."""
        return self.sides[0].suffixes[first]

    def numbered(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Per position the number (from 1) of the n-gram that begins there, 0 where none does."""
        out = np.zeros(len(self.words), np.int64)
        out[self.sides[0].suffixes[ranges(first, size)]] = np.repeat(np.arange(1, len(size) + 1), size)
        return out


def cut_runs(words: np.ndarray, marks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs in which two or more n-grams of ``length`` words with a mark follow each other, and their marks.

    Every run ends with 0; marks stand where a marked n-gram begins. Words at the edge of two runs occur in both.
    """
    inside = np.concatenate([[0], (marks > 0).astype(np.int8), [0]])
    edge = np.diff(inside)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= 2
    begin, end = begin[long], end[long]
    size = end - begin + length
    at = np.minimum(ranges(begin, size), len(words) - 1)
    last = np.cumsum(size) - 1
    new_words = words[at].copy()
    new_words[last] = 0
    new_marks = marks[at].copy()
    for back in range(length):
        new_marks[last - back] = 0
    return new_words, new_marks
