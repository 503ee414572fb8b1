"""Collection suffix array of many short strings, built column by column.

Round j adds one symbol of every string, from its end towards its start, so that after it the collection holds all
suffixes of at most j symbols. With the Burrows-Wheeler transform of the round before, the suffixes of the new round
are the old ones sorted stably by the symbol in front of them, behind the ends of all strings; the common prefix of
two neighbours is one more than the smallest common prefix between their tails. Each round reads the transform and
the prefixes once in order and writes the next ones.
"""

from __future__ import annotations

import numpy as np

#: Byte in front of every string: it cannot occur in UTF-8, and sorts last.
MARK = 0xFF


def _levels(span: np.ndarray) -> np.ndarray:
    """floor(log2) of positive integers below 2^53."""
    return (np.frexp(span.astype(np.float64))[1] - 1).astype(np.uint8)


def _range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of values[first..last] for many ranges, by minima over powers of two."""
    out = np.empty(len(first), values.dtype)
    level = _levels(last - first + 1)
    by_level = np.argsort(level, kind="stable")
    cuts = np.cumsum(np.bincount(level, minlength=1))
    table, size, start = values, 1, 0
    for k, stop in enumerate(cuts.tolist()):
        if k:
            table = np.minimum(table[:-size], table[size:])
            size *= 2
        at = by_level[start:stop]
        out[at] = np.minimum(table[first[at]], table[last[at] - (size - 1)])
        start = stop
    return out


def suffix_collection(strings: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, common) of all suffixes in order: where each starts, and what it shares with the one before.

    ``strings`` are bytes in which ``MARK`` precedes every string; string i stops before ``ends[i]``. Ends of strings
    sort before all bytes and among themselves by string. ``common`` stops at 255.
    """
    ends = ends.astype(np.int32)
    m = len(ends)
    no_prefix = np.zeros(m, np.uint8)
    start, common = ends, no_prefix
    longest = int(np.diff(ends, prepend=0).max()) - 1 if m else 0
    for _ in range(longest):
        front = strings[start - 1]  # the transform of this round
        order = np.argsort(front, kind="stable")
        order = order[:len(order) - np.count_nonzero(front == MARK)].astype(np.int32)
        sorted_front = front[order]
        after = np.flatnonzero(sorted_front[1:] == sorted_front[:-1])
        shared = np.zeros(len(order), np.uint8)
        low = _range_minimum(common, order[after] + 1, order[after + 1])
        shared[after + 1] = np.minimum(low, 254) + 1
        start = np.concatenate([ends, start[order] - 1])
        common = np.concatenate([no_prefix, shared])
    return start, common


def repeated_windows(strings: np.ndarray, ends: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of all windows of ``width`` bytes that also occur in a string of a smaller owner."""
    start, common = suffix_collection(strings, ends)
    group = np.cumsum(common < width)
    string = np.searchsorted(ends, start, side="left")
    long = ends[string] - start >= width
    string, start, group = string[long], start[long], group[long]
    if not len(string):
        return string, start
    firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    smallest = np.minimum.reduceat(owner[string], firsts)
    smallest = np.repeat(smallest, np.diff(np.append(firsts, len(group))))
    repeated = owner[string] > smallest
    string = string[repeated]
    begin = np.append(0, ends[:-1])[string] + 1
    return string, start[repeated] - begin
