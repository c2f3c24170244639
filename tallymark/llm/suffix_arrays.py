"""Suffix arrays of many short strings at once, in numpy.

The strings stand as rows of a byte matrix, padded with zeros. Larsson and Sadakane's refinement: positions are sorted by
their first 8 bytes; then, doubling the depth, each group of equal rank is sorted by the ranks of the positions
``depth`` further on; a position alone in its group is done and is never sorted again. Kasai's common prefixes
run over all strings side by side: at each offset the prefix length of the offset before, less one, is extended by comparing bytes.
"""

from __future__ import annotations

import numpy as np


def words_of(matrix: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position, as a big-endian number; zeros follow the last column."""
    n, width = matrix.shape
    wide = np.zeros((n, width + 8), np.uint8)
    wide[:, :width] = matrix
    out = np.zeros((n, width), np.uint64)
    for j in range(8):
        out |= wide[:, j : j + width].astype(np.uint64) << np.uint64(56 - 8 * j)
    return out


def _ranked(keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """keys, sorted, and the places they stand at -> the rank of each (the place of the first of its group), and which are alone."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.concatenate((first, [len(keys)])))
    return np.repeat(place[first], size), np.repeat(size == 1, size)


def suffix_ranks(matrix: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every position by the first ``depth`` bytes or more from it (equal strings: equal ranks), as the matrix is."""
    n, width = matrix.shape
    keys = words_of(matrix).ravel()
    order = np.argsort(keys, kind="stable")
    rank = np.zeros(n * width, np.int64)
    got, alone = _ranked(keys[order], np.arange(1, len(order) + 1))
    rank[order] = got
    todo = order[~alone]
    column, h = np.arange(n * width, dtype=np.int64) % width, 8
    while h < depth and len(todo):
        ahead = np.where(column[todo] + h < width, rank[np.minimum(todo + h, n * width - 1)], 0)
        key = rank[todo] << 32 | ahead
        by = np.argsort(key, kind="stable")
        todo, key = todo[by], key[by]
        # a group keeps the places it had: subgroups start where their first member now stands
        group = key >> 32
        head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        place = group + np.arange(len(key)) - np.repeat(head, np.diff(np.concatenate((head, [len(key)]))))
        got, alone = _ranked(key, place)
        rank[todo] = got
        todo = todo[~alone]
        h *= 2
    return rank.reshape(n, width)


def common_prefixes(matrix: np.ndarray, rows: np.ndarray, columns: np.ndarray, most: int) -> np.ndarray:
    """Kasai: rows, columns: positions in suffix order -> the length (``most`` at most) of the prefix that each shares with the one before it."""
    n, width = matrix.shape
    flat = np.zeros(n * width + most + 8, np.uint8)
    flat[: n * width] = matrix.ravel()
    at = rows * width + columns
    before = np.full(n * width, -1, np.int64)
    before[at[1:]] = at[:-1]
    place = np.full(n * width, -1, np.int64)
    place[at] = np.arange(len(at))
    out = np.zeros(len(at), np.int64)
    carried = np.zeros(n, np.int64)  # what the string's last offset promises to this one
    for c in range(int(columns.max(initial=-1)) + 1):
        x = np.arange(n) * width + c
        own = np.flatnonzero(before[x] >= 0)
        x, y, length = x[own], before[x[own]], np.maximum(carried[own] - 1, 0)
        room = np.minimum(width - x % width, width - y % width)
        going = np.arange(len(x))
        while len(going):
            going = going[(length[going] < most) & (length[going] < room[going])]
            same = flat[x[going] + length[going]] == flat[y[going] + length[going]]
            going = going[same]
            length[going] += 1
        out[place[x]] = length
        carried[:] = 0
        # the promise holds if the suffix after y is in the array too, before the one after x (the order is one by a limited depth)
        after = place[np.minimum(y + 1, n * width - 1)]
        kept = (y % width + 1 < width) & (after >= 0) & (after < place[np.minimum(x + 1, n * width - 1)])
        carried[own[kept]] = length[kept]
    return out
