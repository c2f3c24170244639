"""numpy kernels over the raw Arrow buffers of a text column.

Texts are read as UTF-8 bytes in blocks of whole documents, so memory is bounded by
``BLOCK`` bytes (or by one document, if that is longer), never by the Arrow batch.
Polynomial hashes are taken modulo 2**64 over random symbol values and finished with
a mixing step; equal strings always get equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21

_rng = np.random.default_rng(20240611)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

#: Bytes that belong to a word: all but ASCII white space, and ASCII letters and digits with all non-ASCII bytes.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        m = max(n, BLOCK + 1)
        if m > 4 * BLOCK:  # a very long document: not kept for the life of the worker
            return _run_of_powers(base, m)
        have = _powers[kind] = _run_of_powers(base, m)
    return have[:n]


def _run_of_powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) over whole documents of about ``limit`` bytes together."""
    data, at = text_buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_spans(data: np.ndarray, at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n+1 word offsets of the documents."""
    inside = word[data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < at[1:]]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = at[1:][at[:-1] < at[1:]] - 1
    last[edges] = inside[edges]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def byte_prefix(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums P with P[j]-P[i] the hash of data[i:j], not yet shifted to the origin."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((_BYTE_VALUE[_LOWER] if lower else _BYTE_VALUE)[data] * _power("up", _BASE, len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((prefix[ends] - prefix[starts]) * _power("down", _INVERSE, len(prefix))[starts])


def word_hashes(data: np.ndarray, at: np.ndarray, word: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, offsets = word_spans(data, at, word)
    return span_hashes(byte_prefix(data, lower), starts, ends), starts, ends, offsets


def symbol_prefix(symbols: np.ndarray) -> np.ndarray:
    out = np.empty(len(symbols) + 1, np.uint64)
    out[0] = 0
    np.cumsum((symbols | np.uint64(1)) * _power("up", _BASE, len(symbols)), out=out[1:])
    return out


def window_hashes(prefix: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k symbols; those that cross documents are the caller's to drop."""
    n = len(prefix) - 1 - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((prefix[k:] - prefix[:-k]) * _power("down", _INVERSE, n))


def window_rows(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of k symbols that stay inside a document, and their documents."""
    room = np.maximum(np.diff(offsets) - k + 1, 0)
    doc = np.repeat(np.arange(len(room)), room)
    return ranges(offsets[:-1], room), doc


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of starts[i] .. starts[i]+lengths[i]-1."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in any span."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes_of(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of symbols of any length, over a symbol prefix."""
    return span_hashes(prefix, starts, ends)
