"""Binary columns that hold runs of numpy values, and the exchange of hashes by part."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def runs_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column: row i holds the next counts[i] values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def joined(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    """All values of a binary column, one row after the other."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    out = []
    for c in chunks:
        wide = pa.types.is_large_binary(c.type)
        _, offsets, data = c.buffers()
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[c.offset : c.offset + len(c) + 1]
        if data is not None and len(at) and at[-1] > at[0]:
            out.append(np.frombuffer(data, np.uint8)[at[0] : at[-1]])
    return np.concatenate(out).view(dtype) if out else np.zeros(0, dtype)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by part, and how many there are of each."""
    kind = part.astype(np.uint16) if parts <= 1 << 16 else part
    return np.argsort(kind, kind="stable"), np.bincount(part, minlength=parts)


class ByPart:
    """Columns of entries, held by part. Each block is put in order when it comes, so no copy of all entries is made when they are packed."""

    def __init__(self, parts: int) -> None:
        self.parts, self.held = parts, []

    def add(self, hashes: np.ndarray, *columns: np.ndarray) -> None:
        order, n = by_part(part_of(hashes, self.parts), self.parts)
        self.held.append((np.concatenate(([0], np.cumsum(n))), *(c[order] for c in columns)))

    def some(self) -> np.ndarray:
        """The parts that have entries."""
        return np.flatnonzero(sum(np.diff(ends) for ends, *_ in self.held)) if self.held else np.zeros(0, np.int64)

    def of(self, p: int) -> list[np.ndarray]:
        """The columns of a part, in the order in which they came."""
        return [np.concatenate(x) for x in zip(*([c[ends[p] : ends[p + 1]] for c in columns] for ends, *columns in self.held), strict=True)]


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Each part in a partition of its own; by the hash of ``part``, one partition in some dozens has four or five."""
    return rows.repartitionById(parts, "part")


def times(values: np.ndarray) -> np.ndarray:
    """How often each value occurs in the whole array."""
    if not len(values):
        return np.zeros(0, np.int64)
    order = np.argsort(values, kind="stable")
    s = values[order]
    edges = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True])))
    out = np.empty(len(values), np.int64)
    out[order] = np.repeat(np.diff(edges), np.diff(edges))
    return out


def gathered(batches: Iterable[pa.RecordBatch], columns: dict[str, type]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {c: [] for c in columns}
    for b in batches:
        for c, kind in columns.items():
            parts[c].append(joined(b.column(c), kind))
    return {c: np.concatenate(v) if v else np.zeros(0, columns[c]) for c, v in parts.items()}


def sliced(batch: pa.RecordBatch, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def taken(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows; the list lets go of each."""
    batches.reverse()
    while batches:
        batch = batches.pop()
        if batch.num_rows:
            yield batch


def owned_rows(owner: np.ndarray, at: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """part, docs (pairs of an owner and its number of places), at (the places): one row for each part of owners that has any."""
    order = np.lexsort((owner, owner % parts))
    owner, at = owner[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
    table = np.stack((owner[first], np.diff(np.concatenate((first, [len(owner)])))), 1).astype(np.int64)
    part = table[:, 0] % parts
    for p in np.unique(part):
        a, b = np.searchsorted(part, (p, p + 1))
        x, y = first[a], first[b] if b < len(first) else len(owner)
        yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "docs": [table[a:b].tobytes()], "at": [at[x:y].tobytes()]})


class Places:
    """The places of each owner, from rows of owned_rows."""

    def __init__(self, batches: list[pa.RecordBatch], kind: type = np.uint32) -> None:
        g = gathered(batches, {"docs": np.int64, "at": kind})
        table = g["docs"].reshape(-1, 2)
        owner = np.repeat(table[:, 0], table[:, 1])
        order = np.argsort(owner, kind="stable")
        self.owner, self.at = owner[order], g["at"][order].astype(np.int64)

    def of(self, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places of a list of owners, and which of the list each belongs to."""
        a, b = np.searchsorted(self.owner, owners, "left"), np.searchsorted(self.owner, owners, "right")
        counts = b - a
        total = int(counts.sum())
        ends = np.cumsum(counts)
        rows = np.arange(total) - np.repeat(ends - counts - a, counts) if total else np.zeros(0, np.int64)
        return self.at[rows], np.repeat(np.arange(len(owners)), counts)


def inverted(mask: pa.Array) -> pa.Array:
    return pc.invert(mask)
