"""Removal of every byte that a ``length``-byte string covers which also starts earlier, by per-shard suffix arrays.

1. Sieve. Of the hashes of all ``K``-byte strings inside a window of ``length`` bytes the smallest is the window's
   anchor; equal windows have equal anchors at equal offsets. Anchors (one for about 30 windows) are
   exchanged by hash in packed parts; only those that occur twice go on.
2. A repeated anchor's windows are consecutive. Their bytes travel, as one string, to the shard of the anchor's hash. So equal
   windows always meet in one shard, and no merging of shards' arrays by binary search is left to do: with it, each shard would
   have to send all its distinct windows.
3. In a shard equal strings are merged, then a suffix array (Larsson and Sadakane) with common prefixes (Kasai) over the rest
   gives the classes of equal windows, byte by byte, not by hash. All but the earliest window of each class (by doc_id, then place) are removed.

An anchor that very many documents hold with different surroundings has a string for each. Such a group is never one suffix array: its windows are hashed, those that
occur once are dropped, and the others go through suffix arrays of their own, in slices of whole hash classes.

Whole copies of a document are found first, by its hash, and take no part. Copies of a string within a task are merged before
they are sent: a passage that a third of the documents hold sends one string for each task.

Defined cases: null and empty texts have no bytes; rows that repeat doc_id and text are one document; equal doc_ids with different
texts are ordered by a hash of the text; a null doc_id comes last; texts shorter than a window stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import arrays as A
from . import packing as K
from . import substring_dedup as S
from . import suffix_arrays as SA
from . import tables as T

GRAM = 40
BLOCK, FLUSH = 1 << 20, 12 << 20
#: Strings that one suffix array takes, at about 100 bytes of memory for each of their bytes. An anchor with more of them is cut up by window.
AT_ONCE = 4000
#: Windows of such an anchor that are hashed and sorted at once.
WINDOWS = 4_000_000
COPY = np.uint32(0xFFFFFFFF)  # as a place: the document is a whole copy of an earlier one
_LAST = np.iinfo(np.int64).max


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows with one anchor: its document, first window, number of windows, anchor's place, anchor's hash."""
    n, span = len(data), length - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64)
    h = A.window_hashes(A.byte_prefix(data), GRAM)
    # the upper half of the hash, then the place: equal windows have equal anchors wherever they stand, ties going to the earlier place
    low = np.uint64(0xFFFFFFFF)
    v = h & ~low
    v |= np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= span:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    if step < span:
        v = np.minimum(v[: len(v) - (span - step)], v[span - step :])
    where, doc = A.window_rows(at, length)
    if not len(where):
        return none, none, none, none, none.astype(np.uint64)
    place = (v[where] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))))
    return doc[first], where[first], np.diff(np.concatenate((first, [len(where)]))), place[first], A.mix(h[place[first]])  # mixed: least hashes crowd the low parts


def copies(docs: DataFrame) -> DataFrame:
    """rk of the documents whose whole text (not empty) an earlier document has."""
    d = docs.select("rk", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("o"), F.xxhash64("text").alias("t"), F.sha2(F.col("text").cast("binary"), 256).alias("s")).filter("s IS NOT NULL")
    # the first of each text and all others meet by their own keys, so the copies of one text are spread
    first = d.groupBy("t", "s").agg(F.min(F.struct("o", "rk")).alias("first")).select(F.col("first.rk").alias("rk"))
    return d.select("rk").join(first, "rk", "left_anti").distinct()


def _owned_copies(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rk = b.column("rk").to_numpy(zero_copy_only=False)
            yield from K.owned_rows(rk, np.full(len(rk), COPY, np.uint32), parts)

    return run


def sieve(docs: DataFrame, length: int, parts: int) -> DataFrame:
    """The packed places of anchors that occur twice."""

    def emit(batch, i, j, data, at):
        doc, _, _, place, h = anchors(data, at, length)
        # an anchor may lead two runs of windows of a document: once is enough
        new = np.concatenate(([True], place[1:] != place[:-1])) if len(place) else np.zeros(0, bool)
        return (h[new], doc[new], (place - at[doc])[new].astype(np.uint32)) if len(place) else None

    packed = docs.select("rk", "text").mapInArrow(lambda x: S._packed(x, emit, lambda held: S.pack_repeats(held, parts)), S.REPEATS)
    return S.exchange_repeats(packed, parts)


def _min_first(doc: np.ndarray, rk: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The order by document, then place."""
    return np.lexsort((at, rk, doc))


def _strings(batches: Iterator[pa.RecordBatch], places: K.Places, length: int, parts: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        rk, order = batch.column("rk").to_numpy(zero_copy_only=False), batch.column("o").to_numpy(zero_copy_only=False)
        for i, j, data, at in A.blocks(batch.column("text"), BLOCK):
            hits, owner = places.of(rk[i:j])
            if not len(hits):
                continue
            copy = np.zeros(j - i, bool)
            copy[owner[hits == COPY]] = True
            hits, owner = hits[hits != COPY], owner[hits != COPY]
            doc, first, n, place, h = anchors(data, at, length)
            wanted = np.isin(place, hits + at[owner]) & ~copy[doc]
            doc, first, n, h = doc[wanted], first[wanted], n[wanted], h[wanted]
            if not len(doc):
                continue
            sizes = n + length - 1
            text = data[A.ranges(first, sizes)]
            prefix = A.byte_prefix(data)
            same = A.span_hashes(prefix, first, first + sizes) ^ A.mix(h + n.astype(np.uint64))
            held.append((h, order[i:j][doc], rk[i:j][doc], first - at[doc], n, same, sizes, text))
            size += len(text) + 64 * len(doc)
            if size > FLUSH:
                yield from _packed_strings(held, parts)
                held, size = [], 0
    if held:
        yield from _packed_strings(held, parts)


STRINGS = "part int, h binary, o binary, rk binary, first binary, n binary, text binary, docs binary, at binary"


def _packed_strings(held: list[tuple], parts: int) -> Iterator[pa.RecordBatch]:
    h, o, rk, first, n, same, sizes, text = (np.concatenate(x) for x in zip(*held, strict=True))
    begins = np.cumsum(sizes) - sizes
    by = _min_first(o, rk, first)
    by = by[np.argsort(same[by], kind="stable")]
    lead = np.concatenate(([True], same[by][1:] != same[by][:-1]))
    later = by[~lead]  # an equal string stands earlier in this task
    if len(later):
        for b in K.owned_rows(rk[later], _runs(first[later], n[later]), parts):
            yield pa.RecordBatch.from_arrays([b.column("part"), *[pa.nulls(1, pa.binary())] * 6, b.column("docs"), b.column("at")], names=[c.split()[0] for c in STRINGS.split(", ")])
    keep = np.sort(by[lead])
    order, counts = K.by_part(K.part_of(h[keep], parts), parts)
    keep, ends = keep[order], np.cumsum(counts)
    for p in np.flatnonzero(counts):
        x = keep[ends[p] - counts[p] : ends[p]]
        columns = [h[x], o[x], rk[x], first[x].astype(np.uint32), n[x].astype(np.uint8), text[A.ranges(begins[x], sizes[x])]]
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in columns], *[pa.nulls(1, pa.binary())] * 2], names=[c.split()[0] for c in STRINGS.split(", ")])


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A run of windows as one number."""
    return first.astype(np.uint64) << np.uint64(8) | n.astype(np.uint64)


def removed_windows(h: np.ndarray, o: np.ndarray, rk: np.ndarray, first: np.ndarray, n: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of windows with one anchor -> owners and runs of the windows that also start earlier."""
    sizes = n + length - 1
    begins = np.cumsum(sizes) - sizes
    by = _min_first(o, rk, first)
    h, o, rk, first, n, sizes, begins = (x[by] for x in (h, o, rk, first, n, sizes, begins))
    width = int(sizes.max(initial=0))
    matrix = np.zeros((len(h), width), np.uint8)
    rows = np.repeat(np.arange(len(h)), sizes)
    matrix[rows, A.ranges(np.zeros(len(h), np.int64), sizes)] = text[A.ranges(begins, sizes)]
    # equal strings: all but the first go whole; the rest is told apart by the suffix array
    lead = np.unique(_row_keys(matrix, n), return_index=True)[1]
    is_lead = np.zeros(len(h), bool)
    is_lead[lead] = True
    out_rk, out_runs = [rk[~is_lead]], [_runs(first[~is_lead], n[~is_lead])]
    x = np.flatnonzero(is_lead)
    shared = K.times(h[x]) > 1
    x = x[shared]
    if len(x):
        m, windows = matrix[x], n[x]
        row = np.repeat(np.arange(len(x)), windows)
        column = A.ranges(np.zeros(len(x), np.int64), windows)
        rank = SA.suffix_ranks(m, length)[row, column]
        order = np.argsort(rank, kind="stable")  # inside a rank by document and place: rows stand in that order
        row, column = row[order], column[order]
        prefix = SA.common_prefixes(m, row, column, length)
        new = prefix < length
        new[0] = True
        klass = np.cumsum(new) - 1
        at = row * width + column
        earliest = np.minimum.reduceat(at, np.flatnonzero(new))
        gone = at > earliest[klass]
        mask = np.zeros((len(x), width), bool)
        mask[row[gone], column[gone]] = True
        flat = np.zeros((len(x), width + 1), bool)
        flat[:, :width] = mask
        a, b = A.runs(flat.ravel())
        r = a // (width + 1)
        out_rk.append(rk[x[r]])
        out_runs.append(_runs(first[x[r]] + a % (width + 1), b - a))
    return np.concatenate(out_rk), np.concatenate(out_runs)


def _cut_up(g: dict, x: np.ndarray, begins: np.ndarray, length: int, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """removed_windows of one anchor's strings (rows x of g), slice by slice: a window goes where all windows with its hash go."""
    n = g["n"][x].astype(np.int64)
    ends = np.cumsum(n)
    passes = -(-int(n.sum()) // WINDOWS)
    for p in range(passes):
        hashes, ids = [], []
        for i in range(0, len(x), 16_384):
            some = slice(i, i + 16_384)
            sizes = n[some] + length - 1
            at = np.concatenate(([0], np.cumsum(sizes)))
            h = A.window_hashes(A.byte_prefix(g["text"][A.ranges(begins[x[some]], sizes)]), length)[A.window_rows(at, length)[0]]
            own = np.flatnonzero(K.part_of(h, passes) == p)
            hashes.append(h[own])
            ids.append(own + (ends[i] - n[i]))
        h, ids = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(h, kind="stable")
        s = h[order]
        edges = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True])))
        often = np.repeat(np.diff(edges) > 1, np.diff(edges))
        ids, s = ids[order[often]], s[often]
        edges = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True]))) if len(s) else np.zeros(1, np.int64)
        a = 0
        while a < len(s):
            b = int(edges[max(np.searchsorted(edges, a + at_once, "right") - 1, np.searchsorted(edges, a, "right"))])
            row = np.searchsorted(ends, ids[a:b], "right")
            column = ids[a:b] - (ends[row] - n[row])
            of = x[row]
            one = np.ones(b - a, np.int64)
            yield removed_windows(s[a:b], g["o"][of], g["rk"][of], g["first"][of].astype(np.int64) + column, one, g["text"][A.ranges(begins[of] + column, one * length)], length)
            a = b


def _row_keys(matrix: np.ndarray, n: np.ndarray) -> np.ndarray:
    wide = np.concatenate((matrix, n.astype(np.uint8)[:, None]), 1)
    return np.ascontiguousarray(wide).view(np.dtype((np.void, wide.shape[1]))).ravel()


def _shard(length: int, parts: int, at_once: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"h": np.uint64, "o": np.int64, "rk": np.int64, "first": np.uint32, "n": np.uint8, "text": np.uint8}
        of: dict[int, list[dict]] = {}
        for b in batches:
            known = b.column("docs").is_valid()
            if (done := b.filter(known).select(["part", "docs", "at"])).num_rows:
                yield done
            own = b.filter(b.column("docs").is_null())
            for r, p in enumerate(own.column("part").to_pylist()):
                of.setdefault(p, []).append({c: K.joined(own.column(c).slice(r, 1), kind) for c, kind in kinds.items()})
        for p in list(of):
            held = of.pop(p)
            g = {c: np.concatenate([x[c] for x in held]) for c in kinds}
            del held
            sizes = g["n"].astype(np.int64) + length - 1
            begins = np.cumsum(sizes) - sizes
            order = np.argsort(g["h"], kind="stable")
            h = g["h"][order]
            edges = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True])))
            found, a = [], 0
            while a < len(h):
                b = int(edges[max(np.searchsorted(edges, a + at_once, "right") - 1, np.searchsorted(edges, a, "right"))])
                x = order[a:b]
                if b - a > at_once:
                    found += _cut_up(g, x, begins, length, at_once)
                    a = b
                    continue
                found.append(removed_windows(g["h"][x], g["o"][x], g["rk"][x], g["first"][x].astype(np.int64), g["n"][x].astype(np.int64), g["text"][A.ranges(begins[x], sizes[x])], length))
                a = b
            if found:
                yield from K.owned_rows(*(np.concatenate(x) for x in zip(*found, strict=True)), parts)

    return run


def strip_repeats(documents: DataFrame, length: int = 100, keep: tuple[str, ...] = ("doc_id",), parts: int | None = None, at_once: int = AT_ONCE) -> DataFrame:
    """The columns of ``keep``, n_bytes, n_removed, n_spans, kept (binary: the bytes that stay)."""
    spark = documents.sparkSession
    parts = parts or T.scale(spark, documents, 6 << 20)
    docs = documents.withColumn("rk", T.row_key(["doc_id", "text"]))
    same = T.checkpoint(copies(docs).mapInArrow(_owned_copies(parts), S.OWNED))
    hits = T.checkpoint(sieve(docs, length, parts))
    T.release(spark)
    ordered = docs.select("rk", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("o"), "text")
    strings = S.with_places(ordered, hits.unionByName(same), parts, lambda rows, places: _strings(rows, places, length, parts), STRINGS)
    found = T.checkpoint(strings.repartition(parts, "part").mapInArrow(_shard(length, parts, at_once), S.OWNED))
    T.release(spark)
    marked = same.withColumn("copy", F.lit(True)).unionByName(found.withColumn("copy", F.lit(False)))
    rows = docs.select("rk", *(F.col(c) for c in keep), F.col("text").alias("_text"))

    def cut(texts: list[pa.RecordBatch], runs: K.Places, copied: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in texts:
            rk = batch.column("rk").to_numpy(zero_copy_only=False)
            whole = np.isin(rk, copied)
            for i, j, data, at in A.blocks(batch.column("_text")):
                got, owner = runs.of(rk[i:j])
                gone = A.covered(len(data), (got >> 8) + at[owner], (got & 255) + length - 1)
                for d in np.flatnonzero(whole[i:j] & (np.diff(at) >= length)):
                    gone[at[d] : at[d + 1]] = True
                total = np.concatenate(([0], np.cumsum(gone)))
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                begins = at[:-1][at[:-1] < at[1:]]
                edge[begins] = gone[begins]
                spans = np.concatenate(([0], np.cumsum(edge)))
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep), pa.array(np.diff(at)), pa.array(total[at[1:]] - total[at[:-1]]), pa.array(spans[at[1:]] - spans[at[:-1]]), pa.array(kept, pa.binary())], names=[*keep, "n_bytes", "n_removed", "n_spans", "kept"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found, copied = [], [], [np.zeros(0, np.int64)]
        for b in batches:
            own = b.column("docs").is_null()
            texts.append(b.filter(own))
            packed = b.filter(b.column("docs").is_valid())
            copy = packed.column("copy")
            found.append(packed.filter(K.inverted(copy)))
            copied.append(K.joined(packed.filter(copy).column("docs"), np.int64).reshape(-1, 2)[:, 0])
        yield from cut([t for t in texts if t.num_rows], K.Places(found, np.uint64), np.concatenate(copied))

    schema = StructType([rows.schema[c] for c in keep] + StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary").fields)
    placed = rows.withColumn("part", F.pmod("rk", F.lit(parts)).cast("int"))
    return placed.unionByName(marked, allowMissingColumns=True).repartition(parts, "part").mapInArrow(meet, schema)
