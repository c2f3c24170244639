"""Removal of word passages that occur more than once, found by fixed-block anchors.

1. Each document's words are cut into consecutive blocks of ``k = (length + 1) // 2`` words, at
   fixed positions: every window of ``length`` words holds a whole block. The blocks are the index;
   every rolling window of k words probes it. Blocks and probes meet by hash, in parts; a probe is
   4 bytes. Both sides of a repeated window own a block that the other side's probes hit, so it is
   enough to send hit blocks back to their own documents.
2. A hit is extended: of all windows around hit blocks, and of those only, full hashes are
   exchanged; the windows that occur twice are the maximal exact repeats, position by position.

Equal windows are found by 64-bit hashes. Copies within a task are combined before each shuffle,
so that a passage that a third of all documents hold sends one entry for each task, not one for
each document. Defined cases: a null or empty text has no words; documents shorter than a window
stay whole; equal rows (even with one doc_id) are places of their own and remove each other;
columns besides doc_id and text are ignored by the search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import arrays as A
from . import packing as K
from . import tables as T

#: Bytes of text that a map task packs together.
FLUSH = 24 << 20


def _packed(batches: Iterator[pa.RecordBatch], emit, pack) -> Iterator[pa.RecordBatch]:
    held, size, docs = [], 0, 0
    for batch in batches:
        rk = batch.column("rk").to_numpy(zero_copy_only=False)
        for i, j, data, at in A.blocks(batch.column("text")):
            got = emit(batch, i, j, data, at)
            if got is not None:
                h, doc, *rest = got
                held.append((h, rk[i:j][doc], *rest))
            size += len(data)
            if size >= FLUSH:
                yield from pack([np.concatenate(x) for x in zip(*held, strict=True)]) if held else ()
                held, size = [], 0
    if held:
        yield from pack([np.concatenate(x) for x in zip(*held, strict=True)])


def _packed_by_part(batches: Iterator[pa.RecordBatch], emit, pack, parts: int, groups: int = 1) -> Iterator[pa.RecordBatch]:
    """emit: None, or a tuple of hashes and columns for each group. pack(part, columns of the first group, ...) makes the part's row."""

    def packed():
        for p in held[0].some():
            yield pack(p, *(g.of(p) for g in held))

    held, size = [K.ByPart(parts) for _ in range(groups)], 0
    for batch in batches:
        for i, j, data, at in A.blocks(batch.column("text")):
            for g, entries in zip(held, emit(batch, i, j, data, at) or (), strict=False):
                g.add(*entries)
            size += len(data)
            if size >= FLUSH:
                yield from packed()
                held, size = [K.ByPart(parts) for _ in range(groups)], 0
    yield from packed()


def hit_blocks(docs: DataFrame, k: int, parts: int) -> DataFrame:
    """(rk, binary of uint32 positions) of the blocks that some other window equals, by 32 + log2(parts) bits of hash."""

    def emit(batch, i, j, data, at):
        words, _, _, offsets = A.word_hashes(data, at, A.NOT_SPACE, lower=False)
        where, doc = A.window_rows(offsets, k)
        if not len(where):
            return None
        h, pos = A.window_hashes(A.symbol_prefix(words), k)[where], (where - offsets[doc]).astype(np.uint32)
        blk = pos % k == 0
        own = h[blk]
        return (h, h.astype(np.uint32)), (own, own.astype(np.uint32), batch.column("rk").to_numpy(zero_copy_only=False)[i:j][doc[blk]], pos[blk])

    def pack(p, probes, blks):
        # of all windows only the key is held, of blocks their places too
        s, (own, rk, pos) = np.sort(probes[0]), blks
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        often = np.diff(np.concatenate((first, [len(s)]))) > 1
        once, twice = s[first[~often]], s[first[often]]
        known = twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own if len(twice) else np.zeros(len(own), bool)
        return pa.RecordBatch.from_pydict({
            "part": pa.array([p], pa.int32()),
            "once": [once.tobytes()],
            "twice": [twice.tobytes()],
            "keys": [own[~known].tobytes()], "docs": [rk[~known].tobytes()], "pos": [pos[~known].tobytes()],
            "known_docs": [rk[known].tobytes()], "known_pos": [pos[known].tobytes()],
        })

    def probe(batches):
        kinds = {"once": np.uint32, "twice": np.uint32, "keys": np.uint32, "docs": np.int64, "pos": np.uint32, "known_docs": np.int64, "known_pos": np.uint32}
        of: dict[int, list] = {}
        for b in batches:
            for r, p in enumerate(b.column("part").to_pylist()):
                of.setdefault(p, []).append({c: K.joined(b.column(c).slice(r, 1), kind) for c, kind in kinds.items()})
        for p in list(of):
            g = {c: np.concatenate([x[c] for x in of[p]]) for c in kinds}
            del of[p]
            s = np.sort(np.concatenate((g["once"], g["twice"], g["twice"])))
            again = np.unique(s[1:][s[1:] == s[:-1]])
            hit = np.isin(g["keys"], again, assume_unique=False)
            yield from K.owned_rows(np.concatenate((g["docs"][hit], g["known_docs"])), np.concatenate((g["pos"][hit], g["known_pos"])), parts)

    packed = docs.select("rk", "text").mapInArrow(lambda x: _packed_by_part(x, emit, pack, parts, 2), "part int, once binary, twice binary, keys binary, docs binary, pos binary, known_docs binary, known_pos binary")
    return K.dealt(packed, parts).mapInArrow(probe, OWNED)


def hashed(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "part")


def with_places(docs: DataFrame, places: DataFrame, parts: int, run: Callable[[Iterator[pa.RecordBatch], K.Places], Iterator[pa.RecordBatch]], schema: StructType | str, deal: Callable[[DataFrame, int], DataFrame] = hashed) -> DataFrame:
    """Brings the packed places of each document (rk) to its row: run(rows, places) in each part.

    Rows are spread by the hash rk, so a part holds about its share of all texts; it is held whole, as Arrow buffers, each until ``run`` has taken the next."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found = [], []
        for b in batches:
            own = b.column("docs").is_null()
            texts.append(b.filter(own))
            found.append(b.filter(K.inverted(own)))
        places = K.Places(found)
        found.clear()
        yield from run(K.taken(texts), places)

    rows = docs.withColumn("part", F.pmod("rk", F.lit(parts)).cast("int"))
    return deal(rows.unionByName(places, allowMissingColumns=True), parts).mapInArrow(meet, schema)


def repeated_windows(docs: DataFrame, blocks: DataFrame, length: int, k: int, parts: int) -> DataFrame:
    """docs: rk, text; blocks: hit_blocks -> the packed starts of all windows that occur twice."""

    def emit(places):
        def run(batch, i, j, data, at):
            hits, owner = places.of(batch.column("rk").to_numpy(zero_copy_only=False)[i:j])
            if not len(hits):
                return None
            words, _, _, offsets = A.word_hashes(data, at, A.NOT_SPACE, lower=False)
            hits = hits + offsets[owner]
            first = np.maximum(hits - (length - k), offsets[owner])
            where, doc = A.window_rows(offsets, length)
            keep = A.covered(len(words), first, hits - first + 1)[where]
            where, doc = where[keep], doc[keep]
            if not len(where):
                return None
            h = A.window_hashes(A.symbol_prefix(words), length)[where]
            return ((h, h, batch.column("rk").to_numpy(zero_copy_only=False)[i:j][doc], (where - offsets[doc]).astype(np.uint32)),)

        return run

    packed = with_places(docs.select("rk", "text"), blocks, parts, lambda rows, places: _packed_by_part(rows, emit(places), lambda p, held: repeats_row(p, *held), parts), REPEATS, K.dealt)
    return exchange_repeats(packed, parts, K.dealt)


OWNED = "part int, docs binary, at binary"
REPEATS = "part int, keys binary, docs binary, pos binary, twice binary, known_docs binary, known_pos binary"


def repeats_row(p: int, h: np.ndarray, rk: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    often = K.times(h)
    known, single = often > 1, often == 1
    first = np.concatenate(([True], rk[single][1:] != rk[single][:-1])) if single.any() else np.zeros(0, bool)
    counts = np.diff(np.concatenate((np.flatnonzero(first), [len(first)])))
    return pa.RecordBatch.from_pydict({
        "part": pa.array([p], pa.int32()),
        "keys": [h[single].tobytes()],
        "docs": [np.stack((rk[single][first], counts), 1).astype(np.int64).tobytes()], "pos": [pos[single].tobytes()],
        "twice": [np.unique(h[known]).tobytes()],
        "known_docs": [rk[known].tobytes()], "known_pos": [pos[known].tobytes()],
    })


def pack_repeats(held, parts):
    h, rk, pos = held
    part = K.part_of(h, parts)
    order, n = K.by_part(part, parts)
    h, rk, pos = h[order], rk[order], pos[order]
    ends = np.cumsum(n)
    for p in np.flatnonzero(n):
        own = slice(ends[p] - n[p], ends[p])
        yield repeats_row(p, h[own], rk[own], pos[own])


def exchange_repeats(packed: DataFrame, parts: int, deal: Callable[[DataFrame, int], DataFrame] = hashed) -> DataFrame:
    def match(batches):
        kinds = {"keys": np.uint64, "docs": np.int64, "pos": np.uint32, "twice": np.uint64, "known_docs": np.int64, "known_pos": np.uint32}
        g = K.gathered(batches, kinds)
        table = g["docs"].reshape(-1, 2)
        docs = np.repeat(table[:, 0], table[:, 1])
        s = np.concatenate((g["keys"], g["twice"], g["twice"]))
        s.sort()
        again = np.unique(s[1:][s[1:] == s[:-1]])
        del s
        hit = again[np.minimum(np.searchsorted(again, g["keys"]), len(again) - 1)] == g["keys"] if len(again) else np.zeros(len(g["keys"]), bool)
        yield from K.owned_rows(np.concatenate((docs[hit], g["known_docs"])), np.concatenate((g["pos"][hit], g["known_pos"])), parts)

    return deal(packed, parts).mapInArrow(match, OWNED)


def repeats(documents: DataFrame, length: int, parts: int) -> DataFrame:
    """documents with rk -> the packed starts of all windows that occur elsewhere too."""
    k = (length + 1) // 2
    docs = documents.select("rk", "text")
    blocks = T.checkpoint(hit_blocks(docs, k, parts))
    T.release(documents.sparkSession)
    found = T.checkpoint(repeated_windows(docs, blocks, length, k, parts))
    T.release(documents.sparkSession)
    return found


def strip_repeats(documents: DataFrame, length: int = 35, keep: tuple[str, ...] = ("doc_id",), parts: int | None = None) -> DataFrame:
    """The columns of ``keep``, n_words, n_removed, kept (the kept words, joined by one space), spans (first word and end of each removed run)."""
    parts = parts or T.scale(documents.sparkSession, documents)
    docs = documents.withColumn("rk", T.row_key(["doc_id", "text"]))
    rows = docs.select("rk", *(F.col(c) for c in keep), F.col("text").alias("_text"))
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch], places: K.Places) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rk = batch.column("rk").to_numpy(zero_copy_only=False)
            for i, j, data, at in A.blocks(batch.column("_text")):
                starts, ends, offsets = A.word_spans(data, at, A.NOT_SPACE)
                hits, owner = places.of(rk[i:j])
                gone = A.covered(len(starts), hits + offsets[owner], length)
                raw, n_words, kept, spans, removed = data.tobytes(), np.diff(offsets), [], [], []
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    stay = [raw[starts[a + x] : ends[a + y - 1]].split() for x, y in zip(*A.runs(~gone[a:b]), strict=True)]
                    kept.append(b" ".join(b" ".join(run) for run in stay).decode())
                    removed.append(int(gone[a:b].sum()))
                    spans.append([{"first": int(x), "end": int(y)} for x, y in zip(*A.runs(gone[a:b]), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in keep] + [pa.array(n_words.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, span)],
                    names=[*keep, "n_words", "n_removed", "kept", "spans"],
                )

    more = StructType.fromDDL("n_words long, n_removed long, kept string, spans array<struct<first:long,end:long>>")
    return with_places(rows, repeats(docs, length, parts), parts, cut, StructType([rows.schema[c] for c in keep] + more.fields), K.dealt)


def without_repeats(documents: DataFrame, length: int = 35) -> DataFrame:
    """The documents without repeated passages: those that hold none are unchanged, those that lose all their words go, n_chars follows the text."""
    taken = ("rk", "part", "docs", "at", "_text", "n_words", "n_removed", "kept", "spans")
    aside = {c: f"_own_{c}" for c in documents.columns if c in taken}
    found = strip_repeats(documents.withColumnsRenamed(aside), length, keep=tuple(aside.get(c, c) for c in documents.columns))
    cut = found.filter("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    if "n_chars" in documents.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("kept").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.withColumn("text", text).select(*(F.col(aside.get(c, c)).alias(c) for c in documents.columns))
