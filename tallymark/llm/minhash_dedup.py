"""MinHash near-duplicates by a multi-index Hamming join.

1. A document's set of word shingles gets a signature of ``SYMBOLS`` minhash symbols of 16 bits.
   Equal sets are one node from here on.
2. Multi-index: the signature is cut into chunks of ``CHUNK`` symbols; a node is indexed under each chunk with
   each one symbol masked, which enumerates all chunks with one error. By the pigeonhole principle any
   two nodes that differ in at most ``MOST = 2 * chunks - 1`` symbols share a key. At a similarity of
   0.85 a pair differs in more than 15 of 32 symbols with a probability of 4e-6.
3. Inside a key, nodes that are within MOST of each other are joined by a forest, not by all
   pairs. The components of these forests are candidate clusters: no link leaves its cluster.
4. Clusters are verified on full shingle sets: a cluster is cut into blocks of about ``GRID`` nodes, and each
   pair of blocks is a task of its own that compares all its sets exactly by matrix products, and again returns a forest.
   The components of the verified links are the result.

Defined cases: null texts and texts without words have an empty set and stay alone; a text of fewer
words than a shingle is one shingle; repeated rows are equal sets; a null doc_id is never the
smallest. Sets hold 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from . import components as C
from . import packing as K
from . import tables as T

SYMBOLS, CHUNK, GRID = 32, 4, 256
MOST = 2 * (SYMBOLS // CHUNK) - 1
_rng = np.random.default_rng(7)
_MULTIPLY = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_FLIP = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64)


def shingles(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted inside each document, and how many each document has."""
    words, _, _, offsets = A.word_hashes(data, at, A.NOT_SPACE, lower=True)
    n = np.diff(offsets)
    where, doc = A.window_rows(offsets, k)
    prefix = A.symbol_prefix(words)
    h = A.window_hashes(prefix, k)[where]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        h = np.concatenate((h, A.span_hashes_of(prefix, offsets[short], offsets[short + 1])))
        doc = np.concatenate((doc, short))
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16) if len(n) < 1 << 16 else doc[order], kind="stable")]
    h, doc = h[order], doc[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
        h, doc = h[new], doc[new]
    return h, np.bincount(doc, minlength=len(n)) if len(doc) else np.zeros(len(n), np.int64)


def signatures(documents: DataFrame, k: int) -> DataFrame:
    """rk, doc_id, n_shingles, node (hash of the set; null if empty), symbols (binary of SYMBOLS uint16)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in A.blocks(batch.column("text")):
                h, n = shingles(data, at, k)
                symbols, node = np.zeros((j - i, SYMBOLS), np.uint16), np.zeros(j - i, np.int64)
                full = np.flatnonzero(n)
                if len(full):
                    first = (np.cumsum(n) - n)[full]
                    for s in range(SYMBOLS):
                        symbols[full, s] = A.mix(np.minimum.reduceat((h ^ _FLIP[s]) * _MULTIPLY[s], first)) >> np.uint64(48)
                    node[full] = (np.add.reduceat(A.mix(h), first) ^ A.mix(n[full].astype(np.uint64))).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("rk").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(n.astype(np.int64)),
                    pa.array(node, mask=n == 0), K.runs_column(symbols.ravel(), np.full(j - i, SYMBOLS)),
                ], names=["rk", "doc_id", "n_shingles", "node", "symbols"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("rk", "doc_id", "text").mapInArrow(sign, f"rk long, doc_id {kind}, n_shingles long, node long, symbols binary")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in K.sliced(whole, 2048):
            symbols = K.joined(batch.column("symbols"), np.uint16).reshape(-1, SYMBOLS)
            node, low = batch.column("node").to_numpy(zero_copy_only=False), (symbols & 0xFF).astype(np.uint8)
            keys = []
            for c in range(SYMBOLS // CHUNK):
                chunk = symbols[:, c * CHUNK : (c + 1) * CHUNK].astype(np.uint64)
                for masked in range(CHUNK):
                    packed = np.full(len(node), c * CHUNK + masked, np.uint64)
                    for s in range(CHUNK):
                        if s != masked:
                            packed = packed << np.uint64(16) | chunk[:, s]
                    keys.append(A.mix(packed))
            m = len(keys)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(node, m)), K.runs_column(np.tile(low, (m, 1)).ravel(), np.full(m * len(node), SYMBOLS)),
            ], names=["key", "node", "low"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(-1) <= MOST


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, nodes, lows = [], [], []
    for b in batches:
        keys.append(b.column("key").to_numpy(zero_copy_only=False))
        nodes.append(b.column("node").to_numpy(zero_copy_only=False))
        lows.append(K.joined(b.column("low"), np.uint8).reshape(-1, SYMBOLS))
    if not keys:
        return
    key, node, low = np.concatenate(keys), np.concatenate(nodes), np.concatenate(lows)
    del keys, nodes, lows
    order = np.argsort(key, kind="stable")
    again = K.times(key[order]) > 1
    order = order[again]
    key, node, low = key[order], node[order], low[order]
    if not len(key):
        return
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((first, [len(key)])))
    pivot = np.repeat(first, size)
    hit = _near(low, low[pivot])
    u, v = [node[hit]], [node[pivot[hit]]]
    missed = np.add.reduceat((~hit).astype(np.int64), first)
    for g in np.flatnonzero((missed > 0) & (size > 2)):
        a, n = first[g], size[g]
        left = np.flatnonzero(~hit[a : a + n]) + a
        queue = list(np.flatnonzero(hit[a : a + n])[1:] + a)
        while len(left):
            if not queue:
                queue, left = [left[0]], left[1:]
            x = queue.pop()
            near = _near(low[left], low[x])
            if near.any():
                u.append(node[left[near]])
                v.append(np.full(int(near.sum()), node[x]))
                queue += list(left[near])
                left = left[~near]
    edges = np.unique(np.stack((np.concatenate(u), np.concatenate(v)), 1), axis=0)
    edges = edges[edges[:, 0] != edges[:, 1]]
    yield from K.sliced(pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["u", "v"]), 10_000)


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets are linked: a boolean matrix."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        shared = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))]] * 2)
        shared[1] = shared[0][::-1]
    else:
        values, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        column = np.cumsum(np.concatenate(([True], values[1:] != values[:-1]))) - 1
        seen = np.bincount(column)
        some = seen[column] > 1
        column = np.unique(column[some], return_inverse=True)[1]
        owner = owner[some]
        shared = np.zeros((n, n), np.float64)
        width = 8192
        edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + width + 1, width))
        for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            m = np.zeros((n, width), np.float32)
            m[owner[a:b], column[a:b] - c * width] = 1
            shared += m @ m.T
    union = sizes[:, None] + sizes[None, :] - shared
    out = (100 * shared >= percent * union) & (union > 0)
    np.fill_diagonal(out, False)
    return out


def _forest_of(links: np.ndarray) -> list[tuple[int, int]]:
    left, out = np.ones(len(links), bool), []
    for start in range(len(links)):
        if not left[start]:
            continue
        left[start], queue = False, [start]
        while queue:
            x = queue.pop()
            new = np.flatnonzero(links[x] & left)
            left[new] = False
            out += [(x, int(y)) for y in new]
            queue += new.tolist()
    return out


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, node, held = [], [], []
        for batch in batches:
            task.append(batch.column("task").to_numpy(zero_copy_only=False))
            node.append(batch.column("node").to_numpy(zero_copy_only=False))
            for _, _, data, at in A.blocks(batch.column("text")):
                h, n = shingles(data, at, k)
                held += np.split(h, np.cumsum(n)[:-1])
        if not task:
            return
        task, node = np.concatenate(task), np.concatenate(node)
        order = np.argsort(task, kind="stable")
        edges = np.flatnonzero(np.concatenate(([True], np.diff(task[order]) != 0, [True])))
        u, v = [], []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = order[a:b]
            own = own[np.unique(node[own], return_index=True)[1]]
            if len(own) > 1:
                for x, y in _forest_of(_linked([held[i] for i in own], percent)):
                    u.append(node[own[x]])
                    v.append(node[own[y]])
        yield from K.sliced(pa.RecordBatch.from_arrays([pa.array(np.array(u, np.int64)), pa.array(np.array(v, np.int64))], names=["u", "v"]), 10_000)

    return run


def clustered(documents: DataFrame, k: int = 5, percent: int = 80, parts: int | None = None) -> DataFrame:
    """documents: doc_id, text, ... -> rk, doc_id, n_shingles, component (null for empty sets), component_id (the smallest doc_id reachable)."""
    spark = documents.sparkSession
    parts = parts or T.scale(spark, documents)
    keyed = documents.withColumn("rk", T.row_key(["doc_id", "text"]))
    signed = T.checkpoint(signatures(keyed, k))
    nodes = signed.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("rk").alias("rk"), F.first("symbols").alias("symbols"))
    index = nodes.select("node", "symbols").mapInArrow(_index, "key long, node long, low binary")
    clusters = C.labels(index.repartition(parts, "key").mapInArrow(_forests, "u long, v long"))
    clusters = T.checkpoint(clusters.withColumnsRenamed({"u": "node", "component": "cluster"}))
    T.release(spark)
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / GRID).cast("int").alias("blocks"), F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    placed = T.join_counted(clusters, sizes, "cluster", clusters.count()).withColumn("block", block).join(nodes.select("node", "rk"), "node")
    texts = keyed.select("rk", "text").join(placed, "rk")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    tasks = texts.select("node", "text", F.explode(F.transform(others, lambda o: F.xxhash64("cluster", F.least("block", o), F.greatest("block", o)))).alias("task"))
    links = tasks.repartition(parts, "task").mapInArrow(_verify(k, percent), "u long, v long")
    found = C.labels(links).withColumnsRenamed({"u": "node"})
    joined = T.checkpoint(nodes.select("node", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    of_node = T.join_counted(joined, least, "component", joined.count()).select("node", "component", "component_id")
    return signed.drop("symbols").join(of_node, "node", "left").select("rk", "doc_id", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, parts: int | None = None) -> DataFrame:
    """documents: doc_id, text, ... -> rk, doc_id, n_shingles, component_id (the smallest doc_id reachable)."""
    return clustered(documents, k, percent, parts).drop("component")


def keep_one(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each near-duplicate group, the first by doc_id (null ids last), and all rows with an empty set."""
    rows = clustered(documents, k, percent).filter("component is not null")
    each = rows.groupBy("rk").agg(F.first("component").alias("component"), F.first("doc_id").alias("doc_id"), F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk"))
    # firsts and others meet by their own keys, never by their component
    chosen = each.groupBy("component").agg(first.alias("first")).select(F.col("first.rk").alias("rk"), F.lit(True).alias("kept"))
    marked = T.checkpoint(each.join(chosen, "rk", "left").filter("kept IS NULL OR n > 1").select(F.col("rk").alias(T.KEY), F.col("kept").isNotNull().alias("kept")))
    keyed = documents.withColumn(T.KEY, T.row_key(["doc_id", "text"]))
    others = keyed.join(marked.select(T.KEY), T.KEY, "left_anti").drop(T.KEY)
    # rows that repeat doc_id and text: one of them
    again = keyed.join(marked.filter("kept"), T.KEY, "left_semi").groupBy(T.KEY).agg(F.min(F.struct(*documents.columns)).alias("row"))
    return others.unionByName(again.select("row.*"))
