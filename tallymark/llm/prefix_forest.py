"""Approximate nearest neighbours (largest inner product) by a hash-prefix forest.

Each of ``TREES`` trees keeps all distinct vectors sorted by a string of ``BITS`` hash bits: signs of random projections
of the vectors, to which one component is added that makes their lengths equal (so the largest inner product is the
smallest angle). Trees are cut at variable-length prefixes into shards of about ``SHARD`` numbers each, as the counts of prefixes
tell; a prefix that is too full and can't be cut any more is dealt to several shards by hash, so no shard grows with the number of
vectors in one direction.

A query descends in every tree to its longest match. First all trees report how many vectors share each
length of prefix with the query (short lengths from the counts of prefixes, longer ones from its shards; codes alone are sent for that);
added up, these give the length to which all trees ascend together until enough candidates are in reach. How many are enough follows from
the data: ``SAMPLE`` queries are compared with all vectors, block by block, which tells how many candidates their true neighbours
take; the forest's number is that at which the share ``RECALL`` of them is found. A query then goes to every shard that its ascended prefix
covers, so shards bound a task's memory and nothing else. Each shard scores its part in double precision, block by block, and
the best of all trees are merged. A query that has ascended to the root of the trees is scored in one of them only, as each holds all vectors.

Equal vectors are one entry with their k + 1 smallest ids: more can't be among the k nearest. Defined cases: vectors that are null,
empty, zero or hold null or non-finite components, and rows with a null id, take no part; rows that repeat an id and
vector are one; only vectors of one dimension are compared; ties go to the smaller id; a table without such vectors or without queries gives
no rows; columns besides id and v are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from . import packing as K
from . import tables as T

TREES, BITS = 16, 32
#: Numbers (vectors times dimension) of a shard.
SHARD = 1 << 22
#: Queries compared with all vectors to set the number of candidates, and the share of their neighbours that it should reach.
SAMPLE, RECALL = 128, 0.95


def usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0)


def planes(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim + 1, TREES * BITS))


def codes(vectors: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash strings, as numbers: vectors x trees."""
    signs = np.concatenate((vectors, last[:, None]), 1) @ planes(vectors.shape[1]) > 0
    packed = np.packbits(signs.reshape(len(vectors), TREES, BITS), axis=2)
    return packed.reshape(len(vectors), TREES, 4).astype(np.int64) @ (np.int64(256) ** np.arange(3, -1, -1, dtype=np.int64))


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two hash strings."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _vectors(column: pa.Array) -> np.ndarray:
    return _numbers(column).astype(np.float64)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def by_dimension(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows with vectors of one dimension."""
    for whole in batches:
        for batch in K.sliced(whole, rows):
            dims = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                yield batch.filter(pa.array(dims == d))


def coded(vectors: DataFrame, longest: float | None) -> DataFrame:
    """The columns of ``vectors`` (v among them) and ``codes``. longest: the greatest length, to which the others are filled up; None for queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_dimension(batches, 2048):
            v = _vectors(b.column("v"))
            last = np.zeros(len(v)) if longest is None else np.sqrt(np.maximum(longest**2 - (v * v).sum(1), 0))
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(codes(v, last))], names=[*b.schema.names, "codes"])

    return vectors.mapInArrow(run, StructType([*vectors.schema.fields, StructField("codes", ArrayType(LongType()))]))


@dataclass(frozen=True)
class Trees:
    """The trees of the vectors of one dimension, cut at prefixes of ``bits`` bits and less."""

    bits: int
    shard: np.ndarray  # trees x 2**bits: the first shard of each prefix
    split: np.ndarray  # trees x 2**bits: the number of shards that a prefix is dealt to
    before: np.ndarray  # trees x (2**bits + 1): how many vectors stand before each prefix

    def prefix(self, code):
        return code >> BITS - self.bits

    def shared(self, code: np.ndarray) -> np.ndarray:
        """How many vectors share each length of prefix up to ``bits`` bits, all trees together; 0 for longer ones. code: rows x trees."""
        n = np.zeros((len(code), BITS + 1), np.int64)
        prefix = self.prefix(code)
        for d in range(self.bits + 1):
            low = prefix >> self.bits - d << self.bits - d
            for t in range(TREES):
                n[:, d] += self.before[t, low[:, t] + (1 << self.bits - d)] - self.before[t, low[:, t]]
        return n

    def covered(self, tree: int, code: int, level: int) -> np.ndarray:
        """The shards of the vectors that share ``level`` bits with a code."""
        prefix = self.prefix(code)
        low = prefix >> max(0, self.bits - level) << max(0, self.bits - level)
        high = low + (1 << max(0, self.bits - level))
        first = self.shard[tree, low:high]
        starts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        return np.concatenate([np.arange(s, s + m) for s, m in zip(first[starts].tolist(), self.split[tree, low:high][starts].tolist(), strict=True)])


def trees_of(counts: np.ndarray, bits: int, limit: int, first: int) -> tuple[Trees, int]:
    """counts: trees x 2**bits. Shards are numbered from ``first``: the shortest prefixes with at most ``limit`` vectors; also the next free number."""
    shard, split = np.zeros(counts.shape, np.int32), np.ones(counts.shape, np.int32)
    before = np.concatenate((np.zeros((TREES, 1), np.int64), np.cumsum(counts, 1)), 1)
    for tree in range(TREES):
        todo = [(0, 1 << bits)]
        while todo:
            a, b = todo.pop()
            n = before[tree, b] - before[tree, a]
            if b - a > 1 and n > limit:
                todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
            else:
                shard[tree, a:b], split[tree, a:b] = first, max(1, -(-n // limit))
                first += int(split[tree, a])
    return Trees(bits, shard, split, before), first


def _by_shard(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[dict, dict]]:
    """(index, some of the queries) of each shard, as arrays, the index sorted by code. Batches come sorted by shard, the index before the queries, of which
    ``rows`` at most are held at once."""
    current, held, index = None, [], None
    for whole in batches:
        shard, query = _column(whole, "shard"), _column(whole, "query")
        runs = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (query[1:] != query[:-1]), [True])))
        for a, b in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
            if not query[a]:
                if shard[a] != current:
                    current, held = shard[a], []
                held.append(whole.slice(a, b - a))
                index = None
            elif shard[a] == current:
                if index is None:
                    index = _arrays(pa.Table.from_batches(held), sort=True)
                for part in K.sliced(whole.slice(a, b - a), rows):
                    yield index, _arrays(pa.Table.from_batches([part]))


def _arrays(t: pa.Table, sort: bool = False) -> dict:
    t = t.combine_chunks()
    out = {c: _numbers(t[c].combine_chunks()) if c == "v" else t[c].to_numpy() for c in t.column_names}
    if sort:
        order = np.lexsort((out["id"], out["code"]))
        out = {c: x[order] for c, x in out.items()}
    return out


def _reach(index: dict, code: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the index that share the first ``level`` bits with each code."""
    width = np.int64(1) << (BITS - level).astype(np.int64)
    low = code // width * width
    return np.searchsorted(index["code"], low), np.searchsorted(index["code"], low + width)


def _counted(ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), _lists(n)], names=["id", "n"])


def _count(bits_of):
    """How many vectors of a shard share more bits with each query than the counts of prefixes tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, queries in _by_shard(batches, 4096):
            n = np.zeros((len(queries["id"]), BITS + 1), np.int64)
            for d in range(BITS, 0, -1):
                low, high = _reach(index, queries["code"], np.full(len(n), d))
                n[:, d] = np.where(d > bits_of(queries["dim"]), high - low, 0)
            yield _counted(queries["id"], n)

    return run


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, queries in _by_shard(batches, 4096):
            low, high = _reach(index, queries["code"], queries["level"])
            order = np.lexsort((high, low))
            cuts = np.flatnonzero(np.concatenate(([True], (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0), [True])))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):  # queries that reach the same rows
                x, y = int(low[order[a]]), int(high[order[a]])
                for i in range(a, b, 256) if y > x else ():
                    group = order[i : min(b, i + 256)]
                    q, row, score = best(index["v"], index["least"], x, y, queries["v"][group].astype(np.float64), k + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(queries["id"][group][q]), pa.array(index["id"][row]), pa.array(index["least"][row]), pa.array(score)], names=["query_id", "entry", "least", "score"])

    return run


def best(vectors: np.ndarray, least: np.ndarray, low: int, high: int, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k rows low..high with the largest inner product, for each query, ties to the smaller ``least``: query, row, score.

    Rows are chosen by matrix products, with a margin for their rounding, and scored again one by one."""
    held_q, held_r, held_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    lengths = np.sqrt((queries * queries).sum(1))
    for at in range(low, high, 8192):
        block = vectors[at : min(high, at + 8192)].astype(np.float64)
        s = queries @ block.T
        margin = 1e-12 * lengths * np.sqrt((block * block).sum(1).max())
        edge = np.partition(s, -k, axis=1)[:, -k] - margin if s.shape[1] > k else np.full(len(s), -np.inf)
        q, r = np.nonzero(s >= edge[:, None])
        q, r, s = np.concatenate((held_q, q)), np.concatenate((held_r, r + at)), np.concatenate((held_s, np.einsum("ij,ij->i", block[r], queries[q])))
        order = np.lexsort((least[r], -s, q))
        q, r, s = q[order], r[order], s[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        held_q, held_r, held_s = q[keep], r[keep], s[keep]
    return held_q, held_r, held_s


def _truth(sample: dict[int, tuple], k: int):
    """sample: by dimension, numbers, entries, vectors and codes of queries. The best k other entries of a partition for each: query number, score, the most bits it shares in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for b in by_dimension(batches, 4096):
            v = _numbers(b.column("v"))
            dim = v.shape[1]
            if dim not in sample:
                continue
            number, own, queries, code = sample[dim]
            q, r, s = best(v, _column(b, "id"), 0, len(v), queries, k + 1)
            entry, codes_ = _column(b, "id")[r], _numbers(b.column("codes"))[r]
            other = entry != own[q]
            q, s, bits = q[other], s[other], shared_bits(codes_[other], code[q[other]]).max(1)
            if dim in held:
                q, s, bits = (np.concatenate(x) for x in zip(held[dim], (q, s, bits), strict=True))
            order = np.lexsort((-s, q))
            q, s, bits = q[order], s[order], bits[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            held[dim] = q[keep], s[keep], bits[keep]
        for dim, (q, s, bits) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(sample[dim][0][q]), pa.array(s), pa.array(bits.astype(np.int32))], names=["q", "score", "bits"])

    return run


def enough(needed: np.ndarray, recall: float) -> int:
    """The number of candidates at which the share ``recall`` of the neighbours is in reach."""
    return int(np.sort(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL, shard: int = SHARD, sample: int = SAMPLE, candidates: int | None = None) -> DataFrame:
    """vectors: id, v (array of floats) -> query_id, rank, id, score for the rows that are queries.
    candidates: their number for each query, if it is not to follow from a sample."""
    spark = vectors.sparkSession
    rows = T.checkpoint(vectors.filter(F.col("id").isNotNull() & usable(F.col("v"))).select("id", "v", F.xxhash64("v").alias("entry"), is_query.alias("query")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    longest = rows.agg(F.max(norm)).first()[0]
    if longest is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(0.0).alias("score")).filter("false")
    # Spark limits the rank below the shuffle too, so a vector that many rows share sends k + 1 ids from a task
    ids = rows.select("entry", "id").distinct().withColumn("r", F.row_number().over(W.partitionBy("entry").orderBy("id"))).filter(F.col("r") <= k + 1).select("entry", F.col("id").alias("member"))
    entries = T.checkpoint(coded(rows.groupBy("entry").agg(F.min("id").alias("least"), F.first("v").alias("v")).select(F.col("entry").alias("id"), "least", "v"), longest))
    asked = T.checkpoint(coded(rows.filter("query").select("id", "entry", "v").dropDuplicates(["id"]), None))
    spark_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    sizes = {r.dim: r.n for r in entries.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}  # a row for each dimension
    bits = {d: int(np.clip(np.ceil(np.log2(max(1, n * d / shard))) + 4, 8, 16)) for d, n in sizes.items()}
    bits_column = F.element_at(F.create_map(*(F.lit(x) for item in bits.items() for x in item)), F.size("v"))
    seen = entries.select(F.size("v").alias("dim"), bits_column.alias("bits"), F.posexplode("codes").alias("tree", "code")).groupBy("dim", "tree", F.expr(f"shiftright(code, {BITS} - bits)").cast("int").alias("p")).count().toArrow()
    dims, tree, p, n = (seen[c].to_numpy() for c in ("dim", "tree", "p", "count"))
    forest, shards = {}, 0
    for d in sizes:
        counts = np.zeros((TREES, 1 << bits[d]), np.int64)
        counts[tree[dims == d], p[dims == d]] = n[dims == d]
        forest[d], shards = trees_of(counts, bits[d], max(1, shard // d), shards)
    lookup = spark.sparkContext.broadcast(forest)
    parts = max(spark_parts, shards // 4)

    def index_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_dimension(batches, 8192):
            yield from placed(b, lookup.value)[0]

    def placed(b: pa.RecordBatch, trees: dict[int, Trees]) -> tuple[list[pa.RecordBatch], list[np.ndarray]]:
        """The rows of entries, tree by tree, with their shards."""
        code, entry, dim = _numbers(b.column("codes")), _column(b, "id"), b.column("v").value_lengths()[0].as_py()
        out, where = [], []
        for t in range(TREES):
            prefix = trees[dim].prefix(code[:, t])
            s = trees[dim].shard[t, prefix] + (entry % trees[dim].split[t, prefix]).astype(np.int32)
            where.append(s)
            out.append(pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.zeros(len(s), bool)), b.column("id"), pa.array(code[:, t]), pa.array(np.full(len(s), dim, np.int32))], names=["shard", "query", "id", "code", "dim"]))
        return out, where

    def query_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_dimension(batches, 1024):
            code, dim = _numbers(b.column("codes")), b.column("v").value_lengths()[0].as_py()
            if dim in lookup.value:
                trees = lookup.value[dim]
                found = [(r, s, c) for t in range(TREES) for r, c in enumerate(code[:, t].tolist()) for s in trees.covered(t, c, trees.bits).tolist()]
                r, s, c = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(np.ones(len(s), bool)), b.column("id").take(pa.array(r)), pa.array(c), pa.array(np.full(len(s), dim, np.int32))], names=["shard", "query", "id", "code", "dim"])

    def from_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_dimension(batches, 4096):
            dim = b.column("v").value_lengths()[0].as_py()
            if dim in lookup.value:
                yield _counted(_column(b, "id"), lookup.value[dim].shared(_numbers(b.column("codes"))))

    lean = "shard int, query boolean, id long, code long, dim int"
    by_shard = lambda df: df.repartition(parts, "shard").sortWithinPartitions("shard", "query")
    both = entries.mapInArrow(index_codes, lean).unionByName(asked.mapInArrow(query_codes, lean))
    counted = by_shard(both).mapInArrow(_count(lambda dim: np.array([lookup.value[int(d)].bits for d in dim])), "id long, n array<long>").unionByName(asked.mapInArrow(from_prefixes, "id long, n array<long>"))
    counted = counted.groupBy("id").agg(F.array(*(F.sum(F.element_at("n", d + 1)) for d in range(BITS + 1))).alias("n"))
    levels = T.checkpoint(asked.select("id", F.size("v").alias("dim")).join(counted, "id"))

    reach = dict.fromkeys(forest, candidates)
    if candidates is None:
        drawn = asked.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(sample).toArrow()
        held, lengths = {}, drawn["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(lengths).tolist():
            own = drawn.filter(pa.array(lengths == d)).combine_chunks()
            held[d] = np.flatnonzero(lengths == d), own["entry"].to_numpy(), _vectors(own["v"].combine_chunks()), _numbers(own["codes"].combine_chunks())
        shared = spark.sparkContext.broadcast(held)
        truth = entries.mapInArrow(lambda batches: _truth(shared.value, k)(batches), "q long, score double, bits int")
        truth = truth.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("r") <= k).toArrow()
        drawn_ids = drawn["id"].to_numpy()
        n_of = {r.id: r.n for r in levels.filter(F.col("id").isin(drawn_ids.tolist())).collect()}
        needed = np.array([([*n_of[int(drawn_ids[q])], 0])[b + 1] + 1 for q, b in zip(truth["q"].to_pylist(), truth["bits"].to_pylist(), strict=True)], np.int64)
        of = lengths[truth["q"].to_numpy()] if len(needed) else np.zeros(0, int)
        reach = {d: enough(needed[of == d], recall) for d in forest}

    wanted = F.element_at(F.create_map(*(F.lit(x) for d, c in reach.items() for x in (d, int(c)))), F.col("dim"))
    level = F.greatest(*(F.when(F.element_at("n", d + 1) >= wanted, d).otherwise(0) for d in range(BITS + 1))).cast("int")
    deep = asked.join(levels.select("id", level.alias("level")), "id")
    shape = f"shard int, query boolean, id long, least long, v {dict(entries.dtypes)['v']}, code long, level int"
    names = ["shard", "query", "id", "least", "v", "code", "level"]

    def index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_dimension(batches, 2048):
            parts_, where = placed(b, lookup.value)
            for part, s in zip(parts_, where, strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(s), part.column("query"), b.column("id"), b.column("least"), b.column("v"), part.column("code"), pa.array(np.zeros(len(s), np.int32))], names=names)

    def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_dimension(batches, 256):
            code, dim, level = _numbers(b.column("codes")), b.column("v").value_lengths()[0].as_py(), _column(b, "level").tolist()
            trees = lookup.value[dim]
            found = [(r, s, int(code[r, t])) for r, d in enumerate(level) for t in range(TREES if d else 1) for s in trees.covered(t, int(code[r, t]), d).tolist()]
            for i in range(0, len(found), 8192):
                r, s, c = np.array(found[i : i + 8192], np.int64).T
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(np.ones(len(s), bool)), b.column("id").take(at), b.column("id").take(at), b.column("v").take(at), pa.array(c), b.column("level").take(at)], names=names)

    found = by_shard(entries.mapInArrow(index_rows, shape).unionByName(deep.mapInArrow(query_rows, shape))).mapInArrow(_score(k), "query_id long, entry long, least long, score double")
    merged = found.groupBy("query_id", "entry").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    merged = merged.withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "least"))).filter(F.col("r") <= k + 1)
    ranked = merged.join(ids, "entry").filter("member <> query_id").withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "member")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("member").alias("id"), "score")
