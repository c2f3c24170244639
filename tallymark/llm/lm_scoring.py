"""Language-model scoring: a unigram base score, and a probabilistic suffix tree over bytes.

Tokens: counts of all tokens (as 64-bit hashes) stay a distributed table, with how often they stand in training texts. The most frequent
tokens of all texts, ``HOT`` at most, are broadcast and scored in the pass over the texts; all other
tokens meet their counts in a shuffle join, in which no key is hot any more, whichever texts held it.

Suffix tree: next-byte counts are taken after each context of ``DEPTH`` bytes of all training texts (A-Z
lower-cased; a text begins after NULs and ends with an end symbol) and summed up for its
suffixes. A context is a candidate if it occurs ``LEAST`` times, so their number grows with the corpus; it is retained if its
next-byte distribution diverges from that of its suffix by at least ``GAIN`` nats in all, or for a longer one that is. A distribution is
smoothed towards that of its suffix. A text is scored with the longest retained suffix at each place.

The tree is a distributed table. Contexts meet by their last ``TOP`` bytes, below which a subtree needs nothing but the distributions
of its top. For scoring it is broadcast in slices of about ``SLICE`` rows, of which a task holds one at a time; every
place is scored in the slice of its last TOP bytes, so the slices together are the whole tree. A task resolves a context and symbol
that its texts repeat once, as long as its table of 1 << ``MEMO`` rows holds it.

Defined cases: null and empty texts are the end symbol alone; without training rows all
distributions are uniform; repeated rows are counted and scored each on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import arrays as A
from . import packing as K
from . import tables as T

HOT, DEPTH, TOP, LEAST, GAIN, PRIOR = 400_000, 6, 2, 32, 30.0, 4.0
SLICE = 4_000_000
END, SYMBOLS = 256, 257
MEMO = 22
_LOWER = A._LOWER.astype(np.uint8)


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted; by a sort, which takes a fraction of the time of numpy's hash table for so many keys."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


def _counter(keys_of, name: str):
    """Counts keys over a partition, merging as it goes: emits each key of the partition once, or once for each few million keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, data, at in A.blocks(batch.column("text")):
                keys = np.sort(keys_of(data, at))
                if not len(keys):
                    continue
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                held.append((keys[first], np.diff(np.concatenate((first, [len(keys)])))))
                size += len(first)
                if size > 3_000_000:
                    held = [_merge(held)]
                    size = len(held[0][0])
                    if size > 1_500_000:
                        yield from out(held.pop())
                        size = 0
        if held:
            yield from out(_merge(held))

    def out(merged):
        yield from K.sliced(pa.RecordBatch.from_arrays([pa.array(merged[0].view(np.int64)), pa.array(merged[1])], names=[name, "n"]), 100_000)

    return run


def token_counts(training: DataFrame, held_out: DataFrame) -> DataFrame:
    """h, c (in the training texts), a (in all) of all words (not the end)."""
    words = _counter(lambda data, at: A.word_hashes(data, at, A.NOT_SPACE, lower=True)[0], "h")
    sides = [texts.select("text").mapInArrow(words, "h long, n long").withColumn("c", c) for texts, c in ((training, F.col("n")), (held_out, F.lit(0).cast("long")))]
    return T.union(sides).groupBy("h").agg(F.sum("c").alias("c"), F.sum("n").alias("a"))


def frequent_tokens(counts: DataFrame, most: int) -> DataFrame:
    """The tokens above a count (in all texts) that leaves at most ``most`` of them; the cut is found in a histogram of a few hundred classes."""
    klass = F.floor(F.log2("a") * 16)
    rows = {r.k: r.n for r in counts.groupBy(klass.alias("k")).agg(F.count("*").alias("n")).collect()}
    cut, total = max(rows, default=0) + 1, 0
    for k in sorted(rows, reverse=True):
        total += rows[k]
        if total > most:
            break
        cut = k
    return counts.filter(klass >= cut)


def context_keys(data: np.ndarray, at: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """context << 9 | next of every place (all bytes and the ends), and the offsets of the documents in those."""
    docs, sizes = len(at) - 1, np.diff(at)
    begins = at[:-1] + np.arange(docs) * (DEPTH + 1)
    ends = begins + DEPTH + sizes
    # each document after DEPTH NULs, and with one byte for its end
    inside = np.ones(len(data) + docs * (DEPTH + 1), bool)
    inside[(begins[:, None] + np.arange(DEPTH)).ravel()] = inside[ends] = False
    padded = np.zeros(len(inside) + 8, np.uint8)
    padded[: len(inside)][inside] = _LOWER[data]
    inside[ends] = True
    # the 8 bytes from each place on, as one number: DEPTH of context, the next one, and one that is not asked for
    eight = np.ndarray(max(0, len(inside) - DEPTH), ">u8", padded, 0, (1,)).astype(np.int64)[inside[DEPTH:]]
    keys = eight >> 16
    keys &= (1 << 8 * depth) - 1
    keys <<= 9
    eight >>= 8
    eight &= 255
    keys |= eight
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
    keys[offsets[1:] - 1] |= END
    return keys, offsets


def context_counts(training: DataFrame, depth: int = DEPTH) -> DataFrame:
    """context (the last ``depth`` bytes, the latest in the lowest), next, n; a row for each map task that holds them, or more."""
    counted = training.select("text").mapInArrow(_counter(lambda data, at: context_keys(data, at, depth)[0], "k"), "k long, n long")
    return counted.select(F.shiftright("k", 9).alias("context"), F.col("k").bitwiseAND(511).cast("int").alias("next"), "n")


@dataclass(frozen=True)
class Tree:
    """Retained contexts but the root, and what was seen after them; of anything else the suffix's probability counts, times ``back``."""

    root: np.ndarray  # log10 probabilities of all symbols
    nodes: np.ndarray  # sorted: level << 48 | context
    back: np.ndarray  # log10 of the weight of the suffix, by node
    keys: np.ndarray  # sorted: level << 57 | context << 9 | next
    logs: np.ndarray  # log10 probabilities, by key

    @property
    def table(self) -> np.ndarray:
        """Dense rows: none, the root, and each node."""
        out = np.zeros((len(self.nodes) + 2, SYMBOLS))
        out[1] = self.root
        for i, node in enumerate(self.nodes.tolist(), 2):
            level, context = node >> 48, node & (1 << 48) - 1
            up = np.searchsorted(self.nodes, level - 1 << 48 | _suffix(context, level - 1)) + 2 if level > 1 else 1
            out[i] = out[up] + self.back[i - 2]
            a, b = np.searchsorted(self.keys, [node << 9, node + 1 << 9])
            out[i, self.keys[a:b] & 511] = self.logs[a:b]
        return out


def _suffix(context, level: int):
    return context & (1 << 8 * level) - 1


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _merge([(keys, n)]) if len(keys) else (keys, n)


def _levels(keys: np.ndarray, n: np.ndarray, depth: int, top: int, above: tuple[np.ndarray, np.ndarray], least: int, gain: float) -> list[tuple]:
    """Levels top + 1 to depth of the subtrees that ``keys`` (sorted: context << 9 | next) are all counts of. Per level: its keys (of
    candidates), their probabilities, its contexts, their totals, and which diverge; ``above``: keys and probabilities of level top."""
    held = {}
    for d in range(depth, top, -1):
        keys, n = _summed(_suffix(keys >> 9, d) << 9 | keys & 511, n)
        held[d] = keys, n
    out = []
    for d in range(top + 1, depth + 1):
        keys, n = held[d]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] >> 9 != keys[:-1] >> 9))) if len(keys) else np.zeros(0, int)
        total = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
        of = np.repeat(total, np.diff(np.concatenate((first, [len(keys)]))))
        enough = of >= least
        keys, n, of = keys[enough], n[enough], of[enough]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] >> 9 != keys[:-1] >> 9))) if len(keys) else np.zeros(0, int)
        # a candidate's suffix is one, and has been seen before all that the candidate has
        parent = above[1][np.searchsorted(above[0], _suffix(keys >> 9, d - 1) << 9 | keys & 511)] if len(keys) else np.zeros(0)
        q = (n + PRIOR * parent) / (of + PRIOR)
        gained = np.add.reduceat(n * np.log(n / of / parent), first) if len(first) else np.zeros(0)
        out.append((keys, q, keys[first] >> 9, of[first], gained >= gain))
        above = keys, q
    return out


def _retained(levels: list[tuple], top: int, below: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """nodes, back, keys, logs of each level, the deepest first; ``below``: contexts of the level after the last of which one is retained."""
    out = []
    for d in range(top + len(levels), top, -1):
        keys, q, contexts, total, own = levels[d - top - 1]
        own = own | np.isin(contexts, _suffix(below, d))
        below = contexts[own]
        seen = own[np.searchsorted(contexts, keys >> 9)] if len(contexts) else np.zeros(0, bool)
        out.append((d << 48 | below, np.log10(PRIOR / (total[own] + PRIOR)), d << 57 | keys[seen], np.log10(q[seen])))
    return out


def grow_slices(counts: DataFrame, pairs: DataFrame | None = None, depth: int = DEPTH, least: int = LEAST, gain: float = GAIN, most: int = SLICE) -> Iterator[Tree]:
    """The tree, in slices by ``slice_of``. counts: those of ``context_counts``; pairs: those of the last TOP bytes, if they are at hand."""
    pairs = counts.select(F.col("context").bitwiseAND((1 << 8 * TOP) - 1).alias("context"), "next", "n") if pairs is None else pairs
    k = F.shiftleft("context", 9).bitwiseOR(F.col("next")).alias("k")
    rows = pairs.groupBy(k).agg(F.sum("n").alias("n")).toArrow()  # at most 65,536 contexts
    keys, n = _summed(rows["k"].to_numpy(), rows["n"].to_numpy())
    v = np.bincount(keys & 511, weights=n, minlength=SYMBOLS)
    root = (v + 0.5) / (v.sum() + 0.5 * SYMBOLS)
    first = _levels(keys, n, TOP, 0, (np.arange(SYMBOLS), root), least, gain)
    spark = counts.sparkSession
    above = spark.sparkContext.broadcast(first[-1][:2])

    def deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("k").to_numpy(), batch.column("n").to_numpy()))
            size += batch.num_rows
            if size > 3_000_000 and size > 2 * len(held[0][0]):
                held = [_merge(held)]
                size = len(held[0][0])
        if held:
            keys, n = _merge(held)
            held.clear()
            for nodes, back, keys, logs in _retained(_levels(keys, n, depth, TOP, above.value, least, gain), TOP, np.zeros(0, np.int64)):
                yield from K.sliced(pa.RecordBatch.from_arrays([pa.array(nodes << 9), pa.array(back), pa.array(np.ones(len(nodes), bool))], names=["k", "log", "node"]), 100_000)
                yield from K.sliced(pa.RecordBatch.from_arrays([pa.array(keys), pa.array(logs), pa.array(np.zeros(len(keys), bool))], names=["k", "log", "node"]), 100_000)

    tops = F.col("context").bitwiseAND((1 << 8 * TOP) - 1)
    # each context and symbol once, over all map tasks, before those of one top meet
    whole = counts.groupBy("context", "next").agg(F.sum("n").alias("n"))
    dealt = whole.select(k, "n", tops.alias("top")).repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), T.scale(spark, counts)), "top").select("k", "n")
    rows = T.checkpoint(dealt.mapInArrow(deep, "k long, log double, node boolean"))
    T.release(spark)
    context = F.shiftright("k", 9).bitwiseAND((1 << 48) - 1)
    below = rows.filter("node").select(context.bitwiseAND((1 << 8 * TOP) - 1).alias("c")).distinct().toArrow()["c"].to_numpy()
    upper = _retained(first, 0, below)
    slices = max(1, -(-rows.count() // most))
    for i in range(slices):
        # one slice at a time is on the driver
        own = rows.filter(context.bitwiseAND((1 << 8 * TOP) - 1) % slices == i).toArrow()
        at, log, is_node = (own[c].to_numpy() for c in ("k", "log", "node"))
        nodes, back = np.concatenate([at[is_node] >> 9] + [x[0] for x in upper]), np.concatenate([log[is_node]] + [x[1] for x in upper])
        keys, logs = np.concatenate([at[~is_node]] + [x[2] for x in upper]), np.concatenate([log[~is_node]] + [x[3] for x in upper])
        by_node, by_key = np.argsort(nodes), np.argsort(keys)
        yield Tree(np.log10(root), nodes[by_node], back[by_node].astype(np.float32), keys[by_key], logs[by_key].astype(np.float32))


def grow(counts: DataFrame, depth: int = DEPTH, least: int = LEAST, gain: float = GAIN) -> Tree:
    """The tree in one piece."""
    return next(grow_slices(counts, None, depth, least, gain, 1 << 62))


def resolve(tree: Tree, wanted: np.ndarray) -> np.ndarray:
    """log10 probability of each of ``wanted`` (context << 9 | next, sorted), by the longest retained suffix."""
    context, out = wanted >> 9, np.zeros(len(wanted))
    left, found = np.arange(len(wanted)), []
    for d in range(1, DEPTH + 1):
        node = d << 48 | _suffix(context[left], d)
        at = np.minimum(np.searchsorted(tree.nodes, node), max(0, len(tree.nodes) - 1))
        hit = tree.nodes[at] == node if len(tree.nodes) else np.zeros(len(node), bool)
        left = left[hit]
        if not len(left):
            break
        found.append((left, at[hit]))
    still = np.ones(len(wanted), bool)
    for d in range(len(found), 0, -1):
        rows, at = found[d - 1]
        rows, at = rows[still[rows]], at[still[rows]]
        key = d << 57 | _suffix(context[rows], d) << 9 | wanted[rows] & 511
        place = np.minimum(np.searchsorted(tree.keys, key), len(tree.keys) - 1)
        hit = tree.keys[place] == key
        out[rows[hit]] += tree.logs[place[hit]]
        still[rows[hit]] = False
        out[rows[~hit]] += tree.back[at[~hit]]
    return out + np.where(still, tree.root[wanted & 511], 0.0)


def tree_scores(tree: Tree, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 probability of each document's bytes and end."""
    keys, offsets = context_keys(data, at)
    distinct, inverse = np.unique(keys, return_inverse=True)
    return np.add.reduceat(resolve(tree, distinct)[inverse], offsets[:-1])


class Resolver:
    """log10 probabilities of keys by the tree (broadcast slices). What has been resolved stays in a table of 1 << ``bits`` rows, where
    each key has one row and takes it over from another's; all other keys are resolved again, so the table's size changes no result.
    Of several slices one is in memory at a time."""

    def __init__(self, slices: list, bits: int = MEMO) -> None:
        self.slices, self.shift = slices, np.uint64(64 - bits)
        self.keys, self.logs = np.zeros(1 << bits, np.int64), np.zeros(1 << bits)
        self.keys[0] = -1  # the row of the key 0, which no other row could stand for
        self.ready = np.zeros(0, np.int64), np.zeros(0)

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * A._BASE >> self.shift).view(np.int64)

    def _keep(self, keys: np.ndarray, logs: np.ndarray) -> None:
        rows = self._rows(keys)
        self.keys[rows], self.logs[rows] = keys, logs

    def prepare(self, texts: pa.Array) -> None:
        """Of several slices, each is read once for all keys of these texts that the table does not hold. Those and what they take the rows
        of are at hand beside the table, which is not changed until the next call."""
        if len(self.slices) == 1:
            return
        held, size = [np.zeros(0, np.int64)], 0
        for _, _, data, at in A.blocks(texts):
            keys = context_keys(data, at)[0]
            held.append(_distinct(keys[self.keys[self._rows(keys)] != keys]))
            size += len(held[-1])
            if size > 2_000_000 and size > 2 * len(held[0]):
                held = [_distinct(np.concatenate(held))]
                size = len(held[0])
        wanted = _distinct(np.concatenate(held))
        mine, logs = _suffix(wanted >> 9, TOP) % len(self.slices), np.zeros(len(wanted))
        for i, one in enumerate(self.slices):
            own = np.flatnonzero(mine == i)
            if len(own):
                logs[own] = resolve(one.value, wanted[own])
                one.__dict__.pop("_value", None)  # read again from its file when it is needed next
        rows = self._rows(wanted)
        gone, had = self.keys[rows], self.logs[rows]
        taken = self._rows(gone) == rows  # a row without a key is not that of its value
        keys = np.concatenate((wanted, gone[taken]))
        order = np.argsort(keys)
        self.ready = keys[order], np.concatenate((logs, had[taken]))[order]
        self._keep(wanted, logs)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        rows = self._rows(keys)
        logs, new = self.logs[rows], np.flatnonzero(self.keys[rows] != keys)
        if len(new):
            distinct, inverse = np.unique(keys[new], return_inverse=True)
            if len(self.slices) == 1:
                found = resolve(self.slices[0].value, distinct)
                self._keep(distinct, found)
            else:
                found = self.ready[1][np.searchsorted(self.ready[0], distinct)]
            logs[new] = found[inverse]
        return logs


def score(documents: DataFrame, held_out: Column, hot: int = HOT, most: int = SLICE) -> DataFrame:
    """documents: doc_id, text -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    keyed = documents.select(T.row_key(["doc_id", "text"]).alias("rk"), "doc_id", held_out.alias("held_out"), "text")
    training = keyed.filter(~F.col("held_out")).select("text")
    counts = T.checkpoint(token_counts(training, keyed.filter("held_out").select("text")))
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = training.count()
    n, v = sums.n + ends, sums.v + (ends > 0)
    z = n + 0.5 * (v + 1)
    top = frequent_tokens(counts, hot).toArrow()
    keys, values = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(keys)
    context = documents.sparkSession.sparkContext
    slices = [context.broadcast(tree) for tree in grow_slices(context_counts(training), context_counts(training, TOP), most=most)]
    shared = context.broadcast((keys[order], np.log10((values[order] + 0.5) / z), values[order] > 0))
    T.release(documents.sparkSession)
    end_score = float(np.log10((ends + 0.5) / z))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, trained = shared.value
        resolved = Resolver(slices)
        for batch in batches:
            resolved.prepare(batch.column("text"))
            for i, j, data, at in A.blocks(batch.column("text"), 1 << 20):
                h, _, _, offsets = A.word_hashes(data, at, A.NOT_SPACE, lower=True)
                words = np.diff(offsets)
                place = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
                known = keys[place] == h if len(keys) else np.zeros(len(h), bool)
                gained = np.concatenate(([0.0], np.cumsum(np.where(known, logs[place] if len(keys) else 0.0, 0.0))))
                seen = np.concatenate(([0], np.cumsum(known & trained[place] if len(keys) else known)))
                doc = np.repeat(np.arange(j - i), words)[~known]
                cold = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=j - i)))).astype(np.int32)), pa.array(h[~known].view(np.int64)))
                places, ends_at = context_keys(data, at)
                yield pa.RecordBatch.from_arrays([
                    batch.column("rk").slice(i, j - i), batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i), pa.array(words + 1),
                    pa.array(seen[offsets[1:]] - seen[offsets[:-1]]), pa.array(gained[offsets[1:]] - gained[offsets[:-1]]), pa.array(np.add.reduceat(resolved(places), ends_at[:-1])), cold,
                ], names=["rk", "doc_id", "held_out", "n_tokens", "hot_known", "hot_score", "score", "cold"])

    more = StructType.fromDDL("n_tokens long, hot_known long, hot_score double, score double, cold array<long>")
    first = T.checkpoint(keyed.mapInArrow(run, StructType([keyed.schema[c] for c in ("rk", "doc_id", "held_out")] + more.fields)))
    scored = first.filter(F.size("cold") > 0).select("rk", F.explode("cold").alias("h")).join(counts.select("h", "c"), "h").select("rk", F.log10((F.col("c") + 0.5) / z).alias("s"), (F.col("c") > 0).cast("long").alias("k"), F.lit(0).alias("row"))
    # repeated rows have one rk, whose sums are divided by their number; a row for each of them is counted beside the join
    marks = first.filter(F.size("cold") > 0).select("rk", F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("k"), F.lit(1).alias("row"))
    tokens = scored.unionByName(marks).groupBy("rk").agg(F.sum("s").alias("cold_score"), F.sum("k").alias("cold_known"), F.sum("row").alias("times"))
    return first.drop("cold").join(tokens, "rk", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce(F.col("cold_known") / F.col("times"), F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce(F.col("cold_score") / F.col("times"), F.lit(0.0)) + end_score).alias("base_score"),
        "score",
    )
