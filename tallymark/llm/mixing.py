"""Mixing sources to target weights as a time-varying curriculum.

Targets: sources share ``share`` times all words by weight; none may pass ``repeat`` times its
own words, and what is over goes to the others by weight until none is above its limit. That
fixed point is the water level L of min(limit, L * weight): sources fill up in the order of
limit / weight, so sums over that order give it without a loop.

Positions: a source's weight schedule g(t) on training time 0..1 is linear; its integral is the
demand D(t) of the source's words up to t. Documents stand in each source in the order of a hash of
their id; a pass over a document begins at a word offset, which, as a part of the source's target, is inverted to its training
position D^-1, in closed form. The mix takes a pass as far as its words are demanded before the end of training, so what a
document gives is the sum over its positions: whole passes over a source first, then a last one up to the target, in which
one document at most is cut. Running sums are taken in levels (prefixes of the hash, then inside a bucket), so
a source with most of the rows is spread over all tasks. Rows carry their own columns along and are range-sorted by position; no key joins them back.

Defined cases: null or empty texts have size 0 and take nothing; rows without an id are ordered by their text's hash; the null source is a source of
its own, ranked last; an empty table gives no rows; repeated rows take part each on their own (which of them is the one that is cut is
open, as they are equal); rows of one id in several sources belong each to its own; columns of the documents keep their names, and a column of the mix
that would clash is named with ``mix_`` before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import tables as T

WORD = r"[^\x20\x09-\x0D]+"
#: By rank of the source, repeating: its weight, and its schedule's slope (-1: early, 1: late).
WEIGHTS = (3, 1, 2)
SLOPES = (-0.8, 0.0, 0.8)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeat: int = 2) -> DataFrame:
    """sizes: source, size -> source, source_size, rank, target. One row for each source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", (F.row_number().over(order) - 1).cast("int")).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    fill = W.orderBy(F.col("source_size") * repeat / F.col("weight"), "rank")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(F.col("source_size") * repeat).over(before), F.lit(0))) / (F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = ranked.withColumn("level", level).withColumn("full", F.col("source_size") * repeat / F.col("weight") <= F.col("level"))
    water = F.max(F.when(~F.col("full"), F.col("level"))).over(W.partitionBy())
    return levelled.withColumn("water", water).select("source", "source_size", "rank", F.when(F.col("full"), F.col("source_size") * F.lit(float(repeat))).otherwise(F.col("water") * F.col("weight")).alias("target"))


def inverse_demand(part: Column, slope: Column) -> Column:
    """t with D(t) = part, for g(t) = 1 + slope * (2t - 1), D(t) = (1 - slope) t + slope t^2."""
    b = 1 - slope
    return F.when(slope == 0, part).otherwise((F.sqrt(b * b + 4 * slope * part) - b) / (2 * slope))


def running(sums: DataFrame, digits: int, step: int = 3) -> DataFrame:
    """sums: _source, _bucket (of ``digits`` digits), n -> _source, _bucket, _base: what stands before each bucket of its source.

    Sums are taken inside prefixes that are ``step`` digits shorter, level by level, so no window holds more than 16 ** step rows."""
    short = max(0, digits - step)
    window = W.partitionBy("_source", F.substring("_bucket", 1, short)).orderBy("_bucket")
    here = sums.select("_source", "_bucket", (F.sum("n").over(window) - F.col("n")).alias("_base"))
    if not short:
        return here
    above = running(sums.groupBy("_source", F.substring("_bucket", 1, short).alias("_bucket")).agg(F.sum("n").alias("n")), short, step).select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), F.col("_base").alias("_before"))
    both = here.join(above, F.col("_source").eqNullSafe(F.col("_s")) & (F.substring("_bucket", 1, short) == F.col("_b")))
    return both.select("_source", "_bucket", (F.col("_base") + F.col("_before")).alias("_base"))


def curriculum(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES, share: float = 1.5, repeat: int = 2, rows_per_bucket: int = 1024, keep: list[str] | None = None) -> DataFrame:
    """documents: doc_id, text, source and more -> doc (a struct of the columns of ``keep``, all if not given; only those are shuffled), size, source_size, target, taken, passes.

    passes: a struct<position, words> for each pass over the document that gives words, in training order."""
    digits = max(1, math.ceil(math.log(max(1, documents.count() / rows_per_bucket), 16)))
    place = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.sha2(F.coalesce("text", F.lit("")), 256))), 256)
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in keep or documents.columns)).alias("doc"), F.col("source").alias("_source"), size_of(F.col("text")).alias("size"), place.alias("_u")).withColumn("_bucket", F.substring("_u", 1, digits))
    sums = T.checkpoint(rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("n")))
    goal = T.checkpoint(targets(sums.select(F.col("_source").alias("source"), F.col("n").alias("size")), weights, share, repeat)).withColumnRenamed("source", "_g")
    base = running(sums, digits).select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), "_base")
    inside = W.partitionBy("_source", "_bucket").orderBy("_u", "size").rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = local.join(base, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))).join(goal, F.col("_source").eqNullSafe(F.col("_g")))
    slope = F.element_at(F.array(*map(F.lit, slopes)), (F.col("rank") % len(slopes) + 1).cast("int"))
    begin = lambda p: p * F.col("source_size") + F.col("_base") + F.col("_local")
    demanded = lambda p: F.least(F.col("size"), F.floor("target") - begin(p)).cast("long")
    passes = F.transform(F.array(*(F.lit(p).cast("long") for p in range(repeat))), lambda p: F.struct(inverse_demand(F.least(F.lit(1.0), begin(p) / F.col("target")), slope).alias("position"), demanded(p).alias("words")))
    placed = placed.withColumn("passes", F.filter(passes, lambda x: x["words"] > 0))
    return placed.select("doc", "size", "source_size", "target", F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"), "passes")


def schedule(documents: DataFrame, **parameters) -> DataFrame:
    """A row for each document, range-sorted by the position of its first pass (those that give nothing last): doc_id, size, source_size, target,
    taken, n_passes, first_position, last_position."""
    placed = curriculum(documents, keep=["doc_id"], **parameters)
    at = lambda i: F.try_element_at("passes", F.lit(i))["position"]
    out = placed.select(F.col("doc")["doc_id"].alias("doc_id"), "size", "source_size", "target", "taken", F.size("passes").alias("n_passes"), at(1).alias("first_position"), at(-1).alias("last_position"))
    order = [F.col("first_position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(documents: DataFrame, **parameters) -> DataFrame:
    """One row for each pass over a document that the mix takes, range-sorted by ``position``: the document's columns, then size, source_size, target, taken, position, words."""
    taken = set(documents.columns)
    name = lambda c: c if c not in taken else name(f"mix_{c}")
    out = curriculum(documents, **parameters).withColumn("pass", F.explode("passes"))
    own = {"size": "size", "source_size": "source_size", "target": "target", "taken": "taken", "position": "pass.position", "words": "pass.words"}
    out = out.select(*(F.col("doc")[c].alias(c) for c in documents.columns), *(F.col(c).alias(name(n)) for n, c in own.items()))
    order = [F.col(name("position")), F.col("doc_id").asc_nulls_last()]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
