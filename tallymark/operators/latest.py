"""Latest-row, ranking and diff operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``: an aggregation (combined before the shuffle), not a window."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*key, "_row.*").select(*df.columns)


def first_n(df: DataFrame, key: list[str], order: list[Column | str], n: int) -> DataFrame:
    """Spark pushes the rank limit below the shuffle (WindowGroupLimit)."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter(F.col("rank") <= n)


def authoritative_manifest(manifests: DataFrame) -> DataFrame:
    """The last manifest of each run and spec, then only if it is complete: an older complete one doesn't step in."""
    return latest(manifests, ["spec_key", "run_id"], ["id"]).filter("manifest_complete")


def current_manifest(manifests: DataFrame) -> DataFrame:
    """The last complete manifest of each spec."""
    return latest(manifests.filter("manifest_complete"), ["spec_key"], ["discovered_at", "id"])


def key_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys, side: only_a, only_b or both. One shuffle for all three set operations."""
    both = a.select(*keys, F.lit(1).alias("m")).distinct().unionByName(b.select(*keys, F.lit(2).alias("m")).distinct())
    sides = both.groupBy(*keys).agg(F.sum("m").alias("m"))
    return sides.select(*keys, F.element_at(F.array(F.lit("only_a"), F.lit("only_b"), F.lit("both")), F.col("m").cast("int")).alias("side"))


def allowed(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return df.join(wanted, key, "left_semi")


def first_specs(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n keys: a top-k on each task, then one; never a sort of all."""
    return df.select(key).distinct().orderBy(key).limit(n)


def unknown(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Wanted keys that don't exist: rows, where a driver program would raise."""
    return wanted.join(df, key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Latest wins, over what is stored and what comes in."""
    return latest(old.unionByName(new), key, order)


def insert_missing(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows of ``new`` to append: the first of each key that ``old`` lacks (idempotent writes)."""
    rest = [c for c in new.columns if c not in key]
    first = new.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*key, "_row.*").select(*new.columns)
    return first.join(old, key, "left_anti")
