"""From captures to snapshots, for all specs at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from . import fingerprints as P
from . import state as S
from . import validation as V
from .latest import current_manifest


def process(captures: DataFrame) -> DataFrame:
    """Captures with their content hash and outcome; the parse branches are filters on capture_kind and ACCEPTED. A capture of a kind without a structural
    contract is UNDECIDABLE: it goes to no branch."""
    return captures.withColumn("content_hash", F.sha2(F.col("html").cast("binary"), 256)).withColumn("outcome", V.outcome(F.col("html"), F.col("capture_kind")))


def needs_person(processed: DataFrame) -> DataFrame:
    return processed.filter("outcome = 'CHALLENGE'")


def checkpoint_events(processed: DataFrame) -> DataFrame:
    """A START and an ACCEPT or REJECT for each group detail page."""
    d = processed.filter("capture_kind = 'GROUP_DETAIL'")
    kinds = F.array(F.struct(F.lit(0).alias("i"), F.lit("START").alias("kind")), F.struct(F.lit(1).alias("i"), F.when(F.col("outcome") == "ACCEPTED", "ACCEPT").otherwise("REJECT").alias("kind")))
    return d.select("capture_id", "source_url", "collected_at", F.explode(kinds).alias("e")).select("capture_id", "source_url", "collected_at", "e.i", "e.kind")


def outside_scope(captures: DataFrame, specs: DataFrame, keys: list[str]) -> DataFrame:
    """Captures of specs that are not registered: they must not be written."""
    return captures.join(specs.select(*keys).distinct(), keys, "left_anti")


def finalize(manifests: DataFrame, groups: DataFrame, accepted: DataFrame, critical: DataFrame) -> DataFrame:
    """State and counts of every spec that has no pending group.

    manifests: spec_key, run_id, id, discovered_at, manifest_complete; groups: id, category, group_id; accepted: spec_key, run_id, category, group_id;
    critical: spec_key of specs with a critically broken page. An empty manifest is vacuously complete."""
    keys = ["spec_key", "run_id", "category", "group_id"]
    now = current_manifest(manifests).select("spec_key", "run_id", "id")
    expected = now.join(groups, "id", "left").join(accepted.withColumn("_ok", F.lit(True)), keys, "left")
    per = expected.groupBy("spec_key", "run_id").agg(
        F.count_if(F.col("group_id").isNotNull() & F.col("_ok").isNull()).alias("pending"), F.count_distinct("category").alias("categories"), F.count_if(F.col("group_id").isNotNull()).alias("groups")
    )
    done = per.filter("pending = 0").join(critical.select("spec_key").distinct().withColumn("_bad", F.lit(True)), "spec_key", "left")
    return done.select("spec_key", "run_id", "categories", "groups", S.snapshot_state(F.col("_bad").isNotNull(), F.lit(True)).alias("state"))


def idempotency_keys(accepted: DataFrame, run: str, spec: str, parts: list[str]) -> DataFrame:
    """Of each run and spec: a hash of the run, the spec and the multiset of accepted captures (category, group, capture)."""
    m = P.multiset(accepted.select(run, spec, H.joined(*map(F.col, parts)).alias("v")), [run, spec], "v")
    text = lambda c: H.json_text(F.col(c).cast("string"), True)
    return m.select(run, spec, H.domain_hash("snapshot-idempotency:v1", H.json_object(captures=H.json_multiset(F.col("pairs")), run_id=text(run), spec_key=text(spec))).alias("k"))


def signature(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """An order-sensitive hash of each group's rows."""
    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, H.joined(*map(F.col, values)).alias("_v")))).alias("l"))
    return listed.select(*keys, F.sha2(F.array_join(F.col("l._v"), ";").cast("binary"), 256).alias("signature"))


def same_signature(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Groups that either side has: whether their parts are the same, in the same order."""
    d = a.join(b.withColumnRenamed("signature", "other"), keys, "full_outer")
    return d.select(*keys, F.col("signature").eqNullSafe(F.col("other")).alias("same"))


def image_presence(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """a, b: keys, image (null: none) -> keys, with_a, with_b: of each group, how many parts have an image on each side, where that differs."""
    has = F.col("image").isNotNull().cast("long")
    sides = a.select(*keys, has.alias("x"), F.lit(0).cast("long").alias("y")).unionByName(b.select(*keys, F.lit(0).cast("long").alias("x"), has.alias("y")))
    return sides.groupBy(*keys).agg(F.sum("x").alias("with_a"), F.sum("y").alias("with_b")).filter("with_a <> with_b")


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (a rule that is null is broken), counted in one pass."""
    counts = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("broken")) for n in rules))).alias("x")).select("x.*")


def index_url(base: str, *parts: Column) -> Column:
    return F.concat_ws("/", F.lit(base), *(F.lower(p) for p in parts))
