"""From manifests, accepted captures and parsed pages to trees, fingerprints and states, for all specs and runs at once.

A tree is a table of parts: spec, category, grp, schema_id and the part's fields. A captured group without schemas is one row without a schema, a schema without
parts one row without a part; groups that are expected but not captured have no row, so categories without any group have none either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as X
from . import fingerprints as P
from . import ingest as I
from . import state as S
from .latest import authoritative_manifest

NORMALIZER_VERSION, PARSER_VERSION, FINGERPRINT_VERSION = "normalizer-v1", "parser-v1", "fingerprint-v1"
FIELDS = ("pnc", "oem", "description", "details", "period", "quantity", "image_url")


def normalize_parts(parts: DataFrame) -> DataFrame:
    """schema_id, pnc, oem, description, details, period, quantity and, if there, pr_codes in normal form; other columns (images, keys) untouched.

    Optional texts that are empty become null; an empty oem stays empty."""
    forms = {"schema_id": X.normalize_text, "pnc": X.normalize_pnc, "oem": X.normalize_oem, "description": X.optional, "details": X.optional, "period": X.optional, "quantity": X.optional, "pr_codes": X.normalize_codes}
    return parts.withColumns({c: f(F.col(c)) for c, f in forms.items() if c in parts.columns} | {"normalizer_version": F.lit(NORMALIZER_VERSION)})


def part_key(parts: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Adds part_fp; null where the row holds no part."""
    fields = {c: F.col(c) for c in ("description", "details", "oem", "period", "pnc", "quantity", "schema_id")}
    return parts.withColumn("part_fp", F.when(F.col("pnc").isNotNull(), P.part_fingerprint(ascii_only, **fields)))


def assemble(expected: DataFrame, accepted: DataFrame, details: DataFrame) -> DataFrame:
    """expected: spec_key, run_id, category, group_id; accepted: those and raw_capture_id; details: capture_id and the rows of a parsed group page.

    -> spec (spec_key, run_id), category, grp, schema_id and the part's fields, critical. Only groups that are both expected and captured are in it."""
    keys = ["spec_key", "run_id", "category", "group_id"]
    captured = expected.select(*keys).join(accepted.select(*keys, F.col("raw_capture_id").alias("capture_id")), keys)
    rows = captured.join(details.drop("source_url"), "capture_id")
    spec = F.struct("spec_key", "run_id").alias("spec")
    # an error that is not critical leaves the group, not a schema or a part
    return rows.select(spec, "category", F.col("group_id").alias("grp"), "schema_id", *FIELDS, F.coalesce("critical", F.lit(False)).alias("critical"))


def fingerprints_of(tree: DataFrame, ascii_only: bool = False) -> DataFrame:
    """spec, the four hashes and the counts of categories, groups, schemas and parts."""
    parts = part_key(normalize_parts(tree), ascii_only)
    return P.fingerprint_set(parts).join(P.tree_counts(parts), "spec")


def plan_finalization(manifests: DataFrame, groups: DataFrame, accepted: DataFrame, details: DataFrame, ascii_only: bool = False) -> DataFrame:
    """One row for each spec and run with a complete last manifest: collection_complete, state, the four hashes, counts, idempotency_key, versions.

    manifests: spec_key, run_id, id, manifest_complete; groups: id, category, group_id; accepted: spec_key, run_id, category, group_id, raw_capture_id; details: parsed
    rows by capture_id. A critical page makes the state INVALID; a run without a captured group has the hashes of an empty tree."""
    runs = authoritative_manifest(manifests).select("spec_key", "run_id", "id")
    expected = runs.join(groups, "id").select("spec_key", "run_id", "category", "group_id")
    tree = assemble(expected, accepted, details)
    keys = ["spec_key", "run_id", "category", "group_id"]
    got = accepted.select(*keys).distinct().withColumn("_got", F.lit(1))
    done = expected.join(got, keys, "left").groupBy("spec_key", "run_id").agg(F.bool_and(F.col("_got").isNotNull()).alias("done"))
    critical = tree.groupBy("spec").agg(F.bool_or("critical").alias("bad"))
    # a run without groups: one row without anything, for the hashes of nothing
    none = runs.select(F.struct("spec_key", "run_id").alias("spec")).join(tree.select("spec").distinct(), "spec", "left_anti")
    whole = tree.drop("critical").unionByName(none.select("spec"), allowMissingColumns=True)
    found = fingerprints_of(whole, ascii_only).join(critical, "spec", "left").select("spec.*", *P.HASHES, "categories", "groups", "schemas", "parts", F.coalesce("bad", F.lit(False)).alias("bad"))
    key = I.idempotency_keys(accepted, "run_id", "spec_key", ["category", "group_id", "raw_capture_id"]).withColumnRenamed("k", "idempotency_key")
    d = runs.drop("id").join(found, ["spec_key", "run_id"]).join(done, ["spec_key", "run_id"], "left").join(key, ["spec_key", "run_id"], "left")
    complete = F.coalesce("done", F.lit(True))  # an empty manifest is vacuously complete
    return d.select(
        "spec_key", "run_id", complete.alias("collection_complete"), S.snapshot_state(F.col("bad"), complete).alias("state"), *P.HASHES, "categories", "groups", "schemas", "parts", "idempotency_key",
        F.lit(PARSER_VERSION).alias("parser_version"), F.lit(NORMALIZER_VERSION).alias("normalizer_version"), F.lit(FINGERPRINT_VERSION).alias("fingerprint_version"),
    )


def commit(plans: DataFrame, snapshots: DataFrame, at: str = "collected_at") -> DataFrame:
    """Snapshots after finalisation: new ones whose idempotency_key is not there yet are added (a repeated plan adds nothing), and every earlier VALID or STALE
    snapshot of a spec with a new VALID or INCOMPLETE one is SUPERSEDED. plans has the columns of snapshots."""
    new = plans.dropDuplicates(["idempotency_key"]).join(snapshots.select("idempotency_key"), "idempotency_key", "left_anti")
    heirs = new.filter(F.col("state").isin("VALID", "INCOMPLETE")).groupBy("spec_key").agg(F.max(at).alias("_heir"))
    old = snapshots.join(heirs, "spec_key", "left")
    gone = F.col("state").isin("VALID", "STALE") & (F.col(at) < F.col("_heir"))
    return old.withColumn("state", F.when(gone, "SUPERSEDED").otherwise(F.col("state"))).select(*snapshots.columns).unionByName(new.select(*snapshots.columns))
