"""Scope summary and quality audit, and their text and JSON forms."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .equivalence import HASHES

#: Finding codes and severities (fixed values), in the order in which a spec's findings stand.
RULES = {
    "SPEC_WITHOUT_SNAPSHOT": "ERROR", "SNAPSHOT_INVALID": "ERROR", "SNAPSHOT_NOT_VALID": "WARNING", "COLLECTION_NOT_COMPLETE": "WARNING",
    "SNAPSHOT_FINGERPRINT_UNAVAILABLE": "WARNING", "SNAPSHOT_SUSPICIOUSLY_EMPTY_STRUCTURE": "WARNING", "SPEC_WITH_ZERO_PARTS": "INFO",
    "MANIFEST_MISSING_OR_INCOMPLETE": "WARNING", "MANIFEST_SNAPSHOT_GROUP_COUNT_MISMATCH": "WARNING", "MANIFEST_GROUPS_NEVER_ACCEPTED": "WARNING",
}
SEVERITIES = ("INFO", "WARNING", "ERROR")
COUNTS = ("categories", "groups", "schemas", "parts")


def scope_summary(specs: DataFrame, snapshots: DataFrame, by: list[str]) -> DataFrame:
    """specs: by.., spec_key; snapshots: the latest of each spec. One left join and one aggregation for all numbers."""
    d = specs.join(snapshots.withColumn("_has", F.lit(True)), "spec_key", "left")
    has, state = F.col("_has").isNotNull(), F.col("state")
    none = lambda c: F.coalesce(c, F.lit(0))
    return d.groupBy(*by).agg(
        F.count("*").alias("discovered"), F.count_if(has).alias("with_snapshot"), F.count_if(state == "VALID").alias("valid"),
        F.count_if(F.coalesce(state != "VALID", F.lit(True))).alias("problematic"), F.count_if(F.col("collection_complete")).alias("complete"),
        *(none(F.sum(c)).cast("long").alias(f"total_{c}") for c in COUNTS),
        none(F.min("groups")).cast("long").alias("groups_min"), none(F.max("groups")).cast("long").alias("groups_max"),
        F.coalesce(F.avg("groups"), F.lit(0.0)).alias("groups_mean"), F.coalesce(F.median("groups"), F.lit(0.0)).alias("groups_median"),
    )


def findings(d: DataFrame) -> DataFrame:
    """d: spec_key, has_snapshot, state, collection_complete, the hashes, counts, has_manifest, expected, missing -> spec_key, position, code, severity.

    expected: distinct groups of the current manifest; missing: those never accepted in its run."""
    snap, man = F.col("has_snapshot"), F.col("has_snapshot") & F.col("has_manifest")
    no_hash = F.lit(False)
    for h in HASHES:
        no_hash = no_hash | F.col(h).isNull()
    when: dict[str, Column] = {
        "SPEC_WITHOUT_SNAPSHOT": ~snap,
        "SNAPSHOT_INVALID": snap & (F.col("state") == "INVALID"),
        "SNAPSHOT_NOT_VALID": snap & ~F.col("state").isin("INVALID", "VALID"),
        "COLLECTION_NOT_COMPLETE": snap & ~F.col("collection_complete"),
        "SNAPSHOT_FINGERPRINT_UNAVAILABLE": snap & no_hash,
        "SNAPSHOT_SUSPICIOUSLY_EMPTY_STRUCTURE": snap & ((F.col("categories") == 0) | (F.col("groups") == 0) | (F.col("schemas") == 0)),
        "SPEC_WITH_ZERO_PARTS": snap & (F.col("parts") == 0),
        "MANIFEST_MISSING_OR_INCOMPLETE": snap & ~F.col("has_manifest"),
        "MANIFEST_SNAPSHOT_GROUP_COUNT_MISMATCH": man & (F.col("expected") != F.col("groups")),
        "MANIFEST_GROUPS_NEVER_ACCEPTED": man & (F.col("missing") > 0),
    }
    rows = [F.when(when[code], F.struct(F.lit(i).alias("position"), F.lit(code).alias("code"), F.lit(sev).alias("severity"))) for i, (code, sev) in enumerate(RULES.items())]
    return d.select("spec_key", F.explode(F.array_compact(F.array(*rows))).alias("f")).select("spec_key", "f.*")


def severity_counts(found: DataFrame) -> DataFrame:
    """A row for each severity, also those without findings."""
    one = found.agg(*(F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES))
    return one.select(F.explode(F.array(*(F.struct(F.lit(s).alias("severity"), F.col(s).alias("n")) for s in SEVERITIES))).alias("x")).select("x.*")


def metrics(runs: DataFrame, events: DataFrame, challenges: DataFrame, beats: DataFrame, completed: DataFrame, limiter: DataFrame, previous: DataFrame, staleness: int) -> DataFrame:
    """The nine metrics of each run at its time ``now`` (seconds).

    runs: run_id, now; events: run_id, kind (ACCEPT, REQUEST); challenges: run_id, observed_at, resolved_at; beats: run_id, worker_id, last_heartbeat_at; completed: run_id, spec_key;
    limiter: run_id, concurrency; previous: run_id, groups_accepted, at. Groups a minute come from the difference to the previous metrics (none: 0), never from the run's start."""
    of = lambda df, *aggs: df.join(runs, "run_id").groupBy("run_id").agg(*aggs)
    c = of(
        challenges, F.count("*").alias("challenges_total"), F.count_if((F.col("observed_at") > F.col("now") - 3600) & (F.col("observed_at") <= F.col("now"))).cast("double").alias("challenges_per_hour"),
        F.coalesce(F.sum(F.col("resolved_at") - F.col("observed_at")), F.lit(0)).cast("long").alias("challenge_wait_seconds"),
    )
    e = events.groupBy("run_id").agg(F.count_if(F.col("kind") == "ACCEPT").alias("groups_accepted"), F.count_if(F.col("kind") == "REQUEST").alias("requests_total"))
    w = of(beats, F.count_if(F.col("last_heartbeat_at") >= F.col("now") - staleness).alias("active_workers"))
    s = completed.groupBy("run_id").agg(F.count_distinct("spec_key").alias("specs_completed"))
    d = runs
    for other in (s, e, c, w, limiter.select("run_id", F.col("concurrency").alias("effective_concurrency")), previous.select("run_id", F.col("groups_accepted").alias("_before"), "at")):
        d = d.join(other, "run_id", "left")
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    rate = (F.coalesce("groups_accepted", F.lit(0)) - F.col("_before")) / F.greatest((F.col("now") - F.col("at")) / 60.0, F.lit(1e-9))
    return d.select(
        "run_id", zero("specs_completed"), zero("groups_accepted"), F.coalesce(F.greatest(F.lit(0.0), rate), F.lit(0.0)).alias("groups_per_minute"), zero("requests_total"), zero("challenges_total"),
        F.coalesce("challenges_per_hour", F.lit(0.0)).alias("challenges_per_hour"), zero("challenge_wait_seconds"), zero("active_workers"), "effective_concurrency",
    )


# text and JSON forms: reports are rows, so their lines are rows too, and are written by any number of tasks


def dotted(n: Column) -> Column:
    """Whole numbers with a dot between thousands."""
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit("."))


def decimals(c: str) -> Column:
    """Two places, ties of the binary value to the even digit."""
    return F.replace(F.format_number(c, 2), F.lit(","), F.lit(""))


def lines(report: DataFrame, key: list[str], title: Column, body: list[Column]) -> DataFrame:
    """key, line_no (from 0), line: a title and the lines of a report's row (null lines are left out)."""
    return report.select(*key, F.posexplode(F.array_compact(F.array(title, *body))).alias("line_no", "line"))


def summary_lines(summary: DataFrame) -> DataFrame:
    """The text form of scope_summary."""
    labels = {"discovered": "specs discovered", "valid": "specs VALID", "problematic": "specs incomplete or problematic", "total_categories": "categories", "total_groups": "groups", "total_schemas": "schemas", "total_parts": "parts"}
    spread = F.when(F.col("with_snapshot") == 0, F.lit("  groups/spec: no specs with a snapshot")).otherwise(
        F.format_string("  groups/spec: min=%d max=%d mean=%s median=%s (n=%d)", "groups_min", "groups_max", decimals("groups_mean"), decimals("groups_median"), "with_snapshot")
    )
    return lines(summary, ["scope"], F.concat(F.lit("Summary - "), "scope"), [F.concat(F.lit(f"  {text}: "), dotted(F.col(c))) for c, text in labels.items()] + [spread])


def finding_lines(found: DataFrame) -> DataFrame:
    """spec_key, position, line of each finding."""
    return found.select("spec_key", "position", F.format_string("  [%s] %s: %s", "severity", "code", F.col("spec_key").cast("string")).alias("line"))


def member_lines(members: DataFrame) -> DataFrame:
    """cluster_key, place, line of each member of a redundancy cluster."""
    return members.select("cluster_key", "place", F.format_string("    %s | catalog %s | %s parts | key=%s", "model_code", "catalog_id", dotted(F.col("parts")), F.col("spec_key").cast("string")).alias("line"))


def comparison_lines(report: DataFrame) -> DataFrame:
    """a, b, line_no, line of each comparison."""
    side = lambda s: F.concat(F.lit(f"  counts {s}: "), F.coalesce(F.to_json(f"counts_{s}"), F.lit("none")))
    relations = F.when(F.col("no_snapshot").isNull(), F.format_string("  equivalence: comparison_valid=%s parts=%s schemas=%s images=%s", F.col("valid").cast("string"), "parts", "schemas", "images")).otherwise(F.concat(F.lit("  equivalence: unavailable - no snapshot of "), "no_snapshot"))
    hashes = F.format_string("  hashes: structure=%s spec_parts=%s schema_semantic=%s image=%s", *(h.replace("_hash", "_equal") for h in HASHES))
    groups = F.when(F.col("no_manifest").isNull(), F.format_string("  groups: only in a %d, only in b %d, shared %d", "only_a", "only_b", "shared")).otherwise(F.concat(F.lit("  groups: unavailable - no complete manifest of "), "no_manifest"))
    return lines(report, ["a", "b"], F.format_string("Comparison - %s, %s", F.col("a").cast("string"), F.col("b").cast("string")), [side("a"), side("b"), relations, hashes, groups, F.lit("  parts: never compared one by one")])


def render_text(report: DataFrame, title: str) -> str:
    """Any report as text, a line for each value; rows come to the driver one partition at a time."""
    out = [title]
    for row in report.toLocalIterator():
        out += [f"  {k}: " + (f"{v:,}".replace(",", ".") if isinstance(v, int) and not isinstance(v, bool) else str(v)) for k, v in row.asDict().items()] + [""]
    return "\n".join(out).rstrip() + "\n"


def render_json(report: DataFrame) -> str:
    return json.dumps([r.asDict(recursive=True) for r in report.toLocalIterator()], indent=2, sort_keys=True, default=str)


def json_rows(report: DataFrame, key: list[str]) -> DataFrame:
    """key, json: each row as canonical JSON, its fields sorted by name, nulls kept."""
    whole = F.to_json(F.struct(*sorted(report.columns)), {"ignoreNullFields": "false"})
    return report.select(*key, whole.alias("json"))


#: Field names that would put raw content into a log (fixed values).
RAW_FIELDS = ("raw_content", "raw_html", "html")


def log_event(run_id: str, event: str, at: str, **fields) -> str:
    """A line of JSON, keys sorted. Raw content is refused: pass a hash, an id or a size."""
    for name, value in fields.items():
        if name in RAW_FIELDS or isinstance(value, bytes | bytearray | memoryview):
            raise ValueError(f"field {name!r} holds raw content")
    return json.dumps({"timestamp": at, "run_id": run_id, "event": event, **fields}, sort_keys=True, default=str)


def log_lines(events: DataFrame) -> DataFrame:
    """line: each row (run_id, event, timestamp and fields) as JSON with sorted keys, for DataFrameWriter.text; columns that hold raw content are refused."""
    raw = [c for c, kind in events.dtypes if c in RAW_FIELDS or kind == "binary"]
    if raw:
        raise ValueError(f"columns {raw} hold raw content")
    return json_rows(events, []).withColumnRenamed("json", "line")
