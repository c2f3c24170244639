"""Table schemas, table scans, and the content-addressed page store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemas of the relational tables (nullable unless a key).
SCHEMAS = {
    "spec_registry": "stable_key string, source string, manufacturer string, vehicle_model string, market string, model_code string, catalog_id string, production_period_raw string, source_url string, production_start date, production_end date, grade string, configuration string",
    "spec_snapshot": "snapshot_id string, spec_identity_ref string, idempotency_key string, collected_at timestamp, parser_version string, normalizer_version string, fingerprint_version string, collection_complete boolean, state string, counts map<string,bigint>, structure_hash string, spec_parts_hash string, schema_semantic_hash string, image_hash string",
    "spec_group_manifest": "id bigint, spec_key string, run_id string, source_capture_id string, discovered_at timestamp, categories array<struct<category_slug:string,groups:array<struct<group_id:string,source_url:string>>>>, manifest_complete boolean, validation_evidence map<string,bigint>",
    "checkpoint_entry": "run_id string, spec_key string, category_slug string, group_id string, status string, raw_capture_id string, attempt_count int, last_attempt_at timestamp, completed_at timestamp, evidence map<string,string>",
    "collection_run": "run_id string, scope string, started_at timestamp, resumed_at timestamp, completed_at timestamp",
    "raw_blob": "content_hash string, size_bytes bigint, storage_path string, first_seen_at timestamp",
    "raw_capture": "capture_id string, run_id string, content_hash string, source_url string, collected_at timestamp, capture_kind string, acquisition_mode string, expected_identity_context struct<market:string,model_code:string,catalog_id:string>, collection_metadata map<string,string>",
    "cluster_assignment": "spec_identity_ref string, cluster_key string, normalizer_version string, fingerprint_version string",
    "asset_resolution": "spec_identity_ref string, origin_spec_ref string, image_url_or_ref string, is_fallback boolean, resolved_within_cluster_key string",
    "spec_lease": "run_id string, spec_key string, owner string, lease_token bigint, expires_at timestamp",
    "challenge_event": "id bigint, run_id string, worker_id string, observed_at timestamp, resolved_at timestamp",
    "worker_heartbeat": "run_id string, worker_id string, last_heartbeat_at timestamp",
    "rate_limiter_state": "run_id string, effective_concurrency int, updated_at timestamp",
    "spec_pool_disposition": "run_id string, spec_key string, kind string, session_id string, updated_at timestamp",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; a known one is read with its schema, without inference."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def by_scope(specs: DataFrame, **parts: str) -> DataFrame:
    """Case-insensitive equality on scope components."""
    for column, value in parts.items():
        specs = specs.filter(F.upper(column) == value.upper())
    return specs


def lookup(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Many point lookups as one semi join."""
    return df.join(keys, key, "left_semi")


def decode_categories(manifests: DataFrame, column: str = "categories_json") -> DataFrame:
    """JSON manifests to a row for each group."""
    kind = "array<struct<category_slug:string,groups:array<struct<group_id:string,source_url:string>>>>"
    d = manifests.withColumn("c", F.explode(F.from_json(column, kind))).withColumn("g", F.explode("c.groups"))
    return d.select(*(c for c in manifests.columns if c != column), F.col("c.category_slug").alias("category"), F.col("g.group_id").alias("group_id"), F.col("g.source_url").alias("source_url"))


def blobs(spark: SparkSession, root: str) -> DataFrame:
    """content_hash, html of a two-level content-addressed folder; the name of a file is its hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("content_hash"), F.decode("content", "UTF-8").alias("html"), F.col("length").alias("size_bytes"), (F.sha2("content", 256) == F.regexp_extract("path", r"([^/]+)$", 1)).alias("intact"))


def register_blobs(captures: DataFrame, known: DataFrame) -> DataFrame:
    """New blobs of captures (html, collected_at): one of each hash, first seen at the least time, without the known ones."""
    hashed = captures.withColumn("content_hash", F.sha2(F.col("html").cast("binary"), 256))
    new = hashed.groupBy("content_hash").agg(F.min("collected_at").alias("first_seen_at"), F.first("html").alias("html"), F.first(F.octet_length("html")).cast("long").alias("size_bytes"))
    return new.join(known, "content_hash", "left_anti")


def replay(captures: DataFrame, store: DataFrame) -> DataFrame:
    """Captures with their content; the ones whose blob is missing have a null."""
    return captures.join(store, "content_hash", "left")


def stored_blobs(spark: SparkSession, root: str) -> DataFrame:
    """content_hash, size_bytes, first_seen_at, html of the blobs written so far (none: an empty table)."""
    return spark.read.schema("content_hash string, size_bytes bigint, first_seen_at bigint, html string, prefix string").option("ignoreMissingFiles", "true").parquet(root)


def write_blobs(captures: DataFrame, root: str) -> DataFrame:
    """Adds the contents of captures (html, collected_at) that the store at ``root`` lacks, in folders by the first two digits of their hash; a repeated write adds nothing.

    Spark commits a write as a whole, so no reader sees half a blob. -> the store after the write."""
    spark = captures.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    known = stored_blobs(spark, root).select("content_hash") if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else spark.createDataFrame([], "content_hash string")
    new = register_blobs(captures, known).select("content_hash", "size_bytes", F.col("first_seen_at").cast("long").alias("first_seen_at"), "html", F.substring("content_hash", 1, 2).alias("prefix"))
    new.write.mode("append").partitionBy("prefix").parquet(root)
    return stored_blobs(spark, root)


def write_table(df: DataFrame, folder: str, name: str, mode: str = "append") -> None:
    """Appends rows (captures, manifests, discovery entries): a write never looks at what is there."""
    df.write.mode(mode).parquet(f"{folder}/{name}.parquet")


def replace(df: DataFrame, folder: str, name: str, version: int) -> str:
    """Writes an upserted table as a new version beside the one it was made from, which it may still read. -> its path."""
    path = f"{folder}/{name}.{version}.parquet"
    df.write.mode("errorifexists").parquet(path)
    return path
