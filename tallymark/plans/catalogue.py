"""Queries over specs and snapshots: summaries, rankings, clusters, comparisons, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import equivalence as E
from ..operators import latest as L
from ..operators import reports as R
from ..operators import state as S
from .standins import Registry

query = Registry()
LATEST = "latest AS (SELECT * FROM snapshots QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY collected_at DESC, snapshot_id DESC) = 1)"
CURRENT = "cur AS (SELECT * FROM manifests WHERE manifest_complete QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY discovered_at DESC, id DESC) = 1)"
ELIGIBLE = "collection_complete AND state IN ('VALID', 'STALE') AND structure_hash IS NOT NULL AND spec_parts_hash IS NOT NULL AND schema_semantic_hash IS NOT NULL AND image_hash IS NOT NULL"
COUNTS = 'categories, "groups", "schemas", parts'


def _latest(t):
    return L.latest(t("snapshots"), ["spec_key"], ["collected_at", "snapshot_id"])


@query(f"""WITH {LATEST} SELECT s.scope, count(*) AS discovered, count(l.spec_key) AS with_snapshot, count(*) FILTER (state = 'VALID') AS valid, count(*) FILTER (state IS DISTINCT FROM 'VALID') AS problematic,
    count(*) FILTER (collection_complete) AS complete, CAST(coalesce(sum(categories), 0) AS BIGINT) AS total_categories, CAST(coalesce(sum("groups"), 0) AS BIGINT) AS total_groups,
    CAST(coalesce(sum("schemas"), 0) AS BIGINT) AS total_schemas, CAST(coalesce(sum(parts), 0) AS BIGINT) AS total_parts, coalesce(min("groups"), 0) AS groups_min, coalesce(max("groups"), 0) AS groups_max,
    coalesce(avg("groups"), 0) AS groups_mean, coalesce(median("groups"), 0) AS groups_median FROM specs s LEFT JOIN latest l USING (spec_key) GROUP BY s.scope""")
def scope_summary(t):
    return R.scope_summary(t("specs").select("scope", "spec_key"), _latest(t).drop("scope"), ["scope"])


@query(f"WITH {LATEST} SELECT spec_key, snapshot_id, state, collected_at FROM latest")
def latest_snapshot(t):
    return _latest(t).select("spec_key", "snapshot_id", "state", "collected_at")


@query("SELECT spec_key, snapshot_id, collected_at FROM snapshots WHERE state IN ('VALID', 'STALE') QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY collected_at DESC, snapshot_id DESC) = 1")
def latest_valid_snapshot(t):
    return L.latest(t("snapshots").filter(E.usable(F.col("state"))), ["spec_key"], ["collected_at", "snapshot_id"]).select("spec_key", "snapshot_id", "collected_at")


@query(f"WITH {CURRENT} SELECT spec_key, id, run_id FROM cur")
def current_manifest(t):
    return L.current_manifest(t("manifests")).select("spec_key", "id", "run_id")


@query("SELECT spec_key, run_id, id FROM (SELECT * FROM manifests QUALIFY row_number() OVER (PARTITION BY spec_key, run_id ORDER BY id DESC) = 1) WHERE manifest_complete")
def authoritative_manifest(t):
    return L.authoritative_manifest(t("manifests")).select("spec_key", "run_id", "id")


@query("SELECT spec_key, row_number() OVER (PARTITION BY spec_key ORDER BY discovered_at DESC, id DESC) AS place, id FROM manifests")
def manifests_of_spec(t):
    from pyspark.sql import Window as W

    return t("manifests").select("spec_key", F.row_number().over(W.partitionBy("spec_key").orderBy(F.desc("discovered_at"), F.desc("id"))).cast("long").alias("place"), "id")


@query("SELECT spec_key, manufacturer, vehicle_model FROM specs WHERE upper(manufacturer) = 'EN' AND upper(vehicle_model) = 'SRC1'")
def scope_filter(t):
    from ..sources import tables

    return tables.by_scope(t("specs"), manufacturer="En", vehicle_model="Src1").select("spec_key", "manufacturer", "vehicle_model")


@query("SELECT spec_key, model_code FROM specs WHERE spec_key IN (SELECT doc_id * 3 FROM labels)")
def spec_allowlist(t):
    return L.allowed(t("specs"), t("labels").select((F.col("doc_id") * 3).alias("spec_key")), "spec_key").select("spec_key", "model_code")


@query("SELECT DISTINCT doc_id * 3 AS spec_key FROM labels WHERE doc_id * 3 NOT IN (SELECT spec_key FROM specs)")
def unknown_specs(t):
    return L.unknown(t("specs"), t("labels").select((F.col("doc_id") * 3).alias("spec_key")).distinct(), "spec_key")


@query("SELECT spec_key, snapshot_id, row_number() OVER (PARTITION BY spec_key ORDER BY collected_at DESC, snapshot_id DESC) AS rank FROM snapshots QUALIFY rank <= 2")
def limit_per_spec(t):
    return L.first_n(t("snapshots"), ["spec_key"], [F.desc("collected_at"), F.desc("snapshot_id")], 2).select("spec_key", "snapshot_id", F.col("rank").cast("long").alias("rank"))


@query(f"""SELECT count(*) AS considered, count(DISTINCT k) AS distinct_hashes, count(DISTINCT k) FILTER (n >= 2) AS clusters, count(DISTINCT k) FILTER (n = 1) AS isolated, coalesce(max(n), 0) AS largest,
    CASE WHEN count(*) > 0 THEN (count(*) - count(DISTINCT k)) / count(*) ELSE 0 END AS ratio, count(DISTINCT structure_hash) AS distinct_structure_hash, count(DISTINCT schema_semantic_hash) AS distinct_schema_semantic_hash, count(DISTINCT image_hash) AS distinct_image_hash
    FROM (SELECT k, structure_hash, schema_semantic_hash, image_hash, count(*) OVER (PARTITION BY k) AS n FROM (SELECT scope || fingerprint_version || spec_parts_hash AS k, structure_hash, schema_semantic_hash, image_hash FROM snapshots WHERE {ELIGIBLE}))""")
def redundancy_summary(t):
    return E.redundancy(t("snapshots"))


@query(f"""SELECT sha256(scope || chr(0) || normalizer_version || chr(0) || fingerprint_version || chr(0) || spec_parts_hash) AS cluster_key, min(spec_parts_hash) AS spec_parts_hash, count(*) AS size, min(spec_key) AS least
    FROM snapshots WHERE {ELIGIBLE} GROUP BY 1 HAVING count(*) >= 2""")
def redundancy_clusters(t):
    return E.clusters(t("snapshots"))


_KEYED = f"k AS (SELECT sha256(scope || chr(0) || normalizer_version || chr(0) || fingerprint_version || chr(0) || spec_parts_hash) AS cluster_key, * FROM snapshots WHERE {ELIGIBLE})"


@query(f"WITH {_KEYED}, c AS (SELECT cluster_key, min(spec_parts_hash) AS h, count(*) AS size FROM k GROUP BY 1 HAVING count(*) >= 2) SELECT row_number() OVER (ORDER BY size DESC, h, cluster_key) AS place, cluster_key, size FROM c")
def redundancy_report(t):
    from pyspark.sql import Window as W

    # the clusters' order is a range sort; places over all of them are for the comparison only
    return E.ordered_clusters(t("snapshots")).select(F.row_number().over(W.orderBy(F.desc("size"), "spec_parts_hash", "cluster_key")).cast("long").alias("place"), "cluster_key", "size")


@query(f"WITH {_KEYED}, c AS (SELECT cluster_key FROM k GROUP BY 1 HAVING count(*) >= 2) SELECT cluster_key, spec_key, model_code, catalog_id, k.parts, row_number() OVER (PARTITION BY cluster_key ORDER BY model_code, catalog_id, spec_key, snapshot_id) AS place FROM k SEMI JOIN c USING (cluster_key) JOIN specs USING (spec_key)")
def cluster_members(t):
    return E.cluster_members(t("snapshots"), t("specs")).withColumn("place", F.col("place").cast("long"))


@query(f"""WITH {_KEYED}, r AS (SELECT cluster_key, spec_key AS representative FROM k WHERE state = 'VALID' QUALIFY row_number() OVER (PARTITION BY cluster_key ORDER BY images DESC, collected_at DESC, parts DESC, spec_key, snapshot_id) = 1)
    SELECT cluster_key, count(*) AS size, min(representative) AS representative FROM k LEFT JOIN r USING (cluster_key) GROUP BY cluster_key""")
def equivalence_classes(t):
    return E.classes(E.with_cluster(t("snapshots")).select("cluster_key", "spec_key", "state", "images", "collected_at", "parts"))


@query("SELECT spec AS spec_key, min(nullif(image_url, '')) AS image FROM parts GROUP BY spec")
def own_image(t):
    return E.own_images(t("parts").select(F.col("spec").alias("spec_key"), F.col("image_url").alias("image")))


@query(f"""WITH m AS (SELECT sha256(scope || chr(0) || normalizer_version || chr(0) || fingerprint_version || chr(0) || spec_parts_hash) AS cluster_key, * FROM snapshots WHERE {ELIGIBLE})
    SELECT cluster_key, spec_key, images, collected_at FROM m WHERE state = 'VALID' QUALIFY row_number() OVER (PARTITION BY cluster_key ORDER BY images DESC, collected_at DESC, parts DESC, spec_key, snapshot_id) = 1""")
def representative(t):
    m = E.with_cluster(t("snapshots"))
    return E.representatives(m.select("cluster_key", "spec_key", "state", "images", "collected_at", "parts")).select("cluster_key", "spec_key", "images", "collected_at")


@query("""WITH m AS (SELECT doc_id AS spec_key, lang || CAST(doc_id % 40 AS STRING) AS cluster_key, CASE WHEN doc_id % 4 = 0 THEN 'img' || CAST(doc_id % 9 AS STRING) END AS image FROM documents),
    f AS (SELECT cluster_key, min(spec_key) AS other, arg_min(image, spec_key) AS other_image FROM m WHERE image IS NOT NULL GROUP BY 1)
    SELECT spec_key, m.cluster_key, coalesce(image, other_image) AS image, CASE WHEN image IS NOT NULL THEN spec_key ELSE other END AS origin, image IS NULL AND other_image IS NOT NULL AS is_fallback FROM m LEFT JOIN f USING (cluster_key)""")
def image_resolution(t):
    m = t("documents").select(F.col("doc_id").alias("spec_key"), F.concat("lang", (F.col("doc_id") % 40).cast("string")).alias("cluster_key"), F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("img"), (F.col("doc_id") % 9).cast("string"))).alias("image"))
    return E.resolve_images(m)


@query("SELECT schema_id, string_agg(DISTINCT oem, ',' ORDER BY oem) AS oems FROM parts WHERE oem <> '' GROUP BY schema_id")
def oem_reference(t):
    return t("parts").filter("oem <> ''").groupBy("schema_id").agg(F.array_join(F.array_sort(F.collect_set("oem")), ",").alias("oems"))


_PAIR = f"""WITH {LATEST}, p AS (SELECT x.spec_key AS a, y.spec_key AS b, x.*, y.scope AS ys, y.normalizer_version AS yn, y.fingerprint_version AS yf, y.collection_complete AS yc, y.state AS yst,
    y.spec_parts_hash AS yp, y.schema_semantic_hash AS ysm, y.image_hash AS yi, y.structure_hash AS yh FROM latest x JOIN latest y ON y.spec_key = x.spec_key + 1),
    v AS (SELECT *, scope = ys AND normalizer_version = yn AND fingerprint_version = yf AND collection_complete AND yc AND state IN ('VALID', 'STALE') AND yst IN ('VALID', 'STALE') AS valid FROM p),
    r AS (SELECT *, CASE WHEN NOT valid OR spec_parts_hash IS NULL OR yp IS NULL THEN 'UNKNOWN' WHEN spec_parts_hash = yp THEN 'EXACT' ELSE 'DIFFERENT' END AS rel_parts,
    CASE WHEN NOT valid THEN 'UNKNOWN' WHEN schema_semantic_hash = ysm THEN 'EXACT' ELSE 'DIFFERENT' END AS rel_schemas FROM v)"""


def _pairs(t):
    # neighbours, within a scope or not: the second snapshot table is the same one, a key on
    s = _latest(t)
    return E.compare(s.select(F.col("spec_key").alias("a"), (F.col("spec_key") + 1).alias("b")), s, F.lit("EMPTY"))


@query(_PAIR + """ SELECT a, b, valid, rel_parts AS parts, rel_schemas AS schemas, CASE WHEN NOT valid THEN 'UNKNOWN' WHEN image_hash = 'EMPTY' AND yi = 'EMPTY' THEN 'NONE' WHEN image_hash <> 'EMPTY' AND yi <> 'EMPTY'
    THEN CASE WHEN image_hash = yi THEN 'EXACT' ELSE 'DIFFERENT' END WHEN rel_parts = 'EXACT' THEN 'COMPLEMENTARY' ELSE 'DIFFERENT' END AS images, valid AND rel_parts = 'EXACT' AS dedup_allowed FROM r""")
def equivalence_pairs(t):
    return _pairs(t).select("a", "b", "valid", "parts", "schemas", "images", "dedup_allowed")


@query(_PAIR + """ SELECT a, b, CASE WHEN NOT valid OR structure_hash IS NULL OR yh IS NULL THEN 'UNAVAILABLE' WHEN structure_hash = yh THEN 'EQUAL' ELSE 'DIFFERENT' END AS structure_equal,
    CASE WHEN NOT valid THEN 'UNAVAILABLE' WHEN spec_parts_hash = yp THEN 'EQUAL' ELSE 'DIFFERENT' END AS spec_parts_equal, CASE WHEN NOT valid THEN 'UNAVAILABLE' WHEN image_hash = yi THEN 'EQUAL' ELSE 'DIFFERENT' END AS image_equal FROM r""")
def literal_hash_compare(t):
    return _pairs(t).select("a", "b", "structure_equal", "spec_parts_equal", "image_equal")


@query(_PAIR + """ SELECT a, b, concat_ws(',', CASE WHEN scope <> ys THEN 'SCOPE' END, CASE WHEN NOT (collection_complete AND yc) THEN 'INCOMPLETE' END,
    CASE WHEN NOT (state IN ('VALID', 'STALE') AND yst IN ('VALID', 'STALE')) THEN 'STATE' END) AS reasons FROM r""")
def compare_pairs(t):
    return _pairs(t).select("a", "b", "reasons")


def _report(t):
    pairs = t("specs").select(F.col("spec_key").alias("a"), (F.col("spec_key") + 1).alias("b"))
    groups = L.current_manifest(t("manifests")).select("spec_key", "id").join(t("manifest_groups"), "id", "left")
    return E.comparison_report(pairs, _latest(t), groups, F.lit("EMPTY"))


_REPORT = f"""{_PAIR}, {CURRENT}, g AS (SELECT DISTINCT spec_key, category, group_id FROM cur JOIN manifest_groups USING (id)),
    d AS (SELECT a, b, count(*) FILTER (n = 1) AS only_a, count(*) FILTER (n = 2) AS only_b, count(*) FILTER (n = 3) AS shared FROM (SELECT a, b, category, group_id, sum(m) AS n FROM
        (SELECT s.spec_key AS a, s.spec_key + 1 AS b, category, group_id, 1 AS m FROM specs s JOIN g ON g.spec_key = s.spec_key UNION ALL SELECT s.spec_key, s.spec_key + 1, category, group_id, 2 FROM specs s JOIN g ON g.spec_key = s.spec_key + 1) GROUP BY ALL) GROUP BY a, b),
    rep AS (SELECT s.spec_key AS a, s.spec_key + 1 AS b, r.valid, r.rel_parts, r.rel_schemas, CASE WHEN r.valid AND r.structure_hash IS NOT NULL AND r.yh IS NOT NULL THEN CASE WHEN r.structure_hash = r.yh THEN 'EQUAL' ELSE 'DIFFERENT' END ELSE 'UNAVAILABLE' END AS structure_equal,
        x.parts AS parts_a, x."groups" AS groups_a, y.parts AS parts_b, CASE WHEN ma.spec_key IS NOT NULL AND mb.spec_key IS NOT NULL THEN coalesce(only_a, 0) END AS only_a, CASE WHEN ma.spec_key IS NOT NULL AND mb.spec_key IS NOT NULL THEN coalesce(only_b, 0) END AS only_b,
        CASE WHEN ma.spec_key IS NOT NULL AND mb.spec_key IS NOT NULL THEN coalesce(shared, 0) END AS shared,
        nullif(concat_ws(',', CASE WHEN x.spec_key IS NULL THEN CAST(s.spec_key AS VARCHAR) END, CASE WHEN y.spec_key IS NULL THEN CAST(s.spec_key + 1 AS VARCHAR) END), '') AS no_snapshot,
        nullif(concat_ws(',', CASE WHEN ma.spec_key IS NULL THEN CAST(s.spec_key AS VARCHAR) END, CASE WHEN mb.spec_key IS NULL THEN CAST(s.spec_key + 1 AS VARCHAR) END), '') AS no_manifest
        FROM specs s LEFT JOIN latest x ON x.spec_key = s.spec_key LEFT JOIN latest y ON y.spec_key = s.spec_key + 1 LEFT JOIN r ON r.a = s.spec_key LEFT JOIN d ON d.a = s.spec_key LEFT JOIN cur ma ON ma.spec_key = s.spec_key LEFT JOIN cur mb ON mb.spec_key = s.spec_key + 1)"""


@query(_REPORT + " SELECT a, b, valid, rel_parts AS parts, rel_schemas AS schemas, structure_equal, parts_a, groups_a, parts_b, only_a, only_b, shared, no_snapshot, no_manifest FROM rep")
def comparison_report(t):
    return _report(t).select("a", "b", "valid", "parts", "schemas", "structure_equal", F.col("counts_a.parts").alias("parts_a"), F.col("counts_a.groups").alias("groups_a"), F.col("counts_b.parts").alias("parts_b"), "only_a", "only_b", "shared", "no_snapshot", "no_manifest")


@query(_REPORT + """ SELECT a, b, CASE WHEN no_manifest IS NULL THEN printf('  groups: only in a %d, only in b %d, shared %d', only_a, only_b, shared) ELSE '  groups: unavailable - no complete manifest of ' || no_manifest END AS line FROM rep""")
def comparison_text(t):
    return R.comparison_lines(_report(t)).filter("line_no = 5").select("a", "b", "line")


_GROUPS_OF = f"{CURRENT}, g AS (SELECT DISTINCT spec_key, category, group_id FROM cur JOIN manifest_groups USING (id)), a AS (SELECT spec_key AS pair, category, group_id FROM g), b AS (SELECT spec_key - 1 AS pair, category, group_id FROM g)"


@query(f"WITH {_GROUPS_OF} SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.category, b.category) AS category, coalesce(a.group_id, b.group_id) AS group_id, CASE WHEN b.pair IS NULL THEN 'only_a' WHEN a.pair IS NULL THEN 'only_b' ELSE 'both' END AS side FROM a FULL JOIN b ON a.pair = b.pair AND a.category = b.category AND a.group_id = b.group_id")
def group_diff(t):
    g = _expected(t)
    keys = ["category", "group_id"]
    return L.key_diff(g.select(F.col("spec_key").alias("pair"), *keys), g.select((F.col("spec_key") - 1).alias("pair"), *keys), ["pair", *keys])


def _expected(t):
    return L.current_manifest(t("manifests")).select("spec_key", "run_id", "id").join(t("manifest_groups"), "id")


_EXPECTED = f"{CURRENT}, e AS (SELECT spec_key, run_id, category, group_id FROM cur JOIN manifest_groups USING (id)), miss AS (SELECT * FROM e ANTI JOIN accepted USING (spec_key, run_id, category, group_id))"
_KEYS = ["spec_key", "run_id", "category", "group_id"]


@query(f"WITH {_EXPECTED} SELECT * FROM miss")
def pending_groups(t):
    return _expected(t).join(t("accepted"), _KEYS, "left_anti").select(*_KEYS)


@query(f"WITH {_EXPECTED} SELECT spec_key, count(*) AS missing FROM miss GROUP BY spec_key")
def missing_accepted(t):
    return _expected(t).join(t("accepted"), _KEYS, "left_anti").groupBy("spec_key").agg(F.count("*").alias("missing"))


@query(f"WITH {_EXPECTED} SELECT spec_key, spec_key NOT IN (SELECT spec_key FROM miss) AS complete FROM cur")
def collection_complete(t):
    lacking = _expected(t).join(t("accepted"), _KEYS, "left_anti").select("spec_key").distinct().withColumn("m", F.lit(True))
    return L.current_manifest(t("manifests")).select("spec_key").join(lacking, "spec_key", "left").select("spec_key", F.col("m").isNull().alias("complete"))


@query("SELECT s.scope, count(*) > 0 AND bool_and(v.spec_key IS NOT NULL) AS completed FROM specs s LEFT JOIN (SELECT DISTINCT spec_key FROM snapshots WHERE state IN ('VALID', 'STALE')) v USING (spec_key) GROUP BY s.scope")
def run_completed(t):
    v = t("snapshots").filter(E.usable(F.col("state"))).select("spec_key").distinct().withColumn("ok", F.lit(True))
    return t("specs").join(v, "spec_key", "left").groupBy("scope").agg((F.bool_and(F.col("ok").isNotNull()) & (F.count("*") > 0)).alias("completed"))


def _quality(t):
    expected = _expected(t)
    lacking = expected.join(t("accepted"), _KEYS, "left_anti").groupBy("spec_key").agg(F.count("*").alias("missing"))
    per = L.current_manifest(t("manifests")).select("spec_key", F.lit(True).alias("man")).join(expected.groupBy("spec_key").agg(F.count("*").alias("expected")), "spec_key", "left").join(lacking, "spec_key", "left")
    d = t("specs").select("spec_key").join(_latest(t).withColumn("snap", F.lit(True)), "spec_key", "left").join(per, "spec_key", "left")
    none = lambda c: F.coalesce(c, F.lit(0))
    return R.findings(d.withColumn("has_snapshot", F.col("snap").isNotNull()).withColumn("has_manifest", F.col("man").isNotNull()).withColumn("expected", none("expected")).withColumn("missing", none("missing")))


_FINDINGS = f"""WITH {LATEST}, {_EXPECTED}, q AS (SELECT s.spec_key, l.* EXCLUDE (spec_key), l.spec_key IS NOT NULL AS has_s, c.spec_key IS NOT NULL AS has_m, coalesce(x.n, 0) AS expected, coalesce(m.n, 0) AS missing FROM specs s
    LEFT JOIN latest l USING (spec_key) LEFT JOIN cur c USING (spec_key) LEFT JOIN (SELECT spec_key, count(*) AS n FROM e GROUP BY 1) x USING (spec_key) LEFT JOIN (SELECT spec_key, count(*) AS n FROM miss GROUP BY 1) m USING (spec_key)),
    f AS (SELECT spec_key, 'SPEC_WITHOUT_SNAPSHOT' AS code, 'ERROR' AS severity FROM q WHERE NOT has_s
    UNION ALL SELECT spec_key, 'SNAPSHOT_INVALID', 'ERROR' FROM q WHERE state = 'INVALID'
    UNION ALL SELECT spec_key, 'SNAPSHOT_NOT_VALID', 'WARNING' FROM q WHERE state NOT IN ('INVALID', 'VALID')
    UNION ALL SELECT spec_key, 'COLLECTION_NOT_COMPLETE', 'WARNING' FROM q WHERE NOT collection_complete
    UNION ALL SELECT spec_key, 'SNAPSHOT_FINGERPRINT_UNAVAILABLE', 'WARNING' FROM q WHERE has_s AND structure_hash IS NULL
    UNION ALL SELECT spec_key, 'SNAPSHOT_SUSPICIOUSLY_EMPTY_STRUCTURE', 'WARNING' FROM q WHERE categories = 0 OR "groups" = 0 OR "schemas" = 0
    UNION ALL SELECT spec_key, 'SPEC_WITH_ZERO_PARTS', 'INFO' FROM q WHERE parts = 0
    UNION ALL SELECT spec_key, 'MANIFEST_MISSING_OR_INCOMPLETE', 'WARNING' FROM q WHERE has_s AND NOT has_m
    UNION ALL SELECT spec_key, 'MANIFEST_SNAPSHOT_GROUP_COUNT_MISMATCH', 'WARNING' FROM q WHERE has_s AND has_m AND expected <> "groups"
    UNION ALL SELECT spec_key, 'MANIFEST_GROUPS_NEVER_ACCEPTED', 'WARNING' FROM q WHERE has_s AND has_m AND missing > 0)"""


@query(_FINDINGS + " SELECT * FROM f")
def quality_findings(t):
    return _quality(t).select("spec_key", "code", "severity")


@query(_FINDINGS + " SELECT s.severity, count(f.code) AS n FROM (VALUES ('INFO'), ('WARNING'), ('ERROR')) s(severity) LEFT JOIN f USING (severity) GROUP BY s.severity")
def severity_counts(t):
    return R.severity_counts(_quality(t))


@query("""SELECT snapshot_id, CASE WHEN state <> 'INVALID' AND coalesce(max(CASE WHEN state IN ('VALID', 'INCOMPLETE') THEN 1 ELSE 0 END) OVER (PARTITION BY spec_key ORDER BY collected_at, snapshot_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) = 1
    THEN 'SUPERSEDED' ELSE state END AS final_state FROM snapshots""")
def snapshot_lifecycle(t):
    return E.supersede(t("snapshots")).select("snapshot_id", "final_state")


@query(f"""WITH {LATEST}, n AS (SELECT max(collected_at) AS now FROM snapshots) SELECT spec_key FROM latest JOIN specs USING (spec_key), n WHERE state = 'VALID' AND now - collected_at >= (CASE WHEN ended_at IS NULL THEN 30 ELSE 180 END) * 86400""")
def freshness_candidates(t):
    now = t("snapshots").agg(F.timestamp_seconds(F.max("collected_at")).alias("now"))
    d = _latest(t).filter("state = 'VALID'").join(t("specs").select("spec_key", "ended_at"), "spec_key").join(F.broadcast(now))
    return d.filter(S.stale_candidate(F.timestamp_seconds("collected_at"), F.col("ended_at"), F.col("now"))).select("spec_key")


@query("""WITH n AS (SELECT max(collected_at) AS now FROM snapshots), d AS (SELECT s.*, now - collected_at >= (CASE WHEN ended_at IS NULL THEN 30 ELSE 180 END) * 86400 AS due FROM snapshots s JOIN specs USING (spec_key), n)
    SELECT snapshot_id, CASE WHEN due AND state = 'VALID' THEN 'STALE' ELSE state END AS state, CASE WHEN due AND state <> 'VALID' THEN 'not VALID: ' || state END AS error FROM d""")
def mark_stale(t):
    from ..operators import records

    now = t("snapshots").agg(F.timestamp_seconds(F.max("collected_at")).alias("now"))
    d = t("snapshots").join(t("specs").select("spec_key", "ended_at"), "spec_key").join(F.broadcast(now))
    return records.mark_stale(d, S.stale_candidate(F.timestamp_seconds("collected_at"), F.col("ended_at"), F.col("now"))).select("snapshot_id", "state", "error")


@query("""WITH s AS (SELECT CAST(doc_id AS STRING) AS k, n_chars % 2 = 0 AS crit, n_chars % 3 = 0 AS comp FROM documents) SELECT k, CASE WHEN crit THEN 'INVALID' WHEN comp THEN 'VALID' ELSE 'INCOMPLETE' END AS state FROM s""")
def snapshot_states(t):
    return t("documents").select(F.col("doc_id").cast("string").alias("k"), S.snapshot_state(F.col("n_chars") % 2 == 0, F.col("n_chars") % 3 == 0).alias("state"))


@query(f"""WITH {LATEST}, m AS (SELECT sha256(scope || chr(0) || normalizer_version || chr(0) || fingerprint_version || chr(0) || spec_parts_hash) AS cluster_key, * FROM snapshots WHERE {ELIGIBLE}),
    r AS (SELECT cluster_key, spec_key AS rep FROM m WHERE state = 'VALID' QUALIFY row_number() OVER (PARTITION BY cluster_key ORDER BY images DESC, collected_at DESC, parts DESC, spec_key, snapshot_id) = 1),
    c AS (SELECT spec_key, cluster_key FROM m SEMI JOIN latest USING (snapshot_id, spec_key))
    SELECT s.spec_key, s.model_code, l.snapshot_id, c.cluster_key, coalesce(r.rep = s.spec_key, false) AS is_representative, l.state, l.collected_at, own.image, coalesce(h.n, 0) AS categories, h.tree FROM specs s LEFT JOIN latest l USING (spec_key) LEFT JOIN c USING (spec_key) LEFT JOIN r USING (cluster_key)
    LEFT JOIN (SELECT spec AS spec_key, min(nullif(image_url, '')) AS image FROM parts GROUP BY 1) own USING (spec_key)
    LEFT JOIN (SELECT spec_key, count(*) AS n, string_agg(category || '=' || gs, ';' ORDER BY category) AS tree FROM (SELECT spec AS spec_key, category, string_agg(DISTINCT grp, ',' ORDER BY grp) AS gs FROM parts GROUP BY ALL) GROUP BY 1) h USING (spec_key)""")
def export_view(t):
    m = E.with_cluster(t("snapshots"))
    reps = E.representatives(m.select("cluster_key", "spec_key", "state", "images", "collected_at", "parts")).select("cluster_key", F.col("spec_key").alias("rep"))
    last = _latest(t)
    of = m.join(last.select("snapshot_id"), "snapshot_id", "left_semi").select("spec_key", "cluster_key")
    images = E.own_images(t("parts").select(F.col("spec").alias("spec_key"), F.col("image_url").alias("image")))
    view = E.export_view(t("specs").select("spec_key", "model_code"), last, of, reps, images, t("parts").select(F.col("spec").alias("spec_key"), "category", "grp"))
    tree = F.array_join(F.transform("hierarchy", lambda c: F.concat(c["category"], F.lit("="), F.array_join(c["groups"], ","))), ";")
    return view.select("spec_key", "model_code", "snapshot.snapshot_id", "cluster_key", "is_representative", "snapshot.state", "snapshot.collected_at", "image", F.coalesce(F.size("hierarchy"), F.lit(0)).cast("long").alias("categories"), tree.alias("tree"))


@query("""SELECT o_custkey AS stable_key, arg_min(o_orderpriority, o_orderkey) AS market, arg_min(o_orderstatus, o_orderkey) AS model_code, arg_max(o_orderpriority, o_orderkey) AS grade, arg_max(o_orderstatus, o_orderkey) AS configuration, max(o_orderkey) AS seq FROM orders GROUP BY 1""")
def identity_upsert(t):
    from ..operators import records

    o = t("orders").select(F.col("o_custkey").alias("stable_key"), F.col("o_orderpriority").alias("market"), F.col("o_orderstatus").alias("model_code"), F.col("o_orderpriority").alias("grade"), F.col("o_orderstatus").alias("configuration"), F.col("o_orderkey").alias("seq"))
    return records.upsert_identities(o.filter("seq % 2 = 0"), o.filter("seq % 2 = 1"), "seq")


@query("""WITH old AS (SELECT DISTINCT spec_parts_hash FROM snapshots WHERE collected_at < 1705000000) SELECT spec_parts_hash, arg_min(snapshot_id, snapshot_id) AS snapshot_id FROM snapshots WHERE collected_at >= 1705000000 AND spec_parts_hash NOT IN (SELECT * FROM old) GROUP BY 1""")
def insert_or_get(t):
    s = t("snapshots")
    return L.insert_missing(s.filter("collected_at < 1705000000").select("spec_parts_hash").distinct(), s.filter("collected_at >= 1705000000").select("spec_parts_hash", "snapshot_id"), ["spec_parts_hash"], ["snapshot_id"])


@query("""SELECT spec_key, concat_ws(';', CASE WHEN model_code <> 'C' || CAST(spec_key % 89 AS VARCHAR) THEN 'model_code:C' || CAST(spec_key % 89 AS VARCHAR) || '/' || model_code END,
    CASE WHEN spec_key % 3 <> 0 AND market IS DISTINCT FROM 'm' || CAST(spec_key % 5 AS VARCHAR) THEN 'market:m' || CAST(spec_key % 5 AS VARCHAR) || '/' || market END) AS diverges FROM specs""")
def identity_divergence(t):
    s = t("specs").withColumn("want_market", F.when(F.col("spec_key") % 3 != 0, F.concat(F.lit("m"), (F.col("spec_key") % 5).cast("string")))).withColumn("want_code", F.concat(F.lit("C"), (F.col("spec_key") % 89).cast("string")))
    found = E.divergence({"model_code": (F.col("want_code"), F.col("model_code")), "market": (F.col("want_market"), F.col("market"))})
    return s.select("spec_key", F.array_join(F.transform(found, lambda x: F.concat(x["field"], F.lit(":"), x["expected"], F.lit("/"), x["actual"])), ";").alias("diverges"))


@query(f"""WITH {LATEST}, z AS (SELECT s.scope, count(*) AS discovered, count(l.spec_key) AS n, min("groups") AS lo, max("groups") AS hi, avg("groups") AS mean, median("groups") AS med, CAST(coalesce(sum(parts), 0) AS BIGINT) AS parts FROM specs s LEFT JOIN latest l USING (spec_key) GROUP BY s.scope)
    SELECT scope, 0 AS line_no, 'Summary - ' || scope AS line FROM z UNION ALL SELECT scope, 1, '  specs discovered: ' || replace(format('{{:,}}', discovered), ',', '.') FROM z UNION ALL SELECT scope, 7, '  parts: ' || replace(format('{{:,}}', parts), ',', '.') FROM z
    UNION ALL SELECT scope, 8, CASE WHEN n = 0 THEN '  groups/spec: no specs with a snapshot' ELSE printf('  groups/spec: min=%d max=%d mean=%.2f median=%.2f (n=%d)', lo, hi, mean, med, n) END FROM z""")
def summary_text(t):
    return R.summary_lines(R.scope_summary(t("specs").select("scope", "spec_key"), _latest(t).drop("scope"), ["scope"])).filter("line_no IN (0, 1, 7, 8)")


@query(_FINDINGS + " SELECT spec_key, '  [' || severity || '] ' || code || ': ' || CAST(spec_key AS VARCHAR) AS line FROM f")
def quality_text(t):
    return R.finding_lines(_quality(t)).select("spec_key", "line")


@query(f"WITH {_KEYED}, c AS (SELECT cluster_key FROM k GROUP BY 1 HAVING count(*) >= 2) SELECT cluster_key, printf('    %s | catalog %s | %s parts | key=%s', model_code, catalog_id, CAST(k.parts AS VARCHAR), CAST(spec_key AS VARCHAR)) AS line FROM k SEMI JOIN c USING (cluster_key) JOIN specs USING (spec_key)")
def redundancy_text(t):
    return R.member_lines(E.cluster_members(t("snapshots"), t("specs"))).select("cluster_key", "line")


@query(_FINDINGS + """ SELECT spec_key, code, '{"code":"' || code || '","severity":"' || severity || '","spec_key":' || spec_key || '}' AS json FROM f""")
def quality_json(t):
    found = _quality(t).select("spec_key", "code", "severity")
    return R.json_rows(found, ["spec_key", "code"])


@query("""SELECT '{"event":"' || event_type || '","run_id":"r' || CAST(user_id % 4 AS VARCHAR) || '","seq":' || seq || ',"timestamp":' || t_s || '}' AS line FROM run_events""")
def event_log(t):
    return R.log_lines(t("run_events").select(F.concat(F.lit("r"), (F.col("user_id") % 4).cast("string")).alias("run_id"), F.col("event_type").alias("event"), F.col("t_s").alias("timestamp"), "seq"))
