"""Queries over stored records: ordered scans, lookups, appends, upserts, current state, and trees from parsed pages to fingerprints."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import assembly as A
from ..operators import equivalence as E
from ..operators import latest as L
from ..operators import pages
from ..operators import records as R
from ..sources import tables
from .catalogue import CURRENT, ELIGIBLE
from .content import _ALL, _fp
from .standins import Registry

query = Registry()

# scans and lookups


@query("SELECT row_number() OVER (ORDER BY catalog_id) AS place, catalog_id AS stable_key FROM specs")
def identity_scan(t):
    s = R.identities(t("specs").select(F.col("catalog_id").alias("stable_key")))
    return s.select(F.row_number().over(W.orderBy("stable_key")).cast("long").alias("place"), "stable_key")


@query("SELECT o_custkey AS stable_key, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders")
def discovery_history(t):
    h = R.history(t("orders").select(F.col("o_custkey").alias("stable_key"), F.col("o_orderkey").alias("id")))
    return h.withColumn("place", F.row_number().over(W.partitionBy("stable_key").orderBy("id")).cast("long"))


@query("SELECT run_id, spec_key, string_agg(category || '/' || group_id, ',' ORDER BY category, group_id) AS groups FROM accepted GROUP BY ALL")
def accepted_groups(t):
    a = R.accepted_groups(t("accepted").withColumn("status", F.lit("ACCEPTED")).unionByName(t("accepted").withColumn("status", F.lit("REJECTED")).limit(0)))
    return a.groupBy("run_id", "spec_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("category", "group_id"))), lambda x: F.concat_ws("/", x["category"], x["group_id"])), ",").alias("groups"))


@query("SELECT scope, run_id, started_at FROM runs WHERE completed_at IS NULL")
def incomplete_runs(t):
    return R.incomplete_runs(t("runs")).select("scope", "run_id", "started_at")


@query("SELECT run_id, started_at FROM runs WHERE completed_at IS NULL AND scope = 'scope7'")
def incomplete_runs_of_scope(t):
    return R.incomplete_runs(t("runs"), "scope7").select("run_id", "started_at")


_KEYED = f"k AS (SELECT sha256(scope || chr(0) || normalizer_version || chr(0) || fingerprint_version || chr(0) || spec_parts_hash) AS cluster_key, spec_key, collected_at, snapshot_id FROM snapshots WHERE {ELIGIBLE})"
_ASSIGNED = f"WITH {_KEYED}, asg AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY collected_at DESC, snapshot_id DESC) = 1)"


def _assigned(t):
    m = E.with_cluster(t("snapshots")).select("cluster_key", "spec_key", F.struct("collected_at", "snapshot_id").alias("at"))
    return R.replace_rows(m.filter("at.collected_at % 172800 = 0"), m.filter("at.collected_at % 172800 <> 0"), ["spec_key"], "at")


@query(_ASSIGNED + " SELECT cluster_key, spec_key FROM asg")
def cluster_assignment(t):
    return _assigned(t).select("cluster_key", "spec_key")


@query(_ASSIGNED + " SELECT cluster_key, spec_key, row_number() OVER (PARTITION BY cluster_key ORDER BY spec_key) AS place FROM asg")
def members_of_cluster(t):
    return R.members(_assigned(t).select("cluster_key", "spec_key")).withColumn("place", F.col("place").cast("long"))


@query("SELECT k.spec_key, s.spec_key IS NOT NULL AS found, model_code FROM (SELECT DISTINCT doc_id * 3 AS spec_key FROM labels) k LEFT JOIN specs s USING (spec_key)")
def point_lookups(t):
    keys = t("labels").select((F.col("doc_id") * 3).alias("spec_key")).distinct()
    return R.present(t("specs").select("spec_key", "model_code"), keys, ["spec_key"])


@query(f"WITH {CURRENT} SELECT spec_key, category, group_id, CASE WHEN a.raw_capture_id IS NULL THEN 'PENDING' ELSE 'ACCEPTED' END AS status FROM cur JOIN manifest_groups USING (id) LEFT JOIN accepted_captures a USING (spec_key, run_id, category, group_id)")
def checkpoint_lookup(t):
    g = L.current_manifest(t("manifests")).select("spec_key", "run_id", "id").join(t("manifest_groups"), "id").drop("id")
    return R.checkpoint_of(g, t("accepted_captures").withColumn("status", F.lit("ACCEPTED")), ["spec_key", "run_id", "category", "group_id"]).select("spec_key", "category", "group_id", "status")


@query("SELECT capture_id, octet_length(encode(html)) AS size_bytes, sha256(html) AS content_hash FROM captures")
def blob_read(t):
    """A capture's content out of a store of its own, by hash; a blob that is missing would be null."""
    c = t("captures")
    store = tables.write_blobs(c, _folder(c.sparkSession))
    found = tables.replay(c.select("capture_id", F.sha2(F.col("html").cast("binary"), 256).alias("content_hash")), store.select("content_hash", "size_bytes"))
    return found.select("capture_id", "size_bytes", "content_hash")


@query("SELECT capture_id, c AS category, n AS group_id FROM (SELECT capture_id, c, unnest(CASE c WHEN 'brakes' THEN range(0, capture_id % 4) ELSE range(0, capture_id % 3) END) AS n FROM captures, (VALUES ('brakes'), ('engine')) v(c))")
def manifest_json(t):
    """Manifests of several categories and groups, empty ones among them, out of JSON."""
    groups = lambda m: F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), F.col("capture_id") % m - 1), lambda i: F.format_string('{"group_id":"%s","source_url":"u"}', i.cast("string"))), ","), F.lit("]"))
    some = lambda m: F.when(F.col("capture_id") % m > 0, groups(m)).otherwise(F.lit("[]"))
    c = t("captures").select("capture_id", F.format_string('[{"category_slug":"brakes","groups":%s},{"category_slug":"engine","groups":%s}]', some(4), some(3)).alias("categories_json"))
    return tables.decode_categories(c).select("capture_id", "category", F.col("group_id").cast("long").alias("group_id"))


# appends and upserts


def _folder(spark):
    """A folder of its own for what a query writes, in the session's shared checkpoint folder; only a local session may be without one."""
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="tallymark-")
    return f"{root}/written-{uuid.uuid4().hex}"


@query("SELECT sha256(html) AS content_hash, octet_length(encode(any_value(html))) AS size_bytes, min(collected_at) AS first_seen_at FROM captures GROUP BY 1")
def blob_write(t):
    """All captures written in two overlapping batches, one of them twice: each content is there once, first seen at its least time so far."""
    c = t("captures").orderBy("collected_at")
    folder = _folder(c.sparkSession)
    early = c.filter(F.col("collected_at") < 1704067200 + 20)
    for batch in (early, early, c):
        store = tables.write_blobs(batch, folder)
    return store.select("content_hash", "size_bytes", "first_seen_at")


@query("SELECT doc_id AS id, lang || ':' || source AS scope, count(*) OVER (PARTITION BY lang, source) AS in_scope FROM documents")
def append_rows(t):
    """Captures, manifests and discovery entries are appended as they come, in two writes."""
    d = t("documents").select(F.col("doc_id").alias("id"), F.concat_ws(":", "lang", "source").alias("scope"))
    spark, folder = d.sparkSession, _folder(d.sparkSession)
    tables.write_table(d.filter("id % 3 = 0"), folder, "entries")
    tables.write_table(d.filter("id % 3 <> 0"), folder, "entries")
    return tables.table(spark, folder, "entries").withColumn("in_scope", F.count("*").over(W.partitionBy("scope")))


@query("SELECT spec_key, 'site' AS source, coalesce(CASE WHEN n_chars % 4 > 0 THEN CAST(n_chars AS VARCHAR) END, '') AS production_period_raw FROM specs")
def discovered_identity(t):
    return R.as_identity(t("specs").select("spec_key", F.when(F.col("n_chars") % 4 > 0, F.col("n_chars").cast("string")).alias("production_period_raw")), "site").select("spec_key", "source", "production_period_raw")


@query("""SELECT user_id AS run_id, arg_min(event_type, seq) AS scope, arg_min(t_s, seq) AS started_at, CASE WHEN arg_max(kind, seq) = 'START' THEN arg_max(t_s, seq) END AS resumed_at, CASE WHEN arg_max(kind, seq) = 'ACCEPT' THEN arg_max(t_s, seq) END AS completed_at FROM run_events GROUP BY 1""")
def run_upsert(t):
    at = lambda kind: F.when(F.col("kind") == kind, F.col("t_s"))
    return R.upsert_runs(t("run_events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("scope"), F.col("t_s").alias("started_at"), at("START").alias("resumed_at"), at("ACCEPT").alias("completed_at"), "seq"))


@query("""WITH w AS (SELECT user_id AS key, seq, kind AS status, min(CASE WHEN kind = 'ACCEPT' THEN seq END) OVER (PARTITION BY user_id) AS done FROM run_events WHERE kind <> 'CHALLENGE')
    SELECT key, CASE arg_max(status, seq) WHEN 'ACCEPT' THEN 'ACCEPTED' ELSE arg_max(status, seq) END AS status, max(seq) AS seq FROM w WHERE done IS NULL OR seq <= done GROUP BY key""")
def checkpoint_upsert(t):
    e = t("run_events").filter("kind <> 'CHALLENGE'").select(F.col("user_id").alias("key"), F.when(F.col("kind") == "ACCEPT", "ACCEPTED").otherwise(F.col("kind")).alias("status"), "seq")
    half = F.col("seq") % 2 == 0
    return R.upsert_checkpoints(e.filter(half), e.filter(~half), ["key"], "seq")


@query("SELECT snapshot_id, CASE WHEN spec_key % 4 = 0 THEN CASE WHEN spec_key % 8 = 0 THEN md5(snapshot_id) END ELSE structure_hash END AS structure_hash, CASE WHEN spec_key % 4 = 0 THEN 'x' ELSE image_hash END AS image_hash, spec_parts_hash FROM snapshots")
def fingerprint_update(t):
    s = t("snapshots")
    new = s.filter("spec_key % 4 = 0").select("snapshot_id", F.when(F.col("spec_key") % 8 == 0, F.md5("snapshot_id")).alias("structure_hash"), F.lit("x").alias("image_hash"))
    unknown = new.limit(1).withColumn("snapshot_id", F.lit("no such snapshot"))
    return R.update_hashes(s, new.unionByName(unknown), ("structure_hash", "image_hash")).select("snapshot_id", "structure_hash", "image_hash", "spec_parts_hash")


@query(_ASSIGNED + """, u AS (SELECT * FROM snapshots WHERE state IN ('VALID', 'STALE') QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY collected_at DESC, snapshot_id DESC) = 1)
    SELECT u.spec_key, u.snapshot_id, u.state, asg.cluster_key FROM u LEFT JOIN asg USING (spec_key)""")
def current_state(t):
    return R.materialize(t("snapshots"), _assigned(t), ["collected_at", "snapshot_id"]).select("spec_key", "snapshot_id", "state", "cluster_key")


@query("SELECT spec AS spec_key, CASE WHEN spec % 3 = 0 THEN 'old.png' ELSE coalesce(min(image_url), 'old.png') END AS image FROM parts GROUP BY spec")
def image_upsert(t):
    own = E.own_images(t("parts").select(F.col("spec").alias("spec_key"), F.col("image_url").alias("image")))
    old = own.select("spec_key", F.lit("old.png").alias("image"), F.lit(0).alias("at"))
    return R.replace_rows(old, own.filter("spec_key % 3 <> 0 AND image IS NOT NULL").withColumn("at", F.lit(1)), ["spec_key"], "at").select("spec_key", "image")


@query("""WITH op AS (SELECT scope, count(*) AS n, min(run_id) AS only_run FROM runs WHERE completed_at IS NULL GROUP BY 1),
    q AS (SELECT o_orderkey AS request, 'scope' || CAST(o_custkey % 60 AS VARCHAR) AS scope, CASE o_orderkey % 5 WHEN 0 THEN 'r' || CAST(o_orderkey AS VARCHAR) WHEN 1 THEN 'r' || CAST(o_orderkey + 1 AS VARCHAR) END AS explicit, o_orderkey % 5 = 2 AS new FROM orders),
    d AS (SELECT q.*, r.run_id AS known, r.scope AS of, r.completed_at, coalesce(n, 0) AS n, only_run FROM q LEFT JOIN runs r ON r.run_id = q.explicit LEFT JOIN op ON op.scope = q.scope),
    z AS (SELECT *, CASE WHEN explicit IS NOT NULL THEN CASE WHEN known IS NULL THEN 'ERROR_UNKNOWN' WHEN of <> scope THEN 'ERROR_SCOPE' WHEN completed_at IS NOT NULL THEN 'ERROR_COMPLETED' ELSE 'RESUME' END WHEN new OR n = 0 THEN 'CREATE' WHEN n = 1 THEN 'RESUME' ELSE 'ERROR_AMBIGUOUS' END AS decision FROM d)
    SELECT request, decision, CASE WHEN decision = 'RESUME' THEN coalesce(explicit, only_run) END AS run_id FROM z""")
def run_choice(t):
    k = F.col("o_orderkey")
    explicit = F.when(k % 5 == 0, F.concat(F.lit("r"), k.cast("string"))).when(k % 5 == 1, F.concat(F.lit("r"), (k + 1).cast("string")))
    return R.run_choice(t("orders").select(k.alias("request"), F.concat(F.lit("scope"), (F.col("o_custkey") % 60).cast("string")).alias("scope"), explicit.alias("explicit"), (k % 5 == 2).alias("new")), t("runs"))


@query("""WITH e AS (SELECT seq // 3 AS id, user_id % 4 AS run_id, t_s, CASE WHEN seq % 3 = 0 THEN 'OPEN' WHEN kind <> 'START' THEN 'CLOSE' END AS k FROM run_events)
    SELECT id, arg_min(run_id, t_s) FILTER (k = 'OPEN') AS run_id, min(t_s) FILTER (k = 'OPEN') AS observed_at, max(t_s) FILTER (k = 'CLOSE') AS resolved_at FROM e GROUP BY id HAVING count(*) FILTER (k = 'OPEN') > 0""")
def challenge_events(t):
    kind = F.when(F.col("seq") % 3 == 0, "OPEN").when(F.col("kind") != "START", "CLOSE")
    e = t("run_events").select(F.floor(F.col("seq") / 3).alias("id"), (F.col("user_id") % 4).alias("run_id"), F.col("t_s").alias("ts"), kind.alias("kind"))
    return R.challenge_intervals(e)


@query("SELECT user_id % 4 AS run_id, user_id AS worker_id, max(t_s) AS last_heartbeat_at FROM run_events GROUP BY ALL")
def heartbeat_upsert(t):
    return R.heartbeats(t("run_events").select((F.col("user_id") % 4).alias("run_id"), F.col("user_id").alias("worker_id"), F.col("t_s").alias("ts")))


@query("""WITH p AS (SELECT user_id AS key, t_s - min(t_s) OVER (PARTITION BY user_id) AS elapsed, CASE kind WHEN 'ACCEPT' THEN 'ACCEPTED' WHEN 'REJECT' THEN 'INVALID' ELSE 'CHALLENGE' END AS outcome FROM run_events),
    c AS (SELECT key, elapsed, outcome FROM p WHERE outcome <> 'CHALLENGE' AND elapsed <= 90000 QUALIFY row_number() OVER (PARTITION BY key ORDER BY elapsed, outcome) = 1), l AS (SELECT key, min(elapsed) AS late FROM p WHERE elapsed > 90000 GROUP BY 1)
    SELECT k.key, CASE WHEN c.key IS NOT NULL THEN c.outcome WHEN late IS NOT NULL THEN 'TIMED_OUT' ELSE 'WAITING' END AS result, coalesce(c.elapsed, late) AS "at" FROM (SELECT DISTINCT key FROM p) k LEFT JOIN c USING (key) LEFT JOIN l USING (key)""")
def challenge_wait(t):
    w = W.partitionBy("user_id")
    p = t("run_events").select(F.col("user_id").alias("key"), (F.col("t_s") - F.min("t_s").over(w)).alias("elapsed"), F.when(F.col("kind") == "ACCEPT", "ACCEPTED").when(F.col("kind") == "REJECT", "INVALID").otherwise("CHALLENGE").alias("outcome"))
    return R.wait_outcome(p, 90_000)


@query("""WITH a AS (SELECT user_id AS worker, seq, CASE WHEN seq % 29 = 0 THEN 'STOP' WHEN t_s % 17 = 0 THEN 'FINISH' WHEN t_s % 3 = 0 THEN 'THROTTLED' ELSE 'CLAIM' END AS action FROM run_events)
    SELECT worker, seq, action FROM a QUALIFY seq <= coalesce(min(CASE WHEN action IN ('STOP', 'FINISH') THEN seq END) OVER (PARTITION BY worker), seq)""")
def worker_actions(t):
    c = t("run_events").select(F.col("user_id").alias("worker"), "seq", (F.col("t_s") % 17).alias("candidates"), (F.col("t_s") % 3).alias("free"), (F.col("seq") % 29 == 0).alias("stopped"))
    return R.worker_actions(c)


@query("SELECT o_custkey AS run_id, CASE WHEN bool_or(o_orderkey % 11 = 1) THEN 'FAILED' WHEN bool_or(o_orderstatus = 'P') THEN 'RUNNING' ELSE 'COMPLETED' END AS result FROM orders GROUP BY 1")
def pool_result(t):
    code = F.when(F.col("o_orderkey") % 11 == 1, 1).when(F.col("o_orderstatus") != "P", 0)
    return R.pool_result(t("orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("worker"), code.alias("exit_code")))


@query("SELECT spec_key, CASE WHEN market NOT IN ('m1', 'm2', 'm3') THEN 'MARKET_INDEX' WHEN spec_key IN (SELECT spec_key FROM accepted) THEN 'GROUPS' ELSE 'FINALIZE' END AS phase FROM specs")
def collection_phases(t):
    indexed = t("specs").filter("market IN ('m1', 'm2', 'm3')").select("market")
    return R.phases(t("specs").select("spec_key", "market"), indexed, t("accepted").select("spec_key"))


@query("SELECT spec_key, upper(trim(manufacturer)) || ':' || upper(trim(vehicle_model)) || ':' || upper(trim(market)) AS equivalence_scope FROM specs")
def equivalence_scope(t):
    return R.equivalence_scope(t("specs"), "manufacturer", "vehicle_model", "market").select("spec_key", "equivalence_scope")


# trees


def _group_pages(t):
    """A page of each captured group, written from its parts; its rows come back by parsing it."""
    cell = lambda name, c: F.concat(F.lit(f'<td class="entriesTable__{name}"> '), c, F.lit(" </td>"))
    row = F.concat(F.lit('<tr data-key="'), F.lower("pnc"), F.lit('">'), cell("number", F.col("oem")), cell("description", F.col("description")), cell("required", F.col("quantity")), F.lit("</tr>"))
    keys = ["spec_key", "run_id", "category", "group_id"]
    image = F.concat(F.lit('<div class="imgMap"><img src="'), F.min("image_url"), F.lit('"></div>'))
    schema = t("group_parts").groupBy(*keys, "schema_id").agg(F.concat(F.lit('<div class="epcSchema__schema" data-id=" '), F.first("schema_id"), F.lit(' ">'), image, F.lit('<table class="entriesTable">'), F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table></div>")).alias("s"))
    page = schema.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("s")), "").alias("s"))
    html = F.concat(F.lit('<div class="epcVariation__details"></div><div class="epcSchema__schemas">'), F.coalesce("s", F.lit("")), F.lit("</div>"))
    of = t("accepted_captures").join(page, keys, "left")
    # group 7 of every fifth spec lacks its container: a critical page; groups 6 and 7 have no parts: empty ones
    return of.select(*keys, F.concat_ws("/", *keys, "raw_capture_id").alias("raw_capture_id"), F.when((F.col("group_id") == "7") & (F.col("spec_key") % 5 == 0), F.lit("<div></div>")).otherwise(html).alias("html"))


def _planned(t):
    captured = _group_pages(t)
    # a page is parsed once: its rows are a table, which trees are assembled from
    spark, folder = captured.sparkSession, _folder(captured.sparkSession)
    tables.write_table(pages.parse_pages(captured.select(F.col("raw_capture_id").alias("capture_id"), "html"), "GROUP_DETAIL"), folder, "parsed")
    return captured.drop("html"), tables.table(spark, folder, "parsed")


_TREE = """auth AS (SELECT * FROM (SELECT * FROM manifests QUALIFY row_number() OVER (PARTITION BY spec_key, run_id ORDER BY id DESC) = 1) WHERE manifest_complete),
    ex AS (SELECT spec_key, run_id, category, group_id FROM auth JOIN manifest_groups USING (id)), got AS (SELECT spec_key, run_id, category, group_id FROM ex JOIN accepted_captures USING (spec_key, run_id, category, group_id)),
    img AS (SELECT spec_key, run_id, category, group_id, schema_id, min(image_url) AS image FROM group_parts GROUP BY ALL),
    tree AS (SELECT CAST(spec_key AS VARCHAR) || '/' || run_id AS spec, category, group_id AS grp, p.schema_id, p.pnc, p.oem, p.description, NULL AS details, NULL AS period, p.quantity, i.image AS image_url
        FROM got LEFT JOIN group_parts p USING (spec_key, run_id, category, group_id) LEFT JOIN img i USING (spec_key, run_id, category, group_id, schema_id)
        UNION ALL SELECT CAST(spec_key AS VARCHAR) || '/' || run_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM auth ANTI JOIN got USING (spec_key, run_id))"""


@query(f"WITH {_TREE} SELECT spec, category, grp, schema_id, count(pnc) AS parts FROM tree WHERE category IS NOT NULL GROUP BY ALL")
def assemble_tree(t):
    accepted, details = _planned(t)
    expected = L.authoritative_manifest(t("manifests")).select("spec_key", "run_id", "id").join(t("manifest_groups"), "id")
    tree = A.normalize_parts(A.assemble(expected, accepted, details))
    return tree.groupBy(F.concat_ws("/", F.col("spec.spec_key").cast("string"), "spec.run_id").alias("spec"), "category", "grp", "schema_id").agg(F.count("pnc").alias("parts"))


_TREE_CHAIN = _fp("tree", "spec") + ", " + _ALL.replace("SELECT spec, category, sha256(", "SELECT spec, category, CASE WHEN category IS NOT NULL THEN sha256(").replace("SELECT spec, category, grp, sha256(", "SELECT spec, category, grp, CASE WHEN grp IS NOT NULL THEN sha256(").replace("|| '}') AS group_fp", "|| '}') END AS group_fp").replace("|| '}') AS category_fp", "|| '}') END AS category_fp")
_STATE = """st AS (SELECT CAST(a.spec_key AS VARCHAR) || '/' || a.run_id AS spec, bool_and(got.group_id IS NOT NULL OR ex.group_id IS NULL) AS collection_complete, bool_or(coalesce(got.group_id = '7' AND a.spec_key % 5 = 0, false)) AS bad
    FROM auth a LEFT JOIN ex USING (spec_key, run_id) LEFT JOIN got ON got.spec_key = a.spec_key AND got.run_id = a.run_id AND got.category = ex.category AND got.group_id = ex.group_id GROUP BY 1),
    cn AS (SELECT spec, count(DISTINCT category) AS categories, count(DISTINCT category || chr(0) || grp) AS "groups", count(DISTINCT category || chr(0) || grp || chr(0) || schema_id) AS "schemas", count(part_fp) AS parts FROM fp GROUP BY 1)"""


@query(f"""WITH {_TREE}, {_TREE_CHAIN}, {_STATE} SELECT spec, collection_complete, CASE WHEN bad THEN 'INVALID' WHEN collection_complete THEN 'VALID' ELSE 'INCOMPLETE' END AS state, structure_hash, spec_parts_hash, schema_semantic_hash, image_hash, categories, "groups", "schemas", parts
    FROM st JOIN structure_hash USING (spec) JOIN spec_parts_hash USING (spec) JOIN schema_semantic_hash USING (spec) JOIN image_hash USING (spec) JOIN cn USING (spec)""")
def finalize_tree(t):
    """From captured pages to the four hashes, state and counts of every run of every spec."""
    accepted, details = _planned(t)
    plan = A.plan_finalization(t("manifests"), t("manifest_groups"), accepted, details, True)
    return plan.select(F.concat_ws("/", F.col("spec_key").cast("string"), "run_id").alias("spec"), "collection_complete", "state", "structure_hash", "spec_parts_hash", "schema_semantic_hash", "image_hash", "categories", "groups", "schemas", "parts")


@query("""WITH o AS (SELECT snapshot_id, spec_key, state, collected_at, md5(spec_parts_hash || CAST(spec_key AS VARCHAR)) AS idempotency_key FROM snapshots WHERE right(snapshot_id, 1) = '0'),
    p AS (SELECT snapshot_id, spec_key, state, collected_at + 9000000 AS collected_at, CASE WHEN spec_key % 4 = 0 THEN md5(spec_parts_hash || CAST(spec_key AS VARCHAR)) ELSE md5(snapshot_id) END AS idempotency_key FROM snapshots WHERE right(snapshot_id, 1) = '1'),
    n AS (SELECT * FROM p ANTI JOIN o USING (idempotency_key)), h AS (SELECT spec_key, max(collected_at) AS heir FROM n WHERE state IN ('VALID', 'INCOMPLETE') GROUP BY 1)
    SELECT o.snapshot_id, CASE WHEN state IN ('VALID', 'STALE') AND collected_at < heir THEN 'SUPERSEDED' ELSE state END AS state FROM o LEFT JOIN h USING (spec_key) UNION ALL SELECT snapshot_id, state FROM n""")
def commit_finalization(t):
    s = t("snapshots").withColumn("n", F.right("snapshot_id", F.lit(1)))
    same = F.md5(F.concat("spec_parts_hash", F.col("spec_key").cast("string")))
    old = s.filter("n = '0'").select("snapshot_id", "spec_key", "state", "collected_at", same.alias("idempotency_key"))
    plans = s.filter("n = '1'").select("snapshot_id", "spec_key", "state", (F.col("collected_at") + 9_000_000).alias("collected_at"), F.when(F.col("spec_key") % 4 == 0, same).otherwise(F.md5("snapshot_id")).alias("idempotency_key"))
    return A.commit(plans, old).select("snapshot_id", "state")


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END AS description, CASE WHEN p_size % 7 = 0 THEN '' ELSE upper(replace(p_type, ' ', '')) END AS oem, upper(p_brand) AS pnc, p_type AS schema_id,
    array_to_string(list_sort([upper(x) FOR x IN string_split(p_name, ' ')]), ',') AS pr_codes, ' ' || p_brand AS image_url FROM part""")
def normalize_parts(t):
    p = t("part").select(
        "p_partkey", F.when(F.col("p_size") % 5 == 0, "  \n ").otherwise(F.concat(F.lit(" \t"), F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit("\r\n"))).alias("description"), F.when(F.col("p_size") % 7 == 0, " ").otherwise(F.lower("p_type")).alias("oem"),
        F.concat(F.lit(" "), F.lower("p_brand")).alias("pnc"), F.concat("p_type", F.lit(" \n")).alias("schema_id"), F.split("p_name", " ").alias("pr_codes"), F.concat(F.lit(" "), "p_brand").alias("image_url"),
    )
    return A.normalize_parts(p).select("p_partkey", "description", "oem", "pnc", "schema_id", F.array_join("pr_codes", ",").alias("pr_codes"), "image_url")


# pages with errors

_DETAIL = '<div class="epcVariation__details"></div>'


@query("""SELECT p_partkey AS capture_id, p_size % 9 AS kind, CASE p_size % 9 WHEN 0 THEN 'missing .epcVariation__details' WHEN 1 THEN 'missing .epcVariation__schemaGroups' WHEN 2 THEN 'missing .epcVariation__schemas' WHEN 3 THEN 'short href' WHEN 4 THEN 'data-id differs from href'
    WHEN 5 THEN 'category not declared' WHEN 6 THEN 'repeated group' END AS error, p_size % 9 < 7 AS critical, CASE WHEN p_size % 9 = 8 THEN false WHEN p_size % 9 = 7 THEN true END AS manifest_complete FROM part""")
def html_manifest_errors(t):
    """All conditions that make a navigation page critical, and an empty manifest under declared categories."""
    n = F.col("p_size") % 9
    nav = F.lit('<div class="epcVariation__schemaGroups"><a class="epcVariation__schemaGroup" data-id="1" href="/c/brakes">B</a></div>')
    card = lambda key, href: F.lit(f'<div class="epcVariation__schema" data-id="{key}"><div class="epcVariation__schema-name"><a href="{href}">x</a></div></div>')
    cards = F.when(n == 3, card("7", "7")).when(n == 4, card("7", "/c/brakes/8")).when(n == 5, card("7", "/c/lamps/7")).when(n == 6, F.concat(card("7", "/c/brakes/7"), card("7", "/c/brakes/7/"))).when(n == 8, F.lit("")).otherwise(card("7", "/c/brakes/7"))
    box = F.when(n == 2, F.lit("")).otherwise(F.concat(F.lit('<div class="epcVariation__schemas">'), cards, F.lit("</div>")))
    html = F.concat(F.when(n == 0, F.lit("")).otherwise(F.lit(_DETAIL)), F.when(n == 1, F.lit("")).otherwise(nav), box)
    p = t("part").select(F.col("p_partkey").alias("capture_id"), html.alias("html"))
    rows = pages.parse_pages(p, "SPEC_NAVIGATION").join(t("part").select(F.col("p_partkey").alias("capture_id"), (F.col("p_size") % 9).alias("kind")), "capture_id")
    return rows.select("capture_id", "kind", "error", F.coalesce("critical", F.lit(False)).alias("critical"), "manifest_complete")


@query("""WITH p AS (SELECT p_partkey AS capture_id, p_size % 6 AS k FROM part) SELECT capture_id, CASE k WHEN 0 THEN 'missing .epcVariation__details' WHEN 1 THEN 'missing .epcSchema__schemas' WHEN 2 THEN 'schema without data-id' WHEN 3 THEN 'row without data-key' END AS error,
    k < 2 AS critical, CASE k WHEN 3 THEN 'S' END AS schema_id, CAST(NULL AS VARCHAR) AS pnc FROM p WHERE k < 4 UNION ALL SELECT capture_id, NULL, NULL, CASE WHEN k < 5 THEN 'S' END, CASE k WHEN 3 THEN 'K' END FROM p WHERE k >= 3""")
def html_detail_errors(t):
    """Group pages without their containers, schemas and rows without keys, a schema without parts, a page without schemas."""
    n = F.col("p_size") % 6
    row = F.lit('<tr data-key="K"><td class="entriesTable__number">1</td></tr>')
    table = lambda rows: F.concat(F.lit('<div class="epcSchema__schema" data-id="S"><table class="entriesTable">'), rows, F.lit("</table></div>"))
    inside = F.when(n == 2, F.lit('<div class="epcSchema__schema" data-id=""></div>')).when(n == 3, table(F.concat(F.lit('<tr data-key=""></tr>'), row))).when(n == 4, table(F.lit(""))).otherwise(F.lit(""))
    html = F.concat(F.when(n == 0, F.lit("")).otherwise(F.lit(_DETAIL)), F.when(n == 1, F.lit("")).otherwise(F.concat(F.lit('<div class="epcSchema__schemas">'), inside, F.lit("</div>"))))
    p = t("part").select(F.col("p_partkey").alias("capture_id"), html.alias("html"))
    return pages.parse_pages(p, "GROUP_DETAIL").select("capture_id", "error", "critical", "schema_id", "pnc")


@query("""SELECT p_partkey AS capture_id, CASE p_size % 7 WHEN 5 THEN '2 cells' WHEN 6 THEN 'no catalogue number' END AS error, CASE WHEN p_size % 7 < 5 AND p_size % 7 <> 3 THEN '2011-05-01' END AS start, CASE p_size % 7 WHEN 0 THEN '2014-12-01' END AS "end" FROM part""")
def html_market_periods(t):
    """Closed, open, half-readable and unreadable periods (a month 13 is no month), and rows that are no variation."""
    n = F.col("p_size") % 7
    period = F.when(n == 0, "2011.05 - 2014.12").when(n == 1, "2011.05 - ...").when(n == 2, "2011.05 - 2014.13").when(n == 3, "since 2011").otherwise("2011.05 - later")
    href = F.when(n == 6, "/x/a").otherwise(F.concat(F.lit("/x/a-"), F.col("p_partkey").cast("string")))
    last = F.when(n == 5, F.lit("")).otherwise(F.lit('<td><span class="info-hint-new">g</span></td>'))
    html = F.concat(F.lit('<span class="breadcrumbs__last-item">eu</span><div class="epcVariations"><table><tr class="epcVariations__row"><td><a href="'), href, F.lit('">M</a></td><td>'), period, F.lit("</td>"), last, F.lit("</tr></table></div>"))
    rows = pages.parse_pages(t("part").select(F.col("p_partkey").alias("capture_id"), html.alias("html")), "MARKET_INDEX")
    return rows.select("capture_id", "error", "start", "end")
