"""Queries over run events: checkpoints, leases, the limiter, challenge metrics, admission."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import state as S
from .standins import Registry

query = Registry()

#: Folds as integers for the oracle: the state is the last digit, attempts and ignored events are higher digits.
_FOLD = """WITH l AS (SELECT user_id AS key, list(CASE kind WHEN 'START' THEN 1 WHEN 'ACCEPT' THEN 2 ELSE 3 END::BIGINT ORDER BY t_s, seq) AS e FROM run_events WHERE kind <> 'CHALLENGE' GROUP BY 1),
    f AS (SELECT key, list_reduce(list_prepend(0::BIGINT, e), lambda a, x: CASE
        WHEN a % 10 = 2 THEN a + 10000000
        WHEN x = 1 AND a % 10 IN (0, 3) THEN a - a % 10 + 1 + 10
        WHEN x = 1 THEN a + 10000000
        WHEN a % 10 = 1 THEN a + 1 + (CASE WHEN x = 3 THEN 1 ELSE 0 END)
        ELSE a + 10000000 END) AS r FROM l)"""


def _events(t):
    return t("run_events").withColumn("ts", F.timestamp_seconds("t_s"))


@query(_FOLD + " SELECT key, CASE r % 10 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, (r % 10000000) // 10 AS attempts, r // 10000000 AS ignored FROM f")
def checkpoint_state(t):
    e = _events(t).filter("kind <> 'CHALLENGE'").select(F.col("user_id").alias("key"), "ts", "seq", "kind")
    return S.checkpoint_states(e).select("key", "status", "attempts", "ignored")


@query("""WITH e AS (SELECT user_id AS key, t_s, seq, kind, row_number() OVER (PARTITION BY user_id ORDER BY t_s, seq) AS i FROM run_events WHERE kind <> 'CHALLENGE'),
    r AS (SELECT key, i, CASE kind WHEN 'START' THEN 'IN_PROGRESS' ELSE 'PENDING' END AS status, CASE kind WHEN 'START' THEN t_s END AS last_at, NULL::VARCHAR AS capture, NULL::BIGINT AS done_at FROM e WHERE i = 1 UNION ALL
    SELECT r.key, e.i, CASE WHEN r.status = 'ACCEPTED' THEN 'ACCEPTED' WHEN e.kind = 'START' AND r.status IN ('PENDING', 'REJECTED') THEN 'IN_PROGRESS' WHEN r.status = 'IN_PROGRESS' AND e.kind = 'ACCEPT' THEN 'ACCEPTED' WHEN r.status = 'IN_PROGRESS' AND e.kind = 'REJECT' THEN 'REJECTED' ELSE r.status END,
    CASE WHEN e.kind = 'START' AND r.status IN ('PENDING', 'REJECTED') THEN e.t_s ELSE r.last_at END, CASE WHEN r.status = 'IN_PROGRESS' AND e.kind = 'ACCEPT' THEN 'c' || CAST(e.seq AS VARCHAR) ELSE r.capture END, CASE WHEN r.status = 'IN_PROGRESS' AND e.kind = 'ACCEPT' THEN e.t_s ELSE r.done_at END FROM r JOIN e ON e.key = r.key AND e.i = r.i + 1)
    SELECT key, status, last_at, capture, done_at FROM r QUALIFY row_number() OVER (PARTITION BY key ORDER BY i DESC) = 1""")
def checkpoint_entry(t):
    """The entry itself: the accepted capture and the times of the last attempt and of acceptance."""
    e = _events(t).filter("kind <> 'CHALLENGE'").select(F.col("user_id").alias("key"), "ts", "seq", "kind", F.concat(F.lit("c"), F.col("seq").cast("string")).alias("capture"))
    return S.checkpoint_states(e).select("key", "status", F.unix_seconds("last_attempt_at").alias("last_at"), F.col("raw_capture_id").alias("capture"), F.unix_seconds("accepted_at").alias("done_at"))


query.oracles["checkpoint_entry"] = query.oracles["checkpoint_entry"].replace("WITH run_events", "WITH RECURSIVE run_events", 1)


@query("""WITH e AS (SELECT user_id % 50 AS resource, t_s, user_id AS owner, row_number() OVER (PARTITION BY user_id % 50 ORDER BY t_s, seq) AS i FROM run_events WHERE kind = 'START'),
    r AS (SELECT resource, i, owner, 1::BIGINT AS token, t_s + 120 AS expires_at, 0::BIGINT AS denied FROM e WHERE i = 1 UNION ALL
    SELECT e.resource, e.i, CASE WHEN r.owner = e.owner OR r.expires_at <= e.t_s THEN e.owner ELSE r.owner END, r.token + CASE WHEN r.owner = e.owner OR r.expires_at <= e.t_s THEN 1 ELSE 0 END,
    CASE WHEN r.owner = e.owner OR r.expires_at <= e.t_s THEN e.t_s + 120 ELSE r.expires_at END, r.denied + CASE WHEN r.owner = e.owner OR r.expires_at <= e.t_s THEN 0 ELSE 1 END FROM r JOIN e ON e.resource = r.resource AND e.i = r.i + 1)
    SELECT resource, owner, token, expires_at, denied FROM r QUALIFY row_number() OVER (PARTITION BY resource ORDER BY i DESC) = 1""")
def lease_state(t):
    return _leases(t).withColumn("expires_at", F.unix_seconds("expires_at"))


query.oracles["lease_state"] = query.oracles["lease_state"].replace("WITH run_events", "WITH RECURSIVE run_events", 1)


def _leases(t):
    return S.lease_states(_events(t).filter("kind = 'START'").select((F.col("user_id") % 50).alias("resource"), "ts", "seq", F.col("user_id").alias("owner")), 120)


@query()
def lease_renew_release(t):
    e = _events(t).filter("kind IN ('ACCEPT', 'REJECT')").groupBy((F.col("user_id") % 50).alias("resource")).agg(F.max_by(F.struct("user_id", "kind", "ts"), F.struct("ts", "seq")).alias("e"))
    actions = e.select("resource", F.col("e.user_id").alias("owner"), F.when(F.col("e.kind") == "ACCEPT", "RENEW").otherwise("RELEASE").alias("kind"), F.col("e.ts").alias("at"))
    return S.release_or_renew(_leases(t), actions, 120).withColumn("expires_at", F.unix_seconds("expires_at"))


@query()
def rate_limiter_state(t):
    e = _events(t).select((F.col("user_id") % 4).alias("run"), "ts", "seq", (F.col("kind") == "CHALLENGE").alias("is_challenge"))
    return S.limiter_states(e, most=4, threshold=2, window=300, stability=600)


@query("""SELECT resource, seq, token, highest FROM (SELECT user_id % 50 AS resource, t_s, seq, CAST(seq * 7919 % 1000 AS BIGINT) AS token, max(CAST(seq * 7919 % 1000 AS BIGINT)) OVER (PARTITION BY user_id % 50 ORDER BY t_s, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM run_events) WHERE token < highest""")
def fencing_audit(t):
    w = _events(t).select((F.col("user_id") % 50).alias("resource"), "ts", "seq", (F.col("seq") * 7919 % 1000).alias("token"))
    return S.fencing_violations(w).select("resource", "seq", "token", "highest")


_BLOCKED = """d AS (SELECT user_id AS spec_key, CASE event_type WHEN 'error' THEN 'MANUAL_RETRY_REQUIRED' WHEN 'click' THEN 'DEFERRED_THIS_SESSION' ELSE 'CLEAR' END AS kind, 's' || CAST(seq % 2 AS STRING) AS session
    FROM run_events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t_s DESC, seq DESC) = 1)"""


def _dispositions(t):
    kind = F.when(F.col("event_type") == "error", "MANUAL_RETRY_REQUIRED").when(F.col("event_type") == "click", "DEFERRED_THIS_SESSION").otherwise("CLEAR")
    return S.dispositions(_events(t).select(F.col("user_id").alias("spec_key"), "ts", "seq", kind.alias("kind"), F.concat(F.lit("s"), (F.col("seq") % 2).cast("string")).alias("session")))


@query(f"WITH {_BLOCKED} SELECT spec_key, kind, session FROM d WHERE kind <> 'CLEAR'")
def pool_disposition(t):
    return _dispositions(t)


@query(f"""WITH {_BLOCKED}, s AS (SELECT DISTINCT user_id AS spec_key FROM run_events), v AS (SELECT DISTINCT user_id AS spec_key FROM run_events WHERE kind = 'ACCEPT' AND seq % 50 = 0), b AS (SELECT spec_key FROM d WHERE kind = 'MANUAL_RETRY_REQUIRED' OR (kind = 'DEFERRED_THIS_SESSION' AND session = 's1')),
    l AS (SELECT user_id AS spec_key, max(t_s) + 7200 AS until FROM run_events WHERE kind = 'START' GROUP BY 1), n AS (SELECT max(t_s) AS now FROM run_events), act AS (SELECT spec_key FROM l, n WHERE until > now)
    SELECT spec_key, row_number() OVER (ORDER BY spec_key) AS place FROM s WHERE spec_key NOT IN (SELECT * FROM v) AND spec_key NOT IN (SELECT * FROM b) AND spec_key NOT IN (SELECT * FROM act) QUALIFY place <= 8 - (SELECT count(*) FROM act)""")
def claim_admission(t):
    e = _events(t)
    specs = e.select(F.col("user_id").alias("spec_key")).distinct()
    valid = e.filter("kind = 'ACCEPT' AND seq % 50 = 0").select(F.col("user_id").alias("spec_key")).distinct()
    blocked = _dispositions(t).filter(~S.eligible_disposition(F.col("kind"), F.col("session"), F.lit("s1"), False)).select("spec_key")
    # the clock is the data's
    now = e.agg(F.max("ts").alias("now"))
    leases = e.filter("kind = 'START'").groupBy(F.col("user_id").alias("resource")).agg((F.max("ts") + F.make_dt_interval(hours=F.lit(2))).alias("expires_at")).join(F.broadcast(now))
    return S.admissible(specs, valid, leases, blocked, F.col("now"), 8).withColumn("place", F.col("place").cast("long"))


@query("""WITH k AS (SELECT user_id % 50 AS resource, max(t_s) AS last FROM run_events GROUP BY 1), h AS (SELECT max(last) AS m FROM k) SELECT count(*) FILTER (last > m - 3600) AS active, CASE WHEN count(*) FILTER (last <= m - 3600) = 0 THEN 'FINISH' WHEN count(*) FILTER (last > m - 3600) >= 4 THEN 'THROTTLED' ELSE 'CLAIM' END AS action FROM k, h""")
def claim_result(t):
    """Whether a worker may claim, waits for a slot, or ends: candidates without a lease and active leases against the slots."""
    k = t("run_events").groupBy((F.col("user_id") % 50).alias("resource")).agg(F.max("t_s").alias("last"))
    one = k.join(F.broadcast(k.agg(F.max("last").alias("m")))).agg(F.count_if(F.col("last") > F.col("m") - 3600).alias("active"), F.count_if(F.col("last") <= F.col("m") - 3600).alias("candidates"))
    return one.select("active", F.when(F.col("candidates") == 0, "FINISH").when(F.col("active") >= 4, "THROTTLED").otherwise("CLAIM").alias("action"))


@query("SELECT user_id % 4 AS run, max(t_s) - 300 AS since, count(*) FILTER (kind = 'CHALLENGE' AND t_s >= m - 300) AS n, count(*) FILTER (kind = 'CHALLENGE' AND t_s >= m - 3600) AS hour, count(*) FILTER (kind = 'CHALLENGE') AS total FROM (SELECT *, max(t_s) OVER (PARTITION BY user_id % 4) AS m FROM run_events) GROUP BY 1")
def challenge_windows(t):
    e = t("run_events").withColumn("run", F.col("user_id") % 4)
    now = e.groupBy("run").agg(F.max("t_s").alias("m"))
    c = F.col("kind") == "CHALLENGE"
    return e.join(F.broadcast(now), "run").groupBy("run").agg((F.max("t_s") - 300).alias("since"), F.count_if(c & (F.col("t_s") >= F.col("m") - 300)).alias("n"), F.count_if(c & (F.col("t_s") >= F.col("m") - 3600)).alias("hour"), F.count_if(c).alias("total"))


@query("""SELECT user_id % 4 AS run, CAST(coalesce(sum(closed - t_s), 0) AS BIGINT) AS wait_seconds, count(closed) AS closed FROM (SELECT user_id, t_s, kind, lead(t_s) OVER (PARTITION BY user_id ORDER BY t_s, seq) AS closed FROM run_events) WHERE kind = 'CHALLENGE' GROUP BY 1""")
def wait_seconds(t):
    e = t("run_events").withColumn("closed", F.lead("t_s").over(W.partitionBy("user_id").orderBy("t_s", "seq")))
    return e.filter("kind = 'CHALLENGE'").groupBy((F.col("user_id") % 4).alias("run")).agg(F.coalesce(F.sum(F.col("closed") - F.col("t_s")), F.lit(0)).cast("long").alias("wait_seconds"), F.count("closed").alias("closed"))


@query("WITH h AS (SELECT user_id % 4 AS run, user_id AS worker, max(t_s) AS beat FROM run_events GROUP BY ALL), n AS (SELECT max(t_s) AS now FROM run_events) SELECT run, count(*) FILTER (beat >= now - 86400 * 3) AS active, count(*) AS workers FROM h, n GROUP BY run")
def active_workers(t):
    h = t("run_events").groupBy((F.col("user_id") % 4).alias("run"), F.col("user_id").alias("worker")).agg(F.max("t_s").alias("beat"))
    now = t("run_events").agg(F.max("t_s").alias("now"))
    return h.join(F.broadcast(now)).groupBy("run").agg(F.count_if(F.col("beat") >= F.col("now") - 86400 * 3).alias("active"), F.count("*").alias("workers"))


@query("""WITH m AS (SELECT user_id % 4 AS run, t_s // 86400 AS day, count(*) FILTER (kind = 'ACCEPT') AS accepted, count(*) AS requests, count(*) FILTER (kind = 'CHALLENGE') AS challenges FROM run_events GROUP BY ALL),
    c AS (SELECT run, day, CAST(sum(accepted) OVER w AS BIGINT) AS accepted, CAST(sum(requests) OVER w AS BIGINT) AS requests, CAST(sum(challenges) OVER w AS BIGINT) AS challenges FROM m WINDOW w AS (PARTITION BY run ORDER BY day))
    SELECT run, day, accepted, requests, challenges, coalesce(greatest(0, (accepted - lag(accepted) OVER v) / ((day - lag(day) OVER v) * 1440.0)), 0)::DOUBLE AS per_minute FROM c WINDOW v AS (PARTITION BY run ORDER BY day)""")
def metrics_snapshot(t):
    k = F.col("kind")
    daily = t("run_events").groupBy((F.col("user_id") % 4).alias("run"), F.floor(F.col("t_s") / 86400).alias("day")).agg(F.count_if(k == "ACCEPT").alias("accepted"), F.count("*").alias("requests"), F.count_if(k == "CHALLENGE").alias("challenges"))
    w = W.partitionBy("run").orderBy("day")
    c = daily.select("run", "day", *(F.sum(x).over(w).alias(x) for x in ("accepted", "requests", "challenges")))
    rate = (F.col("accepted") - F.lag("accepted").over(w)) / ((F.col("day") - F.lag("day").over(w)) * 1440.0)
    return c.withColumn("per_minute", F.coalesce(F.greatest(F.lit(0.0), rate), F.lit(0.0)))


@query("SELECT spec_key, CASE n WHEN 0 THEN 'CREATE' WHEN 1 THEN 'RESUME' ELSE 'ERROR_AMBIGUOUS' END AS decision FROM (SELECT o_custkey AS spec_key, count(*) FILTER (o_orderstatus = 'P') AS n FROM orders GROUP BY 1)")
def run_selection(t):
    n = t("orders").groupBy(F.col("o_custkey").alias("spec_key")).agg(F.count_if(F.col("o_orderstatus") == "P").alias("n"))
    return n.select("spec_key", S.run_selection(F.col("n")).alias("decision"))


_STATUS = "WITH s AS (SELECT user_id, arg_max(kind, t_s * 1000000 + seq) AS k FROM run_events GROUP BY 1)"


@query(_STATUS + " SELECT user_id, CASE k WHEN 'START' THEN 'TRANSPORT_RETRY' WHEN 'CHALLENGE' THEN 'CHALLENGE_PAUSED' WHEN 'REJECT' THEN 'REQUIRES_EXPLICIT_RETRY' END AS cls, k <> 'REJECT' AS included FROM s WHERE k <> 'ACCEPT'")
def retry_classes(t):
    last = t("run_events").groupBy("user_id").agg(F.max_by("kind", F.struct("t_s", "seq")).alias("k")).filter("k <> 'ACCEPT'")
    status = F.when(F.col("k") == "REJECT", "REJECTED").otherwise("IN_PROGRESS")
    d = last.withColumn("cls", S.pending_class(status, F.col("k")))
    return d.select("user_id", "cls", S.included(F.col("cls"), False).alias("included"))


@query(_STATUS + " SELECT user_id, CASE WHEN k = 'REJECT' THEN 'REQUIRES_EXPLICIT_RETRY' WHEN k = 'CHALLENGE' THEN 'CHALLENGE_PAUSED' WHEN k = 'START' THEN 'TRANSPORT_RETRY' ELSE 'NOT_YET_ATTEMPTED' END AS cls, true AS included FROM s")
def retry_rejected(t):
    """With the wish to retry what was rejected; an accepted group asked for again counts as not yet attempted."""
    last = t("run_events").groupBy("user_id").agg(F.max_by("kind", F.struct("t_s", "seq")).alias("k"))
    status = F.when(F.col("k") == "REJECT", "REJECTED").when(F.col("k") != "ACCEPT", "IN_PROGRESS")
    d = last.withColumn("cls", S.pending_class(status, F.col("k")))
    return d.select("user_id", "cls", S.included(F.col("cls"), True).alias("included"))


@query("SELECT user_id, CASE WHEN bool_or(kind = 'ACCEPT') THEN 'PROGRESSED' WHEN bool_or(kind = 'REJECT') THEN 'MANUAL_RETRY_REQUIRED' ELSE 'DEFERRED_THIS_SESSION' END AS disposition FROM run_events GROUP BY 1")
def pass_disposition(t):
    k = F.col("kind")
    return t("run_events").groupBy("user_id").agg(S.pass_disposition(F.bool_or(k == "ACCEPT"), F.bool_or(k == "REJECT")).alias("disposition"))


@query("""WITH cur AS (SELECT * FROM manifests WHERE manifest_complete QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY discovered_at DESC, id DESC) = 1),
    p AS (SELECT spec_key, run_id, category, group_id FROM cur JOIN manifest_groups USING (id) ANTI JOIN accepted USING (spec_key, run_id, category, group_id))
    SELECT spec_key, min(run_id) AS run_id, count(*) AS pending, min(category || '/' || group_id) AS next FROM p GROUP BY spec_key""")
def dry_run_plan(t):
    from ..operators import latest as L

    # the run of the current manifest: what other runs have accepted is pending in this one
    keys = ["spec_key", "run_id", "category", "group_id"]
    e = L.current_manifest(t("manifests")).select("spec_key", "run_id", "id").join(t("manifest_groups"), "id")
    p = e.join(t("accepted").select(*keys).distinct(), keys, "left_anti")
    return p.groupBy("spec_key", "run_id").agg(F.count("*").alias("pending"), F.min(F.concat_ws("/", "category", "group_id")).alias("next"))


@query("""WITH cur AS (SELECT * FROM manifests WHERE manifest_complete QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY discovered_at DESC, id DESC) = 1),
    p AS (SELECT spec_key, category, group_id FROM cur JOIN manifest_groups USING (id) ANTI JOIN accepted USING (spec_key, run_id, category, group_id)), s AS (SELECT spec_key FROM (SELECT DISTINCT spec_key FROM p) ORDER BY spec_key LIMIT 5)
    SELECT spec_key, category, group_id, row_number() OVER (PARTITION BY spec_key ORDER BY category, group_id) AS place FROM p SEMI JOIN s USING (spec_key) QUALIFY place <= 2""")
def limited_plan(t):
    """The first five specs that have anything pending, and two groups of each."""
    from ..operators import latest as L

    keys = ["spec_key", "run_id", "category", "group_id"]
    p = L.current_manifest(t("manifests")).select("spec_key", "run_id", "id").join(t("manifest_groups"), "id").join(t("accepted").select(*keys), keys, "left_anti")
    few = p.join(L.first_specs(p, "spec_key", 5), "spec_key", "left_semi")
    return L.first_n(few, ["spec_key"], ["category", "group_id"], 2).select("spec_key", "category", "group_id", F.col("rank").cast("long").alias("place"))


@query("""WITH r AS (SELECT user_id % 4 AS run_id, max(t_s) AS now FROM run_events GROUP BY 1), e AS (SELECT user_id % 4 AS run_id, * FROM run_events),
    x AS (SELECT run_id, count(*) FILTER (kind = 'ACCEPT') AS accepted, count(*) FILTER (kind = 'START') AS requests, count(DISTINCT user_id) FILTER (kind = 'ACCEPT' AND seq % 5 = 0) AS specs, count(*) FILTER (kind = 'CHALLENGE') AS challenges,
        CAST(coalesce(sum(seq % 60) FILTER (kind = 'CHALLENGE' AND seq % 2 = 0), 0) AS BIGINT) AS wait, count(*) FILTER (kind = 'CHALLENGE' AND t_s > now - 3600) AS hour FROM e JOIN r USING (run_id) GROUP BY 1),
    b AS (SELECT run_id, count(*) FILTER (beat >= now - 86400) AS active FROM (SELECT run_id, user_id, max(t_s) AS beat FROM e GROUP BY ALL) JOIN r USING (run_id) GROUP BY 1),
    q AS (SELECT run_id, count(*) FILTER (kind = 'ACCEPT' AND t_s <= now - 86400) AS before FROM e JOIN r USING (run_id) GROUP BY 1)
    SELECT run_id, specs AS specs_completed, accepted AS groups_accepted, CASE WHEN run_id = 3 THEN 0 ELSE greatest(0, (accepted - before) / 1440.0)::DOUBLE END AS groups_per_minute, requests AS requests_total, challenges AS challenges_total, hour::DOUBLE AS challenges_per_hour,
        wait AS challenge_wait_seconds, active AS active_workers, 4 - run_id AS effective_concurrency FROM x JOIN b USING (run_id) JOIN q USING (run_id)""")
def metrics_report(t):
    from ..operators import records as Q
    from ..operators import reports as R

    e = t("run_events").withColumn("run_id", F.col("user_id") % 4)
    runs = e.groupBy("run_id").agg(F.max("t_s").alias("now"))
    kinds = e.filter("kind IN ('ACCEPT', 'START')").select("run_id", F.when(F.col("kind") == "ACCEPT", "ACCEPT").otherwise("REQUEST").alias("kind"))
    challenges = e.filter("kind = 'CHALLENGE'").select("run_id", F.col("t_s").alias("observed_at"), F.when(F.col("seq") % 2 == 0, F.col("t_s") + F.col("seq") % 60).alias("resolved_at"))
    beats = Q.heartbeats(e.select("run_id", F.col("user_id").alias("worker_id"), F.col("t_s").alias("ts")))
    completed = e.filter("kind = 'ACCEPT' AND seq % 5 = 0").select("run_id", F.col("user_id").alias("spec_key"))
    previous = e.join(runs, "run_id").filter("run_id <> 3").groupBy("run_id").agg(F.count_if((F.col("kind") == "ACCEPT") & (F.col("t_s") <= F.col("now") - 86400)).alias("groups_accepted"), (F.max("now") - 86400).alias("at"))
    return R.metrics(runs, kinds, challenges, beats, completed, runs.select("run_id", (4 - F.col("run_id")).alias("concurrency")), previous, 86400)


@query("SELECT CASE event_type WHEN 'purchase' THEN 'ACCEPTED' WHEN 'error' THEN 'CHALLENGE' WHEN 'click' THEN 'REJECTED' ELSE 'OTHER' END AS bucket, count(*) AS n FROM run_events GROUP BY 1")
def event_counters(t):
    names = F.create_map(*map(F.lit, ("purchase", "ACCEPTED", "error", "CHALLENGE", "click", "REJECTED")))
    return t("run_events").groupBy(F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("OTHER")).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT user_id AS resource, count(*) FILTER (t_s > m - 120) AS active FROM (SELECT *, max(t_s) OVER () AS m FROM run_events) GROUP BY 1")
def active_leases(t):
    now = t("run_events").agg(F.max("t_s").alias("m"))
    return t("run_events").join(F.broadcast(now)).groupBy(F.col("user_id").alias("resource")).agg(F.count_if(F.col("t_s") > F.col("m") - 120).alias("active"))
