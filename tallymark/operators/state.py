"""State machines as folds over ordered events.

The checkpoint machine is folded in two levels: events of a key and time slice become a transition of all
four states (a small struct), and slices are composed in order. So a key with very many events is
worked on in many tasks.

No history of a key is gathered in one row or sorted in one task. Running values (the last grant, the highest token, the challenges of the last minutes) are taken
inside time slices of a key and carried over slices by a small table of one row for each slice. Leases start anew after every pause of a lease's length, so claims are folded pause by
pause. The limiter's raises between two cuts follow from the ticks after the cut alone, so they are found by minima, segment by segment; what is left is a number of
workers that is moved by cuts and raises, composed as above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STATES = ("PENDING", "IN_PROGRESS", "ACCEPTED", "REJECTED")
EVENTS = ("START", "ACCEPT", "REJECT")
#: Next state by event and state (indices), -1: illegal. ACCEPTED absorbs everything.
NEXT = {"START": (1, -1, 2, 1), "ACCEPT": (-1, 2, 2, -1), "REJECT": (-1, 3, 2, -1)}


def _step(acc: Column, event: Column) -> Column:
    to = F.lit(-1)
    for name, row in NEXT.items():
        to = F.when(event["kind"] == name, F.element_at(F.array(*map(F.lit, row)), acc["state"] + 1)).otherwise(to)
    done = acc["state"] == 2
    legal = to >= 0
    return F.struct(
        F.when(legal, to).otherwise(acc["state"]).cast("int").alias("state"),
        (acc["attempts"] + F.when((event["kind"] == "START") & legal & ~done, 1).otherwise(0)).cast("long").alias("attempts"),
        (acc["ignored"] + F.when(~legal | done, 1).otherwise(0)).cast("long").alias("ignored"),
        F.when(legal & ~done & (to == 2), event["ts"]).otherwise(acc["accepted_at"]).alias("accepted_at"),
        F.when(legal & ~done & (to == 2), event["capture"]).otherwise(acc["capture"]).alias("capture"),
        F.when(legal & ~done & (event["kind"] == "START"), event["ts"]).otherwise(acc["last_attempt_at"]).alias("last_attempt_at"),
    )


def _start(state: int) -> Column:
    return F.struct(F.lit(state).cast("int").alias("state"), F.lit(0).cast("long").alias("attempts"), F.lit(0).cast("long").alias("ignored"), F.lit(None).cast("timestamp").alias("accepted_at"), F.lit(None).cast("string").alias("capture"), F.lit(None).cast("timestamp").alias("last_attempt_at"))


def checkpoint_states(events: DataFrame, slice_seconds: int = 86_400) -> DataFrame:
    """events: key, ts, seq, kind, capture (if there) -> key, status, attempts, ignored, accepted_at, raw_capture_id (of the accepted attempt), last_attempt_at."""
    events = events if "capture" in events.columns else events.withColumn("capture", F.lit(None).cast("string"))
    sliced = events.groupBy("key", F.floor(F.unix_timestamp("ts") / slice_seconds).alias("slice")).agg(F.array_sort(F.collect_list(F.struct("ts", "seq", "kind", "capture"))).alias("events"))
    moves = sliced.select("key", "slice", F.array(*(F.aggregate("events", _start(i), _step) for i in range(len(STATES)))).alias("moves"))
    ordered = moves.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("slice", "moves"))).alias("slices"))

    def compose(acc: Column, s: Column) -> Column:
        m = F.element_at(s["moves"], acc["state"] + 1)
        return F.struct(m["state"].alias("state"), (acc["attempts"] + m["attempts"]).alias("attempts"), (acc["ignored"] + m["ignored"]).alias("ignored"), F.coalesce(acc["accepted_at"], m["accepted_at"]).alias("accepted_at"), F.coalesce(acc["capture"], m["capture"]).alias("capture"), F.coalesce(m["last_attempt_at"], acc["last_attempt_at"]).alias("last_attempt_at"))

    final = F.aggregate("slices", _start(0), compose)
    return ordered.select("key", final.alias("f")).select("key", F.element_at(F.array(*map(F.lit, STATES)), F.col("f.state") + 1).alias("status"), "f.attempts", "f.ignored", "f.accepted_at", F.col("f.capture").alias("raw_capture_id"), "f.last_attempt_at")


def _carried(slices: DataFrame, key: str, value: str) -> DataFrame:
    """slices: key, slice, value -> key, slice, ``before``: the greatest value of all earlier slices of the key."""
    earlier = W.partitionBy(key).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    return slices.select(key, "slice", F.max(value).over(earlier).alias("before"))


def running_max(events: DataFrame, key: str, value: Column, name: str, own: bool, slice_seconds: int = 86_400) -> DataFrame:
    """events: key, ts, seq -> with ``name``: the greatest value of the key's earlier events (``own``: and of the event itself), in two levels."""
    d = events.withColumn("slice", F.floor(F.unix_timestamp("ts") / slice_seconds)).withColumn("_v", value)
    before = _carried(d.groupBy(key, "slice").agg(F.max("_v").alias("m")), key, "m")
    inside = W.partitionBy(key, "slice").orderBy("ts", "seq").rowsBetween(W.unboundedPreceding, 0 if own else -1)
    d = d.withColumn("_m", F.max("_v").over(inside)).join(before, [key, "slice"])
    return d.withColumn(name, F.greatest("_m", "before")).drop("_m", "before", "_v", "slice")


def sessions(events: DataFrame, key: str, gap: int, slice_seconds: int = 86_400) -> DataFrame:
    """events: key, ts, seq -> with ``session``: (ts, seq) of the first event after a pause of ``gap`` seconds or more."""
    last = running_max(events, key, F.col("ts"), "_last", False, slice_seconds)
    pause = F.col("_last").isNull() | (F.unix_micros("ts") - F.unix_micros("_last") >= gap * 1_000_000)
    begun = last.withColumn("_begin", F.when(pause, F.struct("ts", "seq")))
    return running_max(begun, key, F.col("_begin"), "session", True, slice_seconds).drop("_last", "_begin")


def lease_states(claims: DataFrame, seconds: int) -> DataFrame:
    """claims: resource, ts, seq, owner -> resource, owner, token, expires_at, denied.

    Granted if there is no lease, the owner is the same, or it has expired; the token grows with every grant. After a pause of a lease's length the next claim is granted whoever
    holds the lease, so each pause ends a fold, and grants and denials are summed up."""
    lists = sessions(claims, "resource", seconds).groupBy("resource", "session").agg(F.array_sort(F.collect_list(F.struct("ts", "seq", "owner"))).alias("events"))
    zero = F.struct(F.lit(None).cast("long").alias("owner"), F.lit(0).cast("long").alias("token"), F.lit(None).cast("timestamp").alias("expires_at"), F.lit(0).cast("long").alias("denied"))

    def claim(acc: Column, e: Column) -> Column:
        ok = acc["owner"].isNull() | (acc["owner"] == e["owner"]) | (acc["expires_at"] <= e["ts"])
        return F.struct(
            F.when(ok, e["owner"]).otherwise(acc["owner"]).alias("owner"), (acc["token"] + ok.cast("long")).alias("token"),
            F.when(ok, e["ts"] + F.make_dt_interval(secs=F.lit(seconds))).otherwise(acc["expires_at"]).alias("expires_at"), (acc["denied"] + (~ok).cast("long")).alias("denied"),
        )

    folded = lists.select("resource", "session", F.aggregate("events", zero, claim).alias("f"))
    final = folded.groupBy("resource").agg(F.max_by("f", "session").alias("f"), F.sum("f.token").alias("token"), F.sum("f.denied").alias("denied"))
    return final.select("resource", "f.owner", "token", "f.expires_at", "denied")


def release_or_renew(leases: DataFrame, actions: DataFrame, seconds: int) -> DataFrame:
    """actions: resource, owner, kind (RENEW, RELEASE), at; only the owner acts. Renewing bumps the token; releasing expires the lease."""
    d = leases.alias("l").join(actions.withColumnRenamed("owner", "actor"), "resource", "left")
    own = F.coalesce(F.col("actor") == F.col("owner"), F.lit(False))
    until = F.when(own & (F.col("kind") == "RENEW"), F.col("at") + F.make_dt_interval(secs=F.lit(seconds))).when(own & (F.col("kind") == "RELEASE"), F.col("at")).otherwise(F.col("expires_at"))
    return d.select("resource", "owner", (F.col("token") + (own & (F.col("kind") == "RENEW")).cast("long")).alias("token"), until.alias("expires_at"))


def fencing_violations(writes: DataFrame) -> DataFrame:
    """writes: resource, ts, seq, token -> those whose token is below one that was seen before."""
    return running_max(writes, "resource", F.col("token"), "highest", False).filter("token < highest")


def recent_count(events: DataFrame, key: str, flag: Column, window: int, name: str, slice_seconds: int = 86_400) -> DataFrame:
    """events: key, ts, seq -> with ``name``: how many flagged events of the key stand in the ``window`` seconds up to each. A slice also gets the flagged events of the window before it, for counting only."""
    width = max(slice_seconds, window + 1)
    own = F.floor(F.unix_seconds("ts") / width)
    d = events.withColumn("_f", flag.cast("int")).withColumn("_slice", own).withColumn("_ghost", F.lit(False))
    late = F.unix_seconds("ts") >= (F.col("_slice") + 1) * width - window
    ghosts = d.filter((F.col("_f") == 1) & late).withColumn("_slice", F.col("_slice") + 1).withColumn("_ghost", F.lit(True))
    w = W.partitionBy(key, "_slice").orderBy(F.unix_seconds("ts")).rangeBetween(-window, 0)
    return d.unionByName(ghosts).withColumn(name, F.sum("_f").over(w)).filter("NOT _ghost").drop("_f", "_slice", "_ghost")


def limiter_states(events: DataFrame, most: int, threshold: int, window: int, stability: int, slice_seconds: int = 86_400) -> DataFrame:
    """events: run, ts, seq, is_challenge (else: a tick) -> run, concurrency, cuts, raises. A run starts with ``most``; one without events has no row.

    A challenge, if the window of seconds up to it holds ``threshold``, takes one off (down to 1) and restarts the clock; a tick
    adds one and restarts it if the clock has run for ``stability`` (over 0) seconds and concurrency is below ``most``. Between two cuts the raises there may be are the first tick after a
    stable time, the first one a stable time after that, and so on, most - 1 times at most; how many of them count depends on the concurrency at the cut alone."""
    seen = recent_count(events, "run", F.col("is_challenge"), window, "recent", slice_seconds).withColumn("cut", F.col("is_challenge") & (F.col("recent") >= threshold))
    marked = running_max(seen, "run", F.when(F.col("cut"), F.struct("ts", "seq")), "segment", True, slice_seconds)
    # a run's first segment begins with its first event, and with no cut
    segments = marked.groupBy("run", "segment").agg(F.min("ts").alias("first")).select("run", "segment", F.coalesce("segment.ts", "first").alias("at"), F.lit(0).alias("raises"), F.coalesce("segment.ts", "first").alias("clock"))
    ticks = marked.filter("NOT is_challenge").select("run", "segment", "ts")
    same = (F.col("run") == F.col("_run")) & F.col("segment").eqNullSafe(F.col("_segment"))
    for _ in range(most - 1):
        clocks = segments.select(F.col("run").alias("_run"), F.col("segment").alias("_segment"), "clock")
        up = ticks.join(clocks, same).filter(F.unix_seconds("ts") - F.unix_seconds("clock") >= stability).groupBy("_run", "_segment").agg(F.min("ts").alias("up"))
        segments = segments.join(up, same, "left").select("run", "segment", "at", (F.col("raises") + F.col("up").isNotNull().cast("int")).alias("raises"), F.coalesce("up", "clock").alias("clock"))

    def start(c: int) -> Column:
        return F.struct(F.lit(c).alias("c"), F.lit(0).cast("long").alias("cuts"), F.lit(0).cast("long").alias("raises"))

    def move(acc: Column, e: Column) -> Column:
        low = F.when(e["cut"], F.greatest(F.lit(1), acc["c"] - 1)).otherwise(acc["c"])
        up = F.least(e["raises"], most - low)
        return F.struct((low + up).alias("c"), (acc["cuts"] + e["cut"].cast("int")).alias("cuts"), (acc["raises"] + up).alias("raises"))

    def compose(acc: Column, s: Column) -> Column:
        m = F.element_at(s["moves"], acc["c"])
        return F.struct(m["c"].alias("c"), (acc["cuts"] + m["cuts"]).alias("cuts"), (acc["raises"] + m["raises"]).alias("raises"))

    steps = segments.select("run", F.floor(F.unix_seconds("at") / slice_seconds).alias("slice"), F.struct(F.col("segment").isNotNull().alias("later"), "at", F.coalesce("segment.seq", F.lit(0)).alias("seq"), F.col("segment").isNotNull().alias("cut"), "raises").alias("e"))
    sliced = steps.groupBy("run", "slice").agg(F.array_sort(F.collect_list("e")).alias("events")).select("run", "slice", F.array(*(F.aggregate("events", start(c), move) for c in range(1, most + 1))).alias("moves"))
    ordered = sliced.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("slice", "moves"))).alias("slices"))
    return ordered.select("run", F.aggregate("slices", start(most), compose).alias("f")).select("run", F.col("f.c").alias("concurrency"), F.col("f.cuts").cast("int").alias("cuts"), F.col("f.raises").cast("int").alias("raises"))


def dispositions(events: DataFrame) -> DataFrame:
    """events: spec_key, ts, seq, kind, session; the last one holds, CLEAR is a tombstone."""
    last = events.groupBy("spec_key").agg(F.max_by(F.struct("kind", "session"), F.struct("ts", "seq")).alias("d"))
    return last.filter("d.kind <> 'CLEAR'").select("spec_key", "d.kind", "d.session")


def eligible_disposition(kind: Column, session: Column, now_session: Column, retry_rejected: bool) -> Column:
    manual = F.lit(retry_rejected)
    return F.when(kind.isNull(), True).when(kind == "MANUAL_RETRY_REQUIRED", manual).otherwise(session != now_session)


def admissible(specs: DataFrame, valid: DataFrame, leases: DataFrame, blocked: DataFrame, now: Column, concurrency: int) -> DataFrame:
    """Specs that may be claimed now, in order, up to the free slots."""
    active = leases.filter(F.col("expires_at") > now)
    free = active.agg((F.lit(concurrency) - F.count("*")).alias("free"))
    rest = specs.join(valid, "spec_key", "left_anti").join(active.select(F.col("resource").alias("spec_key")), "spec_key", "left_anti").join(blocked, "spec_key", "left_anti")
    first = rest.orderBy("spec_key").limit(concurrency).withColumn("place", F.row_number().over(W.orderBy("spec_key")))
    return first.join(F.broadcast(free), F.col("place") <= F.col("free")).select("spec_key", "place")


def pending_class(status: Column, evidence: Column) -> Column:
    """Class of a pending group by its status and the outcome in its evidence."""
    return (
        F.when(status.isNull() | (status == "PENDING"), "NOT_YET_ATTEMPTED").when(status == "IN_PROGRESS", F.when(evidence == "CHALLENGE", "CHALLENGE_PAUSED").otherwise("TRANSPORT_RETRY"))
        .when(status == "REJECTED", "REQUIRES_EXPLICIT_RETRY")
    )


def included(cls: Column, retry_rejected: bool) -> Column:
    return (cls != "REQUIRES_EXPLICIT_RETRY") | F.lit(retry_rejected)


def pass_disposition(progressed: Column, manual: Column) -> Column:
    return F.when(progressed, "PROGRESSED").when(manual, "MANUAL_RETRY_REQUIRED").otherwise("DEFERRED_THIS_SESSION")


def run_selection(candidates: Column) -> Column:
    return F.when(candidates == 0, "CREATE").when(candidates == 1, "RESUME").otherwise("ERROR_AMBIGUOUS")


def snapshot_state(critical: Column, complete: Column) -> Column:
    return F.when(critical, "INVALID").when(complete, "VALID").otherwise("INCOMPLETE")


def stale_candidate(collected: Column, end: Column, now: Column, active_days: int = 30, ended_days: int = 180) -> Column:
    age = F.when(end.isNull(), F.make_dt_interval(F.lit(active_days))).otherwise(F.make_dt_interval(F.lit(ended_days)))
    return now - collected >= age
