"""Reading and writing the catalogue's records: ordered scans, point lookups, appends and upserts.

An upsert is a function of what is stored and what comes in, to what is stored afterwards; ``sources.tables.replace`` writes it. Nothing here goes
row by row: keys meet in one shuffle, and rules about which columns win are part of the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from . import state as S
from .latest import latest

#: Columns of an identity that a later save overwrites; all others are its identity and stay as first written.
MUTABLE = ("production_period_raw", "production_start", "production_end", "grade", "configuration", "source_url")


# scans


def identities(specs: DataFrame) -> DataFrame:
    """All identities in the order of their stable key (a range sort)."""
    return specs.orderBy("stable_key")


def history(entries: DataFrame, stable_key: str | None = None) -> DataFrame:
    """Discovery entries, oldest first, of one spec or of each."""
    return (entries.filter(F.col("stable_key") == stable_key) if stable_key is not None else entries).orderBy("stable_key", "id")


def accepted_groups(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.filter("status = 'ACCEPTED'").orderBy("run_id", "spec_key", "category", "group_id")


def incomplete_runs(runs: DataFrame, scope: str | None = None) -> DataFrame:
    """Runs without an end, of one scope or of all, the oldest first."""
    open_ = runs.filter("completed_at IS NULL")
    return (open_.filter(F.col("scope") == scope) if scope is not None else open_).orderBy("scope", "started_at", "run_id")


def members(assignments: DataFrame) -> DataFrame:
    """Members of every cluster with their place by reference; a cluster stays rows, never a list."""
    return assignments.withColumn("place", F.row_number().over(W.partitionBy("cluster_key").orderBy("spec_key")))


def present(df: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Point lookups, as many as there are keys: each key, whether it is there, and its row."""
    return keys.join(df.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def checkpoint_of(groups: DataFrame, checkpoints: DataFrame, key: list[str]) -> DataFrame:
    """The status of each group; without an entry it is PENDING."""
    return groups.join(checkpoints, key, "left").withColumn("status", F.coalesce("status", F.lit("PENDING")))


# appends and upserts


def as_identity(entries: DataFrame, source: str) -> DataFrame:
    """Discovered entries as identities: the source's name is added, a missing production period is the empty text."""
    return entries.withColumns({"source": F.lit(source), "production_period_raw": F.coalesce("production_period_raw", F.lit(""))})


def upsert_identities(old: DataFrame, new: DataFrame, order: str, mutable: tuple[str, ...] = MUTABLE) -> DataFrame:
    """old, new: stable_key, identity columns, mutable columns, ``order``. The first row of a key gives its identity, the last one its mutable columns."""
    fixed = [c for c in old.columns if c not in (*mutable, "stable_key", order)]
    own = [c for c in mutable if c in old.columns]
    both = old.unionByName(new).groupBy("stable_key")
    d = both.agg(F.min_by(F.struct(*fixed, order), order).alias("a"), F.max_by(F.struct(*own, order), order).alias("b"))
    return d.select("stable_key", *(F.col(f"a.{c}") for c in fixed), *(F.col(f"b.{c}") for c in own), F.col(f"b.{order}"))


def upsert_runs(writes: DataFrame) -> DataFrame:
    """writes: run_id, scope, started_at, resumed_at, completed_at, seq. Scope and start are those of the first write; resumption and end those of the last, null or not."""
    d = writes.groupBy("run_id").agg(F.min_by(F.struct("scope", "started_at"), "seq").alias("a"), F.max_by(F.struct("resumed_at", "completed_at"), "seq").alias("b"))
    return d.select("run_id", "a.scope", "a.started_at", "b.resumed_at", "b.completed_at")


def upsert_checkpoints(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """An entry that is ACCEPTED stays as it is: of the rows of a key up to its first ACCEPTED one, the last."""
    both = old.unionByName(new)
    done = both.groupBy(*key).agg(F.min(F.when(F.col("status") == "ACCEPTED", F.col(order))).alias("_done"))
    rest = [c for c in old.columns if c not in key]
    d = both.join(done, key).filter(F.col("_done").isNull() | (F.col(order) <= F.col("_done")))
    return d.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*key, "r.*").select(*old.columns)


def update_hashes(snapshots: DataFrame, hashes: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """hashes: snapshot_id and ``names``. Snapshots with the hashes that came in for them, null ones included; others unchanged; unknown snapshots add nothing."""
    new = hashes.select("snapshot_id", F.struct(*names).alias("_new"))
    d = snapshots.join(new, "snapshot_id", "left")
    return d.select(*(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in snapshots.columns))


def replace_rows(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Upsert without history (cluster assignments, resolved images): the last row of each key."""
    return latest(old.unionByName(new), key, [order])


def materialize(snapshots: DataFrame, assignments: DataFrame, order: list[str]) -> DataFrame:
    """Current state: the last VALID or STALE snapshot of each spec with its cluster, if it has one; specs without such a snapshot have no row."""
    usable = latest(snapshots.filter(F.col("state").isin("VALID", "STALE")), ["spec_key"], order)
    return usable.join(assignments.select("spec_key", "cluster_key"), "spec_key", "left")


def mark_stale(snapshots: DataFrame, due: Column) -> DataFrame:
    """VALID snapshots that are due become STALE; a due one in any other state is an error, named in ``error``, and stays."""
    valid = F.col("state") == "VALID"
    return snapshots.withColumn("error", F.when(due & ~valid, F.concat(F.lit("not VALID: "), F.col("state")))).withColumn("state", F.when(due & valid, "STALE").otherwise(F.col("state")))


def run_choice(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """requests: request, scope, explicit (a run_id or null), new (boolean); runs: run_id, scope, completed_at -> request, decision, run_id.

    An explicit run must exist, be of the scope and be open; ``new`` always creates; else none, one or several open runs of the scope decide."""
    open_ = runs.filter("completed_at IS NULL").groupBy("scope").agg(F.count("*").alias("n"), F.min("run_id").alias("only"))
    named = runs.select(F.col("run_id").alias("explicit"), F.col("scope").alias("of"), F.col("completed_at").isNotNull().alias("ended"))
    d = requests.join(open_, "scope", "left").join(named, "explicit", "left")
    n = F.coalesce("n", F.lit(0))
    asked = F.when(F.col("of").isNull(), "ERROR_UNKNOWN").when(F.col("of") != F.col("scope"), "ERROR_SCOPE").when(F.col("ended"), "ERROR_COMPLETED").otherwise("RESUME")
    decision = F.when(F.col("explicit").isNotNull(), asked).when(F.col("new"), "CREATE").otherwise(S.run_selection(n))
    return d.select("request", decision.alias("decision"), F.when(decision == "RESUME", F.coalesce("explicit", "only")).alias("run_id"))


def challenge_intervals(events: DataFrame) -> DataFrame:
    """events: id, kind (OPEN, CLOSE), run_id, ts -> id, run_id, observed_at, resolved_at. A challenge is closed by its id; closing an unknown one does nothing, closing twice moves the end."""
    d = events.groupBy("id").agg(F.min(F.when(F.col("kind") == "OPEN", F.struct("ts", "run_id"))).alias("o"), F.max(F.when(F.col("kind") == "CLOSE", F.col("ts"))).alias("resolved_at"))
    return d.filter("o IS NOT NULL").select("id", "o.run_id", F.col("o.ts").alias("observed_at"), "resolved_at")


def heartbeats(beats: DataFrame) -> DataFrame:
    return beats.groupBy("run_id", "worker_id").agg(F.max("ts").alias("last_heartbeat_at"))


def wait_outcome(polls: DataFrame, timeout: int) -> DataFrame:
    """polls: key, elapsed (seconds), outcome -> key, result, at: the first poll that is no CHALLENGE within the timeout, or TIMED_OUT at the first one past it (strictly), else WAITING."""
    over = F.col("elapsed") > timeout
    cleared = (F.col("outcome") != "CHALLENGE") & ~over
    d = polls.groupBy("key").agg(F.min_by(F.struct("outcome", "elapsed"), F.when(cleared, F.col("elapsed"))).alias("c"), F.min(F.when(cleared, F.col("elapsed"))).alias("at"), F.min(F.when(over, F.col("elapsed"))).alias("late"))
    return d.select("key", F.when(F.col("at").isNotNull(), F.col("c.outcome")).when(F.col("late").isNotNull(), "TIMED_OUT").otherwise("WAITING").alias("result"), F.coalesce("at", "late").alias("at"))


def worker_actions(claims: DataFrame) -> DataFrame:
    """claims: worker, seq, candidates, free, stopped -> worker, seq, action. A stopped worker ends; without candidates it ends; with candidates but no slot it waits; else it claims."""
    action = F.when(F.col("stopped"), "STOP").when(F.col("candidates") == 0, "FINISH").when(F.col("free") <= 0, "THROTTLED").otherwise("CLAIM")
    first_end = F.min(F.when(action.isin("STOP", "FINISH"), F.col("seq"))).over(W.partitionBy("worker"))
    return claims.withColumn("action", action).withColumn("_end", first_end).filter(F.col("_end").isNull() | (F.col("seq") <= F.col("_end"))).select("worker", "seq", "action")


def pool_result(workers: DataFrame) -> DataFrame:
    """workers: run_id, worker, exit_code (null: running) -> run_id, result: FAILED if one ended abnormally, RUNNING if one still runs, else COMPLETED."""
    code = F.col("exit_code")
    return workers.groupBy("run_id").agg(F.when(F.bool_or(F.coalesce(code != 0, F.lit(False))), "FAILED").when(F.bool_or(code.isNull()), "RUNNING").otherwise("COMPLETED").alias("result"))


def phases(specs: DataFrame, indexed: DataFrame, pending: DataFrame) -> DataFrame:
    """Which phase of a collection each spec is in: MARKET_INDEX until its market is indexed, GROUPS while groups are pending, else FINALIZE."""
    d = specs.join(indexed.select("market").distinct().withColumn("_i", F.lit(True)), "market", "left").join(pending.select("spec_key").distinct().withColumn("_p", F.lit(True)), "spec_key", "left")
    return d.select("spec_key", F.when(F.col("_i").isNull(), "MARKET_INDEX").when(F.col("_p").isNotNull(), "GROUPS").otherwise("FINALIZE").alias("phase"))


def equivalence_scope(specs: DataFrame, *columns: str) -> DataFrame:
    return specs.withColumn("equivalence_scope", X.equivalence_scope(*(F.col(c) for c in columns)))
