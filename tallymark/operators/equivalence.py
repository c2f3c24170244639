"""Relations of pairs of snapshots, clusters, representatives, images, revalidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hashing as H
from . import fingerprints as P
from .latest import first_n

HASHES = ("structure_hash", "spec_parts_hash", "schema_semantic_hash", "image_hash")
COUNTS = ("categories", "groups", "schemas", "parts")


def usable(state: Column) -> Column:
    return state.isin("VALID", "STALE")


def eligible(s: DataFrame) -> Column:
    """Complete, valid or stale, and no hash missing."""
    whole = F.col("collection_complete") & usable(F.col("state"))
    for h in HASHES:
        whole = whole & F.col(h).isNotNull()
    return whole


def comparison_valid(a: str, b: str) -> Column:
    same = F.lit(True)
    for c in ("scope", "normalizer_version", "fingerprint_version"):
        same = same & (F.col(f"{a}.{c}") == F.col(f"{b}.{c}"))
    return F.coalesce(same & F.col(f"{a}.collection_complete") & F.col(f"{b}.collection_complete") & usable(F.col(f"{a}.state")) & usable(F.col(f"{b}.state")), F.lit(False))


def relation(valid: Column, a: Column, b: Column) -> Column:
    return F.when(~valid | a.isNull() | b.isNull(), "UNKNOWN").when(a == b, "EXACT").otherwise("DIFFERENT")


def image_relation(valid: Column, parts: Column, a: Column, b: Column, empty: Column) -> Column:
    none_a, none_b = a == empty, b == empty
    return (
        F.when(~valid | a.isNull() | b.isNull(), "UNKNOWN").when(none_a & none_b, "NONE").when(~none_a & ~none_b, F.when(a == b, "EXACT").otherwise("DIFFERENT"))
        .otherwise(F.when(parts == "EXACT", "COMPLEMENTARY").otherwise("DIFFERENT"))
    )


def compare(pairs: DataFrame, snapshots: DataFrame, empty_image: Column) -> DataFrame:
    """pairs: a, b (spec keys) -> relations, literal comparison of each hash, and reasons."""
    s = snapshots
    joined = pairs.join(s.select(F.struct(*s.columns).alias("x"), F.col("spec_key").alias("a")), "a").join(s.select(F.struct(*s.columns).alias("y"), F.col("spec_key").alias("b")), "b")
    d = joined.withColumn("valid", comparison_valid("x", "y")).withColumn("parts", relation(F.col("valid"), F.col("x.spec_parts_hash"), F.col("y.spec_parts_hash")))
    d = d.withColumn("schemas", relation(F.col("valid"), F.col("x.schema_semantic_hash"), F.col("y.schema_semantic_hash")))
    d = d.withColumn("images", image_relation(F.col("valid"), F.col("parts"), F.col("x.image_hash"), F.col("y.image_hash"), empty_image))
    reasons = F.array_compact(F.array(
        F.when(F.col("x.scope") != F.col("y.scope"), "SCOPE"),
        F.when(~(F.col("x.collection_complete") & F.col("y.collection_complete")), "INCOMPLETE"),
        F.when(~(usable(F.col("x.state")) & usable(F.col("y.state"))), "STATE"),
    ))
    literal = [H.compare_hashes(F.col(f"x.{h}"), F.col(f"y.{h}"), F.col("valid")).alias(h.replace("_hash", "_equal")) for h in HASHES]
    return d.select("a", "b", "valid", "parts", "schemas", "images", *literal, (F.col("valid") & (F.col("parts") == "EXACT")).alias("dedup_allowed"), F.array_join(reasons, ",").alias("reasons"))


def comparison_report(pairs: DataFrame, snapshots: DataFrame, groups: DataFrame, empty_image: Column) -> DataFrame:
    """A row for each pair (a, b), whatever is missing: relations and literal hash comparisons, counts of both sides, how many groups are only in a, only in b and in both, and why
    something is unavailable. groups: spec_key, category, group_id of complete manifests (without group_id: an empty one). Parts are never compared one by one."""
    one = compare(pairs, snapshots, empty_image)
    has = groups.select("spec_key").distinct()
    g = groups.filter("group_id IS NOT NULL").select("spec_key", "category", "group_id").distinct()
    sides = [pairs.select("a", "b", F.col(s).alias("spec_key")).join(g, "spec_key").select("a", "b", "category", "group_id", F.lit(m).alias("m")) for s, m in (("a", 1), ("b", 2))]
    both = sides[0].unionByName(sides[1]).groupBy("a", "b", "category", "group_id").agg(F.sum("m").alias("m"))
    diff = both.groupBy("a", "b").agg(*(F.count_if(F.col("m") == i).alias(n) for i, n in ((1, "only_a"), (2, "only_b"), (3, "shared"))))
    manifest = lambda key: has.select(F.col("spec_key").alias(key), F.lit(True).alias(f"_m{key}"))
    counts = lambda key: snapshots.select(F.col("spec_key").alias(key), F.struct(*COUNTS).alias(f"counts_{key}"))
    d = pairs.join(one, ["a", "b"], "left").join(diff, ["a", "b"], "left")
    d = d.join(counts("a"), "a", "left").join(counts("b"), "b", "left").join(manifest("a"), "a", "left").join(manifest("b"), "b", "left")
    missing = lambda x, y: F.concat_ws(",", F.when(F.col(x).isNull(), F.col("a")), F.when(F.col(y).isNull(), F.col("b")))
    known = F.col("_ma").isNotNull() & F.col("_mb").isNotNull()
    number = lambda c: F.when(known, F.coalesce(c, F.lit(0))).alias(c)
    literal = [h.replace("_hash", "_equal") for h in HASHES]
    return d.select(
        "a", "b", "valid", "parts", "schemas", "images", *(F.coalesce(c, F.lit("UNAVAILABLE")).alias(c) for c in literal), "counts_a", "counts_b",
        number("only_a"), number("only_b"), number("shared"), F.nullif(missing("counts_a", "counts_b"), F.lit("")).alias("no_snapshot"), F.nullif(missing("_ma", "_mb"), F.lit("")).alias("no_manifest"), F.lit(False).alias("parts_diff_available"),
    )


def with_cluster(snapshots: DataFrame) -> DataFrame:
    return snapshots.filter(eligible(snapshots)).withColumn("cluster_key", H.cluster_key(F.col("scope"), F.col("normalizer_version"), F.col("fingerprint_version"), F.col("spec_parts_hash")))


def clusters(snapshots: DataFrame) -> DataFrame:
    """cluster_key, spec_parts_hash, size, least member, of clusters of two or more. Members stay rows of with_cluster: no list grows with a cluster."""
    return with_cluster(snapshots).groupBy("cluster_key").agg(F.first("spec_parts_hash").alias("spec_parts_hash"), F.count("*").alias("size"), F.min("spec_key").alias("least")).filter("size >= 2")


def ordered_clusters(snapshots: DataFrame) -> DataFrame:
    """Clusters of two or more with their place: the largest first, then by hash."""
    found = clusters(snapshots)
    return found.orderBy(F.desc("size"), "spec_parts_hash", "cluster_key")


def cluster_members(snapshots: DataFrame, specs: DataFrame) -> DataFrame:
    """Members of clusters of two or more, with their place by model code, catalogue number and key. specs: spec_key, model_code, catalog_id."""
    m = with_cluster(snapshots).select("cluster_key", "spec_key", "parts").join(clusters(snapshots).select("cluster_key"), "cluster_key", "left_semi").join(specs.select("spec_key", "model_code", "catalog_id"), "spec_key")
    return m.withColumn("place", F.row_number().over(W.partitionBy("cluster_key").orderBy("model_code", "catalog_id", "spec_key")))


def classes(members: DataFrame) -> DataFrame:
    """members: cluster_key, spec_key, ... -> a record of each class: cluster_key, size, representative, which is one of its members (null: none is VALID)."""
    rep = representatives(members).select("cluster_key", F.col("spec_key").alias("representative"))
    return members.groupBy("cluster_key").agg(F.count("*").alias("size")).join(rep, "cluster_key", "left")


def own_images(images: DataFrame) -> DataFrame:
    """images: spec_key, image (a row for each part) -> spec_key, image: the least of each spec, null if it has none; the empty text is none."""
    return images.groupBy("spec_key").agg(F.min(F.nullif("image", F.lit(""))).alias("image"))


def redundancy(snapshots: DataFrame) -> DataFrame:
    """One row: considered, distinct (cluster keys and the other three hashes), clusters, isolated, largest, and the share that is redundant."""
    m = with_cluster(snapshots)
    of = m.groupBy("cluster_key").agg(F.count("*").alias("n"))
    total, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    others = m.agg(*(F.count_distinct(h).alias(f"distinct_{h}") for h in HASHES if h != "spec_parts_hash"))
    return of.agg(
        total.alias("considered"), distinct.alias("distinct_hashes"), F.count_if(F.col("n") >= 2).alias("clusters"), F.count_if(F.col("n") == 1).alias("isolated"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.when(total > 0, (total - distinct) / total).otherwise(0.0).alias("ratio"),
    ).crossJoin(others)


def representatives(members: DataFrame) -> DataFrame:
    """members: cluster_key, spec_key, state, images, collected_at, parts -> the representative of each cluster that has a VALID member."""
    order = [F.desc("images"), F.desc("collected_at"), F.desc("parts"), F.asc("spec_key")]
    return first_n(members.filter("state = 'VALID'"), ["cluster_key"], order, 1).drop("rank")


def resolve_images(members: DataFrame) -> DataFrame:
    """members: cluster_key, spec_key, image (own least one, or null) -> image, origin, is_fallback.

    The fallback is the image of the least member that has one: one small aggregate, not a self join of members."""
    fallback = members.filter("image IS NOT NULL").groupBy("cluster_key").agg(F.min("spec_key").alias("other"), F.min_by("image", "spec_key").alias("other_image"))
    d = members.join(fallback, "cluster_key", "left")
    return d.select(
        "spec_key", "cluster_key", F.coalesce("image", "other_image").alias("image"), F.when(F.col("image").isNotNull(), F.col("spec_key")).otherwise(F.col("other")).alias("origin"),
        (F.col("image").isNull() & F.col("other_image").isNotNull()).alias("is_fallback"),
    )


def divergence(fields: dict[str, tuple[Column, Column]]) -> Column:
    """fields: name -> (expected, actual). An array of (field, expected, actual) of those whose expected value is known and differs; a missing actual value differs."""
    one = lambda n, e, a: F.when(e.isNotNull() & ~e.eqNullSafe(a), F.struct(F.lit(n).alias("field"), e.alias("expected"), a.alias("actual")))
    return F.array_compact(F.array(*(one(n, e, a) for n, (e, a) in fields.items())))


def export_view(specs: DataFrame, snapshots: DataFrame, assignments: DataFrame, representatives_: DataFrame, images: DataFrame, tree: DataFrame) -> DataFrame:
    """specs with a reference to their last snapshot, their cluster and whether they represent it, their image, and their hierarchy: an array of (category, groups).

    snapshots: one for each spec; assignments: spec_key, cluster_key; representatives_: cluster_key, rep; images: spec_key, image; tree: spec_key, category, grp. A hierarchy is one spec's own."""
    groups = tree.distinct().groupBy("spec_key", "category").agg(F.array_sort(F.collect_list("grp")).alias("groups"))
    hierarchy = groups.groupBy("spec_key").agg(F.array_sort(F.collect_list(F.struct("category", "groups"))).alias("hierarchy"))
    kept = [c for c in ("snapshot_id", "state", "collected_at", "parser_version", "normalizer_version", "fingerprint_version") if c in snapshots.columns]
    d = specs.join(snapshots.select("spec_key", F.struct(*kept).alias("snapshot")), "spec_key", "left").join(assignments, "spec_key", "left").join(representatives_, "cluster_key", "left")
    d = d.join(images, "spec_key", "left").join(hierarchy, "spec_key", "left")
    return d.withColumn("is_representative", F.coalesce(F.col("rep") == F.col("spec_key"), F.lit(False)))


def revalidate(before: DataFrame, after: DataFrame) -> DataFrame:
    """Both: spec, category, category_fp -> spec, category, change (ADDED, REMOVED, CHANGED) of what diverges."""
    a, b = before.select("spec", "category", F.col("category_fp").alias("x")), after.select("spec", "category", F.col("category_fp").alias("y"))
    d = a.join(b, ["spec", "category"], "full_outer").filter(~F.col("x").eqNullSafe(F.col("y")))
    return d.select("spec", "category", F.when(F.col("x").isNull(), "ADDED").when(F.col("y").isNull(), "REMOVED").otherwise("CHANGED").alias("change"))


def revalidate_trees(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """before, after: parts of trees (spec, category, grp, schema_id, part_fp, image_url).

    -> the flags of every spec on both sides (a hash of a missing side differs from any), and the groups whose fingerprints differ: spec, category, grp, change. Both sides are one
    table with a side, so all fingerprints are rolled up once; a group is only told apart where its own hash differs, which makes its category differ."""
    key = lambda df, side: df.withColumn("spec", F.struct(F.col("spec").alias("of"), F.lit(side).alias("side")))
    both = key(before, 1).unionByName(key(after, 2))
    sets = P.fingerprint_set(both)
    sided = [F.max(F.when(F.col("spec.side") == s, F.col(h))).alias(f"{h}_{s}") for h in HASHES for s in (1, 2)]
    flag = lambda h: ~F.col(f"{h}_1").eqNullSafe(F.col(f"{h}_2"))
    flags = sets.groupBy(F.col("spec.of").alias("spec")).agg(*sided).select("spec", *(flag(h).alias(h.replace("_hash", "_changed")) for h in HASHES), (flag(HASHES[0]) | flag(HASHES[1]) | flag(HASHES[2])).alias("is_stale"))
    groups = P.group_fingerprints(both).groupBy(F.col("spec.of").alias("spec"), "category", "grp").agg(*(F.max(F.when(F.col("spec.side") == s, F.col("group_fp"))).alias(f"g{s}") for s in (1, 2)))
    changed = groups.filter(~F.col("g1").eqNullSafe(F.col("g2"))).select("spec", "category", "grp", F.when(F.col("g1").isNull(), "ADDED").when(F.col("g2").isNull(), "REMOVED").otherwise("CHANGED").alias("change"))
    return flags, changed


def changed_flags(before: DataFrame, after: DataFrame) -> DataFrame:
    """Fingerprint sets of two times -> a flag for each hash; is_stale ignores images."""
    d = before.alias("x").join(after.alias("y"), "spec")
    flag = lambda h: ~F.col(f"x.{h}").eqNullSafe(F.col(f"y.{h}"))
    return d.select("spec", *(flag(h).alias(h.replace("_hash", "_changed")) for h in HASHES), (flag(HASHES[0]) | flag(HASHES[1]) | flag(HASHES[2])).alias("is_stale"))


def supersede(snapshots: DataFrame) -> DataFrame:
    """A snapshot is superseded by a later one that is VALID or INCOMPLETE; an INVALID one supersedes nothing."""
    w = W.partitionBy("spec_key").orderBy("collected_at", "snapshot_id").rowsBetween(1, W.unboundedFollowing)
    later = F.max(F.col("state").isin("VALID", "INCOMPLETE").cast("int")).over(w)
    return snapshots.withColumn("final_state", F.when((F.coalesce(later, F.lit(0)) == 1) & (F.col("state") != "INVALID"), "SUPERSEDED").otherwise(F.col("state")))
