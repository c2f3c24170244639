"""Golden cases of the catalogue engine on small hand-built tables."""

import datetime as dt
import hashlib
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tallymark.functions import hashing as H
from tallymark.functions import text as X
from tallymark.operators import assembly as A
from tallymark.operators import equivalence as E
from tallymark.operators import fingerprints as P
from tallymark.operators import ingest as I
from tallymark.operators import latest as L
from tallymark.operators import pages
from tallymark.operators import records
from tallymark.operators import reports as R
from tallymark.operators import state as S
from tallymark.operators import validation as V
from tallymark.sources import tables


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [("a\xa0b", "a b"), ("a\r\nb\rc", "a\nb\nc"), ("a    b\t\tc", "a b c"), ("a\n\n\n\nb", "a\nb"), ("Ａ", "A"), ("  é ", "é"), ("\x1f x\x1c", "x"), ("", ""), (None, None)],
)
def test_normalize_text(spark, raw, want):
    assert one(spark.createDataFrame([(raw,)], "x string").select(X.normalize_text(F.col("x")))) == want


@pytest.mark.parametrize("raw, want", [(" gol ", "GOL"), ("ß", None), ("ﬀ", None), ("é", None), ("А", None), ("AMBER-1", "AMBER-1"), ("a--b", None), ("", None)])
def test_scope_part(spark, raw, want):
    assert one(spark.createDataFrame([(raw,)], "x string").select(X.scope_part(F.col("x")))) == want


def test_scope_round_trip_and_display_key(spark):
    d = spark.createDataFrame([("a", "b", "c", "d:\\")], "a string, b string, c string, d string")
    r = d.select(X.build_scope(F.col("a"), F.col("b"), F.col("c"), F.lit("x")).alias("s"), X.display_key(F.col("a"), F.col("d")).alias("k")).first()
    assert (r.s, r.k) == ("A:B:C:X", "a:d\\:\\\\")
    assert one(spark.createDataFrame([("A:B",)], "s string").select(X.parse_scope(F.col("s"), 0))) is None


def test_oem_and_codes(spark):
    d = spark.createDataFrame([(" 1k0 407\t151 ", ["b", " a ", "b"])], "o string, c array<string>")
    r = d.select(X.normalize_oem(F.col("o")).alias("o"), X.normalize_codes(F.col("c")).alias("c"), X.optional(F.lit("  ")).alias("e")).first()
    assert (r.o, r.c, r.e) == ("1K0407151", ["A", "B", "B"], None)


def test_month(spark):
    d = spark.createDataFrame([("2024.04",), ("2020.13",), ("x",), (None,)], "m string")
    assert [r[0] for r in d.select(X.month(F.col("m"))).collect()] == [dt.date(2024, 4, 1), None, None, None]


def test_canonical_json(spark):
    values = {"b": 'q"\\', "a": None, "c": "é\n"}
    d = spark.createDataFrame([(values["a"], values["b"], values["c"])], "a string, b string, c string")
    text = one(d.select(H.json_object(**{k: H.json_text(F.col(k)) for k in values})))
    assert text == json.dumps(values, sort_keys=True, separators=(",", ":"))
    assert one(d.select(H.domain_hash("part:v1", F.lit(text)))) == hashlib.sha256(b"part:v1\0" + text.encode()).hexdigest()


def test_null_hashes_are_never_equal(spark):
    d = spark.createDataFrame([(None, None, True), ("a", "a", True), ("a", "b", True), ("a", "a", False)], "a string, b string, v boolean")
    assert [r[0] for r in d.select(H.compare_hashes(F.col("a"), F.col("b"), F.col("v"))).collect()] == ["UNAVAILABLE", "EQUAL", "DIFFERENT", "UNAVAILABLE"]


def _tree(spark, rows):
    return spark.createDataFrame([("s", "c", "g", *r) for r in rows], "spec string, category string, grp string, schema_id string, part_fp string, image_url string")


def test_group_fingerprint_is_a_multiset(spark):
    rows = [("1", "x", None), ("1", "y", None), ("2", "x", "i")]
    of = lambda r: P.group_fingerprints(_tree(spark, r)).first().group_fp
    base = of(rows)
    assert all(of(list(p)) == base for p in itertools.islice(itertools.permutations(rows), 3))
    assert of([*rows, rows[0]]) != base
    body = '{"group_id":"g","part_fingerprints_multiset":[["x",2],["y",1]]}'
    assert base == hashlib.sha256(b"group:v1\0" + body.encode()).hexdigest()
    assert of([("1", None, None)]) == hashlib.sha256(b'group:v1\0{"group_id":"g","part_fingerprints_multiset":[]}').hexdigest()


def test_tree_counts_and_image_hash(spark):
    d = _tree(spark, [("1", "x", ""), ("1", "x", None), ("2", "y", None)])
    assert tuple(P.tree_counts(d).first()) == ("s", 1, 1, 2, 3)
    assert P.image_hash(d).first().image_hash == hashlib.sha256(b'image:v1\0{"images_multiset":[]}').hexdigest()


SNAP = "spec_key long, snapshot_id string, scope string, normalizer_version string, fingerprint_version string, collection_complete boolean, state string, structure_hash string, spec_parts_hash string, schema_semantic_hash string, image_hash string"


def snap(k, h="a", scope="S", state="VALID", complete=True, image="i", structure="t"):
    return (k, f"s{k}", scope, "n", "f", complete, state, structure, h, "m", image)


def test_redundancy(spark):
    r = E.redundancy(spark.createDataFrame([snap(1), snap(2), snap(3, "b")], SNAP)).first()
    assert (r.considered, r.distinct_hashes, r.clusters, r.isolated, r.largest, round(r.ratio, 6)) == (3, 2, 1, 1, 2, 0.333333)
    r = E.redundancy(spark.createDataFrame([snap(1), snap(2, state="INCOMPLETE")], SNAP)).first()
    assert (r.considered, r.clusters) == (1, 0)
    r = E.redundancy(spark.createDataFrame([], SNAP)).first()
    assert (r.considered, r.largest, r.ratio) == (0, 0, 0.0)


def test_compare(spark):
    s = spark.createDataFrame([snap(1), snap(2), snap(3, scope="T"), snap(4, structure=None), snap(5, image="EMPTY"), snap(6, h="z", image="EMPTY")], SNAP)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (5, 6), (1, 6)], "a long, b long")
    got = {(r.a, r.b): r for r in E.compare(pairs, s, F.lit("EMPTY")).collect()}
    assert (got[1, 2].parts, got[1, 2].images, got[1, 2].dedup_allowed) == ("EXACT", "EXACT", True)
    assert (got[1, 3].valid, got[1, 3].parts, got[1, 3].spec_parts_equal, got[1, 3].reasons) == (False, "UNKNOWN", "UNAVAILABLE", "SCOPE")
    assert (got[1, 4].structure_equal, got[1, 4].spec_parts_equal) == ("UNAVAILABLE", "EQUAL")
    assert (got[1, 5].images, got[5, 6].images, got[1, 6].images) == ("COMPLEMENTARY", "NONE", "DIFFERENT")


def test_representative_and_images(spark):
    m = spark.createDataFrame([("c", 1, "VALID", 2, 5, 1), ("c", 2, "VALID", 3, 1, 1), ("c", 3, "STALE", 9, 9, 9), ("d", 4, "STALE", 1, 1, 1)], "cluster_key string, spec_key long, state string, images int, collected_at long, parts int")
    assert [(r.cluster_key, r.spec_key) for r in E.representatives(m).collect()] == [("c", 2)]
    i = spark.createDataFrame([(1, "c", None), (2, "c", "z"), (3, "c", "y"), (4, "d", None)], "spec_key long, cluster_key string, image string")
    assert sorted((r.spec_key, r.image, r.origin, r.is_fallback) for r in E.resolve_images(i).filter("image is not null").collect()) == [(1, "z", 2, True), (2, "z", 2, False), (3, "y", 3, False)]


def test_revalidation(spark):
    kind = "spec string, category string, category_fp string"
    a, b = spark.createDataFrame([("s", "x", "1"), ("s", "y", "1"), ("s", "z", "1")], kind), spark.createDataFrame([("s", "x", "1"), ("s", "y", "2"), ("s", "w", "1")], kind)
    assert sorted(tuple(r) for r in E.revalidate(a, b).collect()) == [("s", "w", "ADDED"), ("s", "y", "CHANGED"), ("s", "z", "REMOVED")]


def test_invalid_never_supersedes(spark):
    d = spark.createDataFrame([(1, "a", 1, "VALID"), (1, "b", 2, "INVALID"), (2, "c", 1, "VALID"), (2, "d", 2, "VALID")], "spec_key long, snapshot_id string, collected_at long, state string")
    assert {r.snapshot_id: r.final_state for r in E.supersede(d).collect()} == {"a": "VALID", "b": "INVALID", "c": "SUPERSEDED", "d": "VALID"}


def test_manifest_rules_differ(spark):
    m = spark.createDataFrame([(1, "s", "r", 1, True), (2, "s", "r", 2, False)], "id long, spec_key string, run_id string, discovered_at long, manifest_complete boolean")
    assert L.authoritative_manifest(m).count() == 0
    assert L.current_manifest(m).first().id == 1


def test_diff_upsert_insert(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {r.k: r.side for r in L.key_diff(a, b, ["k"]).collect()} == {1: "only_a", 2: "both", 3: "only_b"}
    kind = "k int, v string, t int"
    old, new = spark.createDataFrame([(1, "a", 1)], kind), spark.createDataFrame([(1, "b", 2), (2, "c", 1), (2, "d", 2)], kind)
    assert {r.k: r.v for r in L.upsert(old, new, ["k"], ["t"]).collect()} == {1: "b", 2: "d"}
    assert [(r.k, r.v) for r in L.insert_missing(old, new, ["k"], ["t"]).collect()] == [(2, "c")]


def test_summary_golden(spark):
    specs = spark.createDataFrame([("s", 1), ("s", 2), ("s", 3)], "scope string, spec_key long")
    snaps = spark.createDataFrame([(1, "VALID", True, 10, 30, 100, 1500), (2, "VALID", True, 10, 20, 80, 1000)], "spec_key long, state string, collection_complete boolean, categories int, groups int, schemas int, parts int")
    r = R.scope_summary(specs, snaps, ["scope"]).first()
    assert (r.discovered, r.valid, r.problematic, r.total_categories, r.total_groups, r.total_schemas, r.total_parts) == (3, 2, 1, 20, 50, 180, 2500)
    assert (r.groups_min, r.groups_max, r.groups_mean, r.groups_median) == (20, 30, 25.0, 25.0)
    assert "2.500" in R.render_text(R.scope_summary(specs, snaps, ["scope"]), "summary")
    assert json.loads(R.render_json(R.scope_summary(specs, snaps, ["scope"])))[0]["total_parts"] == 2500


def test_severities_are_zero_filled(spark):
    d = spark.createDataFrame([(1, 0, "X", "ERROR")], "spec_key long, position int, code string, severity string")
    assert {r.severity: r.n for r in R.severity_counts(d).collect()} == {"INFO": 0, "WARNING": 0, "ERROR": 1}


@pytest.mark.parametrize(
    "kinds, want",
    [
        ([], None), (["START"], ("IN_PROGRESS", 1, 0)), (["START", "ACCEPT", "REJECT", "START"], ("ACCEPTED", 1, 2)), (["START", "REJECT", "START"], ("IN_PROGRESS", 2, 0)), (["ACCEPT"], ("PENDING", 0, 1)),
        (["START", "START", "REJECT"], ("REJECTED", 1, 1)),
    ],
)
@pytest.mark.parametrize("seconds", [1, 86_400])
def test_checkpoint_fold(spark, kinds, want, seconds):
    t = dt.datetime(2024, 1, 1)
    e = spark.createDataFrame([("k", t + dt.timedelta(seconds=i), i, k) for i, k in enumerate(kinds)], "key string, ts timestamp, seq int, kind string")
    got = [(r.status, r.attempts, r.ignored) for r in S.checkpoint_states(e, seconds).collect()]
    assert got == ([want] if want else [])


def test_leases(spark):
    t = dt.datetime(2024, 1, 1)
    at = lambda s: t + dt.timedelta(seconds=s)
    c = spark.createDataFrame([("r", at(0), 0, 1), ("r", at(10), 1, 1), ("r", at(20), 2, 2), ("r", at(130), 3, 2)], "resource string, ts timestamp, seq int, owner long")
    leases = S.lease_states(c, 120)
    r = leases.first()
    assert (r.owner, r.token, r.denied, r.expires_at) == (2, 3, 1, at(250))
    a = spark.createDataFrame([("r", 1, "RELEASE", at(140))], "resource string, owner long, kind string, at timestamp")
    assert S.release_or_renew(leases, a, 120).first().expires_at == at(250)
    a = spark.createDataFrame([("r", 2, "RENEW", at(140))], "resource string, owner long, kind string, at timestamp")
    assert tuple(S.release_or_renew(leases, a, 120).first())[2:] == (4, at(260))


def test_limiter(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("r", t + dt.timedelta(seconds=s), i, c) for i, (s, c) in enumerate([(0, True), (1, True), (2, True), (700, False), (701, False), (1400, False), (2100, False), (2800, False)])]
    r = S.limiter_states(spark.createDataFrame(rows, "run string, ts timestamp, seq int, is_challenge boolean"), most=2, threshold=1, window=300, stability=600).first()
    assert (r.concurrency, r.cuts, r.raises) == (2, 3, 1)


def test_fencing_and_dispositions(spark):
    t = dt.datetime(2024, 1, 1)
    w = spark.createDataFrame([("r", t, i, k) for i, k in enumerate([1, 2, 1, 3])], "resource string, ts timestamp, seq int, token long")
    assert [r.seq for r in S.fencing_violations(w).collect()] == [2]
    d = spark.createDataFrame([(1, t, 0, "MANUAL_RETRY_REQUIRED", "a"), (1, t, 1, "CLEAR", "a"), (2, t, 0, "DEFERRED_THIS_SESSION", "a")], "spec_key long, ts timestamp, seq int, kind string, session string")
    got = S.dispositions(d)
    assert [(r.spec_key, r.kind) for r in got.collect()] == [(2, "DEFERRED_THIS_SESSION")]
    ok = lambda now, retry: one(got.select(S.eligible_disposition(F.col("kind"), F.col("session"), F.lit(now), retry)))
    assert (ok("a", False), ok("b", False)) == (False, True)


OK_PAGE = '<html><body><div class="epcVariation__details"></div></body></html>'


@pytest.mark.parametrize(
    "html, want",
    [
        (OK_PAGE, "ACCEPTED"), ("<html><body>x</body></html>", "INVALID"), (OK_PAGE.replace("</html>", ""), "INCOMPLETE"), ("<html><body class=notranslate></body></html>", "TRANSLATION_CONTAMINATED"),
        ("<html><title>Just a moment</title></html>", "CHALLENGE"), ("<html>Ray ID: 1</html>", "CHALLENGE"), ("<html><body>x", "INVALID"),
        (OK_PAGE.replace("<body>", '<body><div id="registration-form-container"><div class="g-recaptcha"></div></div>'), "ACCEPTED"),
        (OK_PAGE.replace("<body>", '<body><div id="other"><div class="g-recaptcha"></div></div>'), "CHALLENGE"),
        (OK_PAGE.replace("<body>", '<body><div id="registration-form-container"></div><div class="g-recaptcha"></div>'), "CHALLENGE"),
    ],
)
def test_outcome(spark, html, want):
    assert one(spark.createDataFrame([(html, "GROUP_DETAIL")], "h string, k string").select(V.outcome(F.col("h"), F.col("k")))) == want


def test_market_index():
    row = '<tr class="epcVariations__row"><td>{}</td><td>{}</td><td><span class="info-hint-new">Trendline</span></td></tr>'
    page = '<div class="breadcrumbs__last-item">eu west</div><table class="epcVariations">' + row.format('<a href="/x/a-62158">CODE</a>', "2024.04 - ...") + row.format('<a href="/x/a">C</a>', "2020.13 - 2021.01") + '<tr class="epcVariations__row"><td>1</td></tr></table>'
    a, b, c = pages.market_index(page)
    assert (a["market"], a["model_code"], a["catalog_id"], a["start"], a["end"], a["grade"]) == ("EU-WEST", "CODE", "62158", "2024-04-01", None, "Trendline")
    assert (b["error"], c["error"]) == ("no catalogue number", "1 cells")
    assert pages.market_index("<html></html>")[0]["critical"]


def test_manifest():
    card = '<div class="epcVariation__schema" data-id="{0}"><div class="epcVariation__schema-name"><a href="/c/{1}/{2}">n</a></div></div>'
    head = '<div class="epcVariation__details"></div><div class="epcVariation__schemaGroups"><a class="epcVariation__schemaGroup" data-id="" href="/all">A</a><a class="epcVariation__schemaGroup" data-id="1" href="/c/brakes">B</a></div><div class="epcVariation__schemas">'
    assert [(r["category"], r["group_id"]) for r in pages.manifest(head + card.format(7, "brakes", 7) + card.format(9, "brakes", 9) + "</div>")] == [("brakes", "7"), ("brakes", "9")]
    for bad, why in ((card.format(7, "brakes", 8), "data-id differs from href"), (card.format(7, "wheels", 7), "category not declared"), (card.format(7, "brakes", 7) * 2, "repeated group")):
        assert pages.manifest(head + bad + "</div>")[0]["error"] == why
    assert pages.manifest(head + "</div>") == [{"manifest_complete": False, "declared": 1}]


def test_group_detail():
    page = '<div class="epcVariation__details"></div><div class="epcSchema__schemas"><div class="epcSchema__schema" data-id="SCH-1"><div class="imgMap"><img src="i.png"></div><table class="entriesTable"><tr data-key="A01"><td class="entriesTable__number"> 1K0 <td class="entriesTable__number">2</td><td class="entriesTable__description"> Control <b>arm</b><table class="entriesPncDescriptionTable"><tr><td>d</td></tr></table></td><td class="entriesTable__required">1</td></tr></table></div><div class="epcSchema__schema" data-id="SCH-2"></div></div>'
    a, b = pages.group_detail(page)
    assert (a["oem"], a["description"], a["details"], a["quantity"], a["image_url"], a["period"]) == ("1K0", "Controlarm", "d", "1", "i.png", None)
    assert b == {"schema_id": "SCH-2", "image_url": None}
    assert pages.group_detail("")[0]["critical"]


def test_parse_pages(spark):
    d = spark.createDataFrame([(1, None), (2, "<p>")], "capture_id int, html string")
    assert pages.parse_pages(d, "GROUP_DETAIL").filter("critical").count() == 2


def test_blob_registry_and_store(spark, tmp_path):
    c = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "html string, collected_at long")
    new = tables.register_blobs(c, spark.createDataFrame([(hashlib.sha256(b"b").hexdigest(),)], "content_hash string"))
    assert [(r.content_hash, r.first_seen_at) for r in new.collect()] == [(hashlib.sha256(b"a").hexdigest(), 1)]
    name = hashlib.sha256(b"x").hexdigest()
    (tmp_path / name[:2]).mkdir()
    (tmp_path / name[:2] / name).write_bytes(b"x")
    r = tables.blobs(spark, str(tmp_path)).first()
    assert (r.content_hash, r.html, r.intact) == (name, "x", True)


def test_stream(spark, tmp_path):
    from tallymark.streaming import captures as C

    spark.createDataFrame([(OK_PAGE, "GROUP_DETAIL"), ("<html>Ray ID: 1</html>", "GROUP_DETAIL")], "html string, capture_kind string").write.parquet(str(tmp_path / "in"))
    q = C.start(C.classified(C.landed(spark, str(tmp_path / "in"), "html string, capture_kind string")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert q.awaitTermination(120)
    assert sorted(r.outcome for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["ACCEPTED", "CHALLENGE"]


def brute_lease(claims, seconds):
    owner = until = None
    token = denied = 0
    for t, _, who in sorted(claims):
        if owner is None or owner == who or until <= t:
            owner, token, until = who, token + 1, t + seconds
        else:
            denied += 1
    return owner, token, until, denied


def brute_limiter(events, most, threshold, window, stability):
    c, since, cuts, raises = most, None, 0, 0
    hot = [t for t, _, x in events if x]
    for t, _, challenge in sorted(events):
        since = t if since is None else since
        if challenge:
            if sum(t - window <= h <= t for h in hot) >= threshold:
                c, since, cuts = max(1, c - 1), t, cuts + 1
        elif c < most and t - since >= stability:
            c, since, raises = c + 1, t, raises + 1
    return c, cuts, raises


def test_folds_brute_force(spark):
    """Leases, limiter and fencing against loops, over slices of a day and of two minutes."""
    r = random.Random(4)
    at = lambda s: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    claims = {k: [(t, i, r.randrange(3)) for i, t in enumerate(sorted(r.randrange(200_000 if k % 2 else 4000) for _ in range(80)))] for k in range(6)}
    d = spark.createDataFrame([(k, at(t), i, w) for k, x in claims.items() for t, i, w in x], "resource int, ts timestamp, seq int, owner long")
    got = {x.resource: (x.owner, x.token, x.e, x.denied) for x in S.lease_states(d, 120).withColumn("e", F.unix_seconds("expires_at") - int(at(0).timestamp())).collect()}
    assert got == {k: brute_lease(x, 120) for k, x in claims.items()}
    events = {k: [(t, i, r.random() < 0.3) for i, t in enumerate(sorted(r.randrange(100_000) for _ in range(150)))] for k in range(6)}
    d = spark.createDataFrame([(k, at(t), i, c) for k, x in events.items() for t, i, c in x], "run int, ts timestamp, seq int, is_challenge boolean")
    for seconds in (86_400, 500):
        got = {x.run: (x.concurrency, x.cuts, x.raises) for x in S.limiter_states(d, 4, 2, 900, 1500, seconds).collect()}
        assert got == {k: brute_limiter(x, 4, 2, 900, 1500) for k, x in events.items()}
    highest = {(k, i): max([v for u, j, v in [(t, j, (j * 7919) % 100) for t, j, _ in x] if (u, j) < (t, i)], default=None) for k, x in claims.items() for t, i, _ in x}
    d = spark.createDataFrame([(k, at(t), i) for k, x in claims.items() for t, i, _ in x], "resource int, ts timestamp, seq int")
    got = {(x.resource, x.seq): x.highest for x in S.running_max(d, "resource", F.col("seq") * 7919 % 100, "highest", False, 300).collect()}
    assert got == highest


@pytest.mark.parametrize("kind, html, want", [("PRICE_LIST", OK_PAGE, "UNDECIDABLE"), ("PRICE_LIST", "<html>Ray ID: 1</html>", "CHALLENGE"), ("PRICE_LIST", "<html class='translated-rtl'></html>", "TRANSLATION_CONTAMINATED")])
def test_unknown_kinds_are_not_accepted(spark, kind, html, want):
    assert one(spark.createDataFrame([(html, kind)], "h string, k string").select(V.outcome(F.col("h"), F.col("k")))) == want


@pytest.mark.parametrize(
    "html, want",
    [
        ('<div id="registration-form-container"><div class="g-recaptcha"></div></div>', False), ('<div id="registration-form-container"><div></div><p class="g-recaptcha"></p></div>', False), ('<div id="registration-form-container"></div><p class="g-recaptcha"></p>', True),
        ('<div id="other"><p class="g-recaptcha"></p></div>', True), ('<p id="restore-form-container"><b class="g-recaptcha"></b></p>', True), ("<div id = ' restore-form-container '>g-recaptcha</div>", False),
        ('<div id=" restore-form-container "><b class="g-recaptcha"></b></div>', True), ('<div id="restore-form-container"><script>g-recaptcha</script>', False), ("nothing", False), (None, False), ('<div data-id="restore-form-container">g-recaptcha</div>', True),
    ],
)
def test_widget(html, want):
    """Raw spans and the parsed page: the latter (an id must be the approved one exactly) only ever adds."""
    assert V.unproven_widget(html) is want


def test_keys_are_not_ambiguous(spark):
    rows = [("s", "a|b", "c", "x"), ("t", "a", "b|c", "x"), ("u", "a", "b", "x")]
    d = spark.createDataFrame(rows, "spec string, category string, grp string, schema_id string")
    assert len({x.structure_hash for x in P.structure_hash(d).collect()}) == 3
    k = I.idempotency_keys(spark.createDataFrame([("r", "s", "a", None), ("r", "t", None, "a")], "run string, spec string, x string, y string"), "run", "spec", ["x", "y"]).collect()
    assert len({x.k for x in k}) == 2
    assert one(spark.createDataFrame([("a\"b", 1)], "v string, n long").select(H.json_multiset(F.array(F.struct(F.col("v").alias("value"), "n"))))) == '[["a\\"b",1]]'


def test_assemble_and_finalize(spark):
    """A captured empty group stays, one that was not captured leaves no row, nor does its category; a critical page makes its run INVALID."""
    manifests = spark.createDataFrame([(1, "s", "r", True), (2, "t", "r", True), (3, "u", "r", True), (4, "v", "r", False)], "id long, spec_key string, run_id string, manifest_complete boolean")
    groups = spark.createDataFrame([(1, "brakes", "1"), (1, "brakes", "2"), (1, "lamps", "3"), (2, "brakes", "1"), (3, "brakes", "1"), (4, "brakes", "1")], "id long, category string, group_id string")
    accepted = spark.createDataFrame([("s", "r", "brakes", "1", "c1"), ("s", "r", "brakes", "2", "c2"), ("t", "r", "brakes", "1", "c3"), ("t", "r", "old", "9", "c1")], "spec_key string, run_id string, category string, group_id string, raw_capture_id string")
    page = '<div class="epcVariation__details"></div><div class="epcSchema__schemas">{}</div>'
    body = '<div class="epcSchema__schema" data-id=" S1 "><table class="entriesTable"><tr data-key="a1"><td class="entriesTable__number">1k 0</td></tr></table></div><div class="epcSchema__schema" data-id="S2"></div>'
    pages_ = spark.createDataFrame([("c1", page.format(body)), ("c2", page.format("")), ("c3", "<p>")], "capture_id string, html string")
    details = pages.parse_pages(pages_, "GROUP_DETAIL")
    runs = L.authoritative_manifest(manifests).select("spec_key", "run_id", "id").join(groups, "id")
    tree = A.normalize_parts(A.assemble(runs, accepted, details)).filter("spec.spec_key = 's'").collect()
    assert sorted(((x.category, x.grp, x.schema_id, x.pnc, x.oem) for x in tree), key=repr) == sorted([("brakes", "1", "S1", "A1", "1K0"), ("brakes", "1", "S2", None, None), ("brakes", "2", None, None, None)], key=repr)
    plans = {x.spec_key: x for x in A.plan_finalization(manifests, groups, accepted, details).collect()}
    assert {k: (x.collection_complete, x.state, x.categories, x.groups, x.schemas, x.parts) for k, x in plans.items()} == {"s": (False, "INCOMPLETE", 1, 2, 2, 1), "t": (True, "INVALID", 1, 1, 0, 0), "u": (False, "INCOMPLETE", 0, 0, 0, 0)}
    assert plans["u"].spec_parts_hash == hashlib.sha256(b'spec-parts:v1\0{"category_fingerprints_multiset":[]}').hexdigest() and plans["u"].idempotency_key is None
    assert len({x.structure_hash for x in plans.values()}) == 3


def test_commit_is_idempotent(spark):
    kind = "snapshot_id string, spec_key long, state string, collected_at long, idempotency_key string"
    old = spark.createDataFrame([("a", 1, "VALID", 1, "k1"), ("b", 2, "VALID", 1, "k2"), ("c", 3, "STALE", 1, "k3")], kind)
    plans = spark.createDataFrame([("d", 1, "VALID", 2, "k4"), ("e", 2, "INVALID", 2, "k5"), ("f", 3, "VALID", 2, "k3")], kind)
    once = A.commit(plans, old)
    want = {"a": "SUPERSEDED", "b": "VALID", "c": "STALE", "d": "VALID", "e": "INVALID"}
    assert {x.snapshot_id: x.state for x in once.collect()} == want == {x.snapshot_id: x.state for x in A.commit(plans, once).collect()}


def test_accepted_checkpoints_stay(spark):
    kind = "key string, status string, seq long"
    old, new = spark.createDataFrame([("a", "ACCEPTED", 1), ("b", "REJECTED", 1)], kind), spark.createDataFrame([("a", "REJECTED", 2), ("b", "ACCEPTED", 2), ("b", "IN_PROGRESS", 3), ("c", "IN_PROGRESS", 1)], kind)
    assert {x.key: (x.status, x.seq) for x in records.upsert_checkpoints(old, new, ["key"], "seq").collect()} == {"a": ("ACCEPTED", 1), "b": ("ACCEPTED", 2), "c": ("IN_PROGRESS", 1)}


def test_blob_store_writes_once(spark, tmp_path):
    c = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "html string, collected_at long")
    root = str(tmp_path / "blobs")
    tables.write_blobs(c, root)
    got = tables.write_blobs(spark.createDataFrame([("a", 0), ("c", 9)], "html string, collected_at long"), root).collect()
    assert sorted((x.html, x.first_seen_at) for x in got) == [("a", 1), ("b", 2), ("c", 9)] and all(x.prefix == x.content_hash[:2] for x in got)


def test_versions_beside_each_other(spark, tmp_path):
    d = spark.createDataFrame([(1, "a")], "k int, v string")
    path = tables.replace(d, str(tmp_path), "t", 1)
    again = tables.replace(spark.read.parquet(path).withColumn("v", F.lit("b")), str(tmp_path), "t", 2)
    assert [x.v for x in spark.read.parquet(path).collect() + spark.read.parquet(again).collect()] == ["a", "b"]


def test_logs_refuse_raw_content(spark):
    assert json.loads(R.log_event("r", "capture", "t", size=3)) == {"run_id": "r", "event": "capture", "timestamp": "t", "size": 3}
    for bad in ({"html": "x"}, {"page": b"x"}):
        with pytest.raises(ValueError):
            R.log_event("r", "capture", "t", **bad)
    with pytest.raises(ValueError):
        R.log_lines(spark.createDataFrame([("r", "x")], "run_id string, raw_html string"))


def test_revalidate_trees(spark):
    kind = "spec string, category string, grp string, schema_id string, part_fp string, image_url string"
    a = spark.createDataFrame([("s", "x", "1", "S", "p", "i"), ("s", "x", "2", "S", "p", None), ("t", "x", "1", "S", "p", "i"), ("u", "x", "1", "S", "p", "i")], kind)
    b = spark.createDataFrame([("s", "x", "1", "S", "p", "i"), ("s", "x", "2", "S", "q", None), ("s", "y", "3", "S", "p", None), ("t", "x", "1", "S", "p", "j"), ("v", "x", "1", "S", "p", "i")], kind)
    flags, groups = E.revalidate_trees(a, b)
    got = {x.spec: (x.structure_changed, x.spec_parts_changed, x.schema_semantic_changed, x.image_changed, x.is_stale) for x in flags.collect()}
    assert got["s"] == (True, True, True, False, True) and got["t"] == (False, False, False, True, False) and got["u"][4] and got["v"][4]
    assert sorted(map(tuple, groups.collect())) == [("s", "x", "2", "CHANGED"), ("s", "y", "3", "ADDED"), ("u", "x", "1", "REMOVED"), ("v", "x", "1", "ADDED")]
