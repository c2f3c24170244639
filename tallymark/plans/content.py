"""Queries over texts and hashes: normalisation, fingerprints, captures, validation, parsing."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as X
from ..operators import assembly as A
from ..operators import equivalence as E
from ..operators import fingerprints as P
from ..operators import ingest as I
from ..operators import pages
from ..operators import validation as V
from ..sources import tables
from .standins import Registry

query = Registry()
_TEXTS = "documents"


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '[ \t]+', ' ', 'g'), '\n{2,}', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS h FROM documents")
def normalize_text(t):
    return t(_TEXTS).select("doc_id", F.md5(X.normalize_text(F.col("text"))).alias("h"))


@query("SELECT page_id, upper(regexp_replace(url, '\\s+', '', 'g')) AS oem, upper(trim(url)) AS pnc FROM pages")
def normalize_codes(t):
    return t("pages").select("page_id", X.normalize_oem(F.col("url")).alias("oem"), X.normalize_pnc(F.col("url")).alias("pnc"))


@query("SELECT p_partkey, array_to_string(list_sort([upper(x) for x in string_split(p_name, ' ')]), ',') AS codes FROM part")
def normalize_pr_codes(t):
    return t("part").select("p_partkey", F.array_join(X.normalize_codes(F.split("p_name", " ")), ",").alias("codes"))


@query("SELECT c_custkey, CASE WHEN regexp_full_match(upper(trim(c_mktsegment)), '[A-Z0-9]+(-[A-Z0-9]+)*') THEN upper(trim(c_mktsegment)) END AS part FROM customer")
def scope_component(t):
    return t("customer").select("c_custkey", X.scope_part(F.col("c_mktsegment")).alias("part"))


@query("SELECT spec_key, 'SITE:' || upper(manufacturer) || ':' || upper(vehicle_model) || ':' || upper(market) AS scope, upper(vehicle_model) AS model FROM specs")
def scope_roundtrip(t):
    d = t("specs").select("spec_key", X.build_scope(F.lit("site"), F.col("manufacturer"), F.col("vehicle_model"), F.col("market")).alias("scope"))
    return d.select("spec_key", "scope", X.parse_scope(F.col("scope"), 2).alias("model"))


@query("SELECT page_id, concat_ws(':', replace(replace(url, '\\', '\\\\'), ':', '\\:'), 'a') AS k FROM pages")
def display_key(t):
    return t("pages").select("page_id", X.display_key(F.col("url"), F.lit("a")).alias("k"))


@query("""SELECT spec_key, sha256('spec-identity:v1' || chr(0) || '{"catalog_id":"' || catalog_id || '","manufacturer":"' || upper(manufacturer) || '","market":"' || upper(market) || '","model_code":"' || model_code || '","vehicle_model":"' || upper(vehicle_model) || '"}') AS stable_key FROM specs""")
def stable_key(t):
    up = lambda c: H.json_text(F.upper(X.strip(F.col(c))), True)
    return t("specs").select("spec_key", H.domain_hash("spec-identity:v1", H.json_object(catalog_id=up("catalog_id"), manufacturer=up("manufacturer"), market=up("market"), model_code=up("model_code"), vehicle_model=up("vehicle_model"))).alias("stable_key"))


@query("SELECT doc_id, sha256(text) AS h FROM documents")
def content_hash(t):
    return t(_TEXTS).select("doc_id", H.content_hash(F.col("text")).alias("h"))


@query("SELECT sha256(html) AS content_hash, min(collected_at) AS first_seen_at, octet_length(encode(any_value(html))) AS size_bytes FROM captures WHERE capture_id % 10 <> 0 AND html NOT IN (SELECT html FROM captures WHERE capture_id % 10 = 0) GROUP BY 1")
def blob_registry(t):
    c = t("captures")
    known = c.filter("capture_id % 10 = 0").select(F.sha2(F.col("html").cast("binary"), 256).alias("content_hash")).distinct()
    return tables.register_blobs(c.filter("capture_id % 10 <> 0"), known).select("content_hash", "first_seen_at", "size_bytes")


@query("SELECT sha256(text) AS h, count(*) AS captures, min(doc_id) AS first FROM documents GROUP BY 1")
def blob_dedup(t):
    return t(_TEXTS).groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(F.count("*").alias("captures"), F.min("doc_id").alias("first"))


@query("SELECT capture_id, strlen(html) AS size FROM captures")
def capture_replay(t):
    c = t("captures").withColumn("content_hash", F.sha2(F.col("html").cast("binary"), 256))
    store = c.select("content_hash", "html").dropDuplicates(["content_hash"])
    return tables.replay(c.drop("html"), store).select("capture_id", F.octet_length("html").cast("long").alias("size"))


@query("SELECT capture_id, capture_kind AS category, CAST(capture_id AS STRING) AS group_id FROM captures")
def manifest_decode(t):
    c = t("captures").select("capture_id", F.format_string('[{"category_slug":"%s","groups":[{"group_id":"%s","source_url":"u"}]}]', "capture_kind", F.col("capture_id").cast("string")).alias("categories_json"))
    return tables.decode_categories(c).select("capture_id", "category", "group_id")


def _parts(t):
    return A.part_key(A.normalize_parts(t("parts")), True)


#: Normal forms of ASCII text, and a part's fingerprint, in SQL.
_NORMAL = r"""regexp_replace(regexp_replace(regexp_replace({}, '[ \t]+', ' ', 'g'), '\n{{2,}}', chr(10), 'g'), '^\s+|\s+$', '', 'g')"""
_TEXT = lambda c: f"nullif({_NORMAL.format(c)}, '')"
_JSON = lambda c: f"""coalesce('"' || {c} || '"', 'null')"""  # noqa: E731  # the test tables hold no quotes


def _fp(source, keys):
    """CTEs of normalised parts with part_fp."""
    fields = {c: _JSON(c) for c in ("description", "details", "oem", "period", "pnc", "quantity", "schema_id")}
    body = "'{' || " + " || ',' || ".join(f"""'"{c}":' || {x}""" for c, x in fields.items()) + " || '}'"
    return rf"""norm AS (SELECT {keys}, category, grp, {_NORMAL.format("schema_id")} AS schema_id, upper({_NORMAL.format("pnc")}) AS pnc, regexp_replace(upper({_NORMAL.format("oem")}), '\s+', '', 'g') AS oem, {_TEXT("description")} AS description, {_TEXT("details")} AS details, {_TEXT("period")} AS period,
        {_TEXT("quantity")} AS quantity, image_url FROM {source}), fp AS (SELECT *, CASE WHEN pnc IS NOT NULL THEN sha256('part:v1' || chr(0) || {body}) END AS part_fp FROM norm)"""


_PART = _fp("parts", "spec")
_MULTI = "'[' || coalesce(string_agg('[\"' || replace(v, chr(0), '\\u0000') || '\",' || CAST(n AS STRING) || ']', ',' ORDER BY v) FILTER (v IS NOT NULL), '') || ']'"


def _level(name, source, keys, child, domain, head, field):
    return f"""{name} AS (SELECT {keys}, sha256('{domain}' || chr(0) || '{{{head}"{field}":' || {_MULTI} || '}}') AS {name} FROM (SELECT {keys}, {child} AS v, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY {keys})"""


_GROUPS = _level("group_fp", "fp", "spec, category, grp", "part_fp", "group:v1", '"group_id":"\' || grp || \'",', "part_fingerprints_multiset")
_CATS = _level("category_fp", "group_fp", "spec, category", "group_fp", "category:v1", '"category_slug":"\' || category || \'",', "group_fingerprints_multiset")
_SPEC = _level("spec_parts_hash", "category_fp", "spec", "category_fp", "spec-parts:v1", "", "category_fingerprints_multiset")
_SCHEMAS = "sc AS (SELECT DISTINCT spec, category, grp, schema_id FROM fp)"
_SEM = _level("schema_semantic_hash", "sc", "spec", "schema_id", "schema-semantic:v1", "", "schema_ids_multiset")
_IMG = _level("image_hash", "fp", "spec", "nullif(image_url, '')", "image:v1", "", "images_multiset")


def _shape(name, rows):
    return f"{name} AS (SELECT spec, {_MULTI} AS {name} FROM ({rows}) GROUP BY spec)"


_STRUCT = ", ".join([
    _shape("ca", "SELECT DISTINCT spec, category AS v, 1 AS n FROM sc"), _shape("gr", "SELECT DISTINCT spec, category || chr(0) || grp AS v, 1 AS n FROM sc"), _shape("ss", "SELECT spec, grp || chr(0) || schema_id AS v, count(*) AS n FROM sc GROUP BY ALL"),
    """structure_hash AS (SELECT spec, sha256('structure:v1' || chr(0) || '{"categories":' || ca || ',"groups":' || gr || ',"schemas":' || ss || '}') AS structure_hash FROM ca JOIN gr USING (spec) JOIN ss USING (spec))""",
])
_ALL = f"{_GROUPS}, {_CATS}, {_SPEC}, {_SCHEMAS}, {_STRUCT}, {_SEM}, {_IMG}"


@query(f"WITH {_PART} SELECT spec, category, grp, part_fp, count(*) AS n FROM fp GROUP BY ALL")
def part_fp(t):
    return _parts(t).groupBy("spec", "category", "grp", "part_fp").agg(F.count("*").alias("n"))


@query(f"WITH {_PART}, {_GROUPS} SELECT spec, category, grp, group_fp FROM group_fp")
def group_fp(t):
    return P.group_fingerprints(_parts(t))


@query(f"WITH {_PART}, {_GROUPS}, {_CATS} SELECT spec, category, category_fp FROM category_fp")
def category_fp(t):
    return P.category_fingerprints(P.group_fingerprints(_parts(t)))


@query(f"WITH {_PART}, {_GROUPS}, {_CATS}, {_SPEC} SELECT spec, spec_parts_hash FROM spec_parts_hash")
def spec_parts_hash(t):
    return P.spec_parts_hash(P.category_fingerprints(P.group_fingerprints(_parts(t))))


@query(f"WITH {_PART}, {_SCHEMAS}, {_STRUCT} SELECT spec, structure_hash FROM structure_hash")
def structure_hash(t):
    return P.structure_hash(t("parts").select("spec", "category", "grp", "schema_id").distinct())


@query(f"WITH {_PART}, {_SCHEMAS}, {_SEM} SELECT spec, schema_semantic_hash FROM schema_semantic_hash")
def schema_semantic_hash(t):
    return P.schema_semantic_hash(t("parts").select("spec", "category", "grp", "schema_id").distinct())


@query(f"WITH {_PART}, {_IMG} SELECT spec, image_hash FROM image_hash")
def image_hash(t):
    return P.image_hash(t("parts").select("spec", "image_url"))


@query(f"WITH {_PART}, {_ALL} SELECT spec, spec_parts_hash, structure_hash, schema_semantic_hash, image_hash FROM spec_parts_hash JOIN structure_hash USING (spec) JOIN schema_semantic_hash USING (spec) JOIN image_hash USING (spec)")
def fingerprint_set(t):
    return P.fingerprint_set(_parts(t))


@query("SELECT spec, count(DISTINCT category) AS categories, count(DISTINCT category || '|' || grp) AS groups, count(DISTINCT category || '|' || grp || '|' || schema_id) AS schemas, count(*) AS parts FROM parts GROUP BY spec")
def tree_counts(t):
    return P.tree_counts(_parts(t))


def _after(t):
    """The parts as they are found again: a category gone, a group gone, quantities and images changed, a group added."""
    p = t("parts").filter("NOT (spec % 7 = 0 AND category LIKE '1%') AND NOT (spec % 11 = 3 AND grp = 'NO')")
    p = p.withColumn("quantity", F.when((F.col("spec") % 5 == 0) & (F.col("grp") == "AF"), F.concat("quantity", F.lit("0"))).otherwise(F.col("quantity"))).withColumn("image_url", F.when(F.col("spec") % 6 == 1, "new.png").otherwise(F.col("image_url")))
    more = p.filter("spec % 13 = 4 AND grp = 'RF'").withColumn("grp", F.lit("ZZ"))
    return A.part_key(A.normalize_parts(p.unionByName(more)), True)


_AFTER = """again AS (SELECT * REPLACE (CASE WHEN spec % 5 = 0 AND grp = 'AF' THEN quantity || '0' ELSE quantity END AS quantity, CASE WHEN spec % 6 = 1 THEN 'new.png' ELSE image_url END AS image_url) FROM parts WHERE NOT (spec % 7 = 0 AND category LIKE '1%') AND NOT (spec % 11 = 3 AND grp = 'NO')),
    again2 AS (SELECT * FROM again UNION ALL SELECT * REPLACE ('ZZ' AS grp) FROM again WHERE spec % 13 = 4 AND grp = 'RF')"""


def _both_sides():
    """The CTEs of a chain twice: over the parts before (b_) and after (a_)."""
    out = [_AFTER]
    for side, source in (("b", "parts"), ("a", "again2")):
        chain = _fp(source, "spec") + ", " + _ALL
        for n in ("norm", "fp", "group_fp", "category_fp", "spec_parts_hash", "sc", "ca", "gr", "ss", "structure_hash", "schema_semantic_hash", "image_hash"):
            chain = re.sub(rf"(?<![\w\".]){n} AS \(SELECT", f"{side}_{n} AS (SELECT", chain)
            chain = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {side}_{n}", chain)
        out.append(chain)
    return "WITH " + ", ".join(out) + " "


_FULL = "(SELECT coalesce(b.spec, a.spec) AS spec, b.{0} AS x, a.{0} AS y FROM b_{0} b FULL JOIN a_{0} a ON a.spec = b.spec)"


@query(_both_sides() + "SELECT coalesce(b.spec, a.spec) AS spec, coalesce(b.category, a.category) AS category, CASE WHEN b.category_fp IS NULL THEN 'ADDED' WHEN a.category_fp IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM b_category_fp b FULL JOIN a_category_fp a ON a.spec = b.spec AND a.category = b.category WHERE a.category_fp IS DISTINCT FROM b.category_fp")
def revalidation(t):
    return E.revalidate(P.category_fingerprints(P.group_fingerprints(_parts(t))), P.category_fingerprints(P.group_fingerprints(_after(t))))


@query(_both_sides() + "SELECT coalesce(b.spec, a.spec) AS spec, coalesce(b.category, a.category) AS category, coalesce(b.grp, a.grp) AS grp, CASE WHEN b.group_fp IS NULL THEN 'ADDED' WHEN a.group_fp IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM b_group_fp b FULL JOIN a_group_fp a ON a.spec = b.spec AND a.category = b.category AND a.grp = b.grp WHERE a.group_fp IS DISTINCT FROM b.group_fp")
def revalidation_groups(t):
    return E.revalidate_trees(_parts(t), _after(t))[1]


@query(_both_sides() + "SELECT spec, s.x IS DISTINCT FROM s.y AS structure_changed, p.x IS DISTINCT FROM p.y AS spec_parts_changed, m.x IS DISTINCT FROM m.y AS schema_semantic_changed, i.x IS DISTINCT FROM i.y AS image_changed, s.x IS DISTINCT FROM s.y OR p.x IS DISTINCT FROM p.y OR m.x IS DISTINCT FROM m.y AS is_stale FROM " + " JOIN ".join(_FULL.format(n) + f" {a}" + (" USING (spec)" if a != "s" else "") for n, a in (("structure_hash", "s"), ("spec_parts_hash", "p"), ("schema_semantic_hash", "m"), ("image_hash", "i"))))
def revalidation_flags(t):
    return E.revalidate_trees(_parts(t), _after(t))[0]


@query("""WITH g AS (SELECT run_id, spec_key, category || chr(0) || group_id || chr(0) || raw_capture_id AS v FROM accepted_captures) SELECT run_id, spec_key, sha256('snapshot-idempotency:v1' || chr(0) || '{"captures":[' || string_agg('["' || replace(v, chr(0), '\\u0000') || '",1]', ',' ORDER BY v) || '],"run_id":"' || run_id || '","spec_key":"' || CAST(spec_key AS STRING) || '"}') AS k FROM g GROUP BY run_id, spec_key""")
def idempotency_key(t):
    return I.idempotency_keys(t("accepted_captures"), "run_id", "spec_key", ["category", "group_id", "raw_capture_id"])


_LOW = "lower(html)"
_ANY = lambda markers: "(" + " OR ".join(f"contains({_LOW}, '{m}')" for m in markers) + ")"
_INCOMPLETE = f"((contains({_LOW}, '<html') AND NOT contains({_LOW}, '</html>')) OR (contains({_LOW}, '<body') AND NOT contains({_LOW}, '</body>')))"
#: What is left of a page without approved containers (which hold one level of div at most) must not name the widget.
_WIDGET = rf"""contains(regexp_replace({_LOW}, '<div[^>]*\bid\s*=\s*"\s*({"|".join(V.BENIGN_IDS)})\s*"[^>]*>([^<]|<div[^>]*>[^<]*</div>|</?[^d/][^>]*>|</[^d][^>]*>)*</div>', '', 'g'), 'g-recaptcha')"""
_CHALLENGE = f"({_ANY(V.ELEMENT_MARKERS + V.TEXT_MARKERS)} OR {_WIDGET} OR " + " OR ".join(f"contains(regexp_extract({_LOW}, '<title[^>]*>(.*?)</title>', 1), '{m}')" for m in V.TITLE_MARKERS) + ")"
_TRANSLATED = rf"""({_ANY(V.TRANSLATION_MARKERS)} OR regexp_matches({_LOW}, '<html[^>]*class="([^"]* )?({"|".join(V.TRANSLATED_CLASSES)})( [^"]*)?"') OR regexp_matches({_LOW}, '<meta name="google-translate-customization" content="[^"]+"'))"""
_SHAPELESS = "CASE capture_kind " + " ".join(f"""WHEN '{k}' THEN NOT regexp_matches(html, 'class="([^"]* )?({"|".join(names)})( [^"]*)?"')""" for k, names in V.STRUCTURE.items()) + " END"
_OUTCOME = f"CASE WHEN {_CHALLENGE} THEN 'CHALLENGE' WHEN {_TRANSLATED} THEN 'TRANSLATION_CONTAMINATED' WHEN {_SHAPELESS} IS NULL THEN 'UNDECIDABLE' WHEN {_SHAPELESS} THEN 'INVALID' WHEN {_INCOMPLETE} THEN 'INCOMPLETE' ELSE 'ACCEPTED' END"


@query(f"SELECT capture_id, {_INCOMPLETE} AS incomplete FROM marked")
def validate_incomplete(t):
    return t("marked").select("capture_id", V.incomplete(F.col("html")).alias("incomplete"))


@query(f"SELECT capture_id, {_CHALLENGE} AS challenge FROM marked")
def validate_challenge(t):
    return t("marked").select("capture_id", V.challenge(F.col("html")).alias("challenge"))


@query(f"SELECT capture_id, contains({_LOW}, 'g-recaptcha') AS named, {_WIDGET} AS unproven FROM marked")
def validate_widget(t):
    return t("marked").select("capture_id", F.contains(F.lower("html"), F.lit(V.WIDGET)).alias("named"), V.unproven(F.col("html")).alias("unproven"))


@query(f"SELECT capture_id, {_TRANSLATED} AS translated FROM marked")
def validate_translation(t):
    return t("marked").select("capture_id", V.translated(F.col("html")).alias("translated"))


@query(f"SELECT capture_id, {_OUTCOME} AS outcome FROM marked")
def validate_outcome(t):
    return t("marked").select("capture_id", V.outcome(F.col("html"), F.col("capture_kind")).alias("outcome"))


@query(f"SELECT capture_id, {_SHAPELESS} AS invalid FROM marked")
def html_structure(t):
    return t("marked").select("capture_id", V.without_structure(F.col("html"), F.col("capture_kind")).alias("invalid"))


@query(f"SELECT capture_id FROM marked WHERE {_CHALLENGE}")
def needs_person(t):
    return I.needs_person(I.process(t("marked"))).select("capture_id")


@query("""SELECT page_id, CASE WHEN len(p) >= 2 THEN p[-2] END AS category, CASE WHEN len(p) >= 2 THEN p[-1] END AS group_id
    FROM (SELECT page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '') AS p FROM pages)""")
def url_group_key(t):
    a, b = X.url_keys(F.col("url"))
    return t("pages").select("page_id", a.alias("category"), b.alias("group_id"))


@query("SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS start FROM orders")
def period_parse(t):
    d = t("orders").withColumn("raw", F.date_format("o_orderdate", "yyyy.MM"))
    return d.select("o_orderkey", X.month(F.col("raw")).cast("string").alias("start"))


@query("""SELECT p_partkey AS capture_id, 'S' || CAST(p_size AS STRING) AS schema_id, p_brand AS pnc, upper(p_type) AS oem, p_name AS description, CAST(p_size AS STRING) AS quantity FROM part""")
def html_parse_rows(t):
    body = '<div class="epcVariation__details"></div><div class="epcSchema__schemas"><div class="epcSchema__schema" data-id="S%s"><table class="entriesTable"><tr data-key="%s"><td class="entriesTable__number">%s</td><td class="entriesTable__description"> %s </td><td class="entriesTable__required">%s</td></tr></table></div></div>'
    size = F.col("p_size").cast("string")
    p = t("part").select(F.col("p_partkey").alias("capture_id"), F.format_string(body, size, "p_brand", F.upper("p_type"), "p_name", size).alias("html"))
    return pages.parse_pages(p, "GROUP_DETAIL").select("capture_id", "schema_id", "pnc", "oem", "description", "quantity")


@query("SELECT p_partkey AS capture_id, 'EU-WEST' AS market, p_brand AS model_code, CAST(p_partkey AS STRING) AS catalog_id, '20' || lpad(CAST(p_size % 24 AS STRING), 2, '0') || '-0' || CAST(1 + p_size % 9 AS STRING) || '-01' AS start FROM part")
def html_market_index(t):
    body = '<span class="breadcrumbs__last-item">eu west</span><div class="epcVariations"><table><tr class="epcVariations__row"><td><a href="/x/a-%s">%s</a></td><td>20%02d.0%d - ...</td><td><span class="info-hint-new">g</span></td></tr></table></div>'
    p = t("part").select(F.col("p_partkey").alias("capture_id"), F.format_string(body, F.col("p_partkey").cast("string"), "p_brand", F.col("p_size") % 24, 1 + F.col("p_size") % 9).alias("html"))
    return pages.parse_pages(p, "MARKET_INDEX").select("capture_id", "market", "model_code", "catalog_id", "start")


@query("SELECT s_suppkey AS capture_id, 'brakes' AS category, CAST(s_nationkey AS STRING) AS group_id, true AS manifest_complete FROM supplier")
def html_manifest(t):
    body = '<div class="epcVariation__details"></div><div class="epcVariation__schemaGroups"><a class="epcVariation__schemaGroup" data-id="1" href="/c/brakes">B</a></div><div class="epcVariation__schemas"><div class="epcVariation__schema" data-id="%s"><div class="epcVariation__schema-name"><a href="/c/brakes/%s">x</a></div></div></div>'
    n = F.col("s_nationkey").cast("string")
    p = t("supplier").select(F.col("s_suppkey").alias("capture_id"), F.format_string(body, n, n).alias("html"))
    return pages.parse_pages(p, "SPEC_NAVIGATION").select("capture_id", "category", "group_id", "manifest_complete")


@query(f"SELECT capture_kind, {_OUTCOME} AS outcome, count(*) AS captures, count(DISTINCT sha256(html)) AS blobs FROM marked GROUP BY ALL")
def process_captures(t):
    return I.process(t("marked")).groupBy("capture_kind", "outcome").agg(F.count("*").alias("captures"), F.count_distinct("content_hash").alias("blobs"))


@query(f"SELECT capture_id, i, CASE WHEN i = 0 THEN 'START' WHEN {_OUTCOME} = 'ACCEPTED' THEN 'ACCEPT' ELSE 'REJECT' END AS kind FROM marked, (VALUES (0), (1)) v(i) WHERE capture_kind = 'GROUP_DETAIL'")
def capture_checkpoint_events(t):
    c = t("marked").withColumns({"source_url": F.lit("u"), "collected_at": F.lit(0)})
    return I.checkpoint_events(I.process(c)).select("capture_id", "i", "kind")


@query("""WITH cur AS (SELECT * FROM manifests WHERE manifest_complete QUALIFY row_number() OVER (PARTITION BY spec_key ORDER BY discovered_at DESC, id DESC) = 1),
    e AS (SELECT cur.spec_key, cur.run_id, g.category, g.group_id, a.group_id IS NOT NULL OR g.group_id IS NULL AS ok FROM cur LEFT JOIN manifest_groups g ON g.id = cur.id
    LEFT JOIN accepted a ON a.spec_key = cur.spec_key AND a.run_id = cur.run_id AND a.category = g.category AND a.group_id = g.group_id)
    SELECT spec_key, run_id, count(DISTINCT category) AS categories, count(group_id) AS "groups", CASE WHEN spec_key % 9 = 0 THEN 'INVALID' ELSE 'VALID' END AS state FROM e GROUP BY spec_key, run_id HAVING bool_and(ok)""")
def finalize_specs(t):
    critical = t("manifests").filter("spec_key % 9 = 0").select("spec_key")
    return I.finalize(t("manifests"), t("manifest_groups"), t("accepted"), critical)


_SIGNED = "sha256(string_agg(l_returnflag || chr(0) || l_linestatus, ';' ORDER BY l_linenumber, l_returnflag || chr(0) || l_linestatus))"


@query(f"SELECT l_orderkey, {_SIGNED} AS signature FROM lineitem GROUP BY l_orderkey")
def part_signature(t):
    return I.signature(t("lineitem"), ["l_orderkey"], ["l_linenumber"], ["l_returnflag", "l_linestatus"])


@query(f"WITH a AS (SELECT l_orderkey, {_SIGNED} AS s FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey, {_SIGNED} AS s FROM lineitem WHERE l_partkey % 50 <> 3 GROUP BY 1) SELECT l_orderkey, a.s IS NOT DISTINCT FROM b.s AS same FROM a FULL JOIN b USING (l_orderkey)")
def same_parts(t):
    side = lambda d: I.signature(d, ["l_orderkey"], ["l_linenumber"], ["l_returnflag", "l_linestatus"])
    return I.same_signature(side(t("lineitem")), side(t("lineitem").filter("l_partkey % 50 <> 3")), ["l_orderkey"])


@query("SELECT spec, category, grp, count(image_url) AS with_a, count(CASE WHEN CAST(quantity AS INT) % 3 > 0 THEN image_url END) AS with_b FROM parts GROUP BY ALL HAVING with_a <> with_b")
def image_presence_diff(t):
    p = t("parts").select("spec", "category", "grp", F.col("image_url").alias("image"), "quantity")
    return I.image_presence(p, p.withColumn("image", F.when(F.col("quantity").cast("int") % 3 > 0, F.col("image"))), ["spec", "category", "grp"])


@query("SELECT page_id, regexp_matches(url, '^[a-z]+://[^/?#]+') AS absolute FROM pages")
def absolute_urls(t):
    return t("pages").select("page_id", X.is_absolute_url(F.col("url")).alias("absolute"))


@query("SELECT spec_key, 'https://catalogue.example/' || lower(manufacturer) || '/' || lower(vehicle_model) || '/' || lower(market) AS url FROM specs")
def index_urls(t):
    return t("specs").select("spec_key", I.index_url("https://catalogue.example", F.col("manufacturer"), F.col("vehicle_model"), F.col("market")).alias("url"))


@query("SELECT 'text' AS rule, count(*) FILTER (text IS NULL OR text = '') AS broken FROM specs UNION ALL SELECT 'length', count(*) FILTER (n_chars <= 100) FROM specs UNION ALL SELECT 'ended', count(*) FILTER (ended_at IS NULL) FROM specs")
def constraint_violations(t):
    return I.violations(t("specs"), {"text": F.col("text") != "", "length": F.col("n_chars") > 100, "ended": F.col("ended_at").isNotNull()})


@query("""SELECT p_partkey, '{"brand":"' || p_brand || '","note":null,"size":' || p_size || ',"type":"' || p_type || '"}' AS j FROM part""")
def canonical_json(t):
    return t("part").select("p_partkey", H.json_object(type=H.json_text(F.col("p_type")), brand=H.json_text(F.col("p_brand")), size=F.col("p_size").cast("string"), note=H.json_text(F.lit(None).cast("string"))).alias("j"))


@query("SELECT capture_id FROM captures WHERE capture_id * 3 NOT IN (SELECT doc_id FROM documents)")
def captures_outside_scope(t):
    c = t("captures").withColumn("spec", F.col("capture_id") * 3)
    return I.outside_scope(c, t("documents").select(F.col("doc_id").alias("spec")), ["spec"]).select("capture_id")
