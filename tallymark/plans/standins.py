"""Catalogue tables derived from the generic test tables, once as Spark DataFrames and once as SQL for the oracles.

specs: documents; snapshots: one to three for each labelled document; manifests and accepted groups: orders and their
lines; parts: lines of a customer's orders; captures: pages; run events: events.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Pieces of pages by number: markers of each kind, benign and not, approved containers, structures and broken ends (the markers are fixed values). Quotes are double ones only.
_HEADS = ["<title>parts</title>", "<title>Just a moment...</title>", "<title>Attention Required</title>", "<title>Checking your browser</title>", "<title>just a part</title><p>attention required</p>"]
_BODIES = [
    "", "", "", "", "", "", "", "", "",
    *(f"<div id=\"{m}\"></div>" for m in ("cf-challenge-running", "cf-wrapper", "cf-browser-verification", "challenge-running", "challenge-form", "h-captcha")),
    *(f"<p>{m.title()}</p>" for m in ("verify you are human", "checking if the site connection is secure", "enable javascript and cookies to continue", "ray id: 5")),
    "<div class=\"g-recaptcha\"></div>", "<div id=\"registration-form-container\"><div class=\"g-recaptcha\"></div></div>", "<DIV ID = \" restore-form-container \"><p class=\"G-Recaptcha\"></p></DIV>",
    "<div id=\"registration-form-container\"></div><div class=\"g-recaptcha\"></div>", "<div id=\"other\"><i class=\"g-recaptcha\"></i></div>", "<div id=\"restore-form-container\"><div>x</div><b class=\"g-recaptcha\"></b></div>",
    "<font _msttexthash=\"1\"></font>", "<div id=\"goog-trans-section\"></div>", "<b class=\"notranslate\"></b>", "<meta name=\"google-translate-customization\" content=\"x\">", "<meta name=\"google-translate-customization\" content=\"\">",
]
_SHAPES = ["epcVariation__details", "a epcSchema__schemas", "entriesTable b", "epcVariations", "epcVariation__schemaGroups", "epcVariation__schemas", "epcVariations_", "none"]


def _nth(number: str, pieces: list[str]) -> str:
    return f"CASE {number} % {len(pieces)} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(pieces)) + " END"


TEXTS = {
    "marked": f"""SELECT page_id AS capture_id, CASE page_id % 4 WHEN 0 THEN 'GROUP_DETAIL' WHEN 1 THEN 'MARKET_INDEX' WHEN 2 THEN 'SPEC_NAVIGATION' ELSE CASE WHEN page_id % 20 = 3 THEN 'PRICE_LIST' ELSE 'GROUP_DETAIL' END END AS capture_kind,
        CASE WHEN page_id % 23 = 5 THEN '<html class="x translated-ltr">' WHEN page_id % 23 = 6 THEN '<HTML CLASS="Translated-RTL">' ELSE '<html class="page">' END || CASE WHEN page_id % 3 = 0 THEN {_nth("page_id", _HEADS)} ELSE '' END || '<body>' || CASE WHEN page_id % 2 = 0 THEN {_nth("(page_id // 2)", _BODIES)} ELSE '' END
        || '<div class="' || {_nth("(page_id // 4)", _SHAPES)} || '">' || url || '</div>' || CASE WHEN page_id % 11 = 7 THEN '' ELSE '</body>' END || CASE WHEN page_id % 13 = 2 THEN '' ELSE '</HTML>' END AS html FROM pages""",
    "specs": """SELECT doc_id AS spec_key, lang AS manufacturer, source AS vehicle_model, 'm' || CAST(doc_id % 7 AS STRING) AS market, 'C' || CAST(doc_id % 97 AS STRING) AS model_code,
        CAST(doc_id AS STRING) AS catalog_id, lang || ':' || source AS scope, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 1700000000 + doc_id END AS ended_at, text, n_chars FROM documents""",
    "snapshots": """SELECT 's' || CAST(doc_id AS STRING) || '-' || CAST(n AS STRING) AS snapshot_id, doc_id AS spec_key, lang || ':' || source AS scope, 'n1' AS normalizer_version,
        CASE WHEN doc_id % 13 = 0 THEN 'f2' ELSE 'f1' END AS fingerprint_version, 1704067200 + ((doc_id * 7 + n * 13) % 50) * 86400 AS collected_at, quality = 1 AS collection_complete,
        CASE WHEN (quality + n) % 3 = 1 THEN CASE WHEN toxic = 1 THEN 'STALE' ELSE 'VALID' END WHEN toxic = 1 THEN 'INVALID' WHEN n = 2 THEN 'VALID' ELSE 'INCOMPLETE' END AS state,
        CASE WHEN doc_id % 11 = 0 THEN NULL ELSE md5(source || CAST(n_chars % 3 AS STRING)) END AS structure_hash, md5(text) AS spec_parts_hash, md5(lang) AS schema_semantic_hash,
        CASE WHEN doc_id % 5 < 2 THEN 'EMPTY' ELSE md5(substr(text, 1, 20)) END AS image_hash, n_chars % 5 AS categories, n_chars % 17 AS `groups`, n_chars % 29 AS `schemas`, n_chars % 7 AS parts,
        CASE WHEN doc_id % 5 < 2 THEN 0 ELSE doc_id % 4 END AS images
        FROM (SELECT d.doc_id, d.lang, d.source, d.text, d.n_chars, l.quality, l.toxic, SEQ[0, d.doc_id % 3] AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
    "manifests": """SELECT o_orderkey AS id, o_custkey AS spec_key, 'r' || CAST(o_orderkey % 4 AS STRING) AS run_id, CAST(EPOCH[o_orderdate] AS BIGINT) AS discovered_at, o_orderstatus <> 'P' AS manifest_complete FROM orders""",
    "manifest_groups": """SELECT DISTINCT l_orderkey AS id, l_returnflag AS category, CAST(l_linenumber AS STRING) AS group_id FROM lineitem""",
    "accepted": """SELECT DISTINCT o_custkey AS spec_key, 'r' || CAST(o_orderkey % 4 AS STRING) AS run_id, l_returnflag AS category, CAST(l_linenumber AS STRING) AS group_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'""",
    "accepted_captures": """SELECT o_custkey AS spec_key, 'r' || CAST(o_orderkey % 4 AS STRING) AS run_id, l_returnflag AS category, CAST(l_linenumber AS STRING) AS group_id, 'c' || CAST(min(l_orderkey) AS STRING) AS raw_capture_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' GROUP BY 1, 2, 3, 4""",
    "group_parts": """SELECT o_custkey AS spec_key, 'r' || CAST(o_orderkey % 4 AS STRING) AS run_id, l_returnflag AS category, CAST(l_linenumber AS STRING) AS group_id, p_type AS schema_id, p_brand AS pnc, p_name AS oem, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'd' || CAST(p_size % 10 AS STRING) END AS description,
        CAST(CAST(l_quantity AS INT) AS STRING) AS quantity, p_brand || '.png' AS image_url, l_orderkey AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F' AND l_linenumber < 6""",
    "runs": """SELECT 'r' || CAST(o_orderkey AS STRING) AS run_id, 'scope' || CAST(o_custkey % 60 AS STRING) AS scope, CAST(EPOCH[o_orderdate] AS BIGINT) AS started_at, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 9 = 0 THEN NULL ELSE CAST(EPOCH[o_orderdate] AS BIGINT) + o_orderkey % 977 END AS completed_at FROM orders""",
    "parts": """SELECT o_custkey AS spec, o_orderpriority AS category, l_returnflag || l_linestatus AS grp, p_type AS schema_id, p_brand AS pnc, lower(p_brand) || '  x' AS oem, CASE WHEN p_size % 5 = 0 THEN '  ' ELSE ' ' || p_name || '  ok ' END AS description,
        CASE WHEN p_size % 2 = 0 THEN 'd ' || CAST(p_size % 10 AS STRING) END AS details, CASE WHEN p_size % 7 = 0 THEN '' ELSE '20' || CAST(10 + p_size % 15 AS STRING) || '.0' || CAST(1 + p_size % 9 AS STRING) || ' - ...' END AS period, CAST(CAST(l_quantity AS INT) AS STRING) AS quantity,
        CASE WHEN p_size % 4 = 0 THEN p_brand || '.png' END AS image_url FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "captures": """SELECT page_id AS capture_id, url AS source_url, html, 1704067200 + page_id % 37 AS collected_at, CASE page_id % 3 WHEN 0 THEN 'GROUP_DETAIL' WHEN 1 THEN 'MARKET_INDEX' ELSE 'SPEC_NAVIGATION' END AS capture_kind FROM pages""",
    "run_events": """SELECT user_id, CAST(EPOCH[ts] AS BIGINT) AS t_s, event_id AS seq, event_type,
        CASE event_type WHEN 'purchase' THEN 'ACCEPT' WHEN 'click' THEN 'REJECT' WHEN 'error' THEN 'CHALLENGE' ELSE 'START' END AS kind FROM events""",
}

_TABLES = re.compile(r"\b(?:FROM|JOIN) (documents|labels|orders|lineitem|part|pages|events)\b")


def spark_text(text: str) -> str:
    text = re.sub(r"SEQ\[(.*?), (.*?)\]", r"explode(sequence(\1, \2))", text)
    text = re.sub(r"\((\w+) // (\d+)\)", r"(\1 div \2)", text)
    return re.sub(r"EPOCH\[(.*?)\]", r"unix_seconds(CAST(\1 AS TIMESTAMP))", text)


def duck_text(text: str) -> str:
    text = re.sub(r"SEQ\[(.*?), (.*?)\]", r"unnest(range(\1, (\2) + 1))", text).replace("`", '"')
    return re.sub(r"EPOCH\[(.*?)\]", r"floor(epoch(\1))", text)


def stand_in(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = spark_text(TEXTS[name])
    used = set(_TABLES.findall(text))
    text = _TABLES.sub(lambda m: m[0].replace(m[1], "{" + m[1] + "}"), text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def with_tables(sql: str) -> str:
    """SQL with the stand-ins it names put before it as common table expressions."""
    used = [n for n in TEXTS if re.search(rf"\b{n}\b", sql)]
    head = ", ".join(f"{n} AS ({duck_text(TEXTS[n])})" for n in used)
    if not used:
        return sql
    return f"WITH {head}{', ' + sql.lstrip()[5:] if sql.lstrip().upper().startswith('WITH ') else ' ' + sql}"


class Registry:
    """Queries with their oracle SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None, name: str | None = None):
        def add(f):
            key = name or f.__name__
            self.queries[key] = lambda spark, sf_dir: f(lambda t: stand_in(spark, sf_dir, t) if t in TEXTS else spark.read.parquet(f"{sf_dir}/{t}.parquet"))
            if sql:
                self.oracles[key] = with_tables(sql)
            return f

        return add
