"""Canonical JSON and domain-separated hashes, built from Columns."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What a missing hash is called outside; inside it is null, and null equals nothing.
UNAVAILABLE = "UNAVAILABLE-NULL-FINGERPRINT"


@F.pandas_udf(StringType())
def _dumped(values: pd.Series) -> pd.Series:
    return values.map(json.dumps, na_action="ignore") if values.notna().any() else values


def _quoted(c: Column) -> Column:
    """Values without anything to escape stay in the JVM; Python gets a null for them."""
    plain = c.rlike(r"\A[ !#-\[\]-~]*+\z")
    return F.when(plain, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(_dumped(F.when(~plain, c)))


def json_text(c: Column, ascii_only: bool = False) -> Column:
    """A JSON string, non-ASCII escaped; null stays the word null. ascii_only: the caller knows there is nothing to escape but quotes and backslashes."""
    plain = F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.coalesce(plain if ascii_only else _quoted(c), F.lit("null"))


def json_object(**fields: Column) -> Column:
    """Keys sorted, compact, nulls kept; the values are JSON already."""
    pieces: list[Column] = []
    for i, key in enumerate(sorted(fields)):
        pieces += [F.lit(("," if i else "{") + f'"{key}":'), fields[key]]
    return F.concat(*pieces, F.lit("}"))


def json_multiset(pairs: Column) -> Column:
    """array<struct<value,n>> -> [["value",n],...], sorted by value. Values are hex or ASCII keys, in which a NUL may stand between parts."""
    each = F.transform(F.array_sort(pairs), lambda x: F.concat(F.lit("["), F.replace(json_text(x["value"], True), F.lit("\0"), F.lit("\\u0000")), F.lit(","), x["n"].cast("string"), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))


def joined(*parts: Column) -> Column:
    """Parts of a key joined by NUL, which no part holds; a missing part is the word null between its NULs, as nothing may be skipped."""
    return F.concat(*[x for i, p in enumerate(parts) for x in ((F.lit("\0"), F.coalesce(p.cast("string"), F.lit("null"))) if i else (F.coalesce(p.cast("string"), F.lit("null")),))])


def domain_hash(domain: str, text: Column) -> Column:
    return F.sha2(F.concat(F.lit(domain + "\0"), text).cast("binary"), 256)


def content_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def cluster_key(*parts: Column) -> Column:
    """Plain join by NUL; null as soon as a part is null."""
    return F.sha2(F.concat(*[x for i, p in enumerate(parts) for x in ((F.lit("\0"), p) if i else (p,))]).cast("binary"), 256)


def compare_hashes(a: Column, b: Column, valid: Column) -> Column:
    return F.when(~valid | a.isNull() | b.isNull(), "UNAVAILABLE").when(a == b, "EQUAL").otherwise("DIFFERENT")
