"""Text normalisation as Column functions. Only NFKC needs Python, and only for non-ASCII values."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space at the ends, as Python's str.strip sees it.
_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: Spaces other than U+0020 that count as one (fixed values).
TECHNICAL_SPACES = "".join(map(chr, (0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
SCOPE_PART = r"^[A-Z0-9]+(-[A-Z0-9]+)*$"


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore") if values.notna().any() else values


def nfkc(c: Column) -> Column:
    """ASCII values, which are as long in bytes as in characters, stay in the JVM; Python gets a null for them."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, c).otherwise(_nfkc(F.when(~plain, c)))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE, "")


def normalize_text(c: Column) -> Column:
    c = F.regexp_replace(nfkc(c), "\r\n?", "\n")
    c = F.translate(c, TECHNICAL_SPACES, " " * len(TECHNICAL_SPACES))
    return strip(F.regexp_replace(F.regexp_replace(c, "[ \t]+", " "), "\n{2,}", "\n"))


def normalize_pnc(c: Column) -> Column:
    return F.upper(normalize_text(c))


def normalize_oem(c: Column) -> Column:
    return F.regexp_replace(F.upper(normalize_text(c)), r"(?U)\s+", "")


def normalize_codes(codes: Column) -> Column:
    """Each code trimmed and upper-cased, sorted, repeats kept (codes are ASCII: no NFKC)."""
    return F.array_sort(F.transform(codes, lambda x: F.upper(strip(x))))


def optional(c: Column) -> Column:
    """Normalised text, the empty one as null."""
    return F.nullif(normalize_text(c), F.lit(""))


def scope_part(c: Column) -> Column:
    """A scope component, or null if it is not ASCII or breaks the alphabet."""
    clean = F.upper(strip(c))
    return F.when(strip(c).rlike(r"^[\x00-\x7F]*$") & clean.rlike(SCOPE_PART), clean)


def build_scope(*parts: Column) -> Column:
    clean = [scope_part(p) for p in parts]
    whole = clean[0].isNotNull()
    for p in clean[1:]:
        whole = whole & p.isNotNull()
    return F.when(whole, F.concat_ws(":", *clean))


def parse_scope(scope: Column, i: int) -> Column:
    """Component i (from 0) of a scope of four; null if it isn't one."""
    parts = F.split(scope, ":")
    return F.when(F.size(parts) == 4, F.element_at(parts, i + 1))


def equivalence_scope(*parts: Column) -> Column:
    return F.concat_ws(":", *(F.upper(strip(p)) for p in parts))


def display_key(*parts: Column) -> Column:
    escaped = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for p in parts]
    return F.concat_ws(":", *escaped)


def month(c: Column) -> Column:
    """YYYY.MM as the first day of that month; null if it is no month."""
    return F.when(c.rlike(r"^\d{4}\.\d{2}$"), F.try_to_date(F.concat(c, F.lit(".01")), "yyyy.MM.dd"))


def url_keys(url: Column) -> tuple[Column, Column]:
    """The last two non-empty segments of the path (null if there are fewer)."""
    parts = F.filter(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), lambda x: x != "")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)), F.when(F.size(parts) >= 2, F.element_at(parts, -1))


def is_absolute_url(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("PROTOCOL")).isNotNull() & F.try_parse_url(url, F.lit("HOST")).isNotNull()
