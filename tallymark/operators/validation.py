"""Classification of page captures. Everything but the proof of benign widgets is native."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: Markers (fixed values).
TITLE_MARKERS = ("just a moment", "attention required", "checking your browser")
ELEMENT_MARKERS = ("cf-challenge-running", "cf-wrapper", "cf-browser-verification", "challenge-running", "challenge-form", "h-captcha")
TEXT_MARKERS = ("verify you are human", "checking if the site connection is secure", "enable javascript and cookies to continue", "ray id:")
WIDGET = "g-recaptcha"
BENIGN_IDS = ("registration-form-container", "restore-form-container")
TRANSLATION_MARKERS = ("_msttexthash", "goog-trans-section", "notranslate")
TRANSLATED_CLASSES = ("translated-ltr", "translated-rtl")
STRUCTURE = {
    "GROUP_DETAIL": ("epcVariation__details", "epcSchema__schemas", "entriesTable"),
    "MARKET_INDEX": ("epcVariations",),
    "SPEC_NAVIGATION": ("epcVariation__details", "epcVariation__schemaGroups", "epcVariation__schemas"),
}
_DIV = re.compile(r"<(/?)div\b[^>]*>?")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
#: The outcome of a capture whose kind has no structural contract, where neither challenge nor translation decides.
UNDECIDABLE = "UNDECIDABLE"


def any_of(text: Column, markers: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(text, F.lit(m))
    return out


def benign_spans(low: str) -> list[tuple[int, int]]:
    """The div elements with an approved id, by counting opening and closing tags in the raw text: one pass with a stack."""
    spans, open_at = [], []
    for m in _DIV.finditer(low):
        if m[1]:
            if open_at:
                begin, approved = open_at.pop()
                if approved:
                    spans.append((begin, m.end()))
        else:
            ids = [(x or y).strip() for name, x, y in _ATTRIBUTE.findall(m[0]) if name == "id"]
            open_at.append((m.start(), any(i in BENIGN_IDS for i in ids)))
    return spans + [(begin, len(low)) for begin, approved in open_at if approved]


def unproven_widget(html: str | None) -> bool:
    """Whether a widget stands outside all benign spans: what can't be proven benign counts. Elements of that class add to it, and never take away."""
    low = html.lower() if html else ""
    if WIDGET not in low:
        return False
    spans = benign_spans(low)
    return any(not any(a <= m.start() < b for a, b in spans) for m in re.finditer(WIDGET, low)) or unproven_element(html)


def unproven_element(html: str) -> bool:
    """Whether the parsed page holds an element of the widget's class outside all approved elements, whatever the raw text's tags say."""
    from .pages import tree

    def benign(e) -> bool:
        while e is not None:
            if e.attrs.get("id") in BENIGN_IDS:
                return True
            e = e.parent
        return False

    return any(WIDGET in e.classes and not benign(e.parent) for e in tree(html).walk())


@F.pandas_udf(BooleanType())
def _unproven(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(unproven_widget).astype(bool)


def unproven(html: Column) -> Column:
    """The Python rule sees only pages that hold the widget's name: others are sent as null."""
    return F.coalesce(_unproven(F.when(F.contains(F.lower(html), F.lit(WIDGET)), html)), F.lit(False))


def title(low: Column) -> Column:
    return F.regexp_extract(low, r"(?s)<title[^>]*>(.*?)</title>", 1)


def challenge(html: Column) -> Column:
    low = F.lower(html)
    return any_of(title(low), TITLE_MARKERS) | any_of(low, ELEMENT_MARKERS + TEXT_MARKERS) | unproven(html)


def translated(html: Column) -> Column:
    low = F.lower(html)
    classes = low.rlike(r"<html\b[^>]*\bclass\s*=\s*[\"'][^\"']*\b(" + "|".join(TRANSLATED_CLASSES) + r")\b")
    return classes | any_of(low, TRANSLATION_MARKERS) | low.rlike(r"<meta\b[^>]*name\s*=\s*[\"']google-translate-customization[\"'][^>]*content\s*=\s*[\"'][^\"']+")


def incomplete(html: Column) -> Column:
    low = F.lower(html)
    has = lambda s: F.contains(low, F.lit(s))
    return (has("<html") & ~has("</html>")) | (has("<body") & ~has("</body>"))


def without_structure(html: Column, kind: Column) -> Column:
    """True iff none of the kind's class names stands in a class attribute; null for an unknown kind."""
    out = F.lit(None).cast("boolean")
    for k, names in STRUCTURE.items():
        found = F.lit(False)
        for n in names:
            found = found | html.rlike(rf"class\s*=\s*(\"([^\"]*\s)?{n}(\s[^\"]*)?\"|'([^']*\s)?{n}(\s[^']*)?')")
        out = F.when(kind == k, ~found).otherwise(out)
    return out


def precedence(is_challenge: Column, is_translated: Column, is_invalid: Column, is_incomplete: Column) -> Column:
    """A null structure (no contract for the kind) decides nothing: the outcome is UNDECIDABLE, where a driver program would raise."""
    return F.when(is_challenge, "CHALLENGE").when(is_translated, "TRANSLATION_CONTAMINATED").when(is_invalid.isNull(), UNDECIDABLE).when(is_invalid, "INVALID").when(is_incomplete, "INCOMPLETE").otherwise("ACCEPTED")


def outcome(html: Column, kind: Column) -> Column:
    return precedence(challenge(html), translated(html), without_structure(html, kind), incomplete(html))
