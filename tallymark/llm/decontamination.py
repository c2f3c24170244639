"""Benchmark decontamination in DataFrame functions only.

The benchmark's windows (``length`` consecutive words; a shorter item is one window) are a small
table, broadcast if a count of its words proves it small, else joined by shuffle. Documents are not
joined window by window: a document is cut into consecutive blocks of s words, and any window of
2s-1 or 2s words that occurs in it covers one block and lies within its two neighbours. So only blocks (an s-th of the words) are looked
up among the windows' own s-grams, each with its neighbours and never with its whole text; around the few that hit, the windows are built, and verified by a
join on their whole text. One pass over the documents is made for each s in use (one, if every item has
2s-1 words or more).

Defined cases: null and empty texts and items have no words; repeated items count once for each
item_id (a null item_id names no item); repeated documents are found each; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables as T

_ASCII = [chr(c) for c in range(128)]
_FROM = "".join(c for c in _ASCII if not (c.isdigit() or c.islower() or c == " "))
_TO = "".join(c.lower() if c.isupper() else " " for c in _FROM)
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # words as they are before A-Z is lower-cased
#: Largest benchmark, in words, whose windows are broadcast: about 100 bytes a window.
BROADCAST_WORDS = 500_000
#: Most keys of hit documents that are broadcast.
BROADCAST_KEYS = 1_000_000


def normalised(text: Column) -> Column:
    """A-Z lower-cased, words joined by one space."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _FROM, _TO), " {2,}", " "))


def words_in(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1).cast("long")


def windows(benchmark: DataFrame, length: int) -> DataFrame:
    """window, m (its words), items (array of ids, as strings)."""
    items = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), F.split(normalised(F.col("text")), " ").alias("w")).filter("w[0] <> ''")
    m = F.least(F.size("w"), F.lit(length))
    each = items.select("item", m.alias("m"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))).alias("window"))
    return each.groupBy("window", "m").agg(F.collect_set("item").alias("items"))


def _grams(found: DataFrame, s: int) -> DataFrame:
    """All runs of s words of the windows, as the blocks of documents are written."""
    w = F.split("window", " ")
    return found.select(F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - s + 1), lambda i: F.concat(F.array_join(F.slice(w, i, s), " "), F.lit(" ")))).alias("block")).distinct()


def _around(m: int, s: int) -> Column:
    """The runs of m words that cover the block of s words; ``w``: its words and its neighbours', ``ahead``: how many of them stand before it, ``at``: its first word's place."""
    return F.transform(
        F.sequence(F.greatest(F.lit(0), F.col("ahead") - (m - s)), F.col("ahead")),
        lambda i: F.struct((F.col("at") - F.col("ahead") + i).alias("first"), F.array_join(F.slice(F.col("w"), i + 1, m), " ").alias("window")),
    )


def occurrences(documents: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """documents with rk -> rk, first (word of the occurrence, from 0), m, items: each place where a window occurs."""
    found = T.checkpoint(windows(benchmark, length))
    lengths = [r.m for r in found.select("m").distinct().collect()]
    n_words = found.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    near = F.broadcast if n_words <= BROADCAST_WORDS * length else (lambda df: df)
    docs = documents.select("rk", normalised(F.col("text")).alias("norm"))
    out = []
    for s in sorted({(m + 1) // 2 for m in lengths}):
        own = [m for m in lengths if (m + 1) // 2 == s]
        grams = _grams(found.filter(F.col("m").isin(own)), s)
        cut = docs.select("rk", F.regexp_extract_all(F.concat("norm", F.lit(" ")), F.lit(f"(?:[^ ]++ ){{1,{s}}}"), F.lit(0)).alias("blocks"))
        none = F.array(F.lit(""))
        three = F.arrays_zip(F.col("blocks").alias("block"), F.concat(none, "blocks").alias("before"), F.concat(F.slice("blocks", 2, F.greatest(F.size("blocks"), F.lit(1))), none).alias("after"))
        block = cut.select("rk", F.posexplode(three).alias("b", "x")).select("rk", "b", "x.block", "x.before", "x.after").filter("block IS NOT NULL")
        hit = block.join(near(grams), "block", "left_semi").select("rk", (F.col("b") * s).alias("at"), F.when(F.col("before") == "", 0).otherwise(s).alias("ahead"), F.split(F.rtrim(F.concat("before", "block", "after")), " ").alias("w"))
        out.append(hit.select("rk", F.explode(F.concat(*(_around(m, s) for m in own))).alias("x")).select("rk", "x.first", "x.window"))
    if not out:
        return docs.select("rk").filter("false").select("rk", F.lit(0).alias("first"), F.lit(0).alias("m"), F.array(F.lit("")).alias("items"))
    return T.union(out).join(near(found), "window").select("rk", "first", "m", "items")


def contamination(documents: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """rk, n_hit, items (sorted), spans (first, end of each occurrence): one row for each document that is hit."""
    of = occurrences(documents, benchmark, length).groupBy("rk").agg(
        F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("m")).alias("end")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    swept = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(acc["to"], x["first"].cast("long")))).cast("long").alias("n"), F.greatest(acc["to"], x["end"].cast("long")).alias("to")),
        lambda acc: acc["n"],
    )
    return of.select("rk", swept.alias("n_hit"), "items", "spans")


def report(documents: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans for every document."""
    keyed = documents.withColumn("rk", T.row_key(["doc_id", "text"]))
    counted = keyed.select("rk", "doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    hits = contamination(keyed, benchmark, length)
    return counted.join(hits, "rk", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans"
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, length: int = 10, remove: str = "documents") -> DataFrame:
    """Documents without those that hold a window, or (remove="spans") all, without the words inside occurrences.

    Where spans are cut, the rest of that document is its normalised words; other documents are unchanged."""
    hits = contamination(documents.select(T.row_key(["doc_id", "text"]).alias("rk"), "text"), benchmark, length).withColumnRenamed("rk", T.KEY)
    keyed = documents.withColumn(T.KEY, T.row_key(["doc_id", "text"]))
    if remove == "documents":
        found = T.checkpoint(hits.select(T.KEY))
        # a key is 8 bytes: the corpus is shuffled only if very many documents are hit
        return keyed.join(F.broadcast(found) if found.count() <= BROADCAST_KEYS else found, T.KEY, "left_anti").drop(T.KEY)
    joined = keyed.join(hits.select(T.KEY, F.col("spans").alias("_spans")), T.KEY, "left")
    rest = F.array_join(F.filter(F.split(normalised(F.col("text")), " "), lambda w, i: ~F.exists("_spans", lambda s: (s["first"] <= i) & (i < s["end"]))), " ")
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(rest)).select(*documents.columns)
