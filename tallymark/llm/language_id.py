"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of 1 to ``orders`` code points (A-Z lower-cased), hashed into
``1 << bits`` buckets, of a bounded sample of labelled rows: of each language all rows if it
has at most ``per_lang``, else those whose key hash falls under per_lang / rows of the
language (so about per_lang). Of a column with very many labels the ``max_langs`` most frequent ones are learned (ties: those that
sort first), which bounds the log-probability matrix (buckets x languages) that is broadcast. Scoring reads whole
texts: each n-gram gathers a row of the matrix, and rows are summed for each document.

Defined cases: a text that is null or holds no letter is ``und`` with score 0; so is every
text if there is no labelled row. Equal scores go to the language that sorts first. Repeated
rows are scored (and counted) each on their own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A

UNKNOWN = "und"
#: Labels that a model learns at most: 64 MiB of log probabilities.
MAX_LANGS = 256


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    prior: np.ndarray
    table: np.ndarray  # languages x (buckets + 1); the last bucket is that of n-grams that would cross documents: 0
    orders: int
    bits: int


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of a block and the documents' offsets in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).copy()
    upper = (points >= 65) & (points <= 90)
    points[upper] += 32
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    return points, np.minimum(begins[at], len(points))


def buckets(points: np.ndarray, offsets: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each code point; 1 << bits where it would leave the document."""
    n = len(points)
    out = np.full(n, 1 << bits, np.int32)
    if n < order:
        return out
    m = n - order + 1
    h = points[:m].astype(np.uint64)
    for k in range(1, order):
        h = h * np.uint64(0x100000001B3) + points[k : k + m]
    h += np.uint64(order << 40)
    out[:m] = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int32)
    for k in range(1, order):
        ends = offsets[1:] - k
        out[ends[ends >= offsets[:-1]]] = 1 << bits
    return out


def train(labelled: DataFrame, per_lang: int = 5000, orders: int = 3, bits: int = 16, alpha: float = 0.5, max_langs: int = MAX_LANGS) -> Model:
    """labelled: doc_id, text, lang (not null)."""
    rows = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    langs = tuple(sorted(rows))
    if not langs:
        return Model((), np.zeros(0), np.zeros((0, (1 << bits) + 1), np.float32), orders, bits)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, per_lang / rows[lang]))])
    fate = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(fate < share[F.col("lang")]).select("lang", "text")
    index = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = (1 << bits) + 1
        total = np.zeros(len(langs) * width, np.int64)
        for batch in batches:
            which = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
            for i, j, data, at in A.blocks(batch.column("text")):
                points, offsets = code_points(data, at)
                base = np.repeat(which[i:j] * width, np.diff(offsets))
                for order in range(1, orders + 1):
                    total += np.bincount(base + buckets(points, offsets, order, bits), minlength=len(total))
        for lang in range(len(langs)):
            own = total[lang * width : (lang + 1) * width - 1]
            some = np.flatnonzero(own)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), lang, np.int32)), pa.array(some.astype(np.int32)), pa.array(own[some])], names=["lang", "bucket", "n"])

    found = sample.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(langs), 1 << bits))
    counts[found["lang"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    table = np.zeros((len(langs), (1 << bits) + 1), np.float32)
    table[:, :-1] = np.log(counts + alpha) - np.log(counts.sum(1, keepdims=True) + alpha * (1 << bits))
    n = np.array([rows[x] for x in langs], float)
    return Model(langs, np.log(n / n.sum()), table, orders, bits)


def scores(model: Model, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-joint probabilities (documents x languages), and which documents hold a letter."""
    points, offsets = code_points(data, at)
    docs = len(at) - 1
    out = np.tile(model.prior, (docs, 1))
    full = np.flatnonzero(offsets[:-1] < offsets[1:])
    if len(full):
        for order in range(1, model.orders + 1):
            b = buckets(points, offsets, order, model.bits)
            for k in range(len(model.langs)):
                out[full, k] += np.add.reduceat(model.table[k][b], offsets[:-1][full], dtype=np.float64)
    letters = np.zeros(len(points) + 1, np.int64)
    np.cumsum((points >= 97) & (points <= 122), out=letters[1:])
    letter = letters[offsets[1:]] > letters[offsets[:-1]]
    raw = None
    for d in full[~letter[full]]:
        raw = raw if raw is not None else data.tobytes()
        letter[d] = any(c.isalpha() for c in raw[at[d] : at[d + 1]].decode("utf-8", "replace"))
    return out, letter


def predict(documents: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of ``keep``, then (as ``names``) the predicted language and its posterior."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, score = [], []
            for i, j, data, at in A.blocks(batch.column("_text")):
                if not m.langs:
                    langs += [UNKNOWN] * (j - i)
                    score.append(np.zeros(j - i))
                    continue
                joint, letter = scores(m, data, at)
                best = joint.argmax(1)
                top = 1 / np.exp(joint - joint.max(1, keepdims=True)).sum(1)
                langs += [m.langs[b] if ok else UNKNOWN for b, ok in zip(best, letter, strict=True)]
                score.append(np.where(letter, np.clip(top, 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(langs, pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))], names=[*keep, *names])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    chosen = documents.select(*keep, F.col("text").alias("_text"))
    schema = StructType([chosen.schema[c] for c in keep] + [StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return chosen.mapInArrow(label, schema)


def fold(column: str, folds: int) -> Column:
    """crc32 of the key as text, modulo folds (a null key: 0)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0).cast("long"))


def identify(documents: DataFrame, held_out: Column | None = None, keep: list[str] | None = None, per_lang: int = 5000) -> DataFrame:
    """Trains on the labelled documents that are not held out, and labels all documents."""
    labelled = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if held_out is not None:
        labelled = labelled.filter(~held_out)
    return predict(documents, train(labelled.select("doc_id", "text", "lang"), per_lang), keep or ["doc_id"])
