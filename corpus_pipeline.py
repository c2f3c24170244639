"""A corpus pipeline of five stages over the table documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents (the last one: and its own);
it is written as Parquet and read again as the next stage's docs.

language_id        documents whose text holds no letter, or whose language is a guess (posterior under 1/2), go
minhash_dedup      of each group of near-duplicates (5-word shingles, similarity of 0.8 or more) the first stays
substring_dedup    words in windows of 35 that occur elsewhere go, with documents that lose all their words
decontamination    documents that hold a benchmark window of 10 words go
source_mixing      one row for each pass over a document, by training position
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontamination, language_id, minhash_dedup, mixing, substring_dedup, tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    found = language_id.predict(docs, language_id.train(labelled), keep=docs.columns, names=("_lang_pred", "_score"))
    return found.filter((F.col("_lang_pred") != language_id.UNKNOWN) & (F.col("_score") >= 0.5)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs, k=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(docs, length=35)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, tables.read(spark, sf_dir, "benchmark"), length=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{tables.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = tables.read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
        if i:  # what the stage has read is not needed any more
            tables.delete(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
        tables.release(spark)
    return docs


#: Naive Bayes and the order of near-duplicate groups have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None
