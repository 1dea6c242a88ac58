"""From raw documents to token ids: score, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result to the
session's shared folder as Parquet and reads it again as the next stage's documents. All stages but
the last return the columns of `documents`. A stage works on everything that its predecessor kept:

1. quality: documents that the classifier predicts as 0 go;
2. exact duplicates: of equal texts, the row with the largest doc_id stays;
3. near-duplicates: of each SimHash component, the row with the smallest doc_id stays;
4. mix: each document is repeated as often as its source's target asks, down to not at all;
5. tokens: the ids of every text, with their number and both digests.

Empty tables pass through all stages. A null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar.llm import bpe, exact_dedup, mixing, quality, simhash
from rawstar.llm.base import stage, table

#: No SQL twin: four of the stages cannot be said in SQL. The tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs)


STAGES = [
    ("quality", good_quality),
    ("exact", without_copies),
    ("near", without_near_copies),
    ("mix", mixed),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
