"""Exact duplicates: local winners, winners of salted digest groups, then winners overall.

Texts are equal when they are identical after A-Z are lower-cased. Each of the three stages groups
by digest *and* whole content, so two contents that share a digest never merge:

1. inside a task, Spark's partial aggregation keeps one row per (digest, salt, content);
2. those rows meet per (digest, salt, content), so a group of copies is spread over the salts;
3. at most `salts` winners per content meet, and give the row that stays.

Content travels only in the stages that compare it. What goes back to the documents is one narrow
row per digest. Digests that stand for several contents are found first and, if there are any,
joined on the content as well.

Results for odd input: a null text counts as empty, so null and empty texts are copies of each
other. Rows without an id never stay while a copy has one; if none has, `keep_id` is null. Rows
that repeat id and text get equal decisions, and `keep_exact` passes one of them on. An empty table
gives an empty result. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import keep_keys, row_key, salt_of, stage, text_rows

SALTS = 16
Digest = Callable[[bytes], str]


def sha256_hex(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def _normalised(docs: DataFrame, digest: Digest, with_content: bool) -> DataFrame:
    """doc_id, digest and, where it is needed, the normalised content as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            low = [t.encode("utf-8", "surrogatepass").lower() for t in b["text"]]
            out = {"doc_id": b["doc_id"].astype("Int64"), "digest": [digest(c) for c in low]}
            yield pd.DataFrame(out | ({"content": low} if with_content else {}))

    ddl = "doc_id long, digest string" + (", content binary" if with_content else "")
    return docs.mapInPandas(run, ddl)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Digest = sha256_hex,
) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    rows = text_rows(docs, id_col, text_col)
    full = _normalised(rows, digest, True).withColumn("salt", salt_of(F.col("doc_id"), salts=salts))
    salted = full.groupBy("digest", "salt", "content").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    groups = (
        salted.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    narrow = stage(
        groups.groupBy("digest").agg(
            F.count("*").alias("contents"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        ),
        "exact-groups",
    )
    single = narrow.filter("contents = 1").drop("contents")
    found = _normalised(rows, digest, False).join(single, "digest")
    shared = narrow.filter("contents > 1").select("digest")
    if not shared.isEmpty():
        apart = groups.join(shared, "digest", "left_semi")
        found = found.unionByName(
            full.drop("salt").join(apart, ["digest", "content"]).drop("content")
        )
    return found.select(
        "doc_id",
        "digest",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def keep_exact(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns; of rows that repeat id and text, one."""

    @F.pandas_udf("string")
    def digest_of(texts: pd.Series) -> pd.Series:
        low = texts.fillna("").map(lambda t: t.encode("utf-8", "surrogatepass").lower())
        return low.map(sha256_hex)

    kept = exact_dedup(docs, salts=salts).filter("kept")
    kept = kept.select(row_key(F.col("doc_id"), F.col("digest")).alias("_key"))
    key = row_key(F.col("doc_id").cast("long"), digest_of(F.col("text").cast("string")))
    return keep_keys(docs, key, kept)
