"""What the operators share: reading columns safely, staging, normalised text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_SCRATCH = "/tmp/checkpoints/rawstar"

#: White space of the contracts: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors see.

    It lies in the session's `spark.checkpoint.dir`. A session that runs in one process may leave
    that unset; any other one must name it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = LOCAL_SCRATCH
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a relation once to the shared folder and read it back: it outlives lost executors."""
    target = shared_dir(df.sparkSession, name)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, `doc_id` and `text`, whatever else the input has; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def salt_of(*cols: Column, salts: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(salts)).cast("int")


def row_key(doc_id: Column, mark: Column) -> Column:
    """One string that tells rows apart by id and a digest of the text; a null id is its own id."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), mark.cast("string"))


def free_names(df: DataFrame, n: int) -> list[str]:
    """Names for n more columns that no column of `df` has, in any case."""
    taken = {c.lower() for c in df.columns}
    every = (f"_added_{i}" for i in range(n + len(taken)))
    return [name for name in every if name not in taken][:n]


def keep_keys(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """Rows of `docs` whose key is among `kept` (one column, `_key`), one row per key, all columns.

    One shuffle of the rows: they are joined and made unique by the same key.
    """
    (name,) = free_names(docs, 1)
    found = docs.withColumn(name, key).join(kept.select(F.col("_key").alias(name)), name, "left_semi")
    return found.dropDuplicates([name]).select([F.col(f"`{c}`") for c in docs.columns])
