"""Referential completion: add the members a fact refers to but a dimension lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """One constant row with the columns and types of `df`."""
    schema = df.schema
    return df.sparkSession.range(1).select(
        *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def insert_missing(
    target: DataFrame, source: DataFrame, key: str, unknown_row: dict[str, object] | None = None
) -> DataFrame:
    """`target` plus the rows of `source` (and the unknown row) whose key `target` lacks.

    Rows already in `target` never change. A NULL source key matches nothing, so it is inserted;
    two source rows with one new key are both inserted. Only the distinct key column of `target`
    meets the source, so a key repeated in `target` is one row in the join.
    """
    if unknown_row is not None:
        source = one_row(target, unknown_row).unionByName(source)
    casts = [F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    known = target.select(key).filter(F.col(key).isNotNull()).distinct()
    return target.unionByName(source.select(*casts).join(known, key, "left_anti").select(target.columns))


def orphans(
    fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str
) -> DataFrame:
    """Fact keys without a dimension member, with the number of fact rows behind each."""
    counted = fact.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("fact_rows"))
    members = dimension.select(F.col(dimension_key).alias("key")).distinct()
    return counted.join(members, "key", "left_anti")
