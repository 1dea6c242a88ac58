"""Keep one row per key, reject flagged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawstar.functions import text


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in `order`; NULL keys form one group. Give a total order.

    Catalyst turns the rank filter into a limit per key on both sides of the shuffle, so each map
    task sends at most one row per key and a hot key never gathers in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def flag_ok(flags: dict[str, list[str]]) -> Column:
    """Quality predicate over flag columns, NULL when a flag is NULL."""
    ok = F.lit(True)
    for column, patterns in flags.items():
        ok = ok & text.none_like(column, *patterns)
    return ok


def reject_flagged(
    df: DataFrame, flags: dict[str, list[str]]
) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by LIKE patterns on flag columns.

    A NULL flag is not 'clean', so such a row is rejected: kept and rejected always add up.
    """
    ok = flag_ok(flags)
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))
