"""Inferred members: every key a transaction refers to exists in its dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.operators.dedup import keep_latest
from rawstar.operators.members import insert_missing
from rawstar.schemas import UNKNOWN


def _unknown(*names: str) -> list[Column]:
    return [F.lit(UNKNOWN).alias(n) for n in names]


def _unknown_row(df: DataFrame, **values: object) -> dict[str, object]:
    return {c: values.get(c, UNKNOWN) for c in df.columns}


def _newest_per_order(transactions: DataFrame, columns: list[str]) -> DataFrame:
    """The newest transaction of each known order; NULL dates count as newest."""
    known = transactions.filter(F.col("order_id") != UNKNOWN)
    tie = ["transaction_id", "sku", *[c for c in columns if c not in ("order_id", "order_date")]]
    order = [F.col("order_date").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tie]]
    return keep_latest(known, ["order_id"], order)


def infer_customers(
    customers: DataFrame, transactions: DataFrame, unique_key: bool = False
) -> DataFrame:
    """Customers plus those only transactions know.

    A new id seen under two names is inserted twice unless `unique_key` is set.
    """
    source = (
        transactions.filter(F.col("customer_id") != UNKNOWN)
        .select(
            "customer_id",
            "customer_name",
            *_unknown("email", "segment", "loyalty_tier", "signup_source", "is_active"),
        )
    )
    if unique_key:
        source = keep_latest(source, ["customer_id"], [F.col("customer_name").asc()])
    else:
        source = source.distinct()
    return insert_missing(customers, source, "customer_id", _unknown_row(customers))


def infer_products(products: DataFrame, transactions: DataFrame) -> DataFrame:
    """Products plus those only transactions know; their price stays NULL."""
    source = (
        transactions.filter(F.col("sku") != UNKNOWN)
        .select(
            "sku",
            F.col("description").alias("product_name"),
            *_unknown("category"),
            F.lit(None).cast("double").alias("unit_price"),
            *_unknown("currency", "is_active"),
        )
        .distinct()
    )
    return insert_missing(products, source, "sku", _unknown_row(products, unit_price=0.0))


def infer_payments(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Payments plus one per order that has none, from its newest transaction."""
    source = _newest_per_order(
        transactions, ["order_id", "order_date", "payment_method", "payment_amount", "currency"]
    ).select(
        *_unknown("payment_id"),
        "order_id",
        "payment_method",
        F.col("payment_amount").alias("amount"),
        "currency",
        *_unknown("status"),
    )
    return insert_missing(payments, source, "order_id", _unknown_row(payments, amount=0.0))


def infer_orders(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """Orders plus those only transactions know, from their newest transaction."""
    source = _newest_per_order(transactions, ["order_id", "order_date", "customer_id"]).select(
        "order_id", "customer_id", "order_date", *_unknown("order_status", "channel")
    )
    return insert_missing(orders, source, "order_id", _unknown_row(orders, order_date=None))
