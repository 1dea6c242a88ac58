"""Silver: dimensions from positional CSV, transactions from XML and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar import schemas
from rawstar.functions import text
from rawstar.operators.cells import read_source
from rawstar.operators.dedup import flag_ok, keep_latest

# LIKE patterns a source uses to label its own bad rows (fixed values).
NULL_HEAVY = "%null-heavy%"
ANOMALY = "%anomaly%"
INVALID_CUSTOMER = "%invalid customer"
BAD_EMAIL = ("%missing email%", "%invalid email%")
REFUNDED = "REFUNDED%"


def _newest(tie: list[str]) -> list[Column]:
    """Highest row number first; then named columns, NULLs last; then file name."""
    return [
        F.col("file_row_number").desc(),
        *[F.col(c).asc_nulls_last() for c in tie],
        F.col("file_name").asc(),
    ]


# --- rows of each source, and the last row of each key before any of them is rejected ----------


def rows_customers_a(lines: DataFrame) -> DataFrame:
    rows = read_source(lines, schemas.CUSTOMERS_A).filter(F.col("customer_id").like("C%"))
    return rows.withColumn("customer_name", text.full_name("last_name", "first_name"))


def rows_customers_b(lines: DataFrame) -> DataFrame:
    return read_source(lines, schemas.CUSTOMERS_B).filter(F.col("customer_id").like("C%"))


def rows_products(lines: DataFrame) -> DataFrame:
    return read_source(lines, schemas.PRODUCTS)


def rows_orders(lines: DataFrame) -> DataFrame:
    return read_source(lines, schemas.ORDERS).withColumn("channel", text.or_unknown("channel"))


def rows_payments(lines: DataFrame) -> DataFrame:
    return read_source(lines, schemas.PAYMENTS)


ROWS = {
    "customers_a": rows_customers_a,
    "customers_b": rows_customers_b,
    "products": rows_products,
    "orders": rows_orders,
    "payments": rows_payments,
}
KEYS = {
    "customers_a": "customer_id",
    "customers_b": "customer_id",
    "products": "sku",
    "orders": "order_id",
    "payments": "payment_id",
}
TIES = {
    "customers_a": ["customer_name"],
    "customers_b": ["customer_name"],
    "products": ["product_name"],
    "orders": [],
    "payments": [],
}


def last_rows(rows: DataFrame, source: str) -> DataFrame:
    return keep_latest(rows, [KEYS[source]], _newest(TIES[source]))


def last_rows_by_file(lines: DataFrame, source: str) -> DataFrame:
    """The last row of each key in each file. `last_rows` of these is `last_rows` of all rows."""
    return keep_latest(ROWS[source](lines), [KEYS[source], "file_name"], _newest(TIES[source]))


def latest_customers_a(lines: DataFrame) -> DataFrame:
    return last_rows(rows_customers_a(lines), "customers_a")


def latest_customers_b(lines: DataFrame) -> DataFrame:
    return last_rows(rows_customers_b(lines), "customers_b")


def latest_products(lines: DataFrame) -> DataFrame:
    return last_rows(rows_products(lines), "products")


def latest_orders(lines: DataFrame) -> DataFrame:
    return last_rows(rows_orders(lines), "orders")


def latest_payments(lines: DataFrame) -> DataFrame:
    return last_rows(rows_payments(lines), "payments")


# --- dimensions, from ranked rows --------------------------------------------------------------

# Flag columns of each source and the patterns that reject a row.
FLAGS = {
    "customers_a": {"is_active": [NULL_HEAVY]},
    "customers_b": {"is_active": [NULL_HEAVY]},
    "products": {"is_active": [ANOMALY]},
    "orders": {"order_status": [INVALID_CUSTOMER], "channel": [INVALID_CUSTOMER]},
    "payments": {},
}
LATEST = {
    "customers_a": latest_customers_a,
    "customers_b": latest_customers_b,
    "products": latest_products,
    "orders": latest_orders,
    "payments": latest_payments,
}


def clean_customers_a(latest: DataFrame) -> DataFrame:
    return latest.filter(flag_ok(FLAGS["customers_a"])).select(
        "customer_id",
        text.or_unknown("customer_name").alias("customer_name"),
        text.or_unknown("email").alias("email"),
        text.or_unknown("loyalty_tier").alias("loyalty_tier"),
        text.or_unknown("signup_source").alias("signup_source"),
        text.first_token("is_active").alias("is_active"),
    )


def clean_customers_b(latest: DataFrame) -> DataFrame:
    return latest.filter(flag_ok(FLAGS["customers_b"])).select(
        "customer_id",
        text.or_unknown("customer_name").alias("customer_name"),
        F.when(text.any_like("is_active", *BAD_EMAIL), schemas.UNKNOWN)
        .otherwise(F.col("email"))
        .alias("email"),
        text.or_unknown("segment").alias("segment"),
        text.first_token("is_active").alias("is_active"),
    )


def clean_products(latest: DataFrame, strict: bool = False) -> DataFrame:
    return latest.filter(flag_ok(FLAGS["products"])).select(
        "sku",
        "product_name",
        "category",
        text.to_double("unit_price", strict).alias("unit_price"),
        "currency",
        text.first_token("is_active").alias("is_active"),
    )


def clean_orders(latest: DataFrame, strict: bool = False) -> DataFrame:
    return latest.filter(flag_ok(FLAGS["orders"])).select(
        "order_id",
        "customer_id",
        text.to_date("order_date", strict).alias("order_date"),
        text.first_token("order_status").alias("order_status"),
        text.first_token("channel").alias("channel"),
    )


def refund_magnitude(amount: str, status: str) -> Column:
    """Refunds as positive amounts; every other amount as it is."""
    return F.when(F.col(status).like(REFUNDED), F.abs(amount)).otherwise(F.col(amount))


def clean_payments(latest: DataFrame, strict: bool = False) -> DataFrame:
    paid = latest.withColumn("amount", text.to_double("amount", strict))
    return paid.select(
        "payment_id",
        "order_id",
        "payment_method",
        refund_magnitude("amount", "status").alias("amount"),
        "currency",
        text.first_token("status").alias("status"),
    )


def union_customers(b: DataFrame, a: DataFrame) -> DataFrame:
    """Both sources in one shape, exact duplicates once."""
    unknown = F.lit(schemas.UNKNOWN)
    names = schemas.columns(schemas.CUSTOMER_DDL)
    from_b = b.withColumns({"loyalty_tier": unknown, "signup_source": unknown}).select(*names)
    from_a = a.withColumns({"segment": unknown}).select(*names)
    return from_b.unionByName(from_a).distinct()


# --- dimensions, from lines --------------------------------------------------------------------


def customers_a(lines: DataFrame) -> DataFrame:
    return clean_customers_a(latest_customers_a(lines))


def customers_b(lines: DataFrame) -> DataFrame:
    return clean_customers_b(latest_customers_b(lines))


def dim_customers(lines: DataFrame) -> DataFrame:
    return union_customers(customers_b(lines), customers_a(lines))


def dim_product(lines: DataFrame, strict: bool = False) -> DataFrame:
    return clean_products(latest_products(lines), strict)


def dim_order(lines: DataFrame, strict: bool = False) -> DataFrame:
    return clean_orders(latest_orders(lines), strict)


def dim_payments(lines: DataFrame, strict: bool = False) -> DataFrame:
    return clean_payments(latest_payments(lines), strict)


def rejects(latest: DataFrame, source: str) -> DataFrame:
    """What a dimension leaves out or cannot cast: (source, key, reason, detail), in one pass."""
    casts = {
        "products": ("unit_price", text.to_double),
        "orders": ("order_date", text.to_date),
        "payments": ("amount", text.to_double),
    }
    reasons = []
    if FLAGS[source]:
        bad = ~F.coalesce(flag_ok(FLAGS[source]), F.lit(False))
        detail = F.concat_ws(" | ", *FLAGS[source])
        reasons.append(
            F.when(bad, F.struct(F.lit("flagged").alias("reason"), detail.alias("detail")))
        )
    if source in casts:
        column, cast = casts[source]
        reasons.append(
            F.when(
                F.col(column).isNotNull() & cast(column).isNull(),
                F.struct(F.lit(f"bad {column}").alias("reason"), F.col(column).alias("detail")),
            )
        )
    return latest.select(
        F.lit(source).alias("source"),
        F.col(KEYS[source]).alias("key"),
        F.inline(F.array_compact(F.array(*reasons))),
    )


def csv_rejects(latest: dict[str, DataFrame]) -> DataFrame:
    """`rejects` of every source; `latest` maps a source to its ranked rows."""
    return reduce(DataFrame.unionByName, [rejects(df, name) for name, df in latest.items()])


# --- transactions -----------------------------------------------------------------------------


def _tag_text(field: str, value: str) -> Column:
    """Text of an element that may carry attributes: '' when present but empty."""
    return F.when(F.col(field).isNotNull(), F.coalesce(F.col(f"{field}.{value}"), F.lit("")))


def flatten_xml(elements: DataFrame) -> DataFrame:
    """One row per item of each transaction, all fields as text; no item, no row."""
    items = elements.select("file_name", "record_no", "t", F.posexplode("t.Items.Item").alias("item_no", "i"))
    return items.select(
        F.col("t.TransactionID").alias("transaction_id"),
        F.col("t.Order.OrderID").alias("order_id"),
        F.col("t.Order.OrderDate").alias("order_date"),
        F.col("t.Order.Customer.CustomerID").alias("customer_id"),
        F.col("t.Order.Customer.Name.FirstName").alias("first_name"),
        F.col("t.Order.Customer.Name.LastName").alias("last_name"),
        F.col("t.Order.Customer.Email").alias("customer_email"),
        F.col("i.SKU").alias("sku"),
        F.col("i.Description").alias("description"),
        F.col("i.Quantity").alias("quantity"),
        _tag_text("i.UnitPrice", "_VALUE").alias("unit_price"),
        F.col("i.UnitPrice._currency").alias("currency"),
        F.col("t.Payment.Method").alias("payment_method"),
        _tag_text("t.Payment.Amount", "_VALUE").alias("payment_amount"),
        "file_name",
        "record_no",
        "item_no",
    )


def standardise_xml(flat: DataFrame, strict: bool = False) -> DataFrame:
    """Trimmed, typed transaction items; amounts and quantities as magnitudes."""
    return flat.select(
        text.clean("transaction_id").alias("transaction_id"),
        text.clean("order_id").alias("order_id"),
        text.to_date(text.clean("order_date"), strict).alias("order_date"),
        text.clean("customer_id").alias("customer_id"),
        F.trim(text.full_name(text.clean("last_name"), text.clean("first_name"))).alias("customer_name"),
        text.clean("customer_email").alias("customer_email"),
        text.clean("sku").alias("sku"),
        text.clean("description").alias("description"),
        text.amount_or_zero("quantity", strict).alias("quantity"),
        "currency",
        text.clean("payment_method").alias("payment_method"),
        text.amount_or_zero("payment_amount", strict).alias("payment_amount"),
        "file_name",
        "record_no",
        "item_no",
    )


def xml_transactions(
    elements: DataFrame, strict: bool = False, grain: str = "transaction"
) -> DataFrame:
    return newest_xml(flatten_xml(elements), strict, grain)


def newest_xml(flat: DataFrame, strict: bool = False, grain: str = "transaction") -> DataFrame:
    """Newest row per transaction id of flattened items, NULL order dates first.

    With grain 'transaction' one item per id survives and empty ids collapse into one row; with
    'line' every item of the newest copy position survives and rows without an id are all kept.
    """
    rows = standardise_xml(flat, strict)
    order = [
        F.col("order_date").desc_nulls_first(),
        F.col("file_name").asc(),
        F.col("record_no").asc(),
        F.col("item_no").asc(),
    ]
    if grain == "line":
        known = rows.filter(F.col("transaction_id").isNotNull())
        kept = keep_latest(known, ["transaction_id", "item_no"], order).unionByName(
            rows.filter(F.col("transaction_id").isNull())
        )
    else:
        kept = keep_latest(rows, ["transaction_id"], order)
    return kept.drop("record_no", "item_no").withColumnRenamed("file_name", "filename")


def _variant_text(v: str, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _json_items(elements: DataFrame) -> DataFrame:
    from rawstar.operators.documents import variant_members

    places = [c for c in ("file_name", "record_no") if c in elements.columns]
    return elements.select(*places, "t", F.explode(variant_members("t", "$.items")).alias("i"))


def flatten_json(elements: DataFrame, strict: bool = False, lineage: bool = False) -> DataFrame:
    """One typed row per item of each transaction; an empty item list gives no row.

    Numbers and dates that do not parse are NULL, or stop the query when `strict`. `lineage` adds the
    file name.
    """
    items = _json_items(elements)
    places = ["file_name"] if lineage else []

    def get(v: str, path: str, kind: str = "string") -> Column:
        if kind == "double":  # by its text: the engine's cast also takes "1d"
            return text.to_double(_variant_text(v, path), strict)
        return F.try_variant_get(v, path, kind)

    return items.select(
        *places,
        get("t", "$.id").alias("transaction_id"),
        get("t", "$.order.id").alias("order_id"),
        text.to_date(get("t", "$.order.date"), strict).alias("order_date"),
        get("t", "$.order.customer.id").alias("customer_id"),
        text.clean(get("t", "$.order.customer.name")).alias("customer_name"),
        get("t", "$.order.customer.email").alias("customer_email"),
        get("i", "$.sku").alias("sku"),
        get("i", "$.description").alias("description"),
        get("i", "$.qty", "double").alias("quantity"),
        get("i", "$.price.amount", "double").alias("price_amount"),
        get("i", "$.price.currency").alias("currency"),
        get("t", "$.payment.method").alias("payment_method"),
        get("t", "$.payment.total", "double").alias("payment_amount"),
    )


def _bad_values(
    rows: DataFrame, source: str, key: Column, fields: list[tuple[str, Column, Column]]
) -> DataFrame:
    """One row per field whose text is there but has no value: (name, text, value)."""
    reasons = [
        F.when(
            (F.trim(raw) != "") & value.isNull(),
            F.struct(F.lit(f"bad {name}").alias("reason"), raw.alias("detail")),
        )
        for name, raw, value in fields
    ]
    return rows.select(
        F.lit(source).alias("source"),
        "file_name",
        "record_no",
        key.alias("key"),
        F.inline(F.array_compact(F.array(*reasons))),
    ).distinct()  # fields of the transaction come once per item


def xml_rejects(flat: DataFrame) -> DataFrame:
    """Dates and numbers of flattened XML items that do not parse."""
    fields = [("order_date", F.col("order_date"), text.to_date(text.clean("order_date")))]
    for name in ("quantity", "unit_price", "payment_amount"):
        fields.append((name, F.col(name), text.to_double(name)))
    return _bad_values(flat, "xml", text.clean("transaction_id"), fields)


def json_rejects(elements: DataFrame) -> DataFrame:
    """Dates and numbers of JSON transactions that do not parse."""
    date = _variant_text("t", "$.order.date")
    fields = [("order_date", date, text.to_date(date))]
    for name, v, path in (
        ("quantity", "i", "$.qty"),
        ("price_amount", "i", "$.price.amount"),
        ("payment_amount", "t", "$.payment.total"),
    ):
        raw = _variant_text(v, path)
        fields.append((name, raw, text.to_double(raw)))
    return _bad_values(_json_items(elements), "json", _variant_text("t", "$.id"), fields)


def unified_transactions(xml: DataFrame, json: DataFrame) -> DataFrame:
    """Both streams in one relation; missing keys and names become UNKNOWN."""
    names = schemas.columns(schemas.TRANSACTION_DDL)
    both = xml.select(*names).unionByName(json.select(*names))
    as_is = {"order_date", "quantity", "currency", "payment_amount"}
    return both.select(
        *[F.col(c) if c in as_is else text.or_unknown(c).alias(c) for c in names]
    )
