"""Every operator and data product as a query over the analytic tables, with its SQL twin.

A query renders dirty input from whole tables (see render.py), runs the library on it and returns
the result; the SQL states the same result straight from the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar import schemas
from rawstar.functions import text
from rawstar.operators import cells, dedup, documents, members
from rawstar.plans import control, gold, rules, silver
from rawstar.plans import render as r
from rawstar.plans.render import cat, money, table, txt
from rawstar.sources.ingest import ingest
from rawstar.sources.lake import Lake, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def _date(c: str) -> Column:
    return F.col(c).cast("date")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 2) for n in names})


# --- cells and rows ---------------------------------------------------------------------------


@query("""
WITH line AS (
  SELECT c_custkey, concat(c_custkey, ',', c_name, ',',
    CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END,
    ',""', c_mktsegment, '"",') AS s FROM customer),
cell AS (SELECT c_custkey, string_split(s, ',') AS a FROM line),
one AS (SELECT c_custkey, a, unnest(generate_series(1, len(a))) AS i FROM cell)
SELECT 'col' || CAST(i AS VARCHAR) AS key,
  CASE WHEN length(a[i]) = 0 THEN NULL ELSE replace(a[i], '""', '') END AS value,
  'customer.csv' AS file_name, c_custkey AS file_row_number FROM one
""")
def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "customer").select(
        cat(
            txt("c_custkey"), ",", F.col("c_name"), ",",
            F.when(F.col("c_acctbal") < 0, "").otherwise(txt("c_nationkey")),
            ',""', F.col("c_mktsegment"), '"",',
        ).alias("raw_content"),
        F.lit("customer.csv").alias("file_name"),
        F.col("c_custkey").alias("file_row_number"),
    )
    return cells.split_cells(cells.drop_sentinels(lines))


@query("""
SELECT c_custkey AS file_row_number, 'C' || c_custkey AS customer_id,
  CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_name END AS customer_name,
  CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_name || '@example.com' END AS email,
  c_mktsegment AS segment, 'true' AS is_active FROM customer
""")
def csv_positional_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    poor = F.col("c_acctbal") < 0
    lines = table(spark, sf_dir, "customer").select(
        r.csv_row(
            cat("C", txt("c_custkey")),
            F.when(poor, "").otherwise(F.col("c_name")),
            cat(F.col("c_name"), "@example.com"),
            F.col("c_mktsegment"),
            F.when(poor, "true <-- missing email").otherwise("true"),
        ).alias("raw_content"),
        F.lit("client_b/customer.csv").alias("file_name"),
        F.col("c_custkey").alias("file_row_number"),
    )
    named = cells.positional_map(lines, schemas.CUSTOMERS_B.positions)
    return named.select(
        "file_row_number",
        "customer_id",
        text.or_unknown("customer_name").alias("customer_name"),
        F.when(text.any_like("is_active", *silver.BAD_EMAIL), schemas.UNKNOWN)
        .otherwise(F.col("email"))
        .alias("email"),
        "segment",
        text.first_token("is_active").alias("is_active"),
    )


@query("""
SELECT p_partkey AS file_row_number, max('P' || p_partkey) AS sku, max(p_name) AS product_name,
  max(CASE WHEN p_size > 25 THEN NULL ELSE p_brand END) AS category FROM part GROUP BY p_partkey
""")
def csv_pivot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(
        r.csv_row(
            cat("P", txt("p_partkey")),
            F.col("p_name"),
            F.when(F.col("p_size") > 25, "").otherwise(F.col("p_brand")),
        ).alias("raw_content"),
        F.lit("product.csv").alias("file_name"),
        F.col("p_partkey").alias("file_row_number"),
    )
    positions = {"sku": 1, "product_name": 2, "category": 3}
    pivoted = cells.pivot_cells(
        cells.split_cells(lines), positions, ["file_name", "file_row_number"]
    )
    return pivoted.drop("file_name")


@query("""
SELECT 'supplier_' || s_nationkey || '.csv' AS file_name, s_suppkey + 4 AS file_row_number,
  s_suppkey || ',' || s_name AS raw_content FROM supplier
""")
def sentinel_header_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = r.csv_file(
        table(spark, sf_dir, "supplier"),
        cat("supplier_", txt("s_nationkey"), ".csv"),
        [(F.col("s_suppkey") + 4, r.csv_row(txt("s_suppkey"), F.col("s_name")))],
    )
    kept = cells.drop_sentinels(r.csv_envelope(lines, "s_suppkey,s_name"), header_rows=(2,))
    return kept.select("file_name", "file_row_number", "raw_content")


@query("""
SELECT c_custkey, 'C-' || c_custkey AS customer_id FROM customer
WHERE c_acctbal >= 0 AND c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')
""")
def key_shape_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    keyed = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, schemas.UNKNOWN)
        .when(segment == "MACHINERY", cat("c-", txt("c_custkey")))
        .when(segment != "FURNITURE", cat("C-", txt("c_custkey")))
        .alias("customer_id"),
    )
    return keyed.filter(F.col("customer_id").like("C%") & (F.col("customer_id") != schemas.UNKNOWN))


@query("""
SELECT 'exact' AS route, doc_id, source FROM documents WHERE source = 'src1' AND lang = 'en'
UNION ALL
SELECT 'pattern' AS route, doc_id, source FROM documents WHERE lang <> 'en'
UNION ALL
SELECT 'regex' AS route, doc_id, source FROM documents
""")
def route_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        text.normalised_name(
            F.when(F.col("lang") == "en", cat("Client A/", F.col("source"), ".CSV.gz")).otherwise(
                cat("Client B/My Product ", F.col("source"), ".csv")
            )
        ).alias("source_name"),
    )
    routed = {
        "exact": cells.route(named, file_name="client_a/src1.csv"),
        "pattern": cells.route(named, pattern="%product%.csv%"),
        "regex": named.filter(F.col("source_name").rlike(schemas.FILE_PATTERNS["csv"])),
    }
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(k).alias("route"), "doc_id", "source") for k, df in routed.items()],
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'kept' ELSE 'rejected' END AS verdict
FROM orders
""")
def reject_flagged_3vl(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(r.status("F"), "false  <-- null-heavy row").when(r.status("O"), "true").alias("flag"),
    )
    kept, rejected = dedup.reject_flagged(flagged, {"flag": [silver.NULL_HEAVY]})
    return kept.select("o_orderkey", F.lit("kept").alias("verdict")).unionByName(
        rejected.select("o_orderkey", F.lit("rejected").alias("verdict"))
    )


@query("""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()]
    return dedup.keep_latest(orders, ["o_custkey"], order).select(
        "o_custkey", "o_orderkey", _date("o_orderdate").alias("order_date"), "o_orderstatus"
    )


@query("""
WITH o AS (SELECT o_custkey, o_orderkey,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS order_date
  FROM orders)
SELECT * FROM o
QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY order_date DESC NULLS FIRST, o_orderkey) = 1
""")
def latest_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.when(~r.is_urgent(), _date("o_orderdate")).alias("order_date")
    )
    order = [F.col("order_date").desc_nulls_first(), F.col("o_orderkey").asc()]
    return dedup.keep_latest(orders, ["o_custkey"], order)


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS file_name, CAST(l_linenumber AS BIGINT) AS file_row_number,
  l_returnflag || l_linestatus AS raw_content, l_shipdate AS load_dt FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag || l_linestatus
  ORDER BY l_shipdate DESC) = 1
""")
def dedup_exact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        txt("l_orderkey").alias("file_name"),
        F.col("l_linenumber").cast("bigint").alias("file_row_number"),
        F.concat("l_returnflag", "l_linestatus").alias("raw_content"),
        F.col("l_shipdate").alias("load_dt"),
    )
    return documents.dedup_lines(lines)


@query("""
SELECT 'N' || c_nationkey AS customer_id, c_mktsegment AS customer_name, 'none' AS email,
  'seg' AS segment, 'UNKNOWN' AS loyalty_tier, 'UNKNOWN' AS signup_source, 'true' AS is_active
FROM customer
UNION
SELECT 'N' || s_nationkey, 'SUPPLIER', 'none', 'UNKNOWN', 'GOLD', 'Web', 'true' FROM supplier
""")
def union_distinct_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "customer").select(
        cat("N", txt("c_nationkey")).alias("customer_id"),
        F.col("c_mktsegment").alias("customer_name"),
        F.lit("none").alias("email"),
        F.lit("seg").alias("segment"),
        F.lit("true").alias("is_active"),
    )
    a = table(spark, sf_dir, "supplier").select(
        cat("N", txt("s_nationkey")).alias("customer_id"),
        F.lit("SUPPLIER").alias("customer_name"),
        F.lit("none").alias("email"),
        F.lit("GOLD").alias("loyalty_tier"),
        F.lit("Web").alias("signup_source"),
        F.lit("true").alias("is_active"),
    )
    return silver.union_customers(b, a)


@query("""
SELECT 'O' || o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, round(o_totalprice, 2) AS amount,
  'order' AS kind FROM orders
UNION ALL
SELECT 'E' || event_id, CAST(ts AS DATE), round(value, 2), event_type FROM events
UNION ALL SELECT 'UNKNOWN', NULL, CAST(0 AS DOUBLE), 'UNKNOWN'
""")
def union_all_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        cat("O", txt("o_orderkey")).alias("id"),
        _date("o_orderdate").alias("day"),
        F.round("o_totalprice", 2).alias("amount"),
        F.lit("order").alias("kind"),
    )
    events = table(spark, sf_dir, "events").select(
        cat("E", txt("event_id")).alias("id"),
        _date("ts").alias("day"),
        F.round("value", 2).alias("amount"),
        F.col("event_type").alias("kind"),
    )
    both = orders.unionByName(events)
    unknown = {"id": "UNKNOWN", "day": None, "amount": 0.0, "kind": "UNKNOWN"}
    return both.unionByName(members.one_row(both, unknown))


@query("""
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  replace(text, ';', ''), '-----(.|\\n)*?-----', '', 'g'), '//[^\\n]*\\n', chr(10), 'g'),
  '/\\*(.|\\n)*?\\*/', '', 'g'), '(^|\\n)--+[^\\n]*', '\\1', 'g'), ' ')) AS digest,
  CASE WHEN contains(text, ' ') THEN split_part(text, ' ', 1) ELSE text END AS head,
  CASE WHEN trim(text, ' ') = '' THEN NULL ELSE lang || ' ' || source END AS label
FROM documents
""")
def text_cleaners(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = text.strip_dashed(text.strip_semicolons("text"))
    body = text.strip_block_comments(text.strip_line_comments(body))
    return docs.select(
        "doc_id",
        F.md5(F.trim(text.strip_dash_lines(body))).alias("digest"),
        text.first_token("text").alias("head"),
        F.when(text.clean("text").isNotNull(), text.full_name("lang", "source")).alias("label"),
    )


# --- CSV dimensions ---------------------------------------------------------------------------

_CUSTOMERS_B = """
SELECT 'C-CUST-' || c_custkey AS customer_id,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'New ' || c_name ELSE c_name END AS customer_name,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN
         CASE WHEN c_acctbal < 0 THEN 'bad@@mail' ELSE 'c' || c_custkey || '@example.com' END
       WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE 'c' || c_custkey || '@example.com' END AS email,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'UNKNOWN' ELSE c_mktsegment END AS segment,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'false' ELSE 'true' END AS is_active
FROM customer WHERE c_mktsegment <> 'MACHINERY'
"""

_CUSTOMERS_A = """
SELECT 'CUST-A-' || s_suppkey AS customer_id,
  CASE WHEN s_acctbal > 8000 OR s_acctbal < 1000 THEN 'UNKNOWN' ELSE s_name || ' Ann' END
    AS customer_name,
  CASE WHEN s_acctbal > 8000 THEN 'UNKNOWN' ELSE 'a@example.com' END AS email,
  'UNKNOWN' AS loyalty_tier,
  CASE WHEN s_acctbal > 8000 THEN 'UNKNOWN' ELSE 'Web' END AS signup_source,
  CASE WHEN s_acctbal > 8000 THEN 'false' ELSE 'true' END AS is_active
FROM supplier WHERE s_acctbal <= 8000
"""


@query(_CUSTOMERS_B)
def customers_client_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customers_b(r.customer_csv_b(table(spark, sf_dir, "customer")))


@query(_CUSTOMERS_A)
def customers_client_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customers_a(r.customer_csv_a(table(spark, sf_dir, "supplier")))


@query(f"""
SELECT customer_id, customer_name, email, segment, 'UNKNOWN' AS loyalty_tier,
  'UNKNOWN' AS signup_source, is_active FROM ({_CUSTOMERS_B})
UNION
SELECT customer_id, customer_name, email, 'UNKNOWN', loyalty_tier, signup_source, is_active
FROM ({_CUSTOMERS_A})
""")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = r.customer_csv_b(table(spark, sf_dir, "customer")).unionByName(
        r.customer_csv_a(table(spark, sf_dir, "supplier"))
    )
    return silver.dim_customers(lines)


@query("""
SELECT 'SKU-' || p_partkey AS sku, p_name AS product_name,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END AS category,
  CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'PROMO' THEN -round(p_retailprice, 2)
    ELSE round(p_retailprice, 2) END AS unit_price,
  'USD' AS currency, 'true' AS is_active
FROM part WHERE p_type <> 'LARGE'
""")
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = r.product_csv(table(spark, sf_dir, "part"))
    return _rounded(silver.dim_product(lines), "unit_price")


_DIM_ORDER = """
SELECT 'ORD-' || o_orderkey AS order_id, 'C-CUST-' || o_custkey AS customer_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'CLOSED' ELSE o_orderstatus END AS order_status,
  CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'UNKNOWN' ELSE 'Web' END AS channel
FROM orders WHERE o_orderpriority <> '2-HIGH'
"""


@query(_DIM_ORDER)
def dim_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_order(r.order_csv(table(spark, sf_dir, "orders")))


@query("""
SELECT 'PAY-' || o_orderkey AS payment_id, 'ORD-' || o_orderkey AS order_id,
  o_orderpriority AS payment_method,
  round(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END, 2) AS amount,
  'USD' AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'REFUNDED' WHEN 'P' THEN 'CHARGEBACK' ELSE 'PAID' END AS status
FROM orders
""", name="dim_payments")
def refund_abs_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = r.payment_csv(table(spark, sf_dir, "orders"))
    return _rounded(silver.dim_payments(lines), "amount")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END AS amount,
  CASE l_returnflag WHEN 'R' THEN 'REFUNDED' WHEN 'A' THEN 'ADJUSTED' ELSE 'PAID' END AS status
FROM lineitem
""")
def refund_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    paid = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(flag == "N", F.col("l_quantity")).otherwise(-F.col("l_quantity")).alias("amount"),
        F.when(flag == "R", "REFUNDED <-- negative").when(flag == "A", "ADJUSTED")
        .otherwise("PAID").alias("status"),
    )
    return paid.withColumns(
        {"amount": silver.refund_magnitude("amount", "status"), "status": text.first_token("status")}
    )


@query("""
SELECT 'customers_b' AS source, 'C-CUST-' || c_custkey AS key, 'flagged' AS reason,
  'false   <-- null-heavy row' AS detail FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL
SELECT 'products', 'SKU-' || p_partkey, 'flagged', 'false <-- anomaly' FROM part
WHERE p_type = 'LARGE'
UNION ALL
SELECT 'products', 'SKU-' || p_partkey, 'bad unit_price', 'n/a' FROM part WHERE p_type = 'ECONOMY'
UNION ALL
SELECT 'orders', 'ORD-' || o_orderkey, 'flagged',
  CASE WHEN o_orderstatus = 'P' THEN 'P   <-- invalid customer | UNKNOWN'
    ELSE o_orderstatus || ' | Web   <-- invalid customer' END
FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = reduce(
        DataFrame.unionByName,
        [
            r.customer_csv_b(table(spark, sf_dir, "customer")),
            r.product_csv(table(spark, sf_dir, "part")),
            r.order_csv(orders),
            r.payment_csv(orders),
        ],
    )
    return silver.csv_rejects({name: rank(lines) for name, rank in silver.LATEST.items()})


# --- XML and JSON -----------------------------------------------------------------------------

_XML_ITEMS = """
SELECT 'TXN-' || o_orderkey AS transaction_id, 'ORD-' || o_orderkey AS order_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, 'CUST-' || o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Ann' END AS first_name,
  'Lee' || o_custkey AS last_name, 'c' || o_custkey || '@example.com' AS customer_email,
  item.sku || o_orderkey AS sku, item.description,
  CASE WHEN item.sku = 'GIFT-' THEN '1' WHEN o_orderstatus = 'P' THEN ''
    WHEN o_orderstatus = 'F' THEN '-2' ELSE '3' END AS quantity,
  item.unit_price, item.currency, o_orderpriority AS payment_method,
  CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN NULL
    ELSE CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '' END
      || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS payment_amount,
  item.item_no
FROM orders, (VALUES (0, 'SKU-', 'first & more', '7.35', 'USD'), (1, 'GIFT-', '', '0', 'EUR'))
  AS item(item_no, sku, description, unit_price, currency)
"""

_XML_COLUMNS = [
    "transaction_id", "order_id", "order_date", "customer_id", "first_name", "last_name",
    "customer_email", "sku", "description", "quantity", "unit_price", "currency",
    "payment_method", "payment_amount", "item_no",
]


@query(_XML_ITEMS)
def xml_rebuild_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file as one document."""
    elements, _ = documents.xml_document_elements(r.order_xml(table(spark, sf_dir, "orders")))
    return silver.flatten_xml(elements).select(*_XML_COLUMNS)


@query(_XML_ITEMS)
def xml_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file in records."""
    elements, _ = documents.xml_elements(r.order_xml(table(spark, sf_dir, "orders")))
    return silver.flatten_xml(elements).select(*_XML_COLUMNS)


@query("""
SELECT 'TXN-' || o_orderkey AS transaction_id, 'ORD-' || o_orderkey AS order_id,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
  'CUST-' || o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Lee' || o_custkey || ' Ann' END AS customer_name,
  'c' || o_custkey || '@example.com' AS customer_email, 'SKU-' || o_orderkey AS sku,
  CASE WHEN o_orderstatus = 'F' THEN 'copy & more' ELSE 'first & more' END AS description,
  CAST(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 2 ELSE 3 END AS DOUBLE) AS quantity,
  'USD' AS currency, o_orderpriority AS payment_method,
  CASE o_orderpriority WHEN '1-URGENT' THEN CAST(0 AS DOUBLE) WHEN '2-HIGH' THEN NULL
    ELSE round(o_totalprice, 2) END AS payment_amount
FROM orders
""")
def xml_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = r.order_xml(table(spark, sf_dir, "orders"), copies=True)
    elements, _ = documents.xml_elements(lines)
    return _rounded(silver.xml_transactions(elements), "payment_amount").drop("filename")


def _json_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("load_dt", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


@query("""
SELECT event_id, event_type AS kind, CAST(props->>'k' AS BIGINT) AS k FROM events
""")
def json_clean_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _json_lines(r.event_json(table(spark, sf_dir, "events")))
    elements, _ = documents.json_document_elements(lines)
    return elements.select(
        F.try_variant_get("t", "$.id", "bigint").alias("event_id"),
        F.try_variant_get("t", "$.kind", "string").alias("kind"),
        F.try_variant_get("t", "$.props.k", "bigint").alias("k"),
    )


_JSON_ITEMS = """
SELECT 'TXN-' || o_orderkey AS transaction_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'ORD-' || o_orderkey END AS order_id,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
  CAST(o_custkey AS VARCHAR) AS customer_id, 'Lee {' || o_custkey || '}' AS customer_name,
  'a"b@example.com' AS customer_email, item.sku || o_orderkey AS sku, item.description,
  CAST(CASE WHEN item.sku = 'GIFT-' THEN 1 WHEN o_orderstatus = 'F' THEN -3 ELSE 2 END AS DOUBLE)
    AS quantity,
  CAST(item.price_amount AS DOUBLE) AS price_amount, item.currency,
  o_orderpriority AS payment_method, round(o_totalprice, 2) AS payment_amount
FROM orders, (VALUES ('SKU-', 'first', 7.35, 'USD'), ('GIFT-', NULL, NULL, NULL))
  AS item(sku, description, price_amount, currency)
WHERE o_orderstatus <> 'P'
"""


@query(_JSON_ITEMS)
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file as one document."""
    lines = _json_lines(r.order_json(table(spark, sf_dir, "orders")))
    elements, _ = documents.json_document_elements(lines)
    return _rounded(silver.flatten_json(elements), "payment_amount")


@query(_JSON_ITEMS)
def json_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file in records."""
    lines = _json_lines(r.order_json(table(spark, sf_dir, "orders")))
    elements, _ = documents.json_elements(lines)
    return _rounded(silver.flatten_json(elements), "payment_amount")


# --- transactions and inferred members --------------------------------------------------------


def _line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as unified transactions; customer names come from the supplier key."""
    flag = F.col("l_returnflag")
    typed = table(spark, sf_dir, "lineitem").select(
        cat(
            "L", txt("l_orderkey"), "-", txt("l_linenumber"), "-", txt("l_partkey"), "-",
            txt("l_suppkey"),
        ).alias("transaction_id"),
        F.when(flag != "A", cat("ORD-", txt("l_orderkey"))).alias("order_id"),
        F.when(F.col("l_linestatus") == "F", _date("l_shipdate")).alias("order_date"),
        cat("S", txt("l_suppkey")).alias("customer_id"),
        F.when(flag == "N", cat("Name ", txt("l_suppkey"))).alias("customer_name"),
        F.lit(None).cast("string").alias("customer_email"),
        F.when(F.col("l_quantity") > 2, cat("SKU-", txt("l_partkey"))).alias("sku"),
        cat("Part ", txt("l_partkey")).alias("description"),
        F.col("l_quantity").alias("quantity"),
        F.lit("USD").alias("currency"),
        flag.alias("payment_method"),
        F.col("l_extendedprice").alias("payment_amount"),
    )
    return silver.unified_transactions(typed.filter(flag != "R"), typed.filter(flag == "R"))


_LINES = """
SELECT 'L' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
    AS transaction_id,
  CASE WHEN l_returnflag = 'A' THEN 'UNKNOWN' ELSE 'ORD-' || l_orderkey END AS order_id,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS order_date,
  'S' || l_suppkey AS customer_id,
  CASE WHEN l_returnflag = 'N' THEN 'Name ' || l_suppkey ELSE 'UNKNOWN' END AS customer_name,
  'UNKNOWN' AS customer_email,
  CASE WHEN l_quantity > 2 THEN 'SKU-' || l_partkey ELSE 'UNKNOWN' END AS sku,
  'Part ' || l_partkey AS description, l_quantity AS quantity, 'USD' AS currency,
  l_returnflag AS payment_method, l_extendedprice AS payment_amount FROM lineitem
"""


@query(f"""
SELECT transaction_id, order_id, order_date, customer_id, customer_name, customer_email, sku,
  description, quantity, currency, payment_method, round(payment_amount, 2) AS payment_amount
FROM ({_LINES})
""")
def unified_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_line_transactions(spark, sf_dir), "payment_amount")


def _known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter("s_acctbal > 4000")
        .select(
            cat("S", txt("s_suppkey")).alias("customer_id"),
            F.col("s_name").alias("customer_name"),
            *[F.lit("x").alias(c) for c in ("email", "segment", "loyalty_tier", "signup_source")],
            F.lit("true").alias("is_active"),
        )
    )


_KNOWN_CUSTOMERS = """
SELECT 'S' || s_suppkey AS customer_id, s_name AS customer_name, 'x' AS email, 'x' AS segment,
  'x' AS loyalty_tier, 'x' AS signup_source, 'true' AS is_active FROM supplier WHERE s_acctbal > 4000
"""
_ALL_CUSTOMERS = f"""
WITH dim AS ({_KNOWN_CUSTOMERS}), txn AS ({_LINES}),
src AS (
  SELECT 'UNKNOWN' AS customer_id, 'UNKNOWN' AS customer_name
  UNION ALL
  SELECT DISTINCT customer_id, customer_name FROM txn WHERE customer_id <> 'UNKNOWN')
SELECT * FROM dim
UNION ALL
SELECT customer_id, customer_name, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN' FROM src
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.customer_id = src.customer_id)
"""


@query(_ALL_CUSTOMERS)
def infer_missing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.infer_customers(
        _known_customers(spark, sf_dir), _line_transactions(spark, sf_dir)
    )


def _known_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter("p_size > 20")
        .select(
            cat("SKU-", txt("p_partkey")).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.round("p_retailprice", 2).alias("unit_price"),
            F.lit("USD").alias("currency"),
            F.lit("true").alias("is_active"),
        )
    )


_KNOWN_PRODUCTS = """
SELECT 'SKU-' || p_partkey AS sku, p_name AS product_name, p_type AS category,
  round(p_retailprice, 2) AS unit_price, 'USD' AS currency, 'true' AS is_active
FROM part WHERE p_size > 20
"""
_ALL_PRODUCTS = f"""
WITH dim AS ({_KNOWN_PRODUCTS}), txn AS ({_LINES}),
src AS (
  SELECT 'UNKNOWN' AS sku, 'UNKNOWN' AS product_name, CAST(0 AS DOUBLE) AS unit_price
  UNION ALL
  SELECT DISTINCT sku, description, CAST(NULL AS DOUBLE) FROM txn WHERE sku <> 'UNKNOWN')
SELECT * FROM dim
UNION ALL
SELECT sku, product_name, 'UNKNOWN', unit_price, 'UNKNOWN', 'UNKNOWN' FROM src
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.sku = src.sku)
"""


@query(_ALL_PRODUCTS, name="infer_missing_parts")
def infer_missing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.infer_products(_known_products(spark, sf_dir), _line_transactions(spark, sf_dir))


def _known_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, in two parts for status O; none for status F."""
    return _payments(table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'"))


def _payments(orders: DataFrame) -> DataFrame:
    parts = F.when(r.status("O"), F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    return orders.select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.explode(parts).alias("part")
    ).select(
        cat("PAY-", txt("o_orderkey"), F.col("part")).alias("payment_id"),
        cat("ORD-", txt("o_orderkey")).alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.round("o_totalprice", 2).alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("PAID").alias("status"),
    )


_KNOWN_PAYMENTS = """
SELECT 'PAY-' || o_orderkey || part AS payment_id, 'ORD-' || o_orderkey AS order_id,
  o_orderpriority AS payment_method, round(o_totalprice, 2) AS amount, 'USD' AS currency,
  'PAID' AS status
FROM orders, (VALUES ('a'), ('b')) AS p(part)
WHERE o_orderstatus = 'O' OR (o_orderstatus <> 'F' AND part = 'a')
"""
_NEWEST_LINE = f"""
SELECT * FROM ({_LINES}) WHERE order_id <> 'UNKNOWN'
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC NULLS FIRST,
  transaction_id, sku, payment_method, payment_amount, currency, customer_id) = 1
"""
_ALL_PAYMENTS = f"""
WITH dim AS ({_KNOWN_PAYMENTS}), src AS (
  SELECT 'UNKNOWN' AS order_id, 'UNKNOWN' AS payment_method, CAST(0 AS DOUBLE) AS amount,
    'UNKNOWN' AS currency
  UNION ALL
  SELECT order_id, payment_method, round(payment_amount, 2), currency FROM ({_NEWEST_LINE}))
SELECT * FROM dim
UNION ALL
SELECT 'UNKNOWN', order_id, payment_method, amount, currency, 'UNKNOWN' FROM src
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.order_id = src.order_id)
"""


@query(_ALL_PAYMENTS)
def infer_missing_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        rules.infer_payments(_known_payments(spark, sf_dir), _line_transactions(spark, sf_dir)),
        "amount",
    )


def _known_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus <> 'P'")
        .select(
            cat("ORD-", txt("o_orderkey")).alias("order_id"),
            cat("C", txt("o_custkey")).alias("customer_id"),
            _date("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            F.lit("Web").alias("channel"),
        )
    )


_KNOWN_ORDERS = """
SELECT 'ORD-' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status, 'Web' AS channel
FROM orders WHERE o_orderstatus <> 'P'
"""
_ALL_ORDERS = f"""
WITH dim AS ({_KNOWN_ORDERS}), src AS (
  SELECT 'UNKNOWN' AS order_id, 'UNKNOWN' AS customer_id, CAST(NULL AS DATE) AS order_date
  UNION ALL
  SELECT order_id, customer_id, order_date FROM ({_NEWEST_LINE}))
SELECT * FROM dim
UNION ALL
SELECT order_id, customer_id, order_date, 'UNKNOWN', 'UNKNOWN' FROM src
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.order_id = src.order_id)
"""


@query(_ALL_ORDERS)
def infer_missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.infer_orders(_known_orders(spark, sf_dir), _line_transactions(spark, sf_dir))


@query(f"""
WITH txn AS ({_LINES}), c AS ({_ALL_CUSTOMERS}), p AS ({_ALL_PRODUCTS}), o AS ({_ALL_ORDERS}),
k AS ({_ALL_PAYMENTS})
SELECT 'customers' AS dimension, count(DISTINCT customer_id) FILTER (WHERE customer_id NOT IN
    (SELECT customer_id FROM ({_KNOWN_CUSTOMERS}))) AS missing_before,
  count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM c)) AS missing_after FROM txn
UNION ALL
SELECT 'products', count(DISTINCT sku) FILTER (WHERE sku NOT IN
    (SELECT sku FROM ({_KNOWN_PRODUCTS}))),
  count(*) FILTER (WHERE sku NOT IN (SELECT sku FROM p)) FROM txn
UNION ALL
SELECT 'orders', count(DISTINCT order_id) FILTER (WHERE order_id NOT IN
    (SELECT order_id FROM ({_KNOWN_ORDERS}))),
  count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM o)) FROM txn
UNION ALL
SELECT 'payments', count(DISTINCT order_id) FILTER (WHERE order_id NOT IN
    (SELECT order_id FROM ({_KNOWN_PAYMENTS}))),
  count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM k)) FROM txn
""")
def referential_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = _line_transactions(spark, sf_dir)
    cases = {
        "customers": (_known_customers, rules.infer_customers, "customer_id"),
        "products": (_known_products, rules.infer_products, "sku"),
        "orders": (_known_orders, rules.infer_orders, "order_id"),
        "payments": (_known_payments, rules.infer_payments, "order_id"),
    }

    def missing(dim: DataFrame, key: str, name: str, when: str) -> DataFrame:
        return members.orphans(txn, dim, key, key).agg(
            F.lit(name).alias("dimension"), F.lit(when).alias("at"), F.count("key").alias("n")
        )

    counted = []
    for name, (known, infer, key) in cases.items():
        dim = known(spark, sf_dir)
        counted += [missing(dim, key, name, "before"), missing(infer(dim, txn), key, name, "after")]
    return (
        reduce(DataFrame.unionByName, counted)
        .groupBy("dimension")
        .agg(
            F.sum(F.when(F.col("at") == "before", F.col("n")).otherwise(0)).alias("missing_before"),
            F.sum(F.when(F.col("at") == "after", F.col("n")).otherwise(0)).alias("missing_after"),
        )
    )


# --- Gold -------------------------------------------------------------------------------------


@query("""
WITH paid AS (SELECT order_id, sum(amount) AS amount FROM ("""
+ _KNOWN_PAYMENTS.replace("o_orderstatus <> 'F' AND ", "")
+ """) GROUP BY 1)
SELECT 'ORD-' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, 'NO_TRANSACTION' AS gap_type,
  round(coalesce(sum(paid.amount), 0), 2) AS payment_amount
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN paid ON paid.order_id = 'ORD-' || o_orderkey
WHERE l_orderkey IS NULL GROUP BY 1, 2, 3, 4
""")
def order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        cat("ORD-", txt("o_orderkey")).alias("order_id"),
        cat("C", txt("o_custkey")).alias("customer_id"),
        _date("o_orderdate").alias("order_date"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        cat("ORD-", txt("l_orderkey")).alias("order_id")
    )
    paid = _payments(table(spark, sf_dir, "orders"))
    return _rounded(gold.order_gaps(orders, lines, paid), "payment_amount")


@query(f"""
SELECT transaction_id, order_id, order_date, customer_id, sku, quantity,
  round(payment_amount, 2) AS payment_amount FROM ({_LINES})
""")
def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.fact_transactions(_line_transactions(spark, sf_dir)), "payment_amount")


@query(_ALL_CUSTOMERS)
def gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_customers(infer_missing_customers(spark, sf_dir))


@query(_ALL_PRODUCTS)
def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_products(infer_missing_products(spark, sf_dir))


@query(f"SELECT order_id, order_date, order_status, channel FROM ({_ALL_ORDERS})")
def gold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_orders(infer_missing_orders(spark, sf_dir))


@query(f"SELECT payment_id, order_id, payment_method, currency, status FROM ({_ALL_PAYMENTS})")
def gold_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_payments(infer_missing_payments(spark, sf_dir))


# --- batch control ----------------------------------------------------------------------------


@query("""
WITH n AS (
  SELECT 'BATCH_' || source AS batch_id, 1 AS csv, 0 AS json, 0 AS xml FROM documents
  UNION ALL SELECT 'BATCH_' || event_type, 0, 1, 0 FROM events
  UNION ALL SELECT 'BATCH_' || split_part(url, ':', 1), 0, 0, 1 FROM pages)
SELECT batch_id, CAST(sum(csv) AS BIGINT) AS csv_rows, CAST(sum(json) AS BIGINT) AS json_rows,
  CAST(sum(xml) AS BIGINT) AS xml_rows, count(*) AS total_rows FROM n GROUP BY batch_id
""")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def batches(name: str, label: Column) -> DataFrame:
        return table(spark, sf_dir, name).select(cat("BATCH_", label).alias("batch_id"))

    return control.batch_counts(
        {
            "csv_rows": batches("documents", F.col("source")),
            "json_rows": batches("events", F.col("event_type")),
            "xml_rows": batches("pages", F.split_part("url", F.lit(":"), F.lit(1))),
        }
    )


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a control log: one batch per user, its state from the kind of event."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        cat("BATCH_", txt("user_id")).alias("batch_id"),
        F.when(kind == "error", control.FAILED)
        .when(kind == "purchase", control.SUCCESS)
        .when(kind == "signup", control.INGESTED)
        .otherwise(control.RUNNING)
        .alias("status"),
        F.col("ts").alias("start_ts"),
        F.col("ts").alias("updated_at"),
    )


_EVENT_LOG = """
SELECT 'BATCH_' || user_id AS batch_id, CASE event_type WHEN 'error' THEN 'FAILED'
    WHEN 'purchase' THEN 'SUCCESS' WHEN 'signup' THEN 'INGESTED' ELSE 'RUNNING' END AS status,
  ts AS start_ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC,
  CASE event_type WHEN 'error' THEN 4 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 ELSE 1 END DESC) = 1
"""


@query(_EVENT_LOG)
def batch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.batch_state(_event_log(spark, sf_dir)).select("batch_id", "status", "start_ts")


@query(f"""
SELECT batch_id FROM ({_EVENT_LOG}) WHERE status = 'RUNNING'
ORDER BY start_ts DESC, batch_id DESC LIMIT 1
""")
def latest_running_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.latest_running(_event_log(spark, sf_dir))


# --- files ------------------------------------------------------------------------------------

LINES_PER_FILE = 5_000


def _write_order_files(
    spark: SparkSession, sf_dir: str, path: str, condition: str, codec: str
) -> None:
    """Orders as text files of at most LINES_PER_FILE lines, sorted by key."""
    orders = table(spark, sf_dir, "orders").filter(condition)
    part = F.expr(f"o_orderkey div {LINES_PER_FILE}")
    (
        orders.select(
            part.alias("part"),
            "o_orderkey",
            r.csv_row(txt("o_orderkey"), F.col("o_orderstatus"), money("o_totalprice")).alias("value"),
        )
        .repartition("part")
        .sortWithinPartitions("part", "o_orderkey")
        .select("part", "value")
        .write.partitionBy("part")
        .option("compression", codec)
        .text(path)
    )


def _numbered(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.regexp_extract("file_name", r"part=(\d+)", 1).cast("bigint").alias("part"),
        "file_row_number",
        "raw_content",
    )


@query(f"""
SELECT o_orderkey // {LINES_PER_FILE} AS part,
  row_number() OVER (PARTITION BY o_orderkey // {LINES_PER_FILE}, o_orderstatus = 'O'
    ORDER BY o_orderkey) AS file_row_number,
  o_orderkey || ',' || o_orderstatus || ',' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
    AS raw_content
FROM orders
""")
def raw_line_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and compressed files, written from orders, read back with their line numbers."""
    landing, root = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    _write_order_files(spark, sf_dir, f"{landing}/plain.csv", "o_orderstatus = 'O'", "none")
    _write_order_files(spark, sf_dir, f"{landing}/packed.csv", "o_orderstatus <> 'O'", "gzip")
    lake = Lake(spark, root)
    ingest(lake, landing, "BATCH_1")
    return _numbered(lake.raw_lines("csv"))


@query("""
SELECT 'BATCH_1' AS batch_id, count(*) AS csv_rows FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'BATCH_3', count(*) FROM orders WHERE o_orderstatus <> 'O'
""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of one landing tree; the second finds nothing new."""
    landing, root = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    lake = Lake(spark, root)
    _write_order_files(spark, sf_dir, f"{landing}/a.csv", "o_orderstatus = 'O'", "none")
    ingest(lake, landing, "BATCH_1")
    ingest(lake, landing, "BATCH_2")
    _write_order_files(spark, sf_dir, f"{landing}/b.csv", "o_orderstatus <> 'O'", "none")
    ingest(lake, landing, "BATCH_3")
    return lake.raw_lines("csv").groupBy("batch_id").agg(F.count(F.lit(1)).alias("csv_rows"))


@query("""
SELECT 'pass ' || pass AS load, count(*) AS csv_rows FROM orders, (VALUES (1), (2)) AS p(pass)
WHERE o_orderstatus = 'O' OR pass = 2 GROUP BY pass
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a file stream that stops when it has seen every file; run three times."""
    from rawstar.streaming.ingest import ingest_available

    landing, root = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    lake = Lake(spark, root)
    _write_order_files(spark, sf_dir, f"{landing}/a.csv", "o_orderstatus = 'O'", "none")
    ingest_available(lake, landing, "csv")
    ingest_available(lake, landing, "csv")
    first = lake.raw_splits("csv").select("batch_id").distinct()
    first.write.parquet(f"{root}/first")
    _write_order_files(spark, sf_dir, f"{landing}/b.csv", "o_orderstatus <> 'O'", "none")
    ingest_available(lake, landing, "csv")
    per_batch = lake.raw_lines("csv").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    seen = spark.read.parquet(f"{root}/first").withColumn("early", F.lit(True))
    marked = per_batch.join(seen, "batch_id", "left").withColumn(
        "pass", F.when(F.col("early"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    )
    return (
        marked.select(F.explode("pass").alias("pass"), "n")
        .groupBy("pass")
        .agg(F.sum("n").alias("csv_rows"))
        .select(cat("pass ", txt("pass")).alias("load"), "csv_rows")
    )
