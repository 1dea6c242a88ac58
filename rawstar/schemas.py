"""Table schemas and source specs.

Column meaning in the CSV sources is positional, so each source is a mapping from output column to
its 1-based position; everything else about a source (which files, which flags) lives next to it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

UNKNOWN = "UNKNOWN"

# --- Bronze -----------------------------------------------------------------------------------

# As scanned: `split_start` and `line_id` place a line exactly inside its file (see
# sources/raw_lines.py). Kept until the lines of the batch are numbered.
SCANNED_DDL = (
    "raw_content string, line_bytes int, file_path string, split_start bigint, line_id bigint, "
    "load_dt timestamp_ntz, file_size bigint, modification_time timestamp_ntz"
)
# As stored, partitioned by batch and by `route`: which CSV sources a file may belong to.
RAW_LINE_DDL = (
    "raw_content string, file_name string, source_name string, file_row_number bigint, "
    "chunk bigint, file_bytes bigint, load_dt timestamp_ntz"
)

SPLIT_DDL = (
    "file_name string, source_name string, split_start bigint, first_line_id bigint, "
    "first_row_number bigint, split_rows bigint, split_bytes bigint, file_rows bigint, "
    "file_bytes bigint, load_dt timestamp_ntz, file_path string"
)

LEDGER_DDL = "file_path string, file_size bigint, modification_time timestamp_ntz"

CONTROL_DDL = (
    "batch_id string, status string, csv_rows bigint, json_rows bigint, xml_rows bigint, "
    "total_rows bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, error_message string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)

# Raw tables by format, and the file-name pattern each one loads (fixed values).
RAW_TABLES = {
    "csv": "csv_raw_content",
    "json": "raw_json_ingestion",
    "xml": "raw_xml_ingestion",
}
FILE_PATTERNS = {
    "csv": r"(?i).*\.csv.*",
    "json": r".*\.json.*",
    "xml": r".*\.(xml|txt).*",
}

# --- Silver and Gold --------------------------------------------------------------------------
# Names of tables and columns, and their types.

CUSTOMER_DDL = (
    "customer_id string, customer_name string, email string, segment string, "
    "loyalty_tier string, signup_source string, is_active string"
)
ORDER_DDL = (
    "order_id string, customer_id string, order_date date, order_status string, channel string"
)
PRODUCT_DDL = (
    "sku string, product_name string, category string, unit_price double, currency string, "
    "is_active string"
)
PAYMENT_DDL = (
    "payment_id string, order_id string, payment_method string, amount double, currency string, "
    "status string"
)
TRANSACTION_DDL = (
    "transaction_id string, order_id string, order_date date, customer_id string, "
    "customer_name string, customer_email string, sku string, description string, "
    "quantity double, currency string, payment_method string, payment_amount double"
)

SILVER_TABLES = {
    "dim_customers": CUSTOMER_DDL,
    "dim_order": ORDER_DDL,
    "dim_product": PRODUCT_DDL,
    "dim_payments": PAYMENT_DDL,
    "slv_transactions": TRANSACTION_DDL,
}

# What a batch has set aside; written where quarantine is on.
REJECT_TABLES = {
    "csv_rejects": "source string, key string, reason string, detail string",
    "transaction_rejects": (
        "source string, file_name string, record_no bigint, key string, reason string, "
        "detail string"
    ),
    "unparsable_documents": "file_name string, record_no bigint, content string",
}

GOLD_TABLES = {
    "dim_customers": CUSTOMER_DDL,
    "dim_order": "order_id string, order_date date, order_status string, channel string",
    "dim_payment": (
        "payment_id string, order_id string, payment_method string, currency string, status string"
    ),
    "dim_product": PRODUCT_DDL,
    "fact_transactions": (
        "transaction_id string, order_id string, order_date date, customer_id string, sku string, "
        "quantity double, payment_amount double"
    ),
    "fact_order_gaps": (
        "order_id string, customer_id string, order_date date, gap_type string, "
        "payment_amount double"
    ),
}


def columns(ddl: str) -> list[str]:
    """Column names of a DDL string, in order."""
    return [part.split()[0] for part in ddl.split(", ")]


# --- Semi-structured shapes -------------------------------------------------------------------

# Only the fields the transaction stream needs; naming them is what prunes the parse. Fixed values.
XML_TRANSACTION_DDL = """
    TransactionID string,
    Order struct<
        OrderID string,
        OrderDate string,
        Customer struct<
            CustomerID string,
            Name struct<FirstName string, LastName string>,
            Email string>>,
    Items struct<Item array<struct<
        SKU string,
        Description string,
        Quantity string,
        UnitPrice struct<_VALUE string, _currency string>>>>,
    Payment struct<Method string, Amount struct<_VALUE string, _currency string>>
"""

# --- CSV sources ------------------------------------------------------------------------------


@dataclass(frozen=True)
class CsvSource:
    """One positional CSV source.

    `file_name` is an exact normalised name, `pattern` a LIKE pattern on the normalised name; one
    of the two is set. `header_rows` are the row numbers that carry column names.
    """

    positions: dict[str, int]
    file_name: str | None = None
    pattern: str | None = None
    header_rows: tuple[int, ...] = (2,)
    sentinels: tuple[str, ...] = field(
        default=("----- START OF FILE%", "----- END OF FILE%")  # fixed values
    )


def _ordered(*names: str) -> dict[str, int]:
    return {name: i for i, name in enumerate(names, start=1)}


CUSTOMERS_A = CsvSource(
    _ordered(
        "customer_id", "first_name", "last_name", "email", "loyalty_tier", "signup_source",
        "is_active",
    ),
    file_name="customer.csv",
)
CUSTOMERS_B = CsvSource(
    _ordered("customer_id", "customer_name", "email", "segment", "is_active"),
    file_name="client_b/customer.csv",
)
PRODUCTS = CsvSource(
    _ordered("sku", "product_name", "category", "unit_price", "currency", "is_active"),
    pattern="%product%.csv%",
)
ORDERS = CsvSource(
    _ordered("order_id", "customer_id", "order_date", "order_status", "channel"),
    pattern="%order%.csv%",
)
PAYMENTS = CsvSource(
    _ordered("payment_id", "order_id", "payment_method", "amount", "currency", "status"),
    pattern="%payments.csv%",
)

CSV_SOURCES = {
    "customers_a": CUSTOMERS_A,
    "customers_b": CUSTOMERS_B,
    "products": PRODUCTS,
    "orders": ORDERS,
    "payments": PAYMENTS,
}
# --- What each build has parsed (see plans/increments.py) ---------------------------------------


def _texts(*names: str) -> str:
    return ", ".join(f"{name} string" for name in names)


#: Files a build has parsed: which load of them, and with which options.
PARSED_FILES_DDL = (
    "file_name string, kind string, load_batch string, load_dt timestamp_ntz, parsed_as string, "
    "parsed_dt timestamp_ntz"
)
#: Tables of each format, all with a `file_name`.
PARSED_TABLES = {
    "csv": {
        f"last_{name}": f"file_name string, file_row_number bigint, {_texts(*source.positions)}"
        + (", customer_name string" if source is CUSTOMERS_A else "")
        for name, source in CSV_SOURCES.items()
    },
    "xml": {
        "items_xml": _texts(
            "transaction_id", "order_id", "order_date", "customer_id", "first_name", "last_name",
            "customer_email", "sku", "description", "quantity", "unit_price", "currency",
            "payment_method", "payment_amount", "file_name",
        )
        + ", record_no bigint, item_no int",
        "values_xml": REJECT_TABLES["transaction_rejects"],
        "bad_xml": REJECT_TABLES["unparsable_documents"],
    },
    "json": {
        "items_json": "file_name string, price_amount double, " + TRANSACTION_DDL,
        "values_json": REJECT_TABLES["transaction_rejects"],
        "bad_json": REJECT_TABLES["unparsable_documents"],
    },
}

#: Route of lines that no CSV source claims.
NO_ROUTE = "none"
