"""Dirty raw lines rendered from the analytic tables.

The catalog queries need input of the kind the pipeline reads. It is derived here from whole tables,
so it grows with them. Rows are put into files of a fixed number of rows by an increasing id, so no
file depends on how often a key repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_FILE = 150
LINES_PER_ROW = 100
TASKS = 8  # pieces that a table is rendered in at least, whatever it is stored in
ROWS_PER_TASK = 150_000  # rows of a piece at most, unless the number of pieces is given
FILE_BYTES = ROWS_PER_FILE * LINES_PER_ROW * 60  # about the most a record file can hold


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txt(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c: Column | str) -> Column:
    """Fixed two-digit text, the same in any engine."""
    return txt((F.col(c) if isinstance(c, str) else c).cast("decimal(15,2)"))


def cat(*parts: Column | str) -> Column:
    """Concatenation; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def csv_row(*cells: Column) -> Column:
    return F.concat_ws(",", *cells)


def csv_file(
    df: DataFrame, file_name: Column | str, rows: list[tuple[Column, Column]]
) -> DataFrame:
    """Lines of CSV files: `rows` are (row number, text) per input row; NULL text gives no line."""
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    made = F.array(
        *[F.struct(n.cast("bigint").alias("n"), line.alias("line")) for n, line in rows]
    )
    return (
        df.select(name.alias("file_name"), F.explode(made).alias("r"))
        .filter("r.line IS NOT NULL")
        .select(
            "file_name",
            F.col("file_name").alias("source_name"),
            F.col("r.n").alias("file_row_number"),
            F.col("r.line").alias("raw_content"),
        )
    )


def csv_envelope(lines: DataFrame, header: str) -> DataFrame:
    """Add the envelope of every file: start line, header at row 2, blank line, end line."""
    made = F.array(
        *[
            F.struct(F.lit(n).cast("bigint").alias("n"), F.lit(line).alias("line"))
            for n, line in [
                (1, "----- START of FILE: export.csv -----"),
                (2, header),
                (3, None),
                (9_000_000_000_000_000, "----- END OF FILE -----"),
            ]
        ]
    )
    files = lines.select("file_name", "source_name").distinct()
    envelope = files.select("file_name", "source_name", F.explode(made).alias("r")).select(
        "file_name",
        "source_name",
        F.col("r.n").alias("file_row_number"),
        F.col("r.line").alias("raw_content"),
    )
    return lines.unionByName(envelope)


def record_lines(
    df: DataFrame,
    prefix: str,
    suffix: str,
    head: list[str],
    body: list[Column],
    rows_per_file: int = ROWS_PER_FILE,
    tasks: int | None = None,
) -> DataFrame:
    """Lines of record files: `body` lines per input row, after `head` once per file."""
    if tasks is None:
        tasks = max(TASKS, -(-df.count() // ROWS_PER_TASK))
    # The upper bits of the id are the task, the lower ones count the rows of the task from 0.
    placed = (
        df.repartition(tasks)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", 33))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    opened = F.when(first_in_file(rows_per_file), F.array(*map(F.lit, head))).otherwise(
        F.array().cast("array<string>")
    )
    number = F.expr(f"_row div {rows_per_file}")
    return placed.select(
        cat(prefix, txt("_task"), "_", txt(number), suffix).alias("file_name"),
        ((F.col("_row") % rows_per_file) * LINES_PER_ROW).alias("_base"),
        F.posexplode(F.concat(opened, F.array(*body))).alias("_pos", "raw_content"),
    ).select(
        "file_name",
        (F.col("_base") + F.col("_pos") + 1).alias("file_row_number"),
        F.nullif("raw_content", F.lit("")).alias("raw_content"),
        F.lit(FILE_BYTES).cast("bigint").alias("file_bytes"),
    )


# --- XML --------------------------------------------------------------------------------------


def xml_transaction(
    transaction_id: Column,
    order_id: Column,
    order_date: Column,
    customer_id: Column,
    first_name: Column,
    last_name: Column,
    email: Column,
    items: list[tuple[Column, Column, Column, Column, str]],
    method: Column,
    amount: Column,
) -> list[Column]:
    """The lines of one transaction; items are (sku, description, quantity, price, currency).

    A NULL amount leaves its tag out. A comment with a whole transaction in it, unknown fields and
    dashed lines are mixed in; none of them may show up in the result.
    """

    def tag(name: str, value: Column) -> Column:
        return cat(f"      <{name}>", value, f"</{name}>")

    lines = [
        F.lit("  <!-- next: <Transaction><TransactionID>old</TransactionID>"),
        F.lit("       <Items><Item><SKU>old</SKU></Item></Items></Transaction> -->"),
        F.lit("  <Transaction>"),
        tag("TransactionID", transaction_id),
        F.lit("    <Order>"),
        tag("OrderID", order_id),
        tag("OrderDate", order_date),
        F.lit("      <Customer>"),
        tag("CustomerID", customer_id),
        F.lit("        <Name>"),
        tag("FirstName", first_name),
        tag("LastName", last_name),
        F.lit("        </Name>"),
        tag("Email", email),
        F.lit("        <Metadata><Source>Web</Source></Metadata>"),
        F.lit("      </Customer>"),
        F.lit("    </Order>"),
        F.lit("----- page break -----"),
        F.lit("    <Items>"),
    ]
    for sku, description, quantity, price, currency in items:
        lines += [
            cat("      <Item>", tag("SKU", sku)),
            tag("Description", description),
            tag("Quantity", quantity),
            cat(f'      <UnitPrice currency="{currency}">', price, "</UnitPrice></Item>"),
        ]
    lines += [
        F.lit("    </Items>"),
        F.lit("    <Payment>"),
        tag("Method", method),
        F.coalesce(cat('      <Amount currency="USD">', amount, "</Amount>"), F.lit("")),
        F.lit("    </Payment>"),
        F.lit("  </Transaction>"),
        F.lit(""),
    ]
    return lines


XML_HEAD = [
    "----- START OF FILE: transactions.xml -----",
    '<SalesData client="A" generatedAt="2024-03-09T08:15:30Z">',
    "</SalesData>",
    "----- END OF FILE -----",
]


def is_urgent() -> Column:
    return F.col("o_orderpriority") == "1-URGENT"


def is_high() -> Column:
    return F.col("o_orderpriority") == "2-HIGH"


def status(letter: str) -> Column:
    return F.col("o_orderstatus") == letter


def order_xml(
    orders: DataFrame,
    copies: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    tasks: int | None = None,
) -> DataFrame:
    """XML lines: one transaction of two items per order.

    Quantity is negative for status F and blank for P; the amount is blank for urgent orders,
    absent for high ones; the first name is missing for P. With `copies`, each order has a second,
    older copy of its transaction, whose date is missing where the status is F.
    """
    key = txt("o_orderkey")
    date = txt(F.col("o_orderdate").cast("date"))
    quantity = F.when(status("P"), "").when(status("F"), "-2").otherwise("3")
    amount = F.when(is_urgent(), "").when(
        ~is_high(), cat(F.when(status("F"), "-").otherwise(""), money("o_totalprice"))
    )

    def one(day: Column, note: str) -> list[Column]:
        return xml_transaction(
            cat(" TXN-", key, " "),
            cat("ORD-", key),
            day,
            cat("CUST-", txt("o_custkey")),
            F.when(status("P"), "").otherwise("Ann"),
            cat("Lee", txt("o_custkey")),
            cat("c", txt("o_custkey"), "@example.com"),
            [
                (cat("SKU-", key), cat(note, " &amp; more"), quantity, F.lit("7.35"), "USD"),
                (cat("GIFT-", key), F.lit(""), F.lit("1"), F.lit("0"), "EUR"),
            ],
            F.col("o_orderpriority"),
            amount,
        )

    body = one(date, "first")
    if copies:
        older = F.when(status("F"), "").otherwise(
            txt(F.date_sub(F.col("o_orderdate").cast("date"), 7))
        )
        body = body + one(older, "copy")
    return record_lines(
        orders, "client_a/transactions_", ".xml", XML_HEAD, body, rows_per_file, tasks
    )


# --- JSON -------------------------------------------------------------------------------------

JSON_HEAD = [
    "----- START OF FILE: transactions.json -----",
    "{",
    '  "client": "B {[", // who sent it',
    "  /* a block comment",
    '     over two lines: "transactions": [ { */',
    '  "transactions": [',
]
JSON_TAIL = ["  ],", '  "count": 1;', "}", "----- END OF FILE -----"]


def json_file(lines: DataFrame) -> DataFrame:
    """Close the document of every file."""
    made = F.array(
        *[
            F.struct(F.lit(10**15 + i).cast("bigint").alias("n"), F.lit(line).alias("line"))
            for i, line in enumerate(JSON_TAIL)
        ]
    )
    tails = (
        lines.select("file_name")
        .distinct()
        .select("file_name", F.explode(made).alias("r"))
        .select(
            "file_name",
            F.col("r.n").alias("file_row_number"),
            F.col("r.line").alias("raw_content"),
            F.lit(FILE_BYTES).cast("bigint").alias("file_bytes"),
        )
    )
    return lines.unionByName(tails)


def first_in_file(rows_per_file: int = ROWS_PER_FILE) -> Column:
    return F.col("_row") % rows_per_file == 0


def comma(rows_per_file: int = ROWS_PER_FILE) -> Column:
    return F.when(first_in_file(rows_per_file), "").otherwise(",")


def order_json(
    orders: DataFrame, rows_per_file: int = ROWS_PER_FILE, tasks: int | None = None
) -> DataFrame:
    """JSON lines: one transaction per order.

    Two items, or none for status P. The order id is null for urgent orders, the date for high
    ones; the quantity is negative for status F.
    """
    key = txt("o_orderkey")
    body = [
        cat("    ", comma(rows_per_file), '{ "id": "TXN-', key, '",   // as sent'),
        cat(
            '      "order": { "id": ',
            F.when(is_urgent(), "null").otherwise(cat('"ORD-', key, '"')),
            ', "date": ',
            F.when(is_high(), "null").otherwise(
                cat('"', txt(F.col("o_orderdate").cast("date")), '"')
            ),
            ",",
        ),
        cat(
            '        "customer": { "id": ', txt("o_custkey"), ', "name": " Lee {',
            txt("o_custkey"), '} ", "email": "a\\"b@example.com" } },',
        ),
        F.lit('      "items": ['),
        F.when(status("P"), "").otherwise(
            cat(
                '        { "sku": "SKU-', key, '", "description": "first", "qty": ',
                F.when(status("F"), "-3").otherwise("2"),
                ', "price": { "amount": 7.35, "currency": "USD" } },',
            )
        ),
        F.when(status("P"), "").otherwise(
            cat('        { "sku": "GIFT-', key, '", "qty": "1" } /* free */')
        ),
        F.lit("      ],"),
        cat(
            '      "payment": { "method": "', F.col("o_orderpriority"), '", "total": ',
            money("o_totalprice"), "} };",
        ),
    ]
    prefix = "client_b/transactions_"
    lines = record_lines(orders, prefix, ".json", JSON_HEAD, body, rows_per_file, tasks)
    return json_file(lines)


def event_json(events: DataFrame) -> DataFrame:
    """JSON lines: each event's props as a commented element."""
    body = [
        cat("  ", comma(), "// event"),
        cat('  { "id": ', txt("event_id"), ', "kind": "', F.col("event_type"), '", /* props */'),
        cat('    "props": ', F.col("props"), ";"),
        F.lit("  }"),
    ]
    return json_file(record_lines(events, "events_", ".json", JSON_HEAD, body))


# --- CSV --------------------------------------------------------------------------------------

FAR = 1_000_000_000_000  # row numbers of later duplicates start here


def customer_csv_b(customers: DataFrame) -> DataFrame:
    """customer_id, customer_name, email, segment, is_active; some rows sent again later.

    Machinery customers are sent again as null-heavy; furniture customers again under a new name.
    """
    key, seg = cat("C-CUST-", txt("c_custkey")), F.col("c_mktsegment")
    email = F.when(F.col("c_acctbal") < 0, "bad@@mail").otherwise(
        cat("c", txt("c_custkey"), "@example.com")
    )
    note = F.when(F.col("c_acctbal") < 0, "true   <-- invalid email").otherwise("true")
    lines = csv_file(
        customers,
        "client_b/customer.csv",
        [
            (F.col("c_custkey") + 4, csv_row(key, F.col("c_name"), email, seg, note)),
            (
                F.col("c_custkey") + FAR,
                F.when(seg == "FURNITURE", csv_row(key, cat("New ", F.col("c_name")), email, F.lit(""), F.lit("false <-- duplicate")))
                .when(seg == "MACHINERY", csv_row(key, F.lit(""), F.lit(""), F.lit(""), F.lit("false   <-- null-heavy row"))),
            ),
        ],
    )
    return csv_envelope(lines, "customer_id,customer_name,email,segment,is_active")


def customer_csv_a(suppliers: DataFrame) -> DataFrame:
    """customer_id, first, last, email, tier, source, is_active; short and nameless rows."""
    key = cat("CUST-A-", txt("s_suppkey"))
    low = F.col("s_acctbal") < 1000
    first = F.when(low, "").otherwise("Ann")
    lines = csv_file(
        suppliers,
        "customer.csv",
        [
            (
                F.col("s_suppkey") + 4,
                csv_row(
                    key, first, F.col("s_name"), F.lit("a@example.com"), F.lit(""), F.lit("Web"),
                    F.lit("true"),
                ),
            ),
            (
                F.col("s_suppkey") + FAR,
                F.when(F.col("s_acctbal") > 8000, csv_row(key, F.lit(""), F.lit("x"), F.lit(""), F.lit("false"))),
            ),
        ],
    )
    return csv_envelope(
        lines,
        "customer_id,first_name,last_name,email,loyalty_tier,signup_source,is_active",
    )


def product_csv(parts: DataFrame) -> DataFrame:
    """sku, product_name, category, unit_price, currency, is_active in two files.

    Promo parts are sent again with a negative price, large ones are anomalies, economy ones have
    a price that is not a number.
    """
    key = cat("SKU-", txt("p_partkey"))
    kind = F.col("p_type")
    price = F.when(kind == "ECONOMY", "n/a").otherwise(money("p_retailprice"))
    flag = F.when(kind == "LARGE", "false <-- anomaly").otherwise("true")
    file = F.when(F.col("p_size") > 25, "products.csv").otherwise("client_b/product.csv")
    lines = csv_file(
        parts,
        file,
        [
            (
                F.col("p_partkey") + 4,
                csv_row(key, F.col("p_name"), F.col("p_brand"), price, F.lit("USD"), flag),
            ),
            (
                F.col("p_partkey") + FAR,
                F.when(
                    kind == "PROMO",
                    csv_row(key, F.col("p_name"), F.lit(""), cat("-", price), F.lit("USD"), F.lit("true <-- duplicate")),
                ),
            ),
        ],
    )
    return csv_envelope(lines, "sku,product_name,category,unit_price,currency,is_active")


def order_csv(orders: DataFrame) -> DataFrame:
    """order_id, customer_id, order_date, order_status[, channel] in two files.

    Status P orders lie in the file without a channel column. Urgent orders have no date, high ones
    an invalid customer; low ones are sent again with a new status.
    """
    key, cust = cat("ORD-", txt("o_orderkey")), cat("C-CUST-", txt("o_custkey"))
    date = F.when(is_urgent(), "").otherwise(txt(F.col("o_orderdate").cast("date")))
    note = F.when(is_high(), "   <-- invalid customer").otherwise("")
    wide = csv_row(key, cust, date, F.col("o_orderstatus"), cat("Web", note))
    short = csv_row(key, cust, date, cat(F.col("o_orderstatus"), note))
    file = F.when(status("P"), "client_b/order.csv").otherwise("orders.csv")
    lines = csv_file(
        orders,
        file,
        [
            (F.col("o_orderkey") + 4, F.when(status("P"), short).otherwise(wide)),
            (
                F.col("o_orderkey") + FAR,
                F.when(
                    F.col("o_orderpriority") == "5-LOW",
                    csv_row(key, cust, date, F.lit("CLOSED <-- duplicate"), F.lit("")),
                ),
            ),
        ],
    )
    return csv_envelope(lines, "order_id,customer_id,order_date,order_status,channel")


def payment_csv(orders: DataFrame) -> DataFrame:
    """payment_id, order_id, payment_method, amount, currency, status; F orders are refunds."""
    key = txt("o_orderkey")
    state = F.when(status("F"), "REFUNDED <-- negative").when(status("P"), "CHARGEBACK").otherwise(
        "PAID"
    )
    amount = cat(F.when(status("O"), "").otherwise("-"), money("o_totalprice"))
    row = csv_row(
        cat("PAY-", key), cat("ORD-", key), F.col("o_orderpriority"), amount, F.lit("USD"), state
    )
    lines = csv_file(
        orders,
        "client_b/payments.csv",
        [
            (F.col("o_orderkey") + 4, row),
            (F.col("o_orderkey") + FAR, F.when(is_urgent(), row)),
        ],
    )
    return csv_envelope(lines, "payment_id,order_id,payment_method,amount,currency,status")
