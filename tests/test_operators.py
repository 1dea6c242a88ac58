import pytest
from pyspark.sql import functions as F

from rawstar import schemas
from rawstar.functions import text
from rawstar.operators import cells, dedup, gaps, members
from rawstar.plans import rules


def values(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_text(spark):
    lit = F.lit
    r = one(
        spark,
        empty=text.cell_value(lit("")), quotes=text.cell_value(lit('""')),
        inner=text.cell_value(lit('a""b')), token=text.first_token(lit("true   <-- x")),
        name=text.full_name(lit("b"), lit("a")), no_name=text.full_name(lit(None), lit("a")),
        line=text.unenclosed(lit('"a,"b""')), quote=text.unenclosed(lit('"')),
        cr=text.without_cr(lit("a \r")), number=text.to_double(lit(" -1.5 ")),
        bad=text.to_double(lit("x")), date=text.to_date(lit("2025-13-01")),
        zero=text.amount_or_zero(lit("  ")), absent=text.amount_or_zero(lit(None).cast("string")),
        size=text.amount_or_zero(lit("-3")), dashed=text.strip_dashed(lit("a-----b-----c")),
        root=text.strip_root(lit("<S a='1'>x</S><Sx/>"), "S"),
        dash_lines=text.strip_dash_lines(lit("--- a\nb\n-c\n--d")),
        comments=text.strip_line_comments(lit("a // b\nc // d")),
        urls=text.strip_line_comments(lit("http://x // b\n"), keep_urls=True),
        block=text.strip_block_comments(lit("a/* b\n*/c")), semi=text.strip_semicolons(lit("a;b;")),
        path=text.relative_name(text.decoded_path(lit("file:///d/in/Client%20B/a+b.csv")), "/d/in/"),
        s3=text.relative_name(lit("s3a://bucket/in/x.csv"), "s3a://bucket/in"),
        norm=text.normalised_name(lit("Client B/Customer.CSV.gz")),
        like=text.none_like(lit(None).cast("string"), "%x%"),
    )
    assert r.asDict() == dict(
        empty=None, quotes="", inner="ab", token="true", name="b a", no_name=None, line='a,"b"',
        quote='"', cr="a ", number=-1.5, bad=None, date=None, zero=0.0, absent=None, size=3.0,
        dashed="ac", root="x", dash_lines="\nb\n-c\n", comments="a \nc // d", urls="http://x \n",
        block="ac", semi="ab", path="Client B/a+b.csv", s3="x.csv", norm="client_b/customer.csv",
        like=None,
    )


def test_strip_root_is_a_plain_pattern(spark):
    # Any tag that begins with the root name goes, as the pattern says.
    assert one(spark, x=text.strip_root(F.lit("<SalesDataX>1"), "SalesData"))["x"] == "1"


def test_cells_pivot_and_positions_agree(lines):
    df = lines(["a,,c,", "x", None, ',""q""'])
    split = cells.split_cells(df)
    assert split.count() == 4 + 1 + 2
    positions = {"one": 1, "two": 2, "four": 4}
    keys = ["file_name", "file_row_number"]
    pivoted = cells.pivot_cells(split, positions, keys)
    mapped = cells.positional_map(df.filter("raw_content IS NOT NULL"), positions)
    cols = ["file_row_number", "one", "two", "four"]
    assert values(pivoted, *cols) == values(mapped, *cols)
    assert values(mapped, *cols) == [(1, "a", None, None), (2, "x", None, None), (4, None, "q", None)]


def test_quoted_map(lines):
    got = cells.quoted_map(lines(['1,"a, b",c', "2,,"]), {"id": 1, "text": 2})
    assert values(got, "id", "text") == [("1", "a, b"), ("2", None)]


def test_sentinels_and_headers(lines):
    df = lines(["----- start of file: x", "h1,h2", None, "a", "----- END OF FILE -----", "b"])
    kept = cells.drop_sentinels(df, header_rows=(2,))
    assert values(kept, "raw_content") == [("a",), ("b",)]


def test_route(lines):
    df = lines(["a"], "customer.csv").unionByName(lines(["b"], "client_b/my_product_1.csv"))
    assert values(cells.route(df, file_name="customer.csv"), "raw_content") == [("a",)]
    assert values(cells.route(df, pattern="%product%.csv%"), "raw_content") == [("b",)]


def test_keep_latest_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), (None, 5, "n"), (None, 6, "m"), ("b", 1, "z")],
        "k string, n int, v string",
    )
    got = dedup.keep_latest(df, ["k"], [F.col("n").desc()])
    assert values(got) == [("a", 2, None), ("b", 1, "z"), (None, 6, "m")]
    assert values(dedup.keep_latest(got, ["k"], [F.col("n").desc()])) == values(got)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_reject_flagged_splits_everything(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "a bad b"), (3, None)], "id int, flag string")
    kept, rejected = dedup.reject_flagged(df, {"flag": ["%bad%"]})
    assert values(kept, "id") == [(1,)] and values(rejected, "id") == [(2,), (3,)]


def test_insert_missing(spark):
    target = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "k string, v double")
    source = spark.createDataFrame([("a", 9), ("b", 1), ("b", 2), (None, 4)], "k string, v int")
    got = members.insert_missing(target, source, "k", {"k": "UNKNOWN", "v": 0})
    assert values(got) == sorted(
        [("a", 1.0), ("a", 2.0), (None, 3.0), ("UNKNOWN", 0.0), ("b", 1.0), ("b", 2.0), (None, 4.0)],
        key=str,
    )
    again = members.insert_missing(got, spark.createDataFrame([("b", 5)], "k string, v int"), "k", {"k": "UNKNOWN", "v": 0})
    assert values(again) == values(got)


def test_anti_gap_matches_the_joined_form(spark):
    orders = spark.createDataFrame(
        [("1", "c"), ("2", "c"), ("2", "c"), ("3", "c"), (None, "c"), (None, "d")], "k string, c string"
    )
    facts = spark.createDataFrame([("1",), ("1",), (None,)], "k string")
    paid = spark.createDataFrame([("2", 1.5), ("2", 2.0), ("3", None), (None, 7.0), ("1", 9.0)], "k string, a double")
    got = gaps.anti_gap(orders, facts, paid, "k", ["k", "c"], "a", "paid")
    for name, df in [("o", orders), ("f", facts), ("p", paid)]:
        df.createOrReplaceTempView(name)
    want = spark.sql(
        "SELECT o.k, o.c, coalesce(sum(p.a), 0) AS paid FROM o LEFT JOIN f ON o.k = f.k "
        "LEFT JOIN p ON o.k = p.k WHERE f.k IS NULL GROUP BY o.k, o.c"
    )
    assert values(got) == values(want)
    assert ("2", "c", 7.0) in values(got)


TXN = schemas.TRANSACTION_DDL


def test_inferred_members(spark):
    def t(tid, order, date, cust, name):
        return (tid, order, date, cust, name, "e", "S", "d", 1.0, "USD", "Card", 2.0)

    txn = spark.createDataFrame(
        [
            t("1", "O1", "2025-01-01", "C1", "A"),
            t("2", "O1", None, "C2", "B"),
            t("3", "O2", "2025-01-01", "C1", "A2"),
            t("4", "UNKNOWN", None, "UNKNOWN", "x"),
        ],
        TXN.replace("order_date date", "order_date string"),
    ).withColumn("order_date", F.col("order_date").cast("date"))
    none = spark.createDataFrame([], schemas.CUSTOMER_DDL)
    both = rules.infer_customers(none, txn)
    assert values(both, "customer_id", "customer_name") == [
        ("C1", "A"), ("C1", "A2"), ("C2", "B"), ("UNKNOWN", "UNKNOWN"),
    ]
    assert rules.infer_customers(none, txn, unique_key=True).count() == 3
    orders = rules.infer_orders(spark.createDataFrame([], schemas.ORDER_DDL), txn)
    assert values(orders, "order_id", "customer_id") == [("O1", "C2"), ("O2", "C1"), ("UNKNOWN", "UNKNOWN")]
    assert members.orphans(txn, orders, "order_id", "order_id").count() == 0


@pytest.mark.parametrize("hot", ["k0", None])
def test_a_hot_key_gives_whole_results(spark, hot):
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    df = spark.range(0, 30_000, 1, 8).select(key.alias("k"), "id")
    assert dedup.keep_latest(df, ["k"], [F.col("id").desc()]).count() == 20_001
    known = spark.createDataFrame([("k1", 1)], "k string, id bigint")
    assert members.insert_missing(known, df, "k").count() == 30_000


def test_casts_look_at_the_shape(spark):
    odd = ["1d", "NaN", "Infinity", "1,5", "", " 2.50 ", "-3", ".5", "1e3", "2025", "2025-01", "2025-1-2"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    numbers = [r[0] for r in df.select(text.to_double("t")).collect()]
    assert numbers == [None] * 5 + [2.5, -3.0, 0.5, 1000.0, 2025.0, None, None]
    days = [r[0] for r in df.select(text.to_date("t").cast("string")).collect()]
    assert days == [None] * 11 + ["2025-01-02"]
    for bad, cast in (("1d", text.to_double), ("x", text.to_double), ("2025", text.to_date)):
        with pytest.raises(Exception, match="not a|CAST_INVALID_INPUT"):
            spark.createDataFrame([(bad,)], "t string").select(cast("t", strict=True)).collect()
