import random
import time
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.operators import documents as d
from rawstar.plans import silver


def texts(df, *columns):
    return [tuple(r) for r in df.orderBy("file_name", "record_no").select(*columns).collect()]


def test_xml_records_across_chunks_and_comments(lines):
    content = [
        "junk before <!-- <Transaction>no</Transaction>",
        "<Transaction>no</Transaction>",
        "--> <Transaction><A>1</A>",
        "----- page 2 -----",
        "</Transaction > <!-- x --> <Transaction id='2'><A>2</A></Transaction><Transaction>",
        "<TransactionID>3</TransactionID>",
        "<!-- open",
        "still <!-- open",
        "closed --></Transaction></SalesData>",
        "garbage",
        None,
        "<Transaction>never closed",
        "more</Items>",
    ]
    expected = [
        "<Transaction><A>1</A></Transaction>",
        "<Transaction id='2'><A>2</A></Transaction>",
        "<Transaction><TransactionID>3</TransactionID></Transaction>",
    ]
    for rows in (1, 3, 100):
        got = d.cut_xml_records(lines(content), chunk_rows=rows)
        found = texts(got.filter("closed"), "record_no", "raw_content")
        assert found == list(enumerate(expected, start=1)), rows
        open_ = "".join(r["raw_content"] for r in got.filter("not closed and record_no = 4").collect())
        assert sorted(open_) == sorted("<Transaction>never closedmore</Items>"), rows
        assert got.filter("record_no is null").count() == 0, rows


@pytest.mark.parametrize("rows", [1, 2, 100])
def test_marks_broken_over_lines(lines, rows):
    content = [
        "<SalesData><Transac", "tion><A>1</A></Trans", "action><!-", "- <Transaction> -", "-><Transaction",
        " id='2'></Transaction", "></Sales", "Data>",
    ]
    got = d.cut_xml_records(lines(content), chunk_rows=rows)
    assert texts(got, "closed", "raw_content") == [
        (True, "<Transaction><A>1</A></Transaction>"),
        (True, "<Transaction id='2'></Transaction>"),
    ]


def one(i):
    return f"<Transaction><TransactionID>{i}</TransactionID></Transaction>"


XML_FAULTS = {
    "bad tag": ([one(1), "<Transaction><TransactionID>2</Transaction>", one(3)], ["1", "3"], 1),
    "no end tag": ([one(1), "<Transaction><TransactionID>2</TransactionID>", one(3)], ["1", "3"], 1),
    "truncated": ([one(1), "<Transaction><TransactionID>2</Tran"], ["1"], 1),
    "stray end tag": ([one(1), "</Items>", one(2)], ["1", "2"], 1),
    "stray end of a record": ([one(1), "</Transaction>", one(2)], ["1", "2"], 1),
    "other elements": ([one(1), "<Sum><n>1</n>", "<m/></Sum>", one(2)], ["1", "2"], 0),
}

JSON_FAULTS = {
    "bad literal": (['{"id": 1},', '{"id": nope},', '{"id": 3}', "]}"], [1, 3], 1),
    "truncated in a record": (['{"id": 1},', '{"id": 2, "x": {"y'], [1], 1),
    "truncated between records": (['{"id": 1},', '{"id": 2}'], [1, 2], 1),
    "no end of a record": (['{"id": 1},', '{"id": 2, "x": {"y": 2},', '{"id": 3}', "]}"], [1, 3], 1),
    "no end, same line": (['{"id": 1}, {"id": 2, "x": {"y": 2}, {"id": 3},{"id": 4}', "]}"], [1, 3, 4], 1),
    "two ends missing": (['{"id": 1},', '{"id": 2, "x": {"y": 2,', '{"id": 3}', "]}"], [1, 3], 1),
    "last has no end": (['{"id": 1},', '{"id": 2, "x": {"y": 2}', "]}"], [1], 1),
    "open array": (['{"id": 1},', '{"id": 2, "x": [{"y": 2}},', '{"id": 3}', "]}"], [1, 3], 1),
    "open object in an array": (['{"id": 2, "x": [{"y": 2, {"y": 3}]},', '{"id": 3}', "]}"], [3], 1),
    "one end too many": (['{"id": 1}},', '{"id": 2},', '{"id": 3}', "]}"], [1, 2, 3], 0),
    "wrong kind": (['{"id": 1},', '{"id": 2, "x": {"y": 2]},', '{"id": 3}', "]}"], [1], 1),
    "brackets in strings": (['{"id": 1, "s": "}]{["},', '{"id": 2, "s": "\\"}"}', "]}"], [1, 2], 0),
    "comment marks in strings": (
        ['{"id": 1, "u": "http://x.y/a"}, // b', '{"id": 2, "s": "/* "}, /* {', '*/ {"id": 3, "s": " */"}', "]}"],
        [1, 2, 3], 0,
    ),
    "value on the next line": (['{"id": 1, "o":', "", '{"a":', '[1]}}', ',{"id":', "2}]", "}"], [1, 2], 0),
    "deep": (['{"id": 1, "a": [[[[[[{"b": [7]}]]]]]]},', '{"id": 2}', "]}"], [1, 2], 0),
}


def faulty_files(lines, faults, head, tail):
    """One file per case, all in one relation."""
    files = [lines([*head, *content, *tail], file_name=name) for name, (content, _, _) in faults.items()]
    return reduce(DataFrame.unionByName, files)


def per_file(df, column):
    found = {}
    for r in df.orderBy("file_name", "record_no").collect():
        found.setdefault(r["file_name"], []).append(r[column])
    return found


@pytest.mark.parametrize("rows", [1, 2, 100])
def test_xml_faults_are_set_aside(lines, rows):
    df = faulty_files(lines, XML_FAULTS, ["<SalesData>"], ["</SalesData>"])
    good, bad = d.xml_elements(df, chunk_rows=rows)
    ids, faults = per_file(good.select("*", "t.TransactionID"), "TransactionID"), per_file(bad, "content")
    for name, (_, want, n) in XML_FAULTS.items():
        assert ids.get(name, []) == want, name
        assert (name in faults) == (n > 0), name
    good, _ = d.xml_elements(df, chunk_rows=rows, on_bad="document")
    assert set(per_file(good, "record_no")) == {k for k, (_, _, n) in XML_FAULTS.items() if n == 0}


@pytest.mark.parametrize("rows", [1, 2, 100])
def test_json_faults_are_set_aside(lines, rows):
    df = faulty_files(lines, JSON_FAULTS, ['{"transactions": ['], [])
    good, bad = d.json_elements(df, chunk_rows=rows, dedup=False)
    ids = per_file(good.withColumn("id", F.try_variant_get("t", "$.id", "int")), "id")
    faults = per_file(bad, "content")
    for name, (_, want, n) in JSON_FAULTS.items():
        assert ids.get(name, []) == want, name
        assert (name in faults) == (n > 0), name
    assert max(len(x) for all_ in faults.values() for x in all_) < 250
    if rows == 2:
        good, _ = d.json_elements(df, chunk_rows=rows, dedup=False, on_bad="document")
        assert set(per_file(good, "record_no")) == {k for k, (_, _, n) in JSON_FAULTS.items() if n == 0}


@pytest.mark.parametrize("rows", [1, 2, 100])
def test_one_bad_record_of_fifty(lines, rows):
    records = [f'{{"id": {i}, "order": {{"id": "O{i}"}}, "items": [{{"q": 1}}, {{"q": 2}}]}}' for i in range(1, 51)]
    records[1] = records[1][:-1]
    df = lines(['{"transactions": [', *[r + "," for r in records[:-1]], records[-1], "]}"])
    good, bad = d.json_elements(df, chunk_rows=rows, dedup=False)
    numbered = good.select("record_no", F.try_variant_get("t", "$.id", "int").alias("id"))
    assert [tuple(r) for r in numbered.orderBy("record_no").collect()] == [
        (i, i) for i in range(1, 51) if i != 2
    ]
    assert {r["record_no"] for r in bad.collect()} == {2}


def test_json_records_across_chunks(lines):
    content = [
        "--- start",
        '{ "note": "transactions", "refunds": [ {"id": 0} ],',
        "/* [ {",
        '"transactions": [ */ "transactions": [ {"id": 1, "s": "a{\\"["}, // {',
        '{"id": 2,',
        '"items": [ {"q": 1},',
        "{} ] }, 7, [ {} ],",
        None,
        '{"id": 3} ]; , "later": [ {"id": 4} ]',
        "}",
        "---- end",
    ]
    for rows in (1, 3, 100):
        got = d.cut_json_records(lines(content), chunk_rows=rows).select(
            "file_name", "record_no", F.try_parse_json("raw_content").alias("v")
        )
        ids = [
            r["id"]
            for r in got.select("record_no", F.try_variant_get("v", "$.id", "int").alias("id"))
            .orderBy("record_no")
            .collect()
        ]
        assert ids == [1, 2, None, 3], rows


def test_json_long_string_and_unbalanced_file(lines):
    long = "x\\\"" * 20_000
    content = ['{ "transactions": [', '{"id": "' + long + '"},', '{"id": 2, "open": {', "nothing more"]
    got = d.cut_json_records(lines(content), chunk_rows=2).select("*", F.length("raw_content").alias("n"))
    assert texts(got.filter("closed"), "n") == [(len(long) + 10,)]
    assert texts(got.filter("not closed"), "record_no") == [(2,)]


@pytest.mark.parametrize("seed", range(2))
def test_both_ways_agree_on_random_files(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for f in range(6):
        n = 0
        for t in range(rnd.randint(0, 8)):
            text = f"<Transaction><TransactionID>{f}-{t}</TransactionID><Items>" + "".join(
                f"<Item><SKU>s{i}</SKU></Item>" for i in range(rnd.randint(0, 3))
            ) + "</Items></Transaction>"
            noise = rnd.choice(["", "<!-- c -->", "<!-- <Transaction></Transaction> -->", " text "])
            text = noise + text
            while text:
                cut = text.find(">", rnd.randint(0, 40)) + 1 or len(text)
                n += 1
                rows.append((f"f{f}", n, text[:cut]))
                text = text[cut:]
    lines = spark.createDataFrame(rows, "file_name string, file_row_number bigint, raw_content string")

    def items(elements, bad):
        assert bad.count() == 0
        flat = silver.flatten_xml(elements)
        return sorted(
            tuple(r)
            for r in flat.select("file_name", "record_no", "transaction_id", "item_no", "sku").collect()
        )

    whole = items(*d.xml_document_elements(lines))
    assert whole == items(*d.xml_elements(lines, chunk_rows=4)) != []
    assert whole == items(*d.xml_elements(lines))


def test_unparsable_documents_are_set_aside(lines):
    good = "<Transaction><TransactionID>1</TransactionID></Transaction>"
    broken = "<Transaction><TransactionID>2</Transaction>"
    elements, bad = d.xml_document_elements(lines([good, broken]))
    assert elements.count() == 0 and bad.first()["record_no"] is None
    elements, bad = d.xml_elements(lines([good, broken]))
    assert elements.count() == 1 and bad.first()["content"] == broken
    with pytest.raises(Exception, match="(?i)malformed"):
        d.xml_elements(lines([good, broken]), strict=True)[0].collect()


def test_json_documents(lines):
    def run(content, **kw):
        df = lines(content).withColumn("load_dt", F.lit("2024-01-01").cast("timestamp_ntz"))
        return d.json_elements(df.unionByName(df), **kw)

    ok = ["----- x", '{"transactions": {"a": {"id": 1}}}; // tail', ""]
    elements, bad = run(ok)
    assert elements.count() == 1 and bad.count() == 0
    elements, bad = run(['{"transactions": [{"id": "http://x"}]} // y', ""])
    assert elements.count() == 1 and bad.count() == 0
    elements, bad = run(['{"refunds": {"x": {"id": 1}}, "transactions":', '{"a": {"id": 2}, "b": {}}}'], chunk_rows=1)
    assert elements.count() == 2 and bad.count() == 0


def test_empty_elements(lines):
    xml = (
        "<Transaction><TransactionID> a </TransactionID><Items><Item><Quantity></Quantity>"
        '<UnitPrice currency="EUR"></UnitPrice></Item><Item/></Items>'
        '<Payment><Amount currency="USD"> </Amount></Payment></Transaction>'
    )
    elements, _ = d.xml_elements(lines([xml]))
    got = silver.standardise_xml(silver.flatten_xml(elements)).orderBy("item_no").collect()
    assert [(r["quantity"], r["currency"], r["payment_amount"]) for r in got] == [
        (0.0, "EUR", 0.0), (None, None, 0.0),
    ]


@pytest.mark.parametrize("kind", ["xml", "json"])
def test_text_without_marks_takes_linear_time(lines, kind):
    def seconds(n):
        start = time.perf_counter()
        if kind == "xml":
            body = ["<Transaction><TransactionID>1</TransactionID></Transaction>", "x" * n]
            cut = d.cut_xml_records(lines(body), chunk_rows=10)
        else:
            cut = d.cut_json_records(lines(['{"transactions": [', '{"id": "' + "x" * n + '"}]}']), chunk_rows=10)
        assert cut.count() == 1
        return time.perf_counter() - start

    seconds(10)
    short, long = min(seconds(100_000) for _ in range(2)), min(seconds(1_000_000) for _ in range(2))
    assert long < 4 * short + 1  # most of either is starting jobs
