"""What keeps the file queries from growing faster than their input."""

from __future__ import annotations

import gzip
import time
from pathlib import Path

import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rawstar.operators import documents
from rawstar.plans import catalog_files, render
from rawstar.sources.lake import Lake, Staging

TRANSACTION = "<Transaction><TransactionID>{}</TransactionID><Items><Item><SKU>s</SKU></Item></Items></Transaction>"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_xml_is_parsed_once(lines):
    texts = ["<SalesData>", *[TRANSACTION.format(i) for i in range(3)], "</SalesData>"]
    for made in (documents.xml_elements, documents.xml_document_elements):
        elements, _ = made(lines(texts))
        assert _plan(elements).count("from_xml") <= 1 and _plan(elements).count("xmltostructs") <= 1
        assert [r[0] for r in elements.select("t.TransactionID").orderBy("record_no").collect()] == ["0", "1", "2"]


def test_lines_that_follow_each_other_are_one_row_before_the_shuffle(spark):
    rows = [("f", i, None if i == 3 else f"l{i}") for i in (1, 2, 3, 4, 9, 10)] + [("g", 11, "x"), ("g", 13, None)]
    made = spark.createDataFrame(rows, "file_name string, file_row_number bigint, raw_content string").coalesce(1)
    runs = made.mapInArrow(documents._runs("|"), made.select("file_name", "file_row_number", "raw_content").schema)
    found = {(r[0], r[1]): r[2] for r in runs.collect()}
    assert found == {("f", 1): "l1|l2|l4", ("f", 9): "l9|l10", ("g", 11): "x", ("g", 13): None}
    whole = {r[0]: r[1] for r in documents.concat_lines(made, ["file_name"], "raw_content", "|").collect()}
    assert whole == {"f": "l1|l2|l4|l9|l10", "g": "x"}
    backwards = made.orderBy(F.col("file_row_number").desc())
    assert {r[0]: r[1] for r in documents.concat_lines(backwards, ["file_name"], "raw_content", "|").collect()} == whole


def test_json_lines_are_sorted_behind_the_shuffle_only(lines):
    texts = ['{"transactions": [', '{"id": 1}', "]}"]
    made = lines(texts).withColumn("load_dt", F.lit("2024-01-01").cast("timestamp_ntz"))
    elements, _ = documents.json_document_elements(made.unionByName(made))
    plan = elements._jdf.queryExecution().sparkPlan().toString()
    physical = elements._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert physical.rindex("Exchange") > physical.rindex("Sort")
    assert elements.count() == 1


def test_ends_of_comments(spark):
    texts = ["a", "<!-- a", "<!-- a --> b", "a -->", "<!-- a --> <!-->", "<!--->", "<!---->", "--> <!--"]
    made = spark.createDataFrame([(t,) for t in texts], "c string")
    found = [r[0] for r in made.select(documents._ends_in_comment(F.col("c"))).collect()]
    assert found == [None, True, False, False, True, True, False, True]


def test_tails_of_chunks(spark):
    texts = ["a<b", "a<b>", "a-", "a---", "<a -", "", "a<b>-", "<"]
    made = spark.createDataFrame([(t,) for t in texts], "c string")
    found = [r[0] for r in made.select(documents._xml_tail("c")).collect()]
    assert found == ["<b", "", "-", "--", "<a -", "", "-", "<"]


def test_rendering_takes_more_tasks_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(render, "ROWS_PER_TASK", 5)
    made = render.record_lines(spark.range(100), "f", ".txt", ["head"], [F.col("id").cast("string")])
    assert made.select(F.spark_partition_id()).distinct().count() == 20


def test_what_records_were_cut_from_is_emptied(spark, lines, tmp_path, monkeypatch):
    made = []

    class Seen(Staging):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    monkeypatch.setattr(documents, "Staging", Seen)
    texts = ["<SalesData>", *[TRANSACTION.format(i) for i in range(3)], "</SalesData>"]
    elements, _ = documents.xml_elements(lines(texts), stage=Staging(spark, str(tmp_path / "stage")))
    assert elements.count() == 3
    assert sum(spark.read.schema(s).parquet(p).count() for x in made for p, s in x.made) == 0
    assert made and made[0].made


@pytest.mark.parametrize("kind", ["xml", "json"])
def test_a_reader_holds_few_chunks_of_text(spark, lines, monkeypatch, kind):
    made = []

    class Seen(Staging):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    monkeypatch.setattr(documents, "Staging", Seen)
    monkeypatch.setattr(documents, "CHUNK_GROUP", 3)
    monkeypatch.setattr(documents, "PIECE_GROUP", 5)
    monkeypatch.setattr(documents, "_forget", lambda *args: None)  # else they are emptied before they are looked at
    if kind == "xml":
        texts = ["<SalesData>", *[TRANSACTION.format(i) for i in range(60)], "</SalesData>"]
        elements, _ = documents.xml_elements(lines(texts), chunk_rows=1)
    else:
        texts = ['{"transactions": [', *[f'{{"id": {i}}},' for i in range(60)], "]}"]
        elements, _ = documents.json_elements(lines(texts), chunk_rows=1, dedup=False)
    assert elements.count() == 60
    largest = {}
    for path, schema in made[0].made:
        if {"raw_content", "segments"} & set(schema.names):
            files = ds.dataset(path.removeprefix("file://"), format="parquet").get_fragments()
            largest[path] = max((g.num_rows for f in files for g in f.row_groups), default=0)
    assert 3 in largest.values() and 5 in largest.values() and max(largest.values()) <= 5


def test_a_task_writes_a_file_in_order(spark, tmp_path):
    made = spark.range(0, 20_000, 1, 2).select(F.nullif(F.col("id").cast("string"), F.lit("7")).alias("raw_content"))
    landing = str(tmp_path / "landing")
    catalog_files.write_tasks(made, landing, str(tmp_path / "spool"), "client_a/t_{}_0.xml".format)
    for task in (0, 1):
        text = (tmp_path / "landing" / "client_a" / f"t_{task}_0.xml").read_text().splitlines()
        assert text == ["" if i == 7 else str(i) for i in range(10_000 * task, 10_000 * (task + 1))]


def test_a_compressed_landing_tree_has_the_same_lines(spark, tmp_path):
    landing, spool = tmp_path / "landing", str(tmp_path / "spool")
    rows = [(f"client_b/{f}.csv", n, f"{f}{n}" if n != 2 else None) for f in "ab" for n in (3, 1, 2)]
    made = spark.createDataFrame(rows, "file_name string, file_row_number bigint, raw_content string")
    catalog_files.write_landing(made, str(landing), spool, "gzip")
    named = "client_a/t_{}_0.xml".format
    catalog_files.write_tasks(made.coalesce(1), str(landing), f"{spool}-x", named, "gzip")
    found = {str(p.relative_to(landing)): gzip.open(p, "rt").read() for p in landing.rglob("*.gz")}
    assert found == {
        "client_b/a.csv.gz": "a1\n\na3\n",
        "client_b/b.csv.gz": "b1\n\nb3\n",
        "client_a/t_0_0.xml.gz": "a3\na1\n\nb3\nb1\n\n",
    }


def test_the_landing_tree_of_the_pipeline_is_compressed(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog_files, "write_landing", lambda lines, landing, spool, codec="none": seen.append(codec))
    monkeypatch.setattr(catalog_files, "write_tasks", lambda *args: seen.append(args[-1]))
    columns = {
        "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_name string, s_acctbal double",
        "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate date, o_orderpriority string",
        "lineitem": "l_orderkey bigint",
    }
    for name, ddl in columns.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    catalog_files._landing(spark, str(tmp_path))
    assert seen == ["gzip", "gzip"]


def test_what_a_write_has_shuffled_is_deleted(spark, tmp_path):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {p.name for d in dirs for p in Path(d).rglob("shuffle_*.data")}

    before = shuffled()
    rows = Staging(spark, str(tmp_path / "stage"))(spark.range(1000).repartition(3, "id"))
    Lake(spark, str(tmp_path / "lake")).write(rows.groupBy("id").count(), "silver", "t", "B")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 1000


def test_tables_are_stored_in_little_space(spark, tmp_path):
    rows = spark.range(0, 100_000, 1, 1).select("id", F.format_string("line %08d", "id").alias("line"))
    Lake(spark, str(tmp_path / "lake")).write(rows, "bronze", "t", "B")
    for part in (tmp_path / "lake").rglob("*.parquet"):
        columns = [pq.read_metadata(part).row_group(0).column(i) for i in range(2)]
        assert {c.compression for c in columns} == {"ZSTD"}
        assert columns[0].total_compressed_size < 20_000 and columns[1].total_compressed_size < 200_000


def test_chunks_are_emptied_once_they_are_cut(spark, lines, tmp_path):
    def first_table(stage):
        path, schema = stage.made[0]
        return spark.read.schema(schema).parquet(path)

    texts = ["<SalesData>", *[TRANSACTION.format(i) for i in range(3)], "</SalesData>"]
    stage = Staging(spark, str(tmp_path / "xml"))
    records = documents.cut_xml_records(lines(texts), chunk_rows=2, stage=stage)
    assert first_table(stage).columns == ["file_name", "chunk", "raw_content"] and first_table(stage).count() == 0
    assert records.filter("closed").count() == 3
    texts = ['{"transactions": [', *[f'{{"id": {i}}},' for i in range(3)], "]", "{"]
    stage = Staging(spark, str(tmp_path / "json"))
    records = documents.cut_json_records(lines(texts), chunk_rows=2, stage=stage)
    assert "segments" in first_table(stage).columns and first_table(stage).count() == 0
    assert records.filter("closed").count() == 3
    assert "brackets left open" in records.filter("NOT closed").first()["raw_content"]
