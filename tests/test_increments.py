import re

import landing as files
import pytest

from rawstar import Lake, PipelineOptions, run_pipeline, schemas
from rawstar.plans import increments
from rawstar.plans.increments import Increments
from rawstar.plans.pipeline import build_silver

SILVER = schemas.SILVER_TABLES | schemas.REJECT_TABLES
HEADER = "order_id,customer_id,order_date,order_status,channel"


def silver(lake, batch):
    """All Silver tables of a batch, rows in any order, repeated ones included."""
    return {t: sorted(map(repr, lake.silver(t, batch).collect())) for t in SILVER}


def order_file(path, *rows):
    path.write_text(files.envelope("orders", HEADER, list(rows)))


@pytest.fixture
def site(spark, tmp_path):
    files.write(tmp_path / "landing")
    return Lake(spark, str(tmp_path / "lake")), tmp_path / "landing"


def build_all(lake, batch, **options):
    """A full rebuild beside what is there."""
    build_silver(lake, batch, PipelineOptions(incremental=False, **options))
    return silver(lake, batch)


def test_later_batches_read_their_own_lines_only(site):
    lake, landing = site
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B1")
    order_file(landing / "more_orders.csv", "ORD-1,CUST-1,2026-01-01,NEW,Web", "ORD-77,CUST-1,2026-01-02,NEW,Web")
    (landing / "extra.xml").write_text(
        "<SalesData><Transaction><TransactionID>T-9</TransactionID><Order><OrderID>ORD-77</OrderID>"
        "</Order><Items><Item><SKU>SKU-1</SKU><Quantity>x</Quantity></Item></Items></Transaction></SalesData>"
    )
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B2")
    got = silver(lake, "B2")
    ids = {r["order_id"] for r in lake.silver("dim_order", "B2").collect()}
    assert {"ORD-77", "ORD-4", "C-ORD-1"} <= ids
    assert got == build_all(lake, "FULL")
    parsed = lake.read("silver", "items_xml", schemas.PARSED_TABLES["xml"]["items_xml"], "B2")
    assert {r["transaction_id"] for r in parsed.collect()} == {"T-9"}

    # the lines of the first batch are not needed any more
    (landing / "third.json").write_text('{"transactions": [{"id": "C-T-8", "items": [{"sku": "SKU-1"}]}]}')
    for table in schemas.RAW_TABLES.values():
        for batch in ("B1", "B2"):
            lake.truncate("bronze", table, batch)
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B3")
    last = silver(lake, "B3")
    assert len(last["slv_transactions"]) == len(got["slv_transactions"]) + 1
    assert last["dim_order"] != [] and last["csv_rejects"] == got["csv_rejects"]


def test_only_partitions_of_pending_loads_are_read(site):
    lake, landing = site
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B1")
    order_file(landing / "more_orders.csv", "ORD-1,CUST-1,2026-01-01,NEW,Web")
    from rawstar.sources.ingest import ingest

    ingest(lake, str(landing), "B2")
    pending = Increments(lake, "B2").pending("csv")
    assert [r["file_name"] for r in pending.collect()] == ["more_orders.csv"]
    lines = lake.lines_of("csv", pending)
    assert {r["batch_id"] for r in lines.select("batch_id").distinct().collect()} == {"B2"}
    lake.spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        lake.spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Exchange" not in plan and "Join" not in plan
    assert re.search(r"PartitionFilters: \[[^\]]*\(batch_id#\d+ = B2\)", plan)
    assert Increments(lake, "B2").pending("xml").isEmpty()
    assert lake.lines_of("xml", Increments(lake, "B2").pending("xml")).isEmpty()


def test_a_replaced_file_gives_way_to_the_runner_up(site):
    lake, landing = site
    order_file(landing / "a_orders.csv", "ORD-50,CUST-1,2025-05-01,EARLY,Web")
    order_file(landing / "b_orders.csv", "ORD-51,CUST-1,2025-05-01,X,Web", "ORD-50,CUST-1,2025-05-02,LATE,Web")

    def status(batch):
        found = lake.silver("dim_order", batch).filter("order_id = 'ORD-50'").collect()
        return [r["order_status"] for r in found]

    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B1")
    assert status("B1") == ["LATE"]
    order_file(landing / "b_orders.csv", "ORD-51,CUST-1,2025-05-01,Y,Web")
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B2")
    assert status("B2") == ["EARLY"]
    assert silver(lake, "B2") == build_all(lake, "FULL")
    order_file(landing / "b_orders.csv", "ORD-51,CUST-1,2025-05-01,Z,Web", "ORD-50,CUST-1,2025-05-03,NEWEST,Web")
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B3")
    assert status("B3") == ["NEWEST"]


def test_failed_and_repeated_builds(site, monkeypatch):
    lake, landing = site
    write = Lake.write

    def broken(self, df, layer, table, *args, **kwargs):
        if table == "items_json":
            raise OSError("disk")
        return write(self, df, layer, table, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(Lake, "write", broken)
        with pytest.raises(OSError):
            run_pipeline(lake.spark, str(landing), lake.root, batch_id="B1")
    # what the failed build has kept does not count, its lines do
    order_file(landing / "more_orders.csv", "ORD-1,CUST-1,2026-01-01,NEW,Web")
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B2")
    got = silver(lake, "B2")
    # the second batch again: it parses the lines of the first one again, too
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B2")
    assert silver(lake, "B2") == got
    loads = Increments(lake, "B2").parsed_files().filter("batch_id = 'B2'")
    assert {r["load_batch"] for r in loads.collect()} == {"B1", "B2"}
    assert build_all(lake, "FULL") == got


def test_options_that_change_the_parse(site):
    lake, landing = site
    run_pipeline(lake.spark, str(landing), lake.root, batch_id="B1")
    spoiled = PipelineOptions(on_bad="document")
    build_silver(lake, "B2", spoiled)
    assert silver(lake, "B2") == build_all(lake, "FULL", on_bad="document")
    assert Increments(lake, "X", "document").pending("xml").isEmpty()
    assert not Increments(lake, "X", "record", strict=True).pending("xml").isEmpty()
    build_silver(lake, "B3", PipelineOptions())
    assert silver(lake, "B3") == silver(lake, "B1")


def test_nothing_loaded(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    build_silver(lake, "B1", PipelineOptions())
    assert lake.silver("slv_transactions", "B1").isEmpty()
    assert lake.read("silver", increments.TABLE, schemas.PARSED_FILES_DDL).isEmpty()
