import datetime

import landing as files
import pytest
from pyspark.sql import functions as F

from rawstar import Lake, PipelineOptions, run_pipeline
from rawstar.plans.control import BatchControl, EmptyBatchError
from rawstar.sources.ingest import reset_ledger

D = datetime.date


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipe")
    files.write(root / "landing")
    batch = run_pipeline(
        spark, str(root / "landing"), str(root / "lake"), batch_id="BATCH_A", database_prefix="t"
    )
    return Lake(spark, str(root / "lake")), batch, root


def rows(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_batch_is_counted_and_closed(built):
    lake, batch, _ = built
    state = BatchControl(lake).metrics(batch).first()
    counts = files.RAW_ROWS
    assert (state["csv_rows"], state["json_rows"], state["xml_rows"]) == (
        counts["csv"], counts["json"], counts["xml"],
    )
    assert state["total_rows"] == sum(counts.values())
    assert state["status"] == "SUCCESS"


def test_customers(built):
    lake, batch, _ = built
    got = rows(lake.silver("dim_customers", batch), "customer_id", "customer_name", "email", "segment", "loyalty_tier", "is_active")
    u = "UNKNOWN"
    assert got == {
        ("CUST-1", "Stone Ada", "ada@example.com", u, "SILVER", "true"),
        ("CUST-2", u, u, u, "BRONZE", "false"),
        ("CUST-3", "Reed Bo", "bo@@mail..test", u, u, "true"),
        ("C-CUST-1", "Cal Fox", "cal@example.com", "VIP", u, "true"),
        ("C-CUST-2", "Dee Ray", u, "RETAIL", u, "true"),
        ("C-CUST-3", u, u, u, u, "false"),
        (u, u, u, u, u, u),
        ("CUST-5", "Orr Hal", u, u, u, u),
        ("CUST-6", "Poe Ida", u, u, u, u),
        ("C-CUST-9", u, u, u, u, u),
    }


def test_products(built):
    lake, batch, _ = built
    got = rows(lake.silver("dim_product", batch), "sku", "product_name", "unit_price", "is_active")
    u = "UNKNOWN"
    assert got == {
        ("SKU-1", "Mouse", 25.5, "true"),
        ("SKU-2", "Lamp", None, "true"),
        ("C-SKU-1", "Watch", -5.0, "true"),
        (u, u, 0.0, u),
        ("SKU-4", "Pen", None, u),
        ("SKU-5", "Cup", None, u),
        ("C-SKU-9", "Web {cam} [x]", None, u),
    }


def test_orders(built):
    lake, batch, _ = built
    got = rows(lake.silver("dim_order", batch), "order_id", "customer_id", "order_date", "order_status", "channel")
    u = "UNKNOWN"
    assert got == {
        ("ORD-1", "CUST-1", D(2025, 1, 1), "COMPLETED", "Web"),
        ("ORD-3", "CUST-2", None, "PENDING", "Mobile"),
        ("ORD-4", "CUST-3", D(2025, 1, 4), "CANCELLED", "Web"),
        ("C-ORD-1", "C-CUST-1", D(2025, 2, 1), "COMPLETED", u),
        ("C-ORD-2", "C-CUST-2", D(2025, 2, 2), "PENDING", u),
        (u, u, None, u, u),
        ("ORD-2", u, D(2025, 1, 2), u, u),
        ("ORD-5", "CUST-2", None, u, u),
        ("ORD-7", "CUST-6", D(2025, 1, 8), u, u),
    }


def test_payments(built):
    lake, batch, _ = built
    got = rows(lake.silver("dim_payments", batch), "payment_id", "order_id", "payment_method", "amount", "status")
    u = "UNKNOWN"
    assert got == {
        ("PAY-1", "C-ORD-1", "Card", 100.0, "PAID"),
        ("PAY-2", "C-ORD-2", "Card", 20.25, "REFUNDED"),
        ("PAY-3", "C-ORD-2", "Card", -2.0, "CHARGEBACK"),
        (u, u, u, 0.0, u),
        (u, "ORD-1", "Card", 60.0, u),
        (u, "ORD-2", "Cash", 3.0, u),
        (u, "ORD-5", u, 0.0, u),
        (u, "ORD-7", "Cash", 6.0, u),
    }


FACTS = {
    ("T-1", "ORD-1", D(2025, 1, 1), "CUST-1", "SKU-1", 2.0, 60.0),
    ("UNKNOWN", "ORD-5", None, "CUST-2", "UNKNOWN", 0.0, 0.0),
    ("T-2", "ORD-2", D(2025, 1, 2), "UNKNOWN", "SKU-4", 3.0, 3.0),
    ("T-3", "ORD-7", D(2025, 1, 7), "CUST-5", "SKU-5", 1.0, 5.0),
    ("T-4", "ORD-7", D(2025, 1, 8), "CUST-6", "SKU-5", 1.0, 6.0),
    ("C-T-1", "C-ORD-1", D(2025, 2, 1), "C-CUST-1", "C-SKU-1", -3.0, 100.5),
    ("C-T-2", "UNKNOWN", None, "C-CUST-9", "C-SKU-9", 2.0, 11.0),
}


def test_facts(built):
    lake, batch, _ = built
    assert rows(lake.gold("fact_transactions", batch), "*") == FACTS


def test_gaps(built):
    lake, batch, _ = built
    gaps = rows(lake.gold("fact_order_gaps", batch), "order_id", "gap_type", "payment_amount")
    assert gaps == {
        ("ORD-3", "NO_TRANSACTION", 0.0),
        ("ORD-4", "NO_TRANSACTION", 0.0),
        ("C-ORD-2", "NO_TRANSACTION", 18.25),
    }


def test_no_fact_key_is_orphaned_and_gaps_have_no_fact(built):
    lake, batch, _ = built
    fact = lake.gold("fact_transactions", batch)
    for key, table in [("customer_id", "dim_customers"), ("sku", "dim_product"), ("order_id", "dim_order"), ("order_id", "dim_payment")]:
        assert fact.join(lake.gold(table, batch), key, "left_anti").count() == 0
    assert fact.join(lake.gold("fact_order_gaps", batch), "order_id", "left_semi").count() == 0


def test_rejects(built):
    lake, batch, _ = built
    path = f"{lake.path('silver', 'csv_rejects')}/batch_id={batch}"
    assert rows(lake.spark.read.parquet(path), "source", "key", "reason") == {
        ("customers_a", "CUST-9", "flagged"),
        ("customers_b", "C-CUST-4", "flagged"),
        ("products", "SKU-999", "flagged"),
        ("products", "SKU-2", "bad unit_price"),
        ("orders", "ORD-2", "flagged"),
        ("orders", "C-ORD-3", "flagged"),
    }


def test_registered_tables_and_views(built):
    lake, batch, _ = built
    n = lake.spark.sql("SELECT count(*) AS n FROM t_gold.fact_transactions").first()["n"]
    assert n == len(FACTS)
    lake.create_views(batch)
    assert lake.spark.table("gold_fact_order_gaps").count() == 3


def test_a_run_after_a_failure_builds_what_is_loaded(built, spark, tmp_path, monkeypatch):
    from rawstar.plans import pipeline

    _, _, root = built
    lake = Lake(spark, str(tmp_path / "lake"))
    landing = f"{root}/./landing/"  # another spelling of the root
    with monkeypatch.context() as m:
        m.setattr(pipeline, "build_silver", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_pipeline(spark, landing, lake.root, batch_id="BATCH_X")
    batch = run_pipeline(spark, landing, lake.root, batch_id="BATCH_Y")
    assert rows(lake.gold("fact_transactions", batch), "*") == FACTS
    assert lake.silver("transaction_rejects", batch).columns[:2] == ["source", "file_name"]


def test_second_batch(built, spark):
    lake, first, root = built
    landing = str(root / "landing")
    control = BatchControl(lake)
    with pytest.raises(EmptyBatchError):
        run_pipeline(spark, landing, lake.root, batch_id="BATCH_B")
    failed = control.state("BATCH_B").first()
    assert failed["status"] == "FAILED" and "EmptyBatchError" in failed["error_message"]
    assert control.latest_success() == first

    # One file changes: its new copy replaces the old one, all others are still counted in.
    (root / "landing" / "Client B" / "Order.csv").write_text(
        files.envelope("o", "order_id,customer_id,order_date,order_status", ["C-ORD-9,C-CUST-1,2025-03-01,NEW"])
    )
    run_pipeline(spark, landing, lake.root, PipelineOptions(quarantine=False), batch_id="BATCH_C")
    assert control.metrics("BATCH_C").first()["csv_rows"] == 6
    ids = {r[0] for r in rows(lake.silver("dim_order", "BATCH_C"), "order_id")}
    assert "C-ORD-9" in ids and "C-ORD-2" not in ids and "ORD-4" in ids
    assert rows(lake.gold("fact_transactions", "BATCH_C"), "*") == FACTS
    assert control.latest_success() == "BATCH_C"

    lake.truncate("gold", "fact_order_gaps", "BATCH_C")
    assert lake.gold("fact_order_gaps", "BATCH_C").count() == 0
    reset_ledger(lake, "BATCH_C")


def test_options(built, spark, tmp_path):
    from rawstar.plans.pipeline import build_transactions
    from rawstar.sources.lake import Staging

    lake, _, _ = built
    line, _, _ = build_transactions(lake, Staging(spark), PipelineOptions(grain="line"))
    got = sorted((r["transaction_id"], r["sku"]) for r in line.collect() if r["sku"][0] != "C")
    assert got == [
        ("T-1", "SKU-1"), ("T-1", "SKU-2"), ("T-2", "SKU-4"), ("T-3", "SKU-5"), ("T-4", "SKU-5"),
        ("UNKNOWN", "SKU-3"), ("UNKNOWN", "UNKNOWN"),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        from rawstar.plans import silver

        silver.dim_product(lake.raw_lines("csv"), strict=True).collect()
    df = spark.range(3)
    lake.write(df, "silver", "twice", "B")
    lake.write(df, "silver", "twice", "B", append=True)
    assert lake.read("silver", "twice", "id bigint", "B").count() == 6
