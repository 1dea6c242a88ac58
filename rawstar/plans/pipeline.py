"""The whole pipeline: landing files to the Gold star schema, one batch at a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar.operators.documents import json_elements, xml_elements
from rawstar.plans import gold, rules, silver
from rawstar.plans.control import BatchControl
from rawstar.plans.increments import Increments
from rawstar.sources.ingest import ingest
from rawstar.sources.lake import Lake, Staging


@dataclass(frozen=True)
class PipelineOptions:
    """`strict` stops on bad numbers, dates, XML and JSON instead of setting them aside.

    `grain` is 'transaction' (one item per transaction) or 'line'. `unique_key` keeps one inferred
    customer per id. `append` adds to the snapshot of a batch instead of replacing it. `quarantine`
    also stores what was set aside. `on_bad` says whether text that does not parse spoils its 'record'
    or its whole 'document'. `incremental=False` parses all files again, not only those that no batch
    has parsed.
    """

    strict: bool = False
    grain: str = "transaction"
    unique_key: bool = False
    append: bool = False
    quarantine: bool = True
    only_new: bool = True
    ignore_corrupt_files: bool = False
    on_bad: str = "record"
    incremental: bool = True


def build_transactions(
    lake: Lake, stage: Staging, options: PipelineOptions
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unified transactions, their bad values, unparsable documents) from all raw lines."""
    xml, bad_xml = xml_elements(
        lake.raw_lines("xml"), strict=options.strict, on_bad=options.on_bad, stage=stage
    )
    json, bad_json = json_elements(
        lake.raw_lines("json"),
        on_bad=options.on_bad,
        dedup=False,  # raw_lines gives each line of a file once
        stage=stage,
    )
    bad = bad_xml.unionByName(bad_json)
    if options.strict and (broken := bad.first()) is not None:
        raise ValueError(f"{broken['file_name']}: text that does not parse")
    unified = silver.unified_transactions(
        silver.xml_transactions(xml, options.strict, options.grain),
        silver.flatten_json(json, options.strict),
    )
    rejected = silver.xml_rejects(silver.flatten_xml(xml)).unionByName(silver.json_rejects(json))
    return unified, rejected, bad


def build_silver(lake: Lake, batch_id: str, options: PipelineOptions) -> None:
    """New files first, then transactions, as five later steps read them; then each dimension.

    The ranked rows of each CSV source are stored once: the dimension, its keys in the anti join and
    the list of rejects all read columns instead of parsing and ranking lines again.
    """
    stage = Staging(lake.spark, f"{lake.root}/stage/{batch_id}")
    try:
        _build_silver(lake, batch_id, options, stage)
    finally:
        stage.release()


def _build_silver(lake: Lake, batch_id: str, options: PipelineOptions, stage: Staging) -> None:
    parsed = Increments(lake, batch_id, options.on_bad, options.strict, options.incremental)
    parsed.add(stage)
    unified = silver.unified_transactions(
        silver.newest_xml(parsed.rows("items_xml"), options.strict, options.grain),
        parsed.rows("items_json"),
    )
    lake.write(unified, "silver", "slv_transactions", batch_id, options.append)

    latest = {s: stage(silver.last_rows(parsed.rows(f"last_{s}"), s)) for s in silver.ROWS}
    if options.quarantine:
        for table, part in (("unparsable_documents", "bad"), ("transaction_rejects", "values")):
            both = parsed.rows(f"{part}_xml").unionByName(parsed.rows(f"{part}_json"))
            lake.write(both, "silver", table, batch_id, options.append)
        rejected = silver.csv_rejects(latest)
        lake.write(rejected, "silver", "csv_rejects", batch_id, options.append)

    transactions = lake.silver("slv_transactions", batch_id)
    customers = silver.union_customers(
        silver.clean_customers_b(latest["customers_b"]),
        silver.clean_customers_a(latest["customers_a"]),
    )
    products = silver.clean_products(latest["products"], options.strict)
    payments = silver.clean_payments(latest["payments"], options.strict)
    orders = silver.clean_orders(latest["orders"], options.strict)
    complete = {
        "dim_customers": rules.infer_customers(customers, transactions, options.unique_key),
        "dim_product": rules.infer_products(products, transactions),
        "dim_payments": rules.infer_payments(payments, transactions),
        "dim_order": rules.infer_orders(orders, transactions),
    }
    for table, df in complete.items():
        lake.write(df, "silver", table, batch_id, options.append)


def build_gold(lake: Lake, batch_id: str, options: PipelineOptions) -> None:
    def read(table: str) -> DataFrame:
        return lake.silver(table, batch_id)

    transactions, orders, payments = read("slv_transactions"), read("dim_order"), read("dim_payments")
    tables = {
        "fact_transactions": gold.fact_transactions(transactions),
        "dim_customers": gold.gold_customers(read("dim_customers")),
        "dim_product": gold.gold_products(read("dim_product")),
        "dim_order": gold.gold_orders(orders),
        "dim_payment": gold.gold_payments(payments),
        "fact_order_gaps": gold.order_gaps(orders, transactions, payments),
    }
    for table, df in tables.items():
        lake.write(df, "gold", table, batch_id, options.append)


def run_pipeline(
    spark: SparkSession,
    landing: str,
    lake_root: str,
    options: PipelineOptions | None = None,
    database_prefix: str | None = None,
    batch_id: str | None = None,
) -> str:
    """Load what is new in `landing` and rebuild Silver and Gold; returns the batch id.

    A batch without rows stops with EmptyBatchError, unless an earlier batch failed after it had
    loaded rows; then Silver and Gold are built from those. Any failure is recorded as FAILED and leaves
    the snapshots of earlier batches untouched.
    """
    options = options or PipelineOptions()
    lake = Lake(spark, lake_root, database_prefix)
    control = BatchControl(lake)
    lake.create()
    batch_id = control.start(batch_id)
    try:
        ingest(lake, landing, batch_id, options.only_new, options.ignore_corrupt_files)
        control.record_counts(batch_id)
        control.assert_not_empty(batch_id)
        build_silver(lake, batch_id, options)
        build_gold(lake, batch_id, options)
        control.end(batch_id)
    except Exception as e:
        control.fail(batch_id, f"{type(e).__name__}: {e}")
        raise
    lake.refresh()
    return batch_id
