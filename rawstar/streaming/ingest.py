"""Bronze ingest as a file-source stream: its checkpoint is the load history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rawstar import schemas
from rawstar.functions import text
from rawstar.plans.control import BatchControl
from rawstar.sources.ingest import LEDGER
from rawstar.sources.lake import Lake
from rawstar.sources.raw_lines import landing_path, landing_root, line_columns, listing, raw_columns


def ingest_available(
    lake: Lake,
    landing: str,
    kind: str,
    prefix: str = "STREAM",
    max_files_per_trigger: int | None = None,
) -> None:
    """Load every landing file the stream has not seen yet, then stop.

    Each micro-batch becomes a Bronze batch named after its kind and epoch, with its own row in the
    control table (state INGESTED) and its files in the ledger, so that a later `run_pipeline` builds
    from its lines and loads none of them again. All of that is written under the batch's id and the
    ledger last, so an epoch that is run again after a failure leaves the same.
    """
    root = landing_root(lake.spark, landing)
    reader = lake.spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    with listing(lake.spark):
        found = reader.text(root, lineSep="\n")
    wanted = text.relative_name(landing_path(), root).rlike(schemas.FILE_PATTERNS[kind])
    lines = found.filter(wanted).select(*line_columns())
    control = BatchControl(lake)

    def store(batch: DataFrame, epoch: int) -> None:
        batch_id = f"{prefix}_{kind.upper()}_{epoch:012d}"
        control.start(batch_id)
        files = lake.write_raw(raw_columns(batch, right_trim=kind == "csv"), kind, batch_id, root)
        control.record_counts(batch_id)
        lake.write(files, "bronze", LEDGER, batch_id)
        lake.drop_scanned(kind, batch_id)

    with listing(lake.spark):  # the stream lists files in its own time, so until it stops
        stream = (
            lines.writeStream.foreachBatch(store)
            .option("checkpointLocation", lake.path("bronze", f"_stream_{kind}"))
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
