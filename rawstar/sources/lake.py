"""Layered tables on a shared folder: bronze/, silver/ and gold/, one snapshot per batch.

Every table is a directory of parquet partitioned by `batch_id`. A write only ever touches the
partition of its own batch, so no path is overwritten while something reads it, a retried batch
replaces exactly what it wrote before, and a failed batch leaves earlier snapshots as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rawstar import schemas
from rawstar.functions import text
from rawstar.sources.raw_lines import number_lines, replaced_loads, summarise_splits

LAYERS = ("bronze", "silver", "gold")
#: Numbers are kept as differences and texts by what they share with the one before; a dictionary, of which most
#: columns have too many values, would take the place of both. Small row groups let tasks share a file.
STORED = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": 16 * 1024 * 1024,
}


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a write in here has shuffled is deleted as soon as it ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None, group_rows: int | None = None
) -> None:
    """`group_rows` bounds the rows of a row group. Readers take up to 4,096 rows of a group at once, which is
    too much text where each row holds a chunk of a file.
    """
    writer = df.write.mode(mode).options(**STORED)
    if group_rows is not None:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    if by is not None:
        writer = writer.partitionBy(by)
    with without_shuffles(df.sparkSession):
        writer.parquet(path)


class Lake:
    def __init__(self, spark: SparkSession, root: str, database_prefix: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database_prefix = database_prefix

    # --- layout ---

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @staticmethod
    def table_schemas() -> dict[tuple[str, str], str]:
        out = {("bronze", t): schemas.RAW_LINE_DDL for t in schemas.RAW_TABLES.values()}
        out.update(
            {("bronze", f"{t}_splits"): schemas.SPLIT_DDL for t in schemas.RAW_TABLES.values()}
        )
        silver = schemas.SILVER_TABLES | schemas.REJECT_TABLES
        out.update({("silver", t): ddl for t, ddl in silver.items()})
        out.update({("gold", t): ddl for t, ddl in schemas.GOLD_TABLES.items()})
        return out

    def create(self) -> None:
        """Register databases and tables for SQL users, if missing.

        Columns of the control table carry the defaults of a fresh batch.
        """
        if self.database_prefix is None:
            return
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database_prefix}_{layer}")
        raw = schemas.RAW_TABLES.values()
        for (layer, table), ddl in self.table_schemas().items():
            by = "batch_id string, route string" if table in raw else "batch_id string"
            names = by.replace(" string", "")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.database_prefix}_{layer}.{table} "
                f"({ddl}, {by}) USING parquet PARTITIONED BY ({names}) "
                f"LOCATION '{self.path(layer, table)}'"
            )
        columns = []
        for part in schemas.CONTROL_DDL.split(", "):
            name, kind = part.split()
            default = {"bigint": " DEFAULT 0"}.get(kind, "")
            if name in ("created_at", "updated_at"):
                default = " DEFAULT localtimestamp()"
            columns.append(f"{name} {kind}{default}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.database_prefix}_bronze.pipeline_batch_control "
            f"({', '.join(columns)}) USING parquet "
            f"LOCATION '{self.path('bronze', 'pipeline_batch_control')}'"
        )

    def refresh(self) -> None:
        """Let the registered tables see partitions written since."""
        if self.database_prefix is None:
            return
        for layer, table in self.table_schemas():
            self.spark.sql(f"MSCK REPAIR TABLE {self.database_prefix}_{layer}.{table}")
        self.spark.sql(f"REFRESH TABLE {self.database_prefix}_bronze.pipeline_batch_control")

    # --- snapshots ---

    def write(
        self, df: DataFrame, layer: str, table: str, batch_id: str, append: bool = False
    ) -> None:
        """Write the snapshot of one batch; `append` adds to it instead of replacing it."""
        mode = "append" if append else "overwrite"
        write_parquet(df, f"{self.path(layer, table)}/batch_id={batch_id}", mode)

    def read(
        self, layer: str, table: str, ddl: str, batch_id: str | None = None
    ) -> DataFrame:
        """One batch of a table, or all batches with their `batch_id` when none is given."""
        if batch_id is not None:
            return self.spark.read.schema(ddl).parquet(
                f"{self.path(layer, table)}/batch_id={batch_id}"
            )
        try:
            return self.spark.read.schema(f"{ddl}, batch_id string").parquet(
                self.path(layer, table)
            )
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{ddl}, batch_id string")

    def silver(self, table: str, batch_id: str) -> DataFrame:
        ddl = (schemas.SILVER_TABLES | schemas.REJECT_TABLES)[table]
        return self.read("silver", table, ddl, batch_id)

    def gold(self, table: str, batch_id: str) -> DataFrame:
        return self.read("gold", table, schemas.GOLD_TABLES[table], batch_id)

    def truncate(self, layer: str, table: str, batch_id: str) -> None:
        """Empty the snapshot of one batch."""
        ddl = self.table_schemas()[(layer, table)]
        none = self.spark.createDataFrame([], ddl)
        if table in schemas.RAW_TABLES.values():
            none = none.withColumn("route", F.lit(schemas.NO_ROUTE))
            self._write_routed(none, table, batch_id)
        else:
            self.write(none, layer, table, batch_id)

    def create_views(self, batch_id: str) -> None:
        """Temp views `silver_<table>` and `gold_<table>` over one batch, with what it has set aside, and
        `bronze_<table>` over the numbered lines of all batches. A table that is not there is empty.
        """
        layers = {"silver": schemas.SILVER_TABLES | schemas.REJECT_TABLES, "gold": schemas.GOLD_TABLES}
        for layer, tables in layers.items():
            for table, ddl in tables.items():
                own = self.read(layer, table, ddl).filter(F.col("batch_id") == batch_id)
                own.drop("batch_id").createOrReplaceTempView(f"{layer}_{table}")
        for kind, table in schemas.RAW_TABLES.items():
            self.raw_lines(kind).createOrReplaceTempView(f"bronze_{table}")

    # --- bronze ---

    def _write_routed(self, lines: DataFrame, table: str, batch_id: str) -> None:
        """Routes are few, so a task keeps a file open for each, which spares a sort of the text."""
        path = f"{self.path('bronze', table)}/batch_id={batch_id}"
        name = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, max(int(before), 1 << len(schemas.CSV_SOURCES)))
        try:
            write_parquet(lines, path, by="route")
        finally:
            self.spark.conf.set(name, before)

    def write_raw(self, lines: DataFrame, kind: str, batch_id: str, root: str) -> DataFrame:
        """Keep scanned lines and number them. Returns path, size and time of the files that lines came
        from, as they were when they were read.
        """
        self.keep_scan(lines, kind, batch_id)
        return self.number_scan(kind, batch_id, root)

    def keep_scan(self, lines: DataFrame, kind: str, batch_id: str, append: bool = False) -> None:
        """Keep lines as they were scanned; no file may come in two scans of a batch."""
        self.write(lines, "bronze", f"_scanned_{kind}", batch_id, append)

    def number_scan(self, kind: str, batch_id: str, root: str) -> DataFrame:
        """One summary row per split of each file, from all columns but the text, then the numbered
        lines of files named after their place below `root`. Only CSV lines have routes; the others lie
        in one.
        """
        table = schemas.RAW_TABLES[kind]
        stored = self.read("bronze", f"_scanned_{kind}", schemas.SCANNED_DDL, batch_id)
        self.write(summarise_splits(stored, root), "bronze", f"{table}_splits", batch_id)
        splits = self.read("bronze", f"{table}_splits", schemas.SPLIT_DDL, batch_id)
        numbered = number_lines(stored, splits)
        if kind == "csv":
            self._write_routed(numbered, table, batch_id)
        else:
            # straight into the folder of the one route: no sort by it
            path = f"{self.path('bronze', table)}/batch_id={batch_id}/route={schemas.NO_ROUTE}"
            write_parquet(numbered.drop("route"), path)
        files = stored.select("file_path", "file_size", "modification_time").distinct()
        return files.withColumn("file_path", text.decoded_path("file_path"))

    def drop_scanned(self, kind: str, batch_id: str) -> None:
        """Empty what was kept of the scan."""
        none = self.spark.createDataFrame([], schemas.SCANNED_DDL)
        self.write(none, "bronze", f"_scanned_{kind}", batch_id)

    def raw_lines(self, kind: str) -> DataFrame:
        """Numbered lines of all batches; of a file loaded twice, only the newest copy."""
        table = schemas.RAW_TABLES[kind]
        stored = self.read("bronze", table, f"{schemas.RAW_LINE_DDL}, route string")
        old = replaced_loads(self.raw_splits(kind))
        # Mostly there are none, and then the lines need no join.
        return stored if old.isEmpty() else stored.join(old, ["file_name", "batch_id"], "left_anti")

    def newest_loads(self, kind: str) -> DataFrame:
        """(file_name, batch_id, load_dt) of the newest load of each file."""
        last = F.max(F.struct("load_dt", "batch_id")).alias("l")
        loads = self.raw_splits(kind).groupBy("file_name").agg(last)
        return loads.select("file_name", "l.batch_id", "l.load_dt")

    def lines_of(self, kind: str, loads: DataFrame) -> DataFrame:
        """Numbered lines of some loads (file_name, batch_id); partitions of other batches are not read.

        Mostly a batch is wanted whole, and then its lines need no join.
        """
        keys = ["file_name", "batch_id"]
        batches = [r[0] for r in loads.select("batch_id").distinct().collect()]  # one per batch
        wanted = F.col("batch_id").isin(batches) if batches else F.lit(False)
        table = schemas.RAW_TABLES[kind]
        stored = self.read("bronze", table, f"{schemas.RAW_LINE_DDL}, route string").filter(wanted)
        others = self.raw_splits(kind).filter(wanted).select(*keys).distinct()
        others = others.join(loads.select(*keys), keys, "left_anti")
        return stored if others.isEmpty() else stored.join(others, keys, "left_anti")

    def raw_splits(self, kind: str) -> DataFrame:
        return self.read("bronze", f"{schemas.RAW_TABLES[kind]}_splits", schemas.SPLIT_DDL)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names for checkpoints.

    Only a session whose driver and executors are one process may leave it unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/rawstar-{name}-{uuid.uuid4().hex}"


class Staging:
    """Writes a relation once to the shared folder and reads it back.

    It keeps a long plan from being worked out again for each of its readers, and what is written
    outlives the executors that made it.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.base = path or scratch_dir(spark, "stage")
        self.made: list[tuple[str, StructType]] = []
        self.frames: list[DataFrame] = []

    def __call__(self, df: DataFrame, group_rows: int | None = None) -> DataFrame:
        target = f"{self.base}/{len(self.made)}"
        write_parquet(df, target, group_rows=group_rows)
        self.made.append((target, df.schema))
        self.frames.append(self.spark.read.schema(df.schema).parquet(target))
        return self.frames[-1]

    def release(self, *frames: DataFrame) -> None:
        """Empty what was written, or only what these frames read, once nothing reads it any more."""
        for (target, schema), frame in zip(self.made, self.frames, strict=True):
            if not frames or any(frame is f for f in frames):
                self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(target)
