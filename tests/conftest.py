import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("rawstar-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Lines of one file from a list of texts."""

    def make(texts, file_name="f.txt", file_bytes=1):
        rows = [(t, file_name, file_name, i, file_bytes) for i, t in enumerate(texts, start=1)]
        return spark.createDataFrame(
            rows,
            "raw_content string, file_name string, source_name string, file_row_number bigint, "
            "file_bytes bigint",
        )

    return make
