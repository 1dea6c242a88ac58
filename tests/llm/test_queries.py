import compare
import pytest

import __spark_entry__ as e
from rawstar.llm import queries

SF = e.SMOKE_DIR


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = e.queries()[name](spark, SF)
    if name in queries.ORACLES:
        assert compare.difference(df, compare.connect(SF), queries.ORACLES[name]) is None
    else:
        source = "conversations" if "chat" in name else "documents"
        table = spark.read.parquet(f"{SF}/{source}.parquet")
        want = table.select("conv_id").distinct().count() + 1 if "chat" in name else table.count()
        assert df.count() == want


def test_all_operators():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
