"""Every query beside its SQL twin, on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import compare
import pytest

import __spark_entry__ as e
from rawstar.plans.catalog import ORACLES, QUERIES

SF = e.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare.difference(df, con, ORACLES[name]) is None


def test_entry(spark):
    assert e.entry(spark).count() == 27


def test_entry_point_without_the_optional_part(tmp_path):
    """The catalog alone, where the subpackage is gone but for leftovers of its compiled files."""
    root = Path(e.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "rawstar", tmp_path / "rawstar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "rawstar/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()) == len(e.QUERIES) == len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == "True", done.stderr
