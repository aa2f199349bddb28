"""Every registered query against its SQL, on the smallest test tables; and its plan."""

import importlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract
from tests.conftest import TESTDATA

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
check = importlib.import_module("check_oracles")

# Predictions of a fitted model, which SQL cannot give.
WITHOUT_SQL = {"ml_train_predict", "ml_model_report", "score_new_orders"}

# The optional subpackage has tests of its own.
NAMES, SQL = set(contract.QUERIES), set(contract.ORACLES)

# Their result is the scan of a table that they have written.
STORED = {n for n in NAMES if n.startswith(("stream_", "ingest_", "extract_", "bronze_", "watermark_"))}

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return check.connect(str(TESTDATA))


def test_every_query_but_the_models_has_sql():
    assert NAMES - SQL == WITHOUT_SQL
    assert SQL <= NAMES
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert check.compare(spark, connection, name, str(TESTDATA)) is None


@pytest.mark.parametrize("name", sorted(NAMES - WITHOUT_SQL - STORED))
def test_plan_has_no_python_and_no_product(spark, plan_of, name):
    plan = plan_of(contract.queries()[name](spark, str(TESTDATA)))
    for operator in ("PythonUDF", "ArrowEval", "BatchEval", "Cartesian", "NestedLoop", "Collect"):
        assert operator not in plan


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
