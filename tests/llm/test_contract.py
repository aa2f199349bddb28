"""Registered queries of the subpackage: their SQL, plans and columns."""

from __future__ import annotations

import importlib

import pytest

import __spark_entry__ as contract
from millrace.llm.oracles import ORACLES
from millrace.llm.queries import QUERIES
from tests.conftest import TESTDATA

check = importlib.import_module("tools.check_oracles")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.connect(str(TESTDATA)), name, str(TESTDATA)) is None


@pytest.mark.parametrize("number", [1, 4, 5, 13])
def test_native_plans(spark, plan_of, number):
    query = next(q for name, q in QUERIES.items() if name.startswith(f"op{number}_"))
    plan = plan_of(query(spark, str(TESTDATA)))
    for operator in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert operator not in plan


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(QUERIES) <= set(contract.queries())
