"""Every query against DuckDB on the whole test tables."""

from __future__ import annotations

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry_point
from branchlens.catalog import QUERIES
from branchlens.oracle import ORACLE

SF = os.environ.get("TEST_SF", "sf0.01")
NAMES = sorted(entry_point.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(f"/root/testdata/{SF}")


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(NAMES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry_point.queries()[name](spark, f"/root/testdata/{SF}")
    rows, wrong = differences(df, con, entry_point.oracle_sql()[name])
    assert not wrong, wrong[:5]
    assert rows > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "shift_number"
    assert df.count() == 41
