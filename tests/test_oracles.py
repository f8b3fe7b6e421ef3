"""Every registered query against its SQL, over whole supplied tables."""

from __future__ import annotations

import os
import time

import pytest

import __spark_entry__ as entry
from tests.compare import differences, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    started = time.time()
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        problem = differences(df, con, sql)
        assert problem is None, f"{name}: {problem}"
    print(f"{name}: {time.time() - started:.2f}s")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
