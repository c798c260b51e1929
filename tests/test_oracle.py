"""Every registered query equals its DuckDB SQL, value for value."""

from __future__ import annotations

import os

import pytest

from tests.compare import TESTDATA, connect, duck_rows, spark_rows
from tickloom import checks, oracle

SF_DIR = os.path.join(TESTDATA, os.environ.get("TEST_SF", "sf0.001"))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(checks.QUERIES) == set(oracle.ORACLE)


@pytest.mark.parametrize("key", sorted(checks.QUERIES))
def test_query_equals_oracle(spark, con, key):
    df = checks.QUERIES[key](spark, SF_DIR)
    columns, expected = duck_rows(con, oracle.ORACLE[key])
    assert sorted(df.columns) == columns
    found = spark_rows(df)
    assert len(found) == len(expected) > 0
    wrong = [(f, e) for f, e in zip(found, expected) if f != e]
    assert not wrong, f"{len(wrong)} rows differ, first: {wrong[0]}"
