"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from check import compare

FOLDER = os.environ.get("GRIDCAST_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
ORACLES = entry_module.oracle_sql()


# the daily series of the smallest tables still has 80 months; the trees need no oracle
@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, name):
    build = entry_module.queries()[name]
    if name in ORACLES:
        assert compare(spark, FOLDER, build, ORACLES[name]) == []
    else:
        assert build(spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert len(df.columns) == 62 and df.count() > 0
