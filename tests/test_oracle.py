"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from footfall.catalog import ORACLE_SQL, QUERIES
from conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_matches(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == []


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    plan = plan_of(df)
    for slow in ("NestedLoop", "Cartesian", "EvalPython"):
        assert slow not in plan
