"""Every query of the core registry against its SQL, on the smallest tables."""

import os

import pytest

from compare import connect, differ
from lexspark.plans import registry

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, con, name):
    assert differ(spark, con, BASE, registry.QUERIES[name], registry.ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_sql_stands_alone():
    import inspect

    sql = inspect.getsource(registry).split("# ---- the same in SQL")[1]
    assert "L." not in sql  # nothing of the engine's own patterns


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["decade", "n_laws"]
    assert set(e.oracle_sql()) <= set(e.queries())
