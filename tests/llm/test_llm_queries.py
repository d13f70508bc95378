"""The problems' queries against their SQL, on the smallest tables."""

import os

import pytest

from compare import connect, differ
from lexspark.llm import registry

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, con, name):
    assert differ(spark, con, BASE, registry.QUERIES[name], registry.ORACLE[name]) is None


def test_found_queries_have_their_columns(spark):
    want = {"p1_found": ["src", "ord"], "p2_found": ["src", "fld", "ord"], "p3_found": ["ord_a", "ord_b"], "p4_found": ["src", "ord", "start_pos"], "p5_found": ["src", "fld", "ord"], "p8_found": ["doc_id", "subject"]}
    for name, columns in want.items():
        df = registry.QUERIES[name](spark, BASE)
        assert df.columns == columns
        assert df.count() == df.distinct().count() > 0
