"""Every registered query against its SQL on the smallest tables."""

import pytest

from callweave.catalog import ORACLE, QUERIES
from callweave.catalog import retention as retention_queries
from compare import connect, difference, spark_rows, sql_rows

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.fixture(scope="module", autouse=True)
def one_retention_run():
    """The retention queries are views of one run; here they share it."""
    build, runs = retention_queries._run, {}

    def shared(t):
        if t.root not in runs:
            runs[t.root] = build(t)
        return runs[t.root]

    retention_queries._run = shared
    yield
    retention_queries._run = build


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in ORACLE
    got = spark_rows(QUERIES[name](spark, ROOT))
    assert difference(got, sql_rows(con, ORACLE[name])) is None
