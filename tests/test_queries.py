"""Every registered query against its check SQL, whole results, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clauseloom.plans.corpus import TABLES
from clauseloom.plans.queries import QUERIES
from tools.compare import compare


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def test_every_query_has_its_check():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark, data):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_check(spark, con, data, name):
    assert ": ok," in compare(spark, con, name, data)


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_multiplies_tables(spark, data, name):
    if name in ("blocked_rules", "stream_verdicts", "write_verdicts"):
        pytest.skip("its plan is the reading of a written table")
    plan = queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
