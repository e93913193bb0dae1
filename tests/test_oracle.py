"""Every registered query against its DuckDB oracle on the smallest tables
(the driver's gate runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from lathe.plans.catalog import ORACLES, QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)  # the training-data queries have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_survey_query_registered():
    assert len(NAMES) >= 90
    assert set(NAMES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert set(NAMES) == set(ORACLES)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)  # built once: a query may fit a model while it is built
    status, detail = compare(spark, con, name, lambda *_: df, ORACLES.get(name), SF, check_types=True)
    assert status in ("ok", "rows"), detail
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan], name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and set(df.columns) >= {"split", "n", "mae", "r2"}
