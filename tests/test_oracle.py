"""Every registered job against its DuckDB oracle, on sf0.001.

tools/check_oracle.py runs the same comparison at sf0.01."""

import pytest

from admitlab.oracle.compare import compare, duck
from admitlab.oracle.registry import oracle_sql
from admitlab.plans.registry import jobs
from sf_dirs import SF_SMALL

SQL = oracle_sql()
JOBS = jobs()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_job_has_an_oracle():
    assert set(JOBS) == set(SQL)


@pytest.mark.parametrize("key", sorted(JOBS))
def test_job_matches_oracle(spark, con, key):
    r = compare(key, JOBS[key](spark, SF_SMALL), con, SQL[key])
    assert r.ok, r.detail
    assert r.exact, "values equal only within tolerance"
    assert r.types_ok, r.types


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(JOBS) <= set(e.queries()) and set(JOBS) <= set(e.oracle_sql()) <= set(e.queries())
