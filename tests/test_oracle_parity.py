"""Every registered query equals its DuckDB twin on the smallest test tables
(the driver repeats this at sf0.01)."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as se  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

QUERIES = se.queries()
ORACLE = se.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_warehouse_has_an_oracle():
    from cardsentry.plans.registry import spark_queries

    assert set(spark_queries()) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert rows_of(df.columns, got) == rows_of(cols, want)


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["event_dt", "passport_num", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
