"""The driver contract: entry() runs, every query has an oracle, and every query equals
its DuckDB oracle on the smallest test folder (row count, column names, value hash)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402
from notecohort.plans import registry  # noqa: E402
from notecohort.plans.fixtures import BASE_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["patientdurablekey", "stage", "system", "evidence"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.SPARK) == set(registry.ORACLE)
    assert set(registry.SPARK) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.SPARK))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
