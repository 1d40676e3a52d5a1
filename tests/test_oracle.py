"""Every registered query against its independent SQL formulation (DuckDB)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest
from tests.conftest import SF_SMALL

from carelake.plans.catalog import REGISTRY

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, df.columns) == digest(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns[0] == "today_appointments"
