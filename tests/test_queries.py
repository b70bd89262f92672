"""Every query against its SQL on the smallest test tables, where these are at hand."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from check import canonical
from logweir.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r.n for r in rows) == 1000 and {r.owner for r in rows} == {"client01", "client02", "client03"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = engine.execute(sql).df()
    assert canonical(got).equals(canonical(want))
