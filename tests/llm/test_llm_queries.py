"""The queries over the smallest test tables: SQL where there is some, else one row per row of the table."""

from pathlib import Path

import pytest

from check import canonical
from logweir.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert canonical(got).equals(canonical(engine.execute(ORACLES[name]).df()))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_one_row_each(spark, name):
    of = {"op3": "conversations", "op7": "pages"}.get(name.split("_")[0], "documents")
    got = QUERIES[name](spark, SF_DIR)
    key = "conv_id" if of == "conversations" else "page_id" if of == "pages" else "doc_id"
    rows = spark.read.parquet(f"{SF_DIR}/{of}.parquet")
    assert got.groupBy(key).count().exceptAll(rows.groupBy(key).count()).isEmpty() and got.count() == rows.count()
