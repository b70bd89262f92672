from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logweir.llm.packing import pack
from logweir.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        sizes.append(out.count())
        if name == "packing":
            break
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out.checkpoint()
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] == sizes[5]
    kept = docs.select("doc_id").join(labels, "doc_id")
    assert kept.filter("quality = 1 and toxic = 0").count() > 5 * kept.filter("quality = 0").count()
    assert docs.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    assert pack(docs).count() == sizes[-1]


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_all_queries_are_there():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
