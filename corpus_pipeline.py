"""From raw documents to training batches: each stage is written as Parquet and read again as the next one's input."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.exact_dedup import drop_exact_copies
from logweir.llm.kneser_ney import keep_good
from logweir.llm.packing import pack
from logweir.llm.probminhash import drop_near_copies
from logweir.llm.suffix_dedup import remove_repeats
from logweir.llm.tables import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a model of trusted text finds improbable for their language."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of the documents that are equal but for white space."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return drop_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take strings out of the texts that stand elsewhere too."""
    cut = remove_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of each document."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("packing", packing),
]

#: The classifier, the near-duplicate classes and the length buckets have no SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
