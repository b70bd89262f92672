"""Numbering of templates, most frequent first."""

from functools import partial

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.operators.ordered import number_rows
from logweir.operators.skew import hot_keys, lookup_join


def fit_template_index(df: DataFrame) -> StringIndexerModel:
    """Index of ``key`` by falling frequency, ties by name; unseen and null keys get the label count.

    The model holds its labels on the driver. Use ``template_vocabulary`` where templates may be many.
    """
    return StringIndexer(
        inputCol="key", outputCol="encoded_key", handleInvalid="keep", stringOrderType="frequencyDesc"
    ).fit(df.select("key"))


def template_vocabulary(df: DataFrame) -> DataFrame:
    """The same index as a table (key, n, encoded_key) of any size."""
    counts = df.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))
    ordered = number_rows(counts.withColumn("_rank", -F.col("n")), ["_rank", "key"], "_id")
    return ordered.select("key", "n", (F.col("_id") - 1).cast("double").alias("encoded_key"))


def index_with_vocabulary(df: DataFrame, vocabulary: DataFrame, spread: list[str]) -> DataFrame:
    """Add ``encoded_key`` from a vocabulary table. Templates are few and hot, so hot ones are spread."""
    unseen = float(vocabulary.count())
    hot = partial(hot_keys, vocabulary, ["key"], "n")
    indexed = lookup_join(df, vocabulary.select("key", "encoded_key"), ["key"], "left", spread, hot)
    return indexed.select(*df.columns, F.coalesce("encoded_key", F.lit(unseen)).alias("encoded_key"))
