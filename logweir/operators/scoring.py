"""Anomaly scores with Spark ML, or with a model from elsewhere."""

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.schema import FEATURES_18
from logweir.workspace import settle

ENCODED_NAME_CAPITALS = 8


def weak_label(df: DataFrame, out: str = "label") -> DataFrame:
    """Add 1 for names that look like encoded data, which have many capitals and read like noise.

    Where ``df`` has a ``detection`` column, rows that an indicator hit are 1 too.
    """
    encoded = (F.col("value1_capital_count") >= ENCODED_NAME_CAPITALS) & (F.col("value1_human_readable") == 0)
    label = F.coalesce(encoded, F.lit(False))
    if "detection" in df.columns:
        label = label | (F.coalesce("detection", F.lit("")) != "")
    return df.withColumn(out, label.cast("int"))


def fit_classifier(
    labelled: DataFrame,
    features: list[str] = FEATURES_18,
    label: str = "label",
    trees: int = 20,
    depth: int = 5,
    seed: int = 7,
) -> PipelineModel:
    """Random forest over the named features. Fitting passes over them several times: they are kept."""
    stages = [
        VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep"),
        RandomForestClassifier(
            featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
        ),
    ]
    rows = labelled.select(*features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()


def score_anomalies(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``prediction``, 1 for an anomaly, on the row it belongs to."""
    return model.transform(df).select(*df.columns, F.col("prediction").cast("int").alias("prediction"))


def cross_fit(
    labelled: DataFrame, key: list[str], features: list[str] = FEATURES_18, label: str = "label", folds: int = 3, **forest
) -> DataFrame:
    """Add ``prediction`` to every row, by a forest that was fitted without it.

    A hash of ``key`` deals the rows to folds, so that rows of one key are together and a rerun deals them alike. Each
    fold is scored by the forest of all others. Each other fold must have rows; ``forest`` is handed to
    ``fit_classifier``. The rows are written out once, as all folds read them.
    """
    if folds < 2:
        raise ValueError("a row needs rows of another fold to be fitted on")
    dealt = settle(labelled.withColumn("_fold", F.pmod(F.xxhash64(*key), F.lit(folds)).cast("int")))
    scored = []
    for fold in range(folds):
        own = F.col("_fold") == fold
        model = fit_classifier(dealt.filter(~own), features, label, **forest)
        scored.append(score_anomalies(dealt.filter(own), model).drop("_fold"))
    return reduce(DataFrame.unionByName, scored)


def score_with(
    df: DataFrame,
    make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]],
    features: list[str] = FEATURES_18,
    batch_size: int = 4096,
) -> DataFrame:
    """Add ``prediction`` of an outside model, called on batches of feature rows.

    ``make_predict`` runs once per Python worker, so a model it loads is not loaded per row or batch.
    """
    inputs = F.array(*[F.col(c).cast("double") for c in features])
    predict = predict_batch_udf(
        make_predict,
        return_type=T.IntegerType(),
        batch_size=batch_size,
        input_tensor_shapes=[[len(features)]],
    )
    return df.withColumn("prediction", predict(inputs))
