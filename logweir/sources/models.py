"""Saved models, from any file system Spark can reach."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel


def load_template_index(path: str) -> StringIndexerModel:
    return StringIndexerModel.load(path)


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)
