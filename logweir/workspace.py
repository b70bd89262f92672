"""Shared storage for checkpoints and intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a local master gets a temporary folder; a cluster gets an error, since
    no folder chosen here could be known to be shared.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="logweir-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint store once and continue from the written copy."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
