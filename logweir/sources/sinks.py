"""Table sinks. A batch that is retried replaces its own rows, so nothing is written twice."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def write_by_format(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``, one folder per log format."""
    df.hint("rebalance", "log_format").write.mode("overwrite").partitionBy("log_format").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, *partition_cols: str) -> None:
    """Write one micro-batch into its own folder of the table at ``path``.

    Rows of a partition are brought together first, or every task would write a file to every partition.
    Spark splits a partition that this makes too large. Folders are named by copies of the partition columns: from a
    folder's name the empty text comes back as null and ``007`` as a number, but the column keeps what it was.
    """
    folders = {f"{c}_folder": F.col(c) for c in partition_cols}
    if folders:
        writer = df.hint("rebalance", *partition_cols).withColumns(folders).write.mode("overwrite").partitionBy(*folders)
    else:
        writer = df.write.mode("overwrite")
    writer.parquet(batch_folder(path, batch_id))


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: StructType | str) -> DataFrame:
    """One micro-batch as it was written."""
    names = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    return spark.read.schema(schema).parquet(batch_folder(path, batch_id)).select(*names)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any file system that Spark reads."""
    try:
        # A format of fixed columns looks at names alone, whatever the files hold.
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_batches(
    spark: SparkSession, path: str, schema: StructType | str, before: int | None = None
) -> DataFrame:
    """All micro-batches at ``path``, or those before one; no rows if nothing was written yet."""
    fields = StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    schema = StructType([*fields, StructField("batch_id", LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(path).select(*schema.names)
    return table if before is None else table.filter(F.col("batch_id") < before)
