"""Indicator lists: known bad addresses per owner."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.schema import INDICATOR
from logweir.sources.sinks import path_exists, read_batches, write_batch

# The batch that holds what was known before a stream began.
SEED = -1
SNAPSHOT_EVERY = 100


def read_indicator_csv(spark: SparkSession, path: str, owner: str | None = None) -> DataFrame:
    """Distinct non-empty cells of headerless CSV files, whose lines may differ in length.

    ``owner`` names whose list it is. Without it the files lie in ``owner=...`` folders under ``path``.
    """
    empty = spark.createDataFrame([], INDICATOR)
    if not path_exists(spark, path):
        return empty
    lines = spark.read.text(path)
    # No line has more cells than commas and one; a schema of that width loses none.
    commas = lines.agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(","), F.lit(""))))).first()[0]
    if commas is None:
        return empty
    values = [f"cell{i}" for i in range(commas + 1)]
    folders = [c for c in lines.columns if c == "owner"]
    # Text throughout, so that an owner folder such as 007 keeps its name.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*values, *folders]])
    cells = spark.read.schema(schema).option("maxColumns", len(values) + 1).csv(path)
    # The folder of an owner with an empty name reads as null; rows without an owner are not written.
    owner_col = F.coalesce("owner", F.lit("")) if owner is None else F.lit(owner)
    return (
        cells.select(owner_col.alias("owner"), F.explode(F.array(*map(F.col, values))).alias("value2"))
        .filter(F.col("value2") != "")
        .distinct()
    )


def _unknown(indicators: DataFrame, known: DataFrame) -> DataFrame:
    """The indicators, each once, that ``known`` lacks. Without an owner an indicator matches nothing."""
    own = indicators.select(*INDICATOR.names).filter(F.col("owner").isNotNull()).distinct()
    # Both sides are distinct pairs, so this join has no hot key.
    return own.join(known.select(*INDICATOR.names), INDICATOR.names, "left_anti")


def write_indicator_csv(indicators: DataFrame, path: str) -> None:
    """Add those that are not there yet to headerless CSV files, one folder per owner."""
    known = read_indicator_csv(indicators.sparkSession, path)
    _unknown(indicators, known).write.mode("append").partitionBy("owner").csv(path)


def append_indicators(indicators: DataFrame, table: str, path: str) -> None:
    """Add those that are not there yet to the catalog table ``table``, made at ``path`` if there is none."""
    spark = indicators.sparkSession
    if spark.catalog.tableExists(table):
        _unknown(indicators, spark.read.table(table)).write.mode("append").saveAsTable(table)
    else:
        _unknown(indicators, spark.createDataFrame([], INDICATOR)).write.option("path", path).saveAsTable(table)


def read_indicator_table(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Distinct indicators of all batches, or of those before ``before``."""
    return read_batches(spark, path, INDICATOR, before).select(*INDICATOR.names).distinct()


def write_indicator_batch(indicators: DataFrame, path: str, batch_id: int) -> None:
    write_batch(indicators.select(*INDICATOR.names), path, batch_id, "owner")


def ensure_seed(spark: SparkSession, path: str) -> None:
    """Make an empty table of what was known before the stream, if there is none."""
    nothing = spark.createDataFrame([], INDICATOR).withColumn("owner_folder", F.col("owner"))
    nothing.write.mode("ignore").partitionBy("owner_folder").parquet(f"{path}/batch_id={SEED}")


def known_before(spark: SparkSession, path: str, batch_id: int, every: int = SNAPSHOT_EVERY) -> DataFrame:
    """The indicators a micro-batch may know: those of earlier batches and of batch -1, if one was seeded.

    Every ``every`` batches ``write_snapshot`` puts all of them together, so this reads one snapshot and at
    most ``every`` batch folders, all named beforehand, however long the stream has been running.
    """
    start = max((batch_id - 1) // every * every, 0)
    older = f"{_snapshots(path)}/batch_id={start}" if start else f"{path}/batch_id={SEED}"
    recent = [f"{path}/batch_id={i}" for i in range(start, batch_id)]
    tables = [spark.createDataFrame([], INDICATOR)]
    if start or path_exists(spark, older):
        tables.append(spark.read.schema(INDICATOR).parquet(older))
    if recent:
        tables.append(spark.read.schema(INDICATOR).option("basePath", path).parquet(*recent))
    rows = [table.select(*INDICATOR.names) for table in tables]
    return reduce(DataFrame.unionByName, rows).distinct()


def write_snapshot(
    spark: SparkSession, path: str, batch_id: int, known: DataFrame, every: int = SNAPSHOT_EVERY
) -> None:
    """Keep what batch ``batch_id`` knew, if a snapshot is due at it."""
    if batch_id > 0 and batch_id % every == 0:
        write_indicator_batch(known, _snapshots(path), batch_id)


def _snapshots(path: str) -> str:
    return f"{path}-snapshots"
