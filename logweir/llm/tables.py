"""Written tables, checked broadcasts and other things several of the operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.skew import fits_broadcast
from logweir.workspace import new_folder

SPACES = r"\x20\x09-\x0D"
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the written rows.

    This cuts the lineage: a lost executor costs a re-read and nothing is computed twice.
    """
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcasting if it has at most ``rows`` rows and ``BROADCAST_BYTES``; else leave it alone."""
    return F.broadcast(df) if fits_broadcast(df, rows, BROADCAST_BYTES) else df


def word_list(text: Column) -> Column:
    """The words of a text: its longest runs without white space; none for null."""
    text = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    # Splitting at one plain character is far cheaper than matching a pattern.
    return F.array_remove(F.split(text, " "), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_of(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores put before it until no column of ``taken`` has it."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name
