"""Joins that stay balanced when one key holds a large part of the rows.

``lookup_join`` broadcasts the lookup side only after checking its size. Beyond the bound it shuffles, with the rows of
hot keys spread over several partitions. A key is hot when it has more rows than a quarter of an even task's share, and
gets one salt for each such quarter: however large the input, no key puts more than that on one salt, and there are at
most four hot keys, and four extra salts, for each task, so that their list is safe to broadcast.
"""

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.workspace import settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
PIECES_PER_TASK = 4


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` is within both bounds. Reads at most ``max_rows + 1`` rows of it."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, size = (
        df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    )
    return rows <= max_rows and size <= max_bytes


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, keys: list[str], n: str, tasks: int | None = None) -> DataFrame:
    """Keys with more rows than one piece, and their ``_salts``, from a table of rows per key.

    ``tasks`` is the number of partitions the rows are dealt to, by default that of the session's shuffles.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    piece = max(1.0, total / (PIECES_PER_TASK * (tasks or _tasks(counts.sparkSession))))
    return counts.filter(F.col(n) > piece).select(*keys, F.ceil(F.col(n) / piece).cast("int").alias("_salts"))


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def salted_join(
    big: DataFrame, lookup: DataFrame, keys: list[str], how: str, hot: DataFrame, spread: list[str]
) -> DataFrame:
    """Equi join in which the rows of hot keys, and rows with a null key, are spread by ``spread``.

    ``hot`` has the hot keys with their ``_salts``; the lookup rows of a key are repeated once per salt. The salt is
    a hash of row values, so a retried task computes the same one.
    """
    marks = F.broadcast(hot)
    everywhere = F.lit(PIECES_PER_TASK * _tasks(big.sparkSession))
    salts = F.when(_any_null(keys), everywhere).otherwise(F.coalesce("_salts", F.lit(1)))
    left = big.join(marks, keys, "left")
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_salts")
    numbers = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = lookup.join(marks, keys, "left").withColumn("_salt", F.explode(numbers)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str,
    spread: list[str],
    hot: Callable[[], DataFrame] | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``big`` with a lookup table of unique keys; null keys never match.

    ``spread`` names columns of ``big`` that vary within a key. ``hot`` finds the hot keys where the
    caller has a shorter way than counting; it is asked only if the lookup table is too large to broadcast.
    """
    if fits_broadcast(lookup, max_rows):
        return big.join(F.broadcast(lookup), keys, how)
    if hot is None:
        # Written once: the total, and the hot keys of either side, then come from there and not from the rows.
        counts = settle(big.groupBy(*keys).agg(F.count("*").alias("_n")))
        hot = partial(hot_keys, counts, keys, "_n")
    return salted_join(big, lookup, keys, how, hot(), spread)
