"""Ordered operators without a single-partition window.

A window over a whole table, or over an owner that holds a third of it, would sort that much in one
task. Here the rows are range-partitioned in the wanted order, each range is numbered or summed on its
own, and the ranges are put together by their totals, of which there is one per range and group.
"""

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.operators.skew import BROADCAST_ROWS, lookup_join
from logweir.workspace import settle

_DAY = 86_400


def _with_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in contiguous ranges of ``order``, numbered in ``_range``.

    The number is written out with the rows: computed again, the ranges could fall differently.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order])
    return settle(ranged.withColumn("_range", F.spark_partition_id()))


def _totals_before(ranged: DataFrame, group: list[str], total: Column) -> DataFrame:
    """Per group and range, the total of the group's earlier ranges."""
    totals = ranged.groupBy(*group, "_range").agg(total.alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )


def running_total(df: DataFrame, group: list[str], order: str, measure: str, out: str) -> DataFrame:
    """Per group, the sum of ``measure`` over the rows at or before each row in ``order``.

    ``(group, order)`` must be unique and not null.
    """
    ranged = _with_ranges(df, [*group, order])
    before = _totals_before(ranged, group, F.sum(measure))
    within = Window.partitionBy(*group, "_range").orderBy(order)
    local = ranged.withColumn("_within", F.sum(measure).over(within))
    # The join has the window's keys, so it needs no further shuffle of the rows.
    return local.join(before, [*group, "_range"]).select(
        *df.columns, (F.col("_within") + F.col("_before")).alias(out)
    )


def number_rows(df: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """Consecutive numbers from 1 in ``order``, which must name a unique key of the rows."""
    ranged = _with_ranges(df, order)
    totals = ranged.groupBy("_range").agg(F.count("*").alias("_total"))
    # One row per range: this window holds as many rows as there were partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.withColumn("_within", F.row_number().over(within))
        .join(before, "_range")
        .select(*df.columns, (F.col("_within") + F.col("_before")).alias(out))
    )


def zip_by_order(
    left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str] | None = None
) -> DataFrame:
    """Pair the n-th row of ``left`` with the n-th of ``right`` under declared orders."""
    return (
        number_rows(left, left_order, "_id")
        .join(number_rows(right, right_order or left_order, "_id"), "_id")
        .drop("_id")
    )


def running_value_count(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Table of (group, value, n, out): rows with the value, and rows up to and including it.

    ``out`` equals a running count over the rows in value order with ties counted together; nulls are
    not counted, nor are rows without a group. Only distinct values are ordered.
    """
    counts = df.dropna(subset=[*group, value]).groupBy(*group, value).agg(F.count("*").alias("n"))
    return running_total(counts, group, value, "n", out)


def first_gaps(df: DataFrame, group: str, epoch: str, tie: str, out: str = "gap") -> DataFrame:
    """Table of (group, epoch, tie, out): seconds since the group's previous distinct epoch.

    In epoch order with ``tie`` deciding among equals, only the first row of an epoch can follow another
    epoch, so this holds one row per epoch and every other row's gap is 0. The epochs are written out, as
    they are used twice: the lag runs within days, and the first epoch of a day looks at the day before in
    a table with one row per day.
    """
    epochs = settle(
        df.dropna(subset=[group, epoch])
        .groupBy(group, epoch)
        .agg(F.min(tie).alias(tie))
        .withColumn("_day", F.floor(F.col(epoch) / _DAY))
    )
    days = (
        epochs.groupBy(group, "_day")
        .agg(F.max(epoch).alias("_last"))
        .select(
            group, "_day", F.lag("_last").over(Window.partitionBy(group).orderBy("_day")).alias("_last_before")
        )
    )
    in_day = Window.partitionBy(group, "_day").orderBy(epoch)
    previous = F.coalesce("_previous", "_last_before")
    return (
        epochs.withColumn("_previous", F.lag(epoch).over(in_day))
        .join(days, [group, "_day"])
        .select(group, epoch, tie, (F.col(epoch) - previous).alias(out))
    )


def time_gap(
    df: DataFrame, group: str, epoch: str, tie: str, out: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add seconds since the group's previous row; 0 for its first, for unreadable times and no group.

    ``tie`` must be unique within an epoch. The join key contains it, so no key is hot.
    """
    keys = [group, epoch, tie]
    gaps = first_gaps(df, group, epoch, tie, "_gap")
    none_hot = partial(gaps.select(*keys, F.lit(1).alias("_salts")).limit, 0)
    gap = F.coalesce(F.round("_gap", 1), F.lit(0)).cast("decimal(10,1)")
    joined = lookup_join(df, gaps, keys, "left", [tie], none_hot, max_rows)
    return joined.select(*df.columns, gap.alias(out))
