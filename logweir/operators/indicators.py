"""Matching of indicator lists, and new indicators from anomalies."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir.operators.skew import BROADCAST_ROWS, fits_broadcast, lookup_join
from logweir.workspace import settle

# The label of an indicator hit, and the mark of a query response.
LABEL = "Malicious IP Founded in DNSMASQ: "
QUERY_LIKE = "%query%"


class Matches(NamedTuple):
    alerts: DataFrame
    remainder: DataFrame


def _labels(indicators: DataFrame) -> DataFrame:
    known = indicators.select("owner", "value2").filter(F.col("value2") != "").distinct()
    return known.withColumn("_label", F.concat(F.lit(LABEL), "value2"))


def detect(
    df: DataFrame, indicators: DataFrame, spread: list[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``detection``: the hit's label, or the empty string.

    An empty indicator is none: it would hit every message that does not parse.
    """
    labels = _labels(indicators)
    found = lookup_join(df, labels, ["owner", "value2"], "left", spread, max_rows=max_rows)
    return found.select(*df.columns, F.coalesce("_label", F.lit("")).alias("detection"))


def count_alerts(detected: DataFrame, subject: str = "value2") -> DataFrame:
    """Detected rows per owner, subject and label."""
    return (
        detected.filter(F.col("detection") != "")
        .groupBy("owner", subject, "detection")
        .agg(F.count("*").alias("count"))
    )


def first_of_each_name(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows of each (owner, value1).

    Spark limits each group to ``n`` rows in the map tasks already, so a hot name is not collected.
    """
    window = Window.partitionBy("owner", "value1").orderBy(*order)
    return df.withColumn("row_num", F.row_number().over(window)).filter(F.col("row_num") <= n).drop("row_num")


def match_indicators(
    df: DataFrame,
    indicators: DataFrame,
    spread: list[str],
    keep_first_n: int = 0,
    order: list[str] | None = None,
    cached: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> Matches:
    """Alerts of indicator hits, and the rows to score: undetected, of names never seen on a hit.

    ``keep_first_n`` also keeps the undetected ones among the first rows, in ``order``, of each such name.
    Hits are counted by address and name and written out once; alerts and names come from these counts, so that ``df``
    is computed once for them and once for the remainder. With more indicators than can be broadcast, where hot keys
    have to be counted first, ``df`` is written out and computed once in all. Where ``df`` is ``cached`` the counts are
    worked out again instead.
    """
    if not cached and not fits_broadcast(_labels(indicators), max_rows):
        df = settle(df)
    detected = detect(df, indicators, spread, max_rows)
    undetected = F.col("detection") == ""
    hits = detected.filter(~undetected).groupBy("owner", "value1", "value2", "detection").agg(F.count("*").alias("n"))
    if not cached:
        hits = settle(hits)
    alerts = hits.groupBy("owner", "value2", "detection").agg(F.sum("n").alias("count"))
    names = hits.filter(F.col("value1").isNotNull()).select("owner", "value1").distinct()

    def against(rows: DataFrame, how: str) -> DataFrame:
        return lookup_join(rows, names, ["owner", "value1"], how, spread, max_rows=max_rows)

    remainder = against(detected.filter(undetected), "left_anti").select(*df.columns)
    if keep_first_n:
        first = first_of_each_name(against(detected, "left_semi"), keep_first_n, order or spread)
        remainder = remainder.unionByName(first.filter(undetected).select(*df.columns))
    return Matches(alerts, remainder)


def derive_indicators(scored: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Addresses of anomalous query records per owner, without those already known.

    On a query record the address is the asking host's.
    """
    found = (
        scored.filter((F.col("prediction") == 1) & F.col("response").like(QUERY_LIKE))
        .select("owner", "value2")
        .distinct()
    )
    # Both sides are distinct pairs, so this join has no hot key.
    return found if known is None else found.join(known, ["owner", "value2"], "left_anti")
