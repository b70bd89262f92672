"""Message text to templates and parameters."""

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions import error_log_epoch, syslog_epoch
from logweir.schema import APACHE_ACCESS

# The message patterns and the marker for a variable part.
DNS_MESSAGE = r"([a-z]+\[?[A-Z]*\]?)\s(\S+)\s([fromtois]+)\s(\S+)"
ERROR_MESSAGE = (
    r"([^:']+:?)(('[^']+')?(\snot found or unable to stat))?"
    r"(\s*([^\/:,'\(]+:?[^:\/,'\(]+:?)\s*(.*?(?=, referer|$)))?((, referer:)(.*))?"
)
ANY = "<*>"
REFERER = ", referer:"


def _other_columns(df: DataFrame, *consumed: str) -> list[str]:
    return [c for c in df.columns if c not in consumed]


def _indexed(df: DataFrame, index: StringIndexerModel | None) -> DataFrame:
    return df if index is None else index.transform(df)


def parse_dnsmasq(df: DataFrame, year: int, index: StringIndexerModel | None = None) -> DataFrame:
    """DNS records to ``response``, ``key``, ``value1`` (name), ``value2`` (address), ``epoch_timestamp``.

    A message that does not fit gives empty parts. ``index`` adds ``encoded_key``.
    """
    # No part of the pattern can hold a blank, so one match split at its blanks gives all four.
    parts = F.split(F.regexp_extract("message", DNS_MESSAGE, 0), r"\s")
    split = df.withColumns({"_parts": parts, "epoch_timestamp": syslog_epoch("time", year)})

    def part(i: int):
        return F.when(
            F.col("message").isNotNull(), F.coalesce(F.get("_parts", F.lit(i)), F.lit(""))
        )

    parsed = split.select(
        *_other_columns(df, "pid", "time"),
        part(0).alias("response"),
        F.concat(part(0), F.lit(f" {ANY} "), part(2), F.lit(f" {ANY}")).alias("key"),
        part(1).alias("value1"),
        part(3).alias("value2"),
        "epoch_timestamp",
    )
    return _indexed(parsed, index)


# What each part of a web-server error is called here, and the pattern's group that holds it.
ERROR_PARTS = {
    "entity": 1,
    "file": 3,
    "missing": 4,
    "problem": 6,
    "detail": 7,
    "referer": 9,
    "referring_page": 10,
}
# Stands between the parts while they are taken apart; text that holds it goes the slow way.
_BETWEEN = "\x1f"
_WHOLE_MESSAGE = rf"(?s)^[:']*+(?-s:{ERROR_MESSAGE}).*$"


def extract_error_parts(df: DataFrame) -> DataFrame:
    """Add the seven parts of a web-server error message; empty where the message lacks one.

    The pattern is matched once: the message is replaced by its parts in a row, and these are split.
    """
    row = _BETWEEN.join(f"${group}" for group in ERROR_PARTS.values())
    parts = F.split(F.regexp_replace("message", _WHOLE_MESSAGE, row), _BETWEEN)
    one_by_one = F.array(*(F.regexp_extract("message", ERROR_MESSAGE, group) for group in ERROR_PARTS.values()))
    nothing = F.array(*([F.lit("")] * len(ERROR_PARTS)))
    # A message of quotes and colons alone fits nowhere and stays one piece.
    found = F.when(F.col("message").contains(_BETWEEN), one_by_one).otherwise(
        F.when(F.size(parts) == len(ERROR_PARTS), parts).when(F.col("message").isNotNull(), nothing)
    )

    def named(split):
        return F.struct(*(F.get(split, F.lit(i)).alias(name) for i, name in enumerate(ERROR_PARTS)))

    # Within the lambda the message is matched once, however often its parts are used. As a generator it stays in
    # place: Spark would move conditions on the parts below the projection and match again for each.
    return df.select(*df.columns, F.inline(F.transform(F.array(found), named)))


def parse_apache_error(df: DataFrame, index: StringIndexerModel | None = None) -> DataFrame:
    """Web-error records to ``entity``, ``key``, ``value`` (array) and ``epoch_timestamp``."""
    marks = F.when(F.col("referer") == REFERER, ANY).otherwise("")
    key = F.concat("entity", F.lit(" "), "problem", F.lit(ANY), "missing", "referer", marks)
    parsed = extract_error_parts(df).select(
        *_other_columns(df, "pid", "time"),
        "entity",
        key.alias("key"),
        error_log_epoch("time").alias("epoch_timestamp"),
        F.array("file", "detail", "referring_page").alias("value"),
    )
    return _indexed(parsed, index)


def parse_apache_access(df: DataFrame) -> DataFrame:
    """Access records as they are, in the fixed layout, after any other columns."""
    return df.select(*_other_columns(df, *APACHE_ACCESS.names), *APACHE_ACCESS.names)
