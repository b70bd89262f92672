"""Times of log records. Unreadable times give null."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch(text: Column, pattern: str) -> Column:
    # Syslog pads the day with a blank; the parser wants single blanks.
    single_blanks = F.regexp_replace(text, " +", " ")
    return F.unix_timestamp(F.try_to_timestamp(single_blanks, F.lit(pattern)))


def syslog_epoch(c: str, year: int) -> Column:
    """Seconds since 1970 of ``Jan 21 00:01:44``, which has no year, in the session time zone."""
    return _epoch(F.concat(F.col(c), F.lit(f" {year}")), "MMM d HH:mm:ss yyyy")


def error_log_epoch(c: str) -> Column:
    """Seconds since 1970 of ``Jan 18 10:07:23.284717 2022``, fraction dropped."""
    return _epoch(F.col(c), "MMM d HH:mm:ss.SSSSSS yyyy")


def day_of_week(epoch: str) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(F.timestamp_seconds(F.col(epoch)))
