"""Column expressions. Everything here stays on the JVM side."""

from logweir.functions.address import ip_class
from logweir.functions.text import (
    capital_count,
    char_count,
    entropy,
    has_file_extension,
    is_readable,
    strip,
)
from logweir.functions.times import day_of_week, error_log_epoch, syslog_epoch

__all__ = [
    "capital_count",
    "char_count",
    "day_of_week",
    "entropy",
    "error_log_epoch",
    "has_file_extension",
    "ip_class",
    "is_readable",
    "strip",
    "syslog_epoch",
]
