"""Classes of network addresses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIVATE, PUBLIC, NOT_AN_ADDRESS = 0, 1, 2

_PART = r"\s*[+-]?[0-9]+\s*"
_DOTTED_NUMBERS = rf"^{_PART}(?:\.{_PART})*$"
# 172 and 192 need a second part to be decided.
_UNDECIDED = r"^\s*\+?0*(?:172|192)\s*$"
_PRIVATE_RANGES = (
    r"^\s*\+?0*(?:"
    r"10\s*(?:\.|$)"
    r"|172\s*\.\s*\+?0*(?:1[6-9]|2[0-9]|3[01])\s*(?:\.|$)"
    r"|192\s*\.\s*\+?0*168\s*(?:\.|$)"
    r")"
)


def ip_class(c) -> Column:
    """0 for a private address, 1 for other dotted integers, 2 for anything else, null included.

    Number of parts and their range are not checked.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (
        F.when(c.isNull() | ~c.rlike(_DOTTED_NUMBERS) | c.rlike(_UNDECIDED), NOT_AN_ADDRESS)
        .when(c.rlike(_PRIVATE_RANGES), PRIVATE)
        .otherwise(PUBLIC)
    )
