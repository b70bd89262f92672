"""One batch of log lines, from text to alerts, scores and new indicators."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.operators.features import dns_features, dns_features_temporal
from logweir.operators.idrules import apache_id_rules
from logweir.operators.indicators import derive_indicators, match_indicators
from logweir.operators.parse import parse_apache_access, parse_apache_error, parse_dnsmasq
from logweir.operators.ruleset import DEFAULT_RULES, Rule, rules_table
from logweir.operators.templates import index_with_vocabulary
from logweir.schema import APACHE_ACCESS, APACHE_ERROR, CORRUPT, DNSMASQ
from logweir.sources.lines import decode, quarantine, route, unrouted

Scorer = Callable[[DataFrame], DataFrame]

# What varies among records that share a name or an address.
RECORD = ["message", "epoch_timestamp"]


class BatchResult(NamedTuple):
    """``rows`` are the DNS records with features, ``decoded`` all lines; both are cached if so asked.

    ``counts`` has the decoded lines by what became of them: (phase, rows), a phase being a log format,
    ``unrouted`` or ``quarantine``.
    """

    decoded: DataFrame
    rows: DataFrame
    quarantine: DataFrame
    features: DataFrame
    alerts: DataFrame
    scored: DataFrame
    indicators: DataFrame
    errors: DataFrame
    error_alerts: DataFrame
    access: DataFrame
    unrouted: DataFrame
    counts: DataFrame

    def release(self) -> None:
        self.rows.unpersist()
        self.decoded.unpersist()


FORMATS = ["dnsmasq", "apache_error", "apache2_access"]


def run_batch(
    lines: DataFrame,
    known: DataFrame,
    score: Scorer,
    year: int,
    index: StringIndexerModel | DataFrame | None = None,
    cache: bool = False,
    rules: list[Rule] | None = None,
) -> BatchResult:
    """Decode and route. DNS: parse, match against ``known`` indicators, score what is left, derive indicators.
    Web errors: parse, and alerts of the rules with error codes. Everything else is passed on or set aside.

    ``owner`` stays a column throughout, so all owners run in one plan. ``index`` is a fitted model or a vocabulary
    table; without it there is no ``encoded_key``, and a scorer that needs it fails: numbers made anew for each batch
    would mean something else to a model trained before. ``cache`` keeps what the several outputs share, so that the
    source is read once; call ``release`` after use.
    """
    decoded = decode(lines)
    if cache:
        decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
    parsed = parse_dnsmasq(route(decoded, "dnsmasq", DNSMASQ), year)
    if index is None:
        indexed = parsed
    elif isinstance(index, DataFrame):
        indexed = index_with_vocabulary(parsed, index, RECORD)
    else:
        indexed = index.transform(parsed)
    rows = dns_features(indexed)
    if cache:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    matches = match_indicators(rows, known, RECORD, cached=cache)
    scored = score(matches.remainder)
    errors = parse_apache_error(route(decoded, "apache_error", APACHE_ERROR))
    table = rules_table(lines.sparkSession, rules or DEFAULT_RULES)
    phase = F.when(F.col(CORRUPT).isNotNull(), "quarantine").when(F.col("log_format").isin(FORMATS), F.col("log_format"))
    counts = decoded.groupBy(phase.otherwise("unrouted").alias("phase")).agg(F.count("*").alias("rows"))
    return BatchResult(
        decoded,
        rows,
        quarantine(decoded),
        rows,
        matches.alerts,
        scored,
        derive_indicators(scored, known),
        errors,
        apache_id_rules(errors, table, ["message"]),
        parse_apache_access(route(decoded, "apache2_access", APACHE_ACCESS)),
        unrouted(decoded, FORMATS),
        counts,
    )


def score_temporal(df: DataFrame, score: Scorer, tie: str) -> DataFrame:
    """Scores of parsed and indexed records by the 13 features, without rules: message, names, prediction."""
    scored = score(dns_features_temporal(df, tie))
    return scored.select(tie, "owner", "message", "value1", "value2", "prediction")


def anomalies(scored: DataFrame) -> DataFrame:
    """The anomalous rows, without the prediction."""
    return scored.filter(F.col("prediction") == 1).drop("prediction")
