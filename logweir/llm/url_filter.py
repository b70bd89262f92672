"""URL filters: rules for hosts and paths, and gradient-boosted trees on lexical features for the URLs they leave.

Features are native expressions of the URL alone, besides two statistics of its host's suffixes that are learnt from
the labelled URLs; the trees are Spark's. Nothing leaves the JVM.
"""

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.text import char_count, entropy
from logweir.llm.tables import small_or_shuffled, written

#: The trees are fitted on at most so many labelled URLs, chosen by a hash of the URL.
TRAIN_ROWS = 200_000
#: How strongly a suffix's share of bad URLs is drawn to the overall one.
PRIOR = 20.0
SUFFIXES = (1, 2)
PLAIN = (
    "url_chars", "host_chars", "path_chars", "depth", "host_labels", "digit_share", "host_digit_share",
    "url_entropy", "host_entropy", "n_params", "query_chars", "n_hyphens", "fragment", "secure",
)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, text: str) -> "Rule":
        """From text like ``block example.com/de/``."""
        verdict, _, place = text.partition(" ")
        host, _, path = place.partition("/")
        return cls(verdict, host, f"/{path}")

    @property
    def place(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


RULES = tuple(Rule.of(x) for x in ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_place(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Place and verdict of the longest rule that fits columns ``host`` and ``path``; null if none does.

    Of fitting rules of one length all have the same place, so the first given wins.
    """
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.place)):
        fits = rule.fits(F.col("host"), F.col("path"))
        place = F.when(fits, rule.place).otherwise(place)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return place, verdict


def _suffix(labels: int) -> Column:
    """The last labels of the host, all of it if it has fewer."""
    return F.substring_index("host", ".", -labels)


def lexical(urls: DataFrame) -> DataFrame:
    """Add the features in ``PLAIN`` and the host's suffixes to rows with ``url``, ``host`` and ``path``; null is empty."""
    url = F.coalesce("url", F.lit(""))
    share = lambda c: F.regexp_count(c, F.lit("[0-9]")) / F.greatest(F.length(c), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    values = {
        "url_chars": F.length(url),
        "host_chars": F.length("host"),
        "path_chars": F.length("path"),
        "depth": F.regexp_count("path", F.lit("/[^/]")),
        "host_labels": F.size(F.split("host", r"\.")),
        "digit_share": share(url),
        "host_digit_share": share(F.col("host")),
        "url_entropy": entropy(url),
        "host_entropy": entropy("host"),
        "n_params": F.regexp_count(query, F.lit("[^&]+")),
        "query_chars": F.length(query),
        "n_hyphens": char_count("host", "-"),
        "fragment": url.contains("#").cast("int"),
        "secure": url.startswith("https:").cast("int"),
    }
    suffixes = {f"suffix{k}": _suffix(k) for k in SUFFIXES}
    return urls.withColumns({k: v.cast("double") for k, v in values.items()} | suffixes)


@dataclass
class UrlModel:
    """Fitted trees, suffix tables and the overall share of bad URLs; ``trees`` is None if one class was missing."""

    trees: GBTClassificationModel | None
    suffixes: dict[int, DataFrame]
    share: float

    def judge(self, urls: DataFrame) -> DataFrame:
        """Add ``bad`` (boolean) and ``score`` (its probability) to rows with url, host and path."""
        rows = self.features(lexical(urls))
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.share)).withColumn("bad", F.lit(self.share > 0.5))
        rows = self.trees.transform(_assembled(rows))
        score = F.get(vector_to_array("probability"), F.lit(1))
        return rows.withColumn("score", score).withColumn("bad", F.col("prediction") > 0.5)

    def features(self, rows: DataFrame) -> DataFrame:
        """Shares of bad URLs and logarithms of counts of the suffixes; unseen ones get the overall share and 0."""
        for k, stats in self.suffixes.items():
            rows = rows.join(small_or_shuffled(stats), f"suffix{k}", "left")
            rows = rows.withColumn(f"suffix{k}_bad", F.coalesce(f"suffix{k}_bad", F.lit(self.share)))
            rows = rows.withColumn(f"suffix{k}_log", F.coalesce(f"suffix{k}_log", F.lit(0.0)))
        return rows


def _assembled(rows: DataFrame) -> DataFrame:
    names = [*PLAIN, *(f"suffix{k}_{what}" for k in SUFFIXES for what in ("bad", "log"))]
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows)


def fit_urls(labelled: DataFrame, trees: int = 20, depth: int = 4, train_rows: int = TRAIN_ROWS) -> UrlModel:
    """Fit on rows with ``url``, ``host``, ``path`` and ``bad`` (0 or 1; null is left out).

    Suffix statistics are taken over all labelled rows, trees are fitted on at most about ``train_rows`` of them.
    """
    rows = written(lexical(labelled.filter("bad is not null").withColumn("bad", F.col("bad").cast("double"))), "url-rows")
    total = rows.agg(F.count("*").alias("n"), F.avg("bad").alias("share")).first()
    share = float(total.share or 0.0)
    stats = {}
    for k in SUFFIXES:
        counts = rows.groupBy(f"suffix{k}").agg(F.count("*").alias("n"), F.sum("bad").alias("b"))
        smooth = (F.col("b") + PRIOR * share) / (F.col("n") + PRIOR)
        stats[k] = written(
            counts.select(f"suffix{k}", smooth.alias(f"suffix{k}_bad"), F.log1p("n").alias(f"suffix{k}_log")), "url-suffixes"
        )
    model = UrlModel(None, stats, share)
    if not 0 < share < 1:
        return model
    part = max(1, round(total.n / train_rows))
    sample = rows.filter(F.pmod(F.xxhash64("url"), F.lit(part)) == 0)
    ready = _assembled(model.features(sample)).select("features", "bad")
    gbt = GBTClassifier(featuresCol="features", labelCol="bad", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7)
    model.trees = gbt.fit(ready)
    return model


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[Rule] = RULES, id_col: str = "page_id", **options) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    The longest fitting rule decides; other URLs are blocked if the trees say they are bad. ``labelled`` has ``url``
    and ``bad``; without it the URLs of ``pages`` that a rule decides are the labelled ones. If these are all good
    or all bad, so is every other URL; if there are none, every other URL is allowed. A null URL, or one without
    ``://``, has an empty host and path. Repeated rows get equal verdicts, an empty table gives no rows; other
    columns are ignored.
    """
    place, verdict = rule_place(rules)
    parts = lambda df: df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = parts(pages.select(F.col(id_col).alias("id"), F.col("url").cast("string").alias("url")))
    rows = rows.withColumns({"rule": place, "by_rule": verdict})
    if labelled is None:
        known = rows.filter("by_rule is not null")
        known = known.select("url", "host", "path", (F.col("by_rule") == "block").cast("int").alias("bad"))
    else:
        known = parts(labelled.select("url", "bad"))
    judged = fit_urls(known, **options).judge(rows)
    by_trees = F.when(F.col("bad"), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), "score"
    )
