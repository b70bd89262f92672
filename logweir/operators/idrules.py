"""Rules that name error codes."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir.operators.indicators import count_alerts
from logweir.operators.skew import lookup_join

# The code at the head of an entity, and a source address with an optional port.
CODE = r"(\S+):"
ADDRESS = r"(\d+\.\d+\.\d+\.\d+):?(\d+)?"


def code_labels(rules: DataFrame, last_id_only: bool = False) -> DataFrame:
    """Table (code, detection) of the rules with codes; labels sharing a code are joined by commas.

    ``last_id_only`` keeps the last code of each description, where several would otherwise count.
    """
    codes = rules.filter(F.col("codes").isNotNull()).select(
        "rule_id", "description", F.posexplode("codes").alias("position", "code")
    )
    if last_id_only:
        last = Window.partitionBy("description").orderBy(F.desc("rule_id"), F.desc("position"))
        codes = codes.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") == 1)
    in_order = F.array_sort(F.collect_set(F.struct("rule_id", "description")))
    labels = F.array_distinct(F.transform(in_order, lambda r: r["description"]))
    return codes.groupBy("code").agg(F.array_join(labels, ",").alias("_label"))


def with_source(df: DataFrame) -> DataFrame:
    """Add ``srcip`` and ``srcport`` of the client column."""
    return df.withColumns(
        {"srcip": F.regexp_extract("client", ADDRESS, 1), "srcport": F.regexp_extract("client", ADDRESS, 2)}
    )


def detect_codes(df: DataFrame, rules: DataFrame, spread: list[str], last_id_only: bool = False) -> DataFrame:
    """Add ``detection`` from the code in ``entity``, and the source columns."""
    coded = with_source(df).withColumn("code", F.regexp_extract("entity", CODE, 1))
    found = lookup_join(coded, code_labels(rules, last_id_only), ["code"], "left", spread)
    kept = [c for c in coded.columns if c != "code"]
    return found.select(*kept, F.coalesce("_label", F.lit("")).alias("detection"))


def apache_id_rules(
    df: DataFrame, rules: DataFrame, spread: list[str], last_id_only: bool = False
) -> DataFrame:
    """Alerts (owner, srcip, detection, count) of parsed web errors."""
    return count_alerts(detect_codes(df, rules, spread, last_id_only), "srcip")
