"""Model features of parsed DNS records."""

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions import (
    capital_count,
    char_count,
    day_of_week,
    entropy,
    has_file_extension,
    ip_class,
    is_readable,
)
from logweir.operators.ordered import running_value_count, time_gap
from logweir.operators.skew import hot_keys, lookup_join
from logweir.schema import FEATURES_13, FEATURES_18
from logweir.workspace import settle

_CHARS = {"dot": ".", "hyphen": "-", "slash": "/", "asterisk": "*"}


def _lexical(value: str, extension_mode: str) -> dict:
    features = {f"{value}_length": F.length(value)}
    for name, char in _CHARS.items():
        features[f"{value}_{name}_count"] = char_count(value, char)
    features[f"{value}_capital_count"] = capital_count(value)
    features[f"{value}_has_file_extensions"] = has_file_extension(value, extension_mode)
    return features


def dns_features(df: DataFrame, extension_mode: str = "substring") -> DataFrame:
    """Add the 18 features to parsed records. One projection, no shuffle.

    Records without ``encoded_key`` get the other 17.
    """
    added = {
        "encoded_key": F.col("encoded_key").cast("int"),
        "key_length": F.length("key"),
        **_lexical("value1", extension_mode),
        "value1_human_readable": is_readable(entropy("value1")),
        **_lexical("value2", extension_mode),
        "value2_ip_class": ip_class("value2"),
    }
    kept = [c for c in df.columns if c not in added]
    names = [n for n in FEATURES_18 if n != "encoded_key" or n in df.columns]
    return df.select(*kept, *[added[name].alias(name) for name in names])


def with_value_counts(
    df: DataFrame, group: str, outs: dict[str, str], tie: str, counted: DataFrame | None = None
) -> DataFrame:
    """For each value column of ``outs``, add how many rows of the group have a value up to and including this one's.

    A null value gives 0. All columns are counted in one pass. ``counted`` has the same rows where ``df`` is
    costly to compute a second time.
    """
    named = [F.struct(F.lit(value).alias("_column"), F.col(value).alias("_value")) for value in outs]
    stacked = (df if counted is None else counted).select(group, F.inline(F.array(*named)))
    running = running_value_count(stacked, [group, "_column"], "_value", "_running")
    for value, out in outs.items():
        of_column = running.filter(F.col("_column") == value).select(
            group, F.col("_value").alias(value), "n", F.col("_running").alias(out)
        )
        hot = partial(hot_keys, of_column, [group, value], "n")
        joined = lookup_join(df, of_column.drop("n"), [group, value], "left", [tie], hot)
        df = joined.select(*df.columns, F.coalesce(out, F.lit(0)).cast("bigint").alias(out))
    return df


def dns_features_temporal(df: DataFrame, tie: str, group: str = "owner") -> DataFrame:
    """Add the 13 features, time gaps and running counts among them, to parsed records.

    ``tie`` names a unique key; it orders records of the same second. What needs an order is worked out on the five
    columns it depends on, written out once, and joined back by ``tie``: whole records are shuffled once, or not at
    all where the measures are within the bounds of a broadcast.
    """
    narrow = settle(df.select(tie, group, "epoch_timestamp", "value1", "value2"))
    gapped = time_gap(narrow, group, "epoch_timestamp", tie, "time_diff_unix")
    outs = {"value1": "value1_count", "value2": "value2_count"}
    measured = with_value_counts(gapped, group, outs, tie, narrow).select(tie, "time_diff_unix", *outs.values())
    measured = settle(measured)
    none_hot = partial(measured.select(tie, F.lit(1).alias("_salts")).limit, 0)
    counted = lookup_join(df, measured, [tie], "left", [tie], none_hot)
    added = {
        "encoded_key": F.col("encoded_key").cast("int"),
        "time_diff_unix": F.col("time_diff_unix"),
        "day_of_week": day_of_week("epoch_timestamp"),
        "value1_length": F.length("value1"),
        "value2_length": F.length("value2"),
        "value1_dot_count": char_count("value1", "."),
        "value1_hyphen_count": char_count("value1", "-"),
        "value2_dot_count": char_count("value2", "."),
        "value2_hyphen_count": char_count("value2", "-"),
        "key_length": F.length("key"),
        "value1_count": F.col("value1_count"),
        "value2_count": F.col("value2_count"),
        "value2_ip_class": ip_class("value2"),
    }
    kept = [c for c in df.columns if c not in added]
    return counted.select(*kept, *[added[name].alias(name) for name in FEATURES_13])
