"""Fixed column layouts of the log formats and of the derived tables."""

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


APACHE_ERROR = T.StructType(_strings("time log_format owner level pid client message"))
APACHE_ACCESS = T.StructType(
    _strings("host owner log_format user method path code size referer agent")
)
DNSMASQ = T.StructType(_strings("time ident owner log_format pid message"))

# One decode covers every format; fields a format lacks come out null.
CORRUPT = "_corrupt_record"
ANY_LOG = T.StructType(
    _strings(
        "log_format owner time ident pid message level client"
        " host user method path code size referer agent"
    )
)
ANY_LOG_OR_CORRUPT = T.StructType(ANY_LOG.fields + _strings(CORRUPT))

INDICATOR = T.StructType(_strings("owner value2"))

# Model input order of the two classifiers.
FEATURES_18 = """
    encoded_key key_length value1_length value2_length
    value1_dot_count value1_hyphen_count value1_slash_count value1_asterisk_count
    value1_capital_count value1_has_file_extensions value1_human_readable
    value2_dot_count value2_hyphen_count value2_slash_count value2_asterisk_count
    value2_capital_count value2_has_file_extensions value2_ip_class
""".split()

FEATURES_13 = """
    encoded_key time_diff_unix day_of_week value1_length value2_length
    value1_dot_count value1_hyphen_count value2_dot_count value2_hyphen_count
    key_length value1_count value2_count value2_ip_class
""".split()
