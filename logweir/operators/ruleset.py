"""The default web-server rules as plain values, and rules from XML files.

The values of the default rules (ids, levels, patterns, texts) are those of a public rule set under the GNU General
Public License, version 2; the code around them is our own.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Rule(NamedTuple):
    rule_id: int
    level: int
    noalert: bool = False
    frequency: int | None = None
    timeframe: int | None = None
    decoded_as: str | None = None
    parents: list[int] | None = None
    counted_rule: int | None = None
    same_source: bool = False
    match: str | None = None
    regex: str | None = None
    codes: list[str] | None = None
    description: str = ""
    techniques: list[str] | None = None
    tags: list[str] | None = None


SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("noalert", T.BooleanType()),
        T.StructField("frequency", T.IntegerType()),
        T.StructField("timeframe", T.IntegerType()),
        T.StructField("decoded_as", T.StringType()),
        T.StructField("parents", T.ArrayType(T.IntegerType())),
        T.StructField("counted_rule", T.IntegerType()),
        T.StructField("same_source", T.BooleanType()),
        T.StructField("match", T.StringType()),
        T.StructField("regex", T.StringType()),
        T.StructField("codes", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("techniques", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

_MISSING_FILE = (
    "File does not exist: |failed to open stream: No such file or directory|Failed opening "
)

# Id, level, parents, condition, description, technique and leading tag of each rule.
# Compliance tags decide nothing and are left to the XML files.
DEFAULT_RULES = [
    Rule(30100, 0, decoded_as="apache-errorlog", description="Apache messages grouped."),
    Rule(30101, 0, parents=[30100], match="^[error] ", description="Apache error messages grouped."),
    Rule(30102, 0, parents=[30100], match="^[warn] ", description="Apache warn messages grouped."),
    Rule(30103, 0, parents=[30100], match="^[notice] ", description="Apache notice messages grouped."),
    Rule(30104, 12, parents=[30103], match="exit signal Segmentation Fault",
         description="Apache: segmentation fault.", tags=["service_availability"]),
    Rule(30105, 5, parents=[30101], match="denied by server configuration",
         description="Apache: Attempt to access forbidden file or directory.", tags=["access_denied"]),
    Rule(30106, 5, parents=[30101], match="Directory index forbidden by rule",
         description="Apache: Attempt to access forbidden directory index.", tags=["access_denied"]),
    Rule(30107, 6, parents=[30101], match="Client sent malformed Host header",
         description="Apache: Code Red attack.", techniques=["T1102"], tags=["automatic_attack"]),
    Rule(30108, 5, parents=[30102], match="authentication failed",
         description="Apache: User authentication failed.", tags=["authentication_failed"]),
    Rule(30109, 9, parents=[30101], regex=r"user \S+ not found|user \S+ in realm \.* not found",
         description="Apache: Attempt to login using a non-existent user.", tags=["invalid_login"]),
    Rule(30110, 5, parents=[30101], match="authentication failure",
         description="Apache: User authentication failed.", tags=["authentication_failed"]),
    Rule(30112, 0, parents=[30101], match=_MISSING_FILE, tags=["unknown_resource"],
         description="Apache: Attempt to access an non-existent file (those are reported on the access.log)."),
    Rule(30115, 5, parents=[30101], match="Invalid URI in request",
         description="Apache: Invalid URI (bad client request).", tags=["invalid_request"]),
    Rule(30116, 10, frequency=10, timeframe=120, counted_rule=30115, same_source=True,
         description="Apache: Multiple Invalid URI requests from same source.",
         techniques=["T1499"], tags=["invalid_request"]),
    Rule(30117, 10, parents=[30101], match="File name too long|request failed: URI too long",
         description="Apache: Invalid URI, file name too long.", tags=["invalid_request"]),
    Rule(30118, 6, parents=[30101], match="mod_security: Access denied|ModSecurity: Access denied",
         description="ModSecurity: Access attempt blocked.", tags=["modsecurity", "access_denied"]),
    Rule(30119, 12, frequency=8, timeframe=120, counted_rule=30118, same_source=True,
         description="ModSecurity: Multiple attempts blocked.",
         techniques=["T1110"], tags=["modsecurity", "access_denied"]),
    Rule(30120, 12, parents=[30101], match="Resource temporarily unavailable:",
         description="Apache: without resources to run.", tags=["service_availability"]),
    Rule(30200, 6, noalert=True, match="^mod_security-message: ",
         description="Modsecurity alert.", tags=["modsecurity"]),
    Rule(30201, 6, parents=[30200], match="^mod_security-message: Access denied ",
         description="ModSecurity: access denied.", tags=["modsecurity", "access_denied"]),
    Rule(30202, 10, frequency=10, timeframe=120, counted_rule=30201,
         description="ModSecurity: Multiple attempts blocked.",
         techniques=["T1110"], tags=["modsecurity", "access_denied"]),
    Rule(30301, 0, parents=[30100], regex=r" [\S*:error] ", description="Apache error messages grouped."),
    Rule(30302, 0, parents=[30100], regex=r" [\S+:warn] ", description="Apache warn messages grouped."),
    Rule(30303, 0, parents=[30100], regex=r" [\S+:notice] ", description="Apache notice messages grouped."),
    Rule(30304, 12, parents=[30303], match="exit signal Segmentation Fault",
         description="Apache: segmentation fault.", tags=["service_availability"]),
    Rule(30305, 5, parents=[30301], codes=["AH01630"],
         description="Apache: Attempt to access forbidden file or directory.", tags=["access_denied"]),
    Rule(30306, 5, parents=[30301], codes=["AH01276"], techniques=["T1190"], tags=["access_denied"],
         description="Apache: Attempt to access forbidden directory index."),
    Rule(30307, 6, parents=[30301], codes=["AH00550"], techniques=["T1102"], tags=["automatic_attack"],
         description="Apache: Client sent malformed Host header. Possible Code Red attack."),
    Rule(30308, 5, parents=[30302],
         codes=["AH01617", "AH01807", "AH01694", "AH01695", "AH02009", "AH02010"],
         description="Apache: User authentication failed.", tags=["authentication_failed"]),
    Rule(30309, 5, parents=[30301], codes=["AH01618", "AH01808", "AH01790"],
         description="Apache: Attempt to login using a non-existent user.", tags=["invalid_login"]),
    Rule(30310, 10, frequency=12, timeframe=160, counted_rule=30309, same_source=True,
         description="Apache: Multiple authentication failures with invalid user.",
         techniques=["T1110"], tags=["authentication_failures"]),
    Rule(30312, 0, parents=[30301], match=_MISSING_FILE, tags=["unknown_resource"],
         description="Apache: Attempt to access an non-existent file (those are reported on the access.log)."),
    Rule(30315, 5, parents=[30301], codes=["AH00126"],
         description="Apache: Invalid URI (bad client request).", tags=["invalid_request"]),
    Rule(30316, 10, frequency=10, timeframe=120, counted_rule=30315, same_source=True,
         description="Apache: Multiple Invalid URI requests from same source.",
         techniques=["T1499"], tags=["invalid_request"]),
    Rule(30317, 10, parents=[30301], codes=["AH00565"],
         description="Apache: Invalid URI, file name too long.", tags=["invalid_request"]),
    Rule(30318, 5, parents=[30301], match="PHP Notice:", description="Apache: PHP Notice in Apache log"),
    Rule(30401, 0, parents=[30301], match="ModSecurity: Warning",
         description="ModSecurity Warning messages grouped", tags=["modsecurity"]),
    Rule(30402, 0, parents=[30301], match="ModSecurity: Access denied",
         description="ModSecurity Access denied messages grouped", tags=["modsecurity"]),
    Rule(30403, 0, parents=[30301], match="ModSecurity: Audit log:",
         description="ModSecurity Audit log messages grouped", tags=["modsecurity"]),
    Rule(30411, 7, parents=[30402], match="with code 403",
         description="ModSecurity rejected a query", techniques=["T1083"], tags=["modsecurity"]),
]


def paced(rules: list[Rule], slower: int) -> list[Rule]:
    """The frequency rules among ``rules`` for logs that are ``slower`` times as sparse, frequencies as they are."""
    return [r._replace(timeframe=r.timeframe * slower) for r in rules if r.counted_rule is not None]


def rules_table(spark: SparkSession, rules: list[Rule] = DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame(rules, SCHEMA)


# Strings throughout: inference would read a technique such as T1 as a time of day.
_XML = (
    "_id int, _level int, _frequency int, _timeframe int, _noalert int, decoded_as string,"
    " if_sid string, if_matched_sid string, same_source_ip string, match array<string>,"
    " regex array<string>, id string, description string,"
    " mitre struct<id: array<string>>, group array<string>,"
    " info array<struct<_VALUE: string, _type: string>>"
)


#: A group of rules: its name is a list of tags, and its rules are told by their ids.
_XML_GROUP = "_name string, rule array<struct<_id: int>>"


def _read_xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag)
    # Blanks at the ends belong to the patterns.
    return reader.option("ignoreSurroundingSpaces", "false").schema(schema).load(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of XML files as a table: the columns of ``SCHEMA``, ``info``, and ``groups``.

    ``tags`` are those of the rule itself, ``groups`` those that the name of the enclosing group gives to all its rules;
    a rule outside any has none. Attributes of elements, such as the kind of a pattern, are passed over; those of
    ``info`` are kept.
    """
    xml = _read_xml(spark, path, "rule", _XML)

    def items(text, separator):
        return F.filter(F.transform(F.split(text, separator), lambda item: F.trim(item)), lambda item: item != "")

    tags = F.flatten(F.transform("group", lambda text: items(text, ",")))
    # An element of the same name within a rule lists tags; as a row it has no rules.
    enclosing = _read_xml(spark, path, "group", _XML_GROUP).select(items(F.col("_name"), ",").alias("groups"), F.explode("rule._id").alias("_id"))
    enclosing = enclosing.groupBy("_id").agg(F.array_distinct(F.flatten(F.collect_list("groups"))).alias("groups"))
    xml = xml.join(enclosing, "_id", "left")
    return xml.select(
        F.col("_id").alias("rule_id"),
        F.col("_level").alias("level"),
        (F.coalesce("_noalert", F.lit(0)) == 1).alias("noalert"),
        F.col("_frequency").alias("frequency"),
        F.col("_timeframe").alias("timeframe"),
        F.trim("decoded_as").alias("decoded_as"),
        items(F.col("if_sid"), ",").cast("array<int>").alias("parents"),
        F.trim("if_matched_sid").cast("int").alias("counted_rule"),
        F.col("same_source_ip").isNotNull().alias("same_source"),
        # Repeated elements continue one pattern; there are none where the element is absent.
        F.when(F.size("match") > 0, F.array_join("match", "")).alias("match"),
        F.when(F.size("regex") > 0, F.array_join("regex", "")).alias("regex"),
        items(F.col("id"), r"\|").alias("codes"),
        F.trim("description").alias("description"),
        F.col("mitre.id").alias("techniques"),
        tags.alias("tags"),
        F.col("info"),
        F.coalesce("groups", F.array().cast("array<string>")).alias("groups"),
    )


def as_rules(table: DataFrame) -> list[Rule]:
    """Rules of a table as values. A rule set is configuration: it is read as code would be."""
    return [Rule(**row.asDict()) for row in table.select(*SCHEMA.names).orderBy("rule_id").toLocalIterator()]
