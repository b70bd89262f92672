"""Log records made from the test tables.

The tables hold no logs, so each row of ``events`` becomes one record of each format, named after the host
of a page. The texts below are SQL that Spark and DuckDB both read: the input of a query and of its check
are the same, while everything computed from it is written twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = 2024

# The events of a month stand for a few minutes of logs: timeframes are so many times as long.
RULE_PACE = 7200

# Owners whose names a folder's name would not give back.
ODD_OWNERS = {"client01": "007", "client02": ""}

# Parts of the month that reach a stream one after the other. One event in so many comes late, by so many parts.
PARTS = 4
LATE_EVENT, LATE_PARTS = 40, 2

OWNER = "'client0' || CAST(user_id % 3 + 1 AS STRING)"

_USER = "CAST(user_id AS STRING)"
_NET = "CAST(user_id % 4 AS STRING) || '.' || CAST(user_id AS STRING)"
_HASH = "md5(CAST(event_id AS STRING))"
_ENCODED = (
    f"'9q4-.' || upper(substr({_HASH}, 1, 20)) || '*' || substr({_HASH}, 21, 6) || '/'"
    f" || substr({_HASH}, 27, 6) || '-.ledger_pages_2.xlsx.' || host"
)

DNS_MESSAGE = f"""CASE
    WHEN event_type = 'click' THEN 'query[A] ' || host || ' from 10.143.' || {_NET}
    WHEN event_type = 'view' THEN 'query[AAAA] ' || host || ' from 10.143.' || {_NET}
    WHEN event_type = 'signup' THEN 'query[TXT] ' || {_ENCODED} || ' from 10.143.' || {_NET}
    WHEN event_type = 'purchase' AND value < 3 THEN 'started, version 2.85 cachesize 150'
    WHEN event_type = 'purchase' THEN 'forwarded ' || host || ' to 192.168.231.254'
    WHEN user_id % 10 = 0 THEN 'reply ' || host || ' is NXDOMAIN'
    ELSE 'reply ' || host || ' is 195.128.194.' || {_USER} END"""

DNS_LINE = (
    """'{"time":"' || time || '","ident":"dnsmasq","owner":"' || owner"""
    """ || '","log_format":"dnsmasq","pid":"3468","message":"' || message || '"}'"""
)

# Of seven lines one has a tail, one is glued to itself, one each is empty, blank and missing.
ODD_LINE = """CASE event_id % 7 WHEN 0 THEN value || ' tail' WHEN 1 THEN value || value WHEN 2 THEN ''
    WHEN 3 THEN '  ' WHEN 4 THEN NULL ELSE value END"""

# The codes of the rules that name some.
CODES = (
    "AH01630 AH01276 AH00550 AH01617 AH01807 AH01694 AH01695 AH02009 AH02010"
    " AH01618 AH01808 AH01790 AH00126 AH00565"
).split()

ERROR_LEVEL = """CASE
    WHEN event_type = 'click' AND value < 50 THEN 'autoindex:error'
    WHEN event_type = 'click' THEN 'core:warn'
    WHEN event_type = 'view' AND value < 40 THEN 'auth_basic:warn'
    WHEN event_type = 'view' THEN 'auth_basic:error'
    WHEN event_type = 'signup' THEN 'error'
    WHEN event_type = 'purchase' AND value >= 100 THEN 'core:notice'
    WHEN event_type = 'purchase' THEN 'php7:error'
    WHEN value < 60 THEN 'php7:warn'
    ELSE 'core:error' END"""

# Level and message of web errors that make each plain rule fire, in turn over the events.
RULE_TEXTS = [
    ("error", "client denied by server configuration: /srv/a"),
    ("error", "Directory index forbidden by rule: /srv/b/"),
    ("error", "Client sent malformed Host header"),
    ("warn", "user eve: authentication failed for /c"),
    ("error", "user eve in realm inner not found: /c"),
    ("error", "user eve: authentication failure for /c: Password Mismatch"),
    ("error", "File does not exist: /srv/d"),
    ("error", "Invalid URI in request GET /e"),
    ("error", "request failed: URI too long"),
    ("error", "(36)File name too long: access to /f"),
    ("error", "mod_security: Access denied with code 500"),
    ("error", "Resource temporarily unavailable: fork"),
    ("notice", "child pid 7 exit signal Segmentation Fault (11)"),
    ("info", "mod_security-message: Access denied with code 403"),
    ("info", "mod_security-message: rule engine started"),
    ("core:notice", "child pid 8 exit signal Segmentation Fault (11)"),
    ("core:error", "AH01630: client denied: /srv/g"),
    ("autoindex:error", "AH01276: Cannot serve directory /srv/h/"),
    ("core:error", "AH00550: Client sent malformed header"),
    ("auth_basic:warn", "AH01617: user eve: password mismatch"),
    ("auth_basic:error", "AH01618: user eve unknown: /c"),
    ("core:error", "AH00126: Invalid request"),
    ("core:error", "AH00565: request failed"),
    ("php7:error", "PHP Warning:  include(x.php): failed to open stream: No such file or directory"),
    ("php7:error", "PHP Notice:  undefined index"),
    ("security2:error", "ModSecurity: Warning. Match of x"),
    ("security2:error", "ModSecurity: Access denied with code 403 (phase 2)"),
    ("security2:error", "ModSecurity: Access denied with redirection"),
    ("security2:error", "ModSecurity: Audit log: no space"),
    ("core:info", "nothing to tell"),
]

ERROR_CLIENT = (
    f"'172.17.' || {_NET} || CASE WHEN event_type = 'view' THEN ''"
    " ELSE ':' || CAST(32768 + event_id % 20000 AS STRING) END"
)

ERROR_MESSAGE = f"""CASE
    WHEN event_type = 'click' THEN error_code || ': Cannot serve directory /var/www/' || host
        || '/: No matching DirectoryIndex (index.html,index.php) found, referer: https://' || host
    WHEN event_type = 'view' THEN error_code || ': user u' || {_USER} || ' not found: /' || host
    WHEN event_type = 'signup' AND value < 25 THEN 'mod_security-message: Access denied with code 403 on ' || host
    WHEN event_type = 'signup' AND value < 50 THEN 'ModSecurity: Access denied with code 403 (phase 2)'
    WHEN event_type = 'signup' THEN 'Invalid URI in request GET /' || host || ' HTTP/1.1'
    WHEN event_type = 'purchase' AND value >= 100 THEN 'child pid ' || {_USER} || ' exit signal Segmentation Fault (11)'
    WHEN event_type = 'purchase' AND value < 30 THEN 'script ''/var/www/' || host || '/p.php'' not found or unable to stat'
    WHEN event_type = 'purchase' THEN 'script ''/var/www/' || host
        || '/p.php'' not found or unable to stat, referer: https://' || host
    WHEN value < 60 THEN 'PHP Warning:  scandir(/var/www/' || host
        || '/cache/): failed to open dir: No such file or directory in /var/www/' || host || '/f.php on line ' || {_USER}
    ELSE 'ModSecurity: Access denied with code 403 (phase 2). Pattern match' END"""

ACCESS_FIELDS = {
    "host": f"'172.17.' || {_NET}",
    "user": "CASE WHEN event_type = 'signup' THEN 'u' || " + _USER + " ELSE '-' END",
    "method": "CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END",
    "path": "path",
    "code": "CASE WHEN event_type = 'error' THEN '404' ELSE '200' END",
    "size": "CAST(CAST(floor(value * 100) AS BIGINT) AS STRING)",
    "referer": "CASE WHEN event_type = 'view' THEN 'https://' || host || '/' ELSE '-' END",
    "agent": "'Mozilla/5.0 (X11; Linux x86_64)'",
}

PAGE_HOST = "^[a-z]+://([^/?#]+)"
PAGE_PATH = "^[a-z]+://[^/?#]+(/.*)$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def base_events(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    """Events, or a stream of them, with owner, and host and path of a page. Page numbers are 0 to n - 1."""
    pages = table(spark, sf_dir, "pages")
    n_pages = pages.agg(F.max("page_id") + 1).first()[0]
    hosts = pages.select(
        "page_id",
        F.regexp_extract("url", PAGE_HOST, 1).alias("host"),
        F.regexp_extract("url", PAGE_PATH, 1).alias("path"),
    )
    events = table(spark, sf_dir, "events")
    source = events if stream is None else stream
    keyed = source.withColumns({"page_id": F.col("event_id") % n_pages, "owner": F.expr(OWNER)})
    # Neither side is hinted: Spark broadcasts the smaller if its size allows, and event numbers are even.
    return keyed.join(hosts, "page_id")


def part_of(epoch: str, low: str, high: str) -> str:
    """The part of the month that a second is in, between the first and the last second."""
    return f"CAST(floor(({epoch} - {low}) * {PARTS} / ({high} - {low} + 1)) AS INT)"


def arrival_of(part: str) -> str:
    """The part with which an event comes where some come late."""
    return f"CASE WHEN event_id % {LATE_EVENT} = 0 THEN least({part} + {LATE_PARTS}, {PARTS - 1}) ELSE {part} END"


def dealt_events(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Events, and the part (``arrival``) with which each reaches a stream."""
    second = "unix_seconds(CAST(ts AS TIMESTAMP))"
    events = table(spark, sf_dir, "events")
    low, high = events.selectExpr(f"min({second})", f"max({second})").first()
    part = part_of(second, str(low), str(high))
    return events.withColumn("arrival", F.expr(arrival_of(part) if late else part))


def dns_feed(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    return base_events(spark, sf_dir, stream).select(
        "event_id",
        "value",
        "ts",
        F.date_format("ts", "MMM dd HH:mm:ss").alias("time"),
        F.lit("dnsmasq").alias("ident"),
        "owner",
        F.lit("dnsmasq").alias("log_format"),
        F.lit("3468").alias("pid"),
        F.expr(DNS_MESSAGE).alias("message"),
    )


def dns_lines(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    """``event_id``, ``value`` as JSON line, and the event's measure and time."""
    return dns_feed(spark, sf_dir, stream).select(
        "event_id", "ts", F.col("value").alias("measure"), F.expr(DNS_LINE).alias("value")
    )


def error_feed(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in CODES])
    coded = base_events(spark, sf_dir, stream).withColumn(
        "error_code", F.element_at(codes, (F.col("event_id") % len(CODES) + 1).cast("int"))
    )
    return coded.select(
        "event_id",
        F.date_format("ts", f"MMM dd HH:mm:ss.SSSSSS '{YEAR}'").alias("time"),
        F.lit("apache_error").alias("log_format"),
        "owner",
        F.expr(ERROR_LEVEL).alias("level"),
        F.lit("27406").alias("pid"),
        F.expr(ERROR_CLIENT).alias("client"),
        F.expr(ERROR_MESSAGE).alias("message"),
    )


def _pick(texts: list[str]) -> str:
    listed = ", ".join("'" + text + "'" for text in texts)
    return f"element_at(array({listed}), CAST(event_id % {len(texts)} + 1 AS INT))"


def rule_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web errors of ``RULE_TEXTS``."""
    return error_feed(spark, sf_dir).withColumns(
        {"level": F.expr(_pick([level for level, _ in RULE_TEXTS])), "message": F.expr(_pick([text for _, text in RULE_TEXTS]))}
    )


def access_feed(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    return base_events(spark, sf_dir, stream).select(
        "event_id",
        "owner",
        F.lit("apache2_access").alias("log_format"),
        *[F.expr(sql).alias(name) for name, sql in ACCESS_FIELDS.items()],
    )


def supplier_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer addresses of suppliers, as indicators of the owner that would see them."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "'client0' || CAST(s_suppkey % 3 + 1 AS STRING) AS owner",
        "'195.128.194.' || CAST(s_suppkey AS STRING) AS value2",
    ).distinct()


# The same feeds for the check engine.
ORACLE_FEED = f"""
    page AS (SELECT page_id, regexp_extract(url, '{PAGE_HOST}', 1) AS host,
                    regexp_extract(url, '{PAGE_PATH}', 1) AS path FROM pages),
    base AS (SELECT e.*, {OWNER} AS owner, p.host, p.path,
                    list_extract({CODES!r}, CAST(event_id % {len(CODES)} + 1 AS INTEGER)) AS error_code
             FROM events e JOIN page p ON p.page_id = e.event_id % (SELECT max(page_id) + 1 FROM pages)),
    dns AS (SELECT event_id, value, ts, owner, strftime(ts, '%b %d %H:%M:%S') AS time, {DNS_MESSAGE} AS message,
                   CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_timestamp FROM base),
    err AS (SELECT event_id, owner, {ERROR_LEVEL} AS level, {ERROR_CLIENT} AS client,
                   {ERROR_MESSAGE} AS message,
                   CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_timestamp FROM base),
    texts(n, level, message) AS (VALUES {", ".join(f"({n}, '{level}', '{text}')" for n, (level, text) in enumerate(RULE_TEXTS))}),
    ends AS (SELECT min(epoch_timestamp) AS low, max(epoch_timestamp) AS high FROM err),
    parted AS (SELECT *, {arrival_of("part")} AS arrival
               FROM (SELECT event_id, epoch_timestamp, {part_of("epoch_timestamp", "low", "high")} AS part FROM err, ends)),
    ioc AS (SELECT DISTINCT 'client0' || CAST(s_suppkey % 3 + 1 AS STRING) AS owner,
                   '195.128.194.' || CAST(s_suppkey AS STRING) AS value2
            FROM supplier)
"""
