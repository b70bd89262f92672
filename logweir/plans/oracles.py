"""SQL for the same answers, run by the check engine on the same tables.

Written from the definitions, not from the Spark code; both share the input feed only.
"""

from logweir.plans.feed import ODD_LINE, ODD_OWNERS, ORACLE_FEED, PARTS, RULE_PACE, RULE_TEXTS

# Fixed value: the DNS message pattern.
_DNS_RE = r"([a-z]+\[?[A-Z]*\]?)\s(\S+)\s([fromtois]+)\s(\S+)"

_PARSED = rf"""
    parts AS (SELECT *, regexp_extract(message, '{_DNS_RE}', 1) AS response,
                     regexp_extract(message, '{_DNS_RE}', 2) AS value1,
                     regexp_extract(message, '{_DNS_RE}', 3) AS term,
                     regexp_extract(message, '{_DNS_RE}', 4) AS value2 FROM dns),
    parsed AS (SELECT event_id, ts, owner, message, epoch_timestamp, response, value1, value2,
                      response || ' <*> ' || term || ' <*>' AS key FROM parts)
"""

# The check engine's patterns have no look-ahead: the referer is cut off first.
_ERR = r"""
    cut AS (SELECT *, CASE WHEN contains(message, ', referer') THEN split_part(message, ', referer', 1)
                           ELSE message END AS body FROM err),
    eparts AS (SELECT *,
        regexp_extract(message, '^([^:'']+:?)', 1) AS entity,
        regexp_extract(message, '^[^:'']+:?(''[^'']+'')? not found or unable to stat', 1) AS file,
        CASE WHEN regexp_matches(message, '^[^:'']+:?(''[^'']+'')? not found or unable to stat')
             THEN ' not found or unable to stat' ELSE '' END AS missing,
        CASE WHEN contains(message, ', referer:') THEN ', referer:' ELSE '' END AS referer,
        regexp_extract(message, ', referer:(.*)$', 1) AS referring_page,
        regexp_replace(body, '^[^:'']+:?((''[^'']+'')?( not found or unable to stat))?', '') AS rest FROM cut),
    errs AS (SELECT * EXCLUDE (rest, body),
        regexp_extract(rest, '^\s*([^/:,''(]+:?[^:/,''(]+:?)\s*(.*)$', 1) AS problem,
        regexp_extract(rest, '^\s*([^/:,''(]+:?[^:/,''(]+:?)\s*(.*)$', 2) AS detail FROM eparts),
    etempl AS (SELECT *, entity || ' ' || problem || '<*>' || missing || referer
                         || CASE WHEN referer = ', referer:' THEN '<*>' ELSE '' END AS key,
                      regexp_extract(client, '([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+)', 1) AS srcip,
                      regexp_extract(entity, '(\S+):', 1) AS code FROM errs)
"""

_VOCABULARY = """
    vocabulary AS (SELECT key, count(*) AS n,
                          CAST(row_number() OVER (ORDER BY count(*) DESC, key) - 1 AS DOUBLE) AS encoded_key
                   FROM {source} GROUP BY key)
"""


def _entropy(s: str) -> str:
    share = f"((length({s}) - length(replace({s}, c, ''))) / length({s}))"
    return (
        f"CASE WHEN {s} = '' THEN 0.0 ELSE list_sum(list_transform(list_distinct(string_split({s}, '')),"
        f" lambda c: -{share} * log2({share}))) END"
    )


def _count(s: str, char: str) -> str:
    return f"CAST(length({s}) - length(replace({s}, '{char}', '')) AS INTEGER)"


def _capitals(s: str) -> str:
    return rf"CAST(length(regexp_replace({s}, '[^\p{{Lu}}]', '', 'g')) AS INTEGER)"


# The extensions the file-name test looks for.
_EXTENSIONS = (
    "doc|docx|odt|pages|rtf|txt|wpd|wps|csv|numbers|ods|xls|xlsx|asp|aspx|css|htm|html|jsp|php|xml|afdesign|ai|cad|cdr"
    "|drw|dwg|eps|odg|svg|vsdx|afpub|indd|pdf|pdfxml|pmd|pub|qxp|c|cpp|cs|java|js|json|py|sql|swift|vb|7z|rar|tar"
    "|tar[.]gz|zip|bak|cfg|conf|ini|msi|sys|tmp|app|bat|bin|cmd|com|exe|vbs|x86"
)


def _extension(s: str) -> str:
    return f"CAST(regexp_matches(lower({s}), '{_EXTENSIONS}') AS INTEGER)"


def _ip_class(s: str) -> str:
    part = "TRY_CAST(string_split({s}, '.')[{i}] AS BIGINT)"
    one, two = part.format(s=s, i=1), part.format(s=s, i=2)
    return f"""CASE WHEN NOT regexp_full_match({s}, '[0-9]+([.][0-9]+)*') THEN 2
        WHEN {one} IN (172, 192) AND {two} IS NULL THEN 2
        WHEN {one} = 10 OR ({one} = 172 AND {two} BETWEEN 16 AND 31) OR ({one} = 192 AND {two} = 168) THEN 0
        ELSE 1 END"""


def _lexical(v: str) -> str:
    return f"""CAST(length({v}) AS INTEGER) AS {v}_length,
        {_count(v, '.')} AS {v}_dot_count, {_count(v, '-')} AS {v}_hyphen_count,
        {_count(v, '/')} AS {v}_slash_count, {_count(v, '*')} AS {v}_asterisk_count,
        {_capitals(v)} AS {v}_capital_count, {_extension(v)} AS {v}_has_file_extensions"""


_DNS_VOCABULARY = _VOCABULARY.format(source="parsed")
_FEATURES = f"""
    features AS (SELECT event_id, parsed.owner, response, value1, value2, epoch_timestamp,
        CAST(encoded_key AS INTEGER) AS encoded_key, CAST(length(parsed.key) AS INTEGER) AS key_length,
        {_lexical('value1')}, CAST({_entropy('value1')} < 3.0 AS INTEGER) AS value1_human_readable,
        {_lexical('value2')}, {_ip_class('value2')} AS value2_ip_class
        FROM parsed JOIN vocabulary USING (key))
"""

_DETECTED = """
    detected AS (SELECT p.*, CASE WHEN i.value2 IS NULL THEN ''
                                  ELSE 'Malicious IP Founded in DNSMASQ: ' || p.value2 END AS detection
                 FROM parsed p LEFT JOIN ioc i ON i.owner = p.owner AND i.value2 = p.value2),
    bad AS (SELECT DISTINCT owner, value1 FROM detected WHERE detection <> '')
"""

_IN_BAD = "EXISTS (SELECT 1 FROM bad WHERE bad.owner = d.owner AND bad.value1 = d.value1)"

_ALERTS = """SELECT owner, value2, detection, count(*) AS count FROM detected
    WHERE detection <> '' GROUP BY owner, value2, detection"""

# The codes of the rules that name some, and the rules' descriptions.
_ID_RULES = {
    "AH01630": "Apache: Attempt to access forbidden file or directory.",
    "AH01276": "Apache: Attempt to access forbidden directory index.",
    "AH00550": "Apache: Client sent malformed Host header. Possible Code Red attack.",
    "AH01617": "Apache: User authentication failed.",
    "AH01807": "Apache: User authentication failed.",
    "AH01694": "Apache: User authentication failed.",
    "AH01695": "Apache: User authentication failed.",
    "AH02009": "Apache: User authentication failed.",
    "AH02010": "Apache: User authentication failed.",
    "AH01618": "Apache: Attempt to login using a non-existent user.",
    "AH01808": "Apache: Attempt to login using a non-existent user.",
    "AH01790": "Apache: Attempt to login using a non-existent user.",
    "AH00126": "Apache: Invalid URI (bad client request).",
    "AH00565": "Apache: Invalid URI, file name too long.",
}
_LAST_OF_ITS_RULE = "AH01630 AH01276 AH00550 AH02010 AH01790 AH00126 AH00565".split()


def _id_alerts(codes) -> str:
    rows = ", ".join(f"('{c}', '{_ID_RULES[c]}')" for c in codes)
    return f"""WITH {ORACLE_FEED}, {_ERR}, labels(code, detection) AS (VALUES {rows})
        SELECT owner, srcip, detection, count(*) AS count FROM etempl JOIN labels USING (code)
        GROUP BY owner, srcip, detection"""


# (rule, parent, condition) for the plain rules, parents first.
_MISSING = ("(contains(message, 'File does not exist: ') OR contains(message, 'failed to open stream: No such file or directory')"
            " OR contains(message, 'Failed opening '))")
_TREE = [
    (30100, None, "true"),
    (30101, 30100, "level = 'error'"),
    (30102, 30100, "level = 'warn'"),
    (30103, 30100, "level = 'notice'"),
    (30104, 30103, "contains(message, 'exit signal Segmentation Fault')"),
    (30105, 30101, "contains(message, 'denied by server configuration')"),
    (30106, 30101, "contains(message, 'Directory index forbidden by rule')"),
    (30107, 30101, "contains(message, 'Client sent malformed Host header')"),
    (30108, 30102, "contains(message, 'authentication failed')"),
    (30109, 30101, r"regexp_matches(message, 'user \S+ not found|user \S+ in realm .* not found')"),
    (30110, 30101, "contains(message, 'authentication failure')"),
    (30112, 30101, _MISSING),
    (30115, 30101, "contains(message, 'Invalid URI in request')"),
    (30117, 30101, "(contains(message, 'File name too long') OR contains(message, 'request failed: URI too long'))"),
    (30118, 30101, "(contains(message, 'mod_security: Access denied') OR contains(message, 'ModSecurity: Access denied'))"),
    (30120, 30101, "contains(message, 'Resource temporarily unavailable:')"),
    (30200, None, "starts_with(message, 'mod_security-message: ')"),
    (30201, 30200, "starts_with(message, 'mod_security-message: Access denied ')"),
    (30301, 30100, "suffix(level, ':error')"),
    (30302, 30100, "regexp_full_match(level, '.+:warn')"),
    (30303, 30100, "regexp_full_match(level, '.+:notice')"),
    (30304, 30303, "contains(message, 'exit signal Segmentation Fault')"),
    (30305, 30301, "code = 'AH01630'"),
    (30306, 30301, "code = 'AH01276'"),
    (30307, 30301, "code = 'AH00550'"),
    (30308, 30302, "code IN ('AH01617', 'AH01807', 'AH01694', 'AH01695', 'AH02009', 'AH02010')"),
    (30309, 30301, "code IN ('AH01618', 'AH01808', 'AH01790')"),
    (30312, 30301, _MISSING),
    (30315, 30301, "code = 'AH00126'"),
    (30317, 30301, "code = 'AH00565'"),
    (30318, 30301, "contains(message, 'PHP Notice:')"),
    (30401, 30301, "contains(message, 'ModSecurity: Warning')"),
    (30402, 30301, "contains(message, 'ModSecurity: Access denied')"),
    (30403, 30301, "contains(message, 'ModSecurity: Audit log:')"),
    (30411, 30402, "contains(message, 'with code 403')"),
]

_CONDITION = {rule: condition for rule, _, condition in _TREE}
_PARENT = {rule: parent for rule, parent, _ in _TREE}


def _holds(rule: int) -> str:
    own = f"({_CONDITION[rule]})"
    return own if _PARENT[rule] is None else f"{own} AND {_holds(_PARENT[rule])}"


_HITS = "hits AS (" + " UNION ALL ".join(
    f"SELECT event_id, owner, srcip, epoch_timestamp, {rule} AS rule_id FROM etempl WHERE {_holds(rule)}"
    for rule in _CONDITION
) + ")"

# Level and description of the alerting rules.
_LEVELS = """(30104, 12, 'Apache: segmentation fault.'),
    (30109, 9, 'Apache: Attempt to login using a non-existent user.'),
    (30115, 5, 'Apache: Invalid URI (bad client request).'), (30118, 6, 'ModSecurity: Access attempt blocked.'),
    (30201, 6, 'ModSecurity: access denied.'), (30304, 12, 'Apache: segmentation fault.'),
    (30305, 5, 'Apache: Attempt to access forbidden file or directory.'),
    (30306, 5, 'Apache: Attempt to access forbidden directory index.'),
    (30307, 6, 'Apache: Client sent malformed Host header. Possible Code Red attack.'),
    (30308, 5, 'Apache: User authentication failed.'),
    (30309, 5, 'Apache: Attempt to login using a non-existent user.'),
    (30315, 5, 'Apache: Invalid URI (bad client request).'), (30317, 10, 'Apache: Invalid URI, file name too long.'),
    (30411, 7, 'ModSecurity rejected a query')"""


def _fires(rule: int, counted: int, frequency: int, seconds: int, same_source: bool) -> str:
    source = "srcip" if same_source else "''"
    return f"""SELECT DISTINCT owner, {source} AS srcip, {rule} AS rule_id, epoch_timestamp, n AS hits FROM (
        SELECT *, count(*) OVER (PARTITION BY owner, {source} ORDER BY epoch_timestamp
                                 RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW) AS n
        FROM hits WHERE rule_id = {counted}) WHERE n >= {frequency}"""


# The frequency rules, what they count, how often, within how many seconds, whether by source.
_FREQUENCY_RULES = [
    (30116, 30115, 10, 120, True),
    (30119, 30118, 8, 120, True),
    (30202, 30201, 10, 120, False),
    (30310, 30309, 12, 160, True),
    (30316, 30315, 10, 120, True),
]
_FREQUENCY = " UNION ALL ".join(_fires(r, c, n, s * RULE_PACE, by) for r, c, n, s, by in _FREQUENCY_RULES)

# A hit is late if, two parts before its own, hits had come that were 600 seconds younger: the watermark of a
# micro-batch comes from the batches before it, and what comes late is told by the watermark one batch older.
_ON_TIME = """
    marks AS (SELECT a.n AS arrival, max(epoch_timestamp) - 600 AS mark
              FROM range(0, 100) a(n) JOIN parted ON parted.arrival <= a.n - 2 GROUP BY a.n),
    on_time AS (SELECT event_id FROM parted LEFT JOIN marks USING (arrival) WHERE mark IS NULL OR epoch_timestamp > mark),
    given AS (SELECT * FROM all_hits),
    hits AS (SELECT * FROM all_hits WHERE event_id IN (SELECT event_id FROM on_time))
"""
_ALL_HITS = _HITS.replace("hits AS (", "all_hits AS (", 1)

_ANOMALY = "(value1_capital_count >= 8 AND value1_length > 60)"

_LINE = f"""'{{"time":"' || strftime(ts, '%b %d %H:%M:%S') || '","ident":"dnsmasq","owner":"' || owner
    || '","log_format":"dnsmasq","pid":"3468","message":"' || message || '"}}'"""

_GAPS = """gaps AS (SELECT *, coalesce(epoch_timestamp - lag(epoch_timestamp)
                             OVER (PARTITION BY owner ORDER BY epoch_timestamp, event_id), 0) AS gap FROM parsed)"""


_WEAK_LABEL = "CAST(value1_capital_count >= 8 AND value1_human_readable = 0 AS INTEGER)"

# What a run learns: an anomaly's name is its own, so no earlier hit keeps it from being scored.
_LEARNT = f"""learnt AS (SELECT owner, value2, min(part) AS first FROM features JOIN (SELECT event_id, part FROM parted) USING (event_id)
    WHERE {_ANOMALY} AND response LIKE '%query%' GROUP BY owner, value2)"""
_LEARNT_ALERTS = """SELECT part AS batch_id, owner, value2, count(*) AS count
    FROM parsed JOIN (SELECT event_id, part FROM parted) USING (event_id) JOIN learnt USING (owner, value2)
    WHERE first < part GROUP BY ALL"""


def _dns(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([ORACLE_FEED, _PARSED, *ctes])} {select}"


def _errors(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([ORACLE_FEED, _ERR, *ctes])} {select}"


ORACLES: dict[str, str] = {
    "json_decode_route": f"""WITH {ORACLE_FEED}
        SELECT 'dnsmasq' AS log_format, owner, count(*) AS n, count(*) AS n_messages,
               CAST(sum(length(message)) AS BIGINT) AS message_chars, 0 AS n_paths FROM dns GROUP BY owner
        UNION ALL SELECT 'apache_error', owner, count(*), count(*), CAST(sum(length(message)) AS BIGINT), 0 FROM err GROUP BY owner
        UNION ALL SELECT 'apache2_access', owner, count(*), 0, 0, count(*) FROM base GROUP BY owner""",
    "corrupt_quarantine": f"""WITH {ORACLE_FEED}
        SELECT event_id, substr({_LINE}, 1, length({_LINE}) - 3) AS line FROM dns WHERE value > 100""",
    "text_source_trim": f"""WITH {ORACLE_FEED}
        SELECT owner, count(*) AS n, CAST(sum(length({_LINE})) AS BIGINT) AS chars FROM dns GROUP BY owner""",
    "owners": "SELECT DISTINCT 'client0' || CAST(user_id % 3 + 1 AS VARCHAR) AS owner FROM events",
    "parquet_by_format": f"""WITH {ORACLE_FEED}
        SELECT 'dnsmasq' AS log_format, owner, count(*) AS n, CAST(sum(length(message)) AS BIGINT) AS chars FROM dns GROUP BY owner
        UNION ALL SELECT 'apache_error', owner, count(*), CAST(sum(length(message)) AS BIGINT) FROM err GROUP BY owner
        UNION ALL SELECT 'apache2_access', owner, count(*), CAST(sum(length(path)) AS BIGINT) FROM base GROUP BY owner""",
    "dns_parse": _dns("SELECT event_id, response, value1, value2, key FROM parsed"),
    "dns_template": _dns("SELECT owner, key, count(*) AS n FROM parsed GROUP BY owner, key"),
    "dns_epoch": f"WITH {ORACLE_FEED} SELECT event_id, epoch_timestamp FROM dns",
    "apache_error_parse": _errors("""SELECT event_id, entity, file, missing, problem,
        detail, referer, referring_page FROM errs"""),
    "apache_error_template": _errors("""SELECT event_id, key, epoch_timestamp,
        file || '|' || detail || '|' || referring_page AS parameters FROM etempl"""),
    "access_passthrough": f"""WITH {ORACLE_FEED}
        SELECT event_id, '172.17.' || (user_id % 4) || '.' || user_id AS host, owner,
               'apache2_access' AS log_format, CASE event_type WHEN 'signup' THEN 'u' || user_id ELSE '-' END AS user,
               CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS method, path,
               CASE event_type WHEN 'error' THEN '404' ELSE '200' END AS code,
               CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS size,
               CASE event_type WHEN 'view' THEN 'https://' || host || '/' ELSE '-' END AS referer,
               'Mozilla/5.0 (X11; Linux x86_64)' AS agent FROM base""",
    "char_counts": f"""SELECT doc_id, {_count('text', '.')} AS dots, {_count('text', '-')} AS hyphens,
        {_count('text', '/')} AS slashes, {_count('text', '*')} AS asterisks, CAST(length(text) AS INTEGER) AS chars FROM documents""",
    "page_char_counts": f"""SELECT page_id, {_count('url', '.')} AS url_dots, {_count('url', '-')} AS url_hyphens,
        {_count('url', '/')} AS url_slashes, {_count('html', '/')} AS html_slashes,
        {_count('html', '*')} AS html_asterisks FROM pages""",
    "capital_count": f"SELECT doc_id, {_capitals('text')} AS capitals FROM documents",
    "file_extension_flag": f"""SELECT page_id, {_extension('url')} AS anywhere,
        CAST(regexp_matches(lower(url), '[.]({_EXTENSIONS})$') AS INTEGER) AS at_end FROM pages""",
    "ip_class": _dns(f"SELECT event_id, {_ip_class('value2')} AS value2_ip_class FROM parsed"),
    "entropy_readable": _dns(f"""SELECT event_id, round({_entropy('value1')}, 6) AS entropy,
        CAST({_entropy('value1')} < 3.0 AS INTEGER) AS human_readable FROM parsed"""),
    "document_entropy": f"SELECT doc_id, round({_entropy('text')}, 6) AS entropy FROM documents",
    "dns_features_18": _dns(
        "SELECT * EXCLUDE (response, value1, value2, epoch_timestamp) FROM features", _DNS_VOCABULARY, _FEATURES
    ),
    "dns_features_13": _dns(
        """SELECT g.event_id, g.owner, f.encoded_key, CAST(gap AS DOUBLE) AS time_diff_unix,
               CAST(dayofweek(make_timestamp(g.epoch_timestamp * 1000000)) + 1 AS INTEGER) AS day_of_week,
               value1_length, value2_length, value1_dot_count, value1_hyphen_count, value2_dot_count,
               value2_hyphen_count, key_length,
               count(g.value1) OVER (PARTITION BY g.owner ORDER BY g.value1) AS value1_count,
               count(g.value2) OVER (PARTITION BY g.owner ORDER BY g.value2) AS value2_count, value2_ip_class
           FROM gaps g JOIN features f USING (event_id)""",
        _DNS_VOCABULARY, _FEATURES, _GAPS,
    ),
    "time_gap": _dns("SELECT event_id, CAST(gap AS DOUBLE) AS gap FROM gaps", _GAPS),
    "second_gaps": _dns("""SELECT owner, epoch_timestamp, coalesce(epoch_timestamp - lag(epoch_timestamp)
        OVER (PARTITION BY owner ORDER BY epoch_timestamp), 0) AS gap
        FROM (SELECT DISTINCT owner, epoch_timestamp FROM parsed)"""),
    "day_of_week": f"""WITH {ORACLE_FEED}
        SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week FROM dns""",
    "running_value_count": _dns("""SELECT DISTINCT owner, value1, count(*) OVER (PARTITION BY owner, value1) AS n,
        count(*) OVER (PARTITION BY owner ORDER BY value1) AS running FROM parsed"""),
    "template_index": _dns("SELECT event_id, key, encoded_key FROM parsed JOIN vocabulary USING (key)", _DNS_VOCABULARY),
    "error_template_vocabulary": _errors(
        "SELECT key, n, encoded_key FROM vocabulary", _VOCABULARY.format(source="etempl")
    ),
    "error_template_index": _errors(
        "SELECT event_id, key, encoded_key FROM etempl JOIN vocabulary USING (key)", _VOCABULARY.format(source="etempl")
    ),
    "rules_xml_table": f"""WITH {ORACLE_FEED}
        SELECT CAST(page_id + 100000 AS INTEGER) AS rule_id, CAST(page_id % 16 AS INTEGER) AS level,
               page_id % 5 = 0 AS noalert, '^[' || host || '] |denied ' AS match, 'Page ' || host AS description,
               '30301' AS parents, 'AH' || page_id || ',BH' || page_id AS codes,
               'web,' || split_part(url, ':', 1) AS tags, 'pages,' || CASE WHEN page_id % 2 = 0 THEN 'even' ELSE 'odd' END AS groups,
               CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'T1190' ELSE 'T1102,T' || (page_id + 2000) END AS techniques,
               'link=' || host || ',text=a note' AS info FROM page JOIN pages USING (page_id)""",
    "apache_id_alerts": _id_alerts(_ID_RULES),
    "apache_id_alerts_last_id": _id_alerts(_LAST_OF_ITS_RULE),
    "rule_matches": _errors("SELECT event_id, rule_id FROM hits", _HITS),
    "rule_every_hit": f"""WITH {ORACLE_FEED}, told AS (
            SELECT level, message, regexp_extract(message, '^(AH[0-9]+):', 1) AS code, count(event_id) AS n
            FROM texts LEFT JOIN events ON event_id % {len(RULE_TEXTS)} = texts.n GROUP BY ALL)
        """ + " UNION ALL ".join(
        f"SELECT {rule} AS rule_id, level, message, n FROM told WHERE n > 0 AND {_holds(rule)}" for rule in _CONDITION
    ),
    "list_source": """SELECT 'region' || n_regionkey AS owner, 'reply' AS response, replace(n_name, ' ', '-') AS value1,
        '10.0.0.' || n_nationkey AS value2 FROM nation""",
    "rule_hierarchy": _errors(
        """SELECT owner, srcip, rule_id, level, description, count(*) AS count FROM hits JOIN rules USING (rule_id)
           GROUP BY ALL""",
        _HITS, f"rules(rule_id, level, description) AS (VALUES {_LEVELS})",
    ),
    "rule_frequency": _errors(_FREQUENCY, _HITS),
    "indicator_alerts": _dns(_ALERTS, _DETECTED),
    "indicator_remainder": _dns(
        f"SELECT event_id, owner, value1, value2 FROM detected d WHERE detection = '' AND NOT {_IN_BAD}", _DETECTED
    ),
    "keep_first_n_per_domain": _dns(
        f"""SELECT event_id, owner, value1, value2 FROM (
               SELECT *, {_IN_BAD} AS associated, row_number() OVER (PARTITION BY owner, value1
                      ORDER BY epoch_timestamp, event_id) AS n FROM detected d)
           WHERE detection = '' AND (NOT associated OR n <= 3)""",
        _DETECTED,
    ),
    "indicator_csv_scan": f"WITH {ORACLE_FEED} SELECT owner, value2, 1 AS copies FROM ioc",
    "indicator_table_append": f"WITH {ORACLE_FEED} SELECT owner, value2, 1 AS n_rows, 1 AS copies FROM ioc",
    "zip_by_order": _dns("""SELECT value2, a.event_id AS address_event, epoch_timestamp, t.event_id AS time_event
        FROM (SELECT value2, event_id, row_number() OVER (ORDER BY value2, event_id) AS n FROM parsed) a
        JOIN (SELECT epoch_timestamp, event_id, row_number() OVER (ORDER BY epoch_timestamp, event_id) AS n
              FROM parsed) t USING (n)"""),
    # The labels follow from the features by rules that a forest must find: it is to be right about every record.
    "anomaly_score": _dns(
        f"SELECT event_id, owner, {_WEAK_LABEL} AS label, {_WEAK_LABEL} AS prediction FROM features", _DNS_VOCABULARY, _FEATURES
    ),
    "anomaly_score_temporal": _dns(
        """SELECT event_id, owner, CAST(length(value1) > 60 AS INTEGER) AS label, CAST(length(value1) > 60 AS INTEGER) AS prediction
           FROM parsed"""
    ),
    "saved_model_score": _dns(
        f"""SELECT owner, CAST(encoded_key AS DOUBLE) AS encoded_key, {_WEAK_LABEL} AS label, {_WEAK_LABEL} AS prediction, count(*) AS n
            FROM features GROUP BY ALL""",
        _DNS_VOCABULARY, _FEATURES,
    ),
    "batch_model_score": _dns(
        f"SELECT event_id, CAST({_ANOMALY} AS INTEGER) AS prediction FROM features", _DNS_VOCABULARY, _FEATURES
    ),
    "temporal_anomalies": _dns(
        """SELECT event_id, owner, message, value1, value2 FROM gaps
           WHERE gap < 300 AND length(value1) > 60""",
        _GAPS,
    ),
    "derived_indicators": _dns(
        f"""SELECT DISTINCT d.owner, d.value2 FROM detected d JOIN features f USING (event_id)
            WHERE detection = '' AND NOT {_IN_BAD} AND {_ANOMALY} AND f.response LIKE '%query%'
            EXCEPT SELECT owner, value2 FROM ioc""",
        _DNS_VOCABULARY, _FEATURES, _DETECTED,
    ),
    "indicator_feedback": _dns(
        f"""SELECT p.owner, p.value2, 'Malicious IP Founded in DNSMASQ: ' || p.value2 AS detection, count(*) AS count
            FROM parsed p JOIN learnt USING (owner, value2) WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL""",
        _DNS_VOCABULARY, _FEATURES,
        f"""learnt AS (SELECT DISTINCT owner, value2 FROM features JOIN (SELECT event_id, ts FROM dns) USING (event_id)
            WHERE ts < TIMESTAMP '2024-01-16' AND {_ANOMALY} AND response LIKE '%query%')""",
    ),
    "stream_dns_alerts": _dns(_ALERTS, _DETECTED),
    "stream_owner_names": _dns(
        f"""SELECT DISTINCT CASE owner {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in ODD_OWNERS.items())} ELSE owner END AS owner,
                value2 FROM features WHERE {_ANOMALY} AND response LIKE '%query%'""",
        _DNS_VOCABULARY, _FEATURES,
    ),
    "stream_frequency_windows": _errors(
        f"SELECT *, epoch_timestamp <= (SELECT max(epoch_timestamp) - 600 FROM err) AS closed FROM ({_FREQUENCY})",
        _ALL_HITS, _ON_TIME,
    ),
    "stream_late_hits": _errors(
        f"""SELECT CAST(f.rule AS INTEGER) AS rule_id, count(g.event_id) AS hits, count(g.event_id) - count(h.event_id) AS late
            FROM (VALUES {", ".join(f"({rule}, {counted})" for rule, counted, *_ in _FREQUENCY_RULES)}) f(rule, counted)
            LEFT JOIN given g ON g.rule_id = f.counted LEFT JOIN hits h ON h.rule_id = f.counted AND h.event_id = g.event_id
            GROUP BY ALL""",
        _ALL_HITS, _ON_TIME,
    ),
    "stream_learning": _dns(_LEARNT_ALERTS, _DNS_VOCABULARY, _FEATURES, _LEARNT),
    "stream_resumed": _dns(_LEARNT_ALERTS, _DNS_VOCABULARY, _FEATURES, _LEARNT),
    "stream_phase_counts": _dns(
        f"""SELECT part AS batch_id, 'observed rows' AS phase, count(*) AS rows FROM sent GROUP BY ALL
            UNION ALL SELECT part, 'observed chars', CAST(sum(length({_LINE})) AS BIGINT) FROM (SELECT event_id, part FROM sent) JOIN dns USING (event_id) GROUP BY ALL
            UNION ALL SELECT part, 'lines dnsmasq', count(*) FROM sent GROUP BY ALL
            UNION ALL SELECT n, 'alerts', count(found.owner)
                FROM range(0, {PARTS}) t(n) LEFT JOIN (SELECT DISTINCT part, owner, value2 FROM known) found ON found.part = n GROUP BY ALL
            UNION ALL SELECT n, 'scored', count(left_over.event_id)
                FROM range(0, {PARTS}) t(n) LEFT JOIN (SELECT * FROM sent
                    WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.part = sent.part AND known.owner = sent.owner
                                      AND (known.value1 = sent.value1 OR known.event_id = sent.event_id))) left_over
                ON left_over.part = n GROUP BY ALL
            UNION ALL SELECT n, 'indicators', count(learnt.owner) FROM range(0, {PARTS}) t(n) LEFT JOIN learnt ON first = n GROUP BY ALL
            UNION ALL SELECT n, phase, 0 FROM range(0, {PARTS}) t(n),
                (VALUES ('errors'), ('error_alerts'), ('access'), ('unrouted'), ('quarantine')) v(phase)""",
        _DNS_VOCABULARY, _FEATURES, _LEARNT,
        "sent AS (SELECT p.*, part FROM parsed p JOIN parted USING (event_id))",
        "known AS (SELECT s.* FROM sent s JOIN learnt USING (owner, value2) WHERE first < part)",
    ),
    "stream_rate_lines": f"""WITH {ORACLE_FEED}
        SELECT owner, count(*) AS n, CAST(sum(length(message)) AS BIGINT) AS chars FROM dns GROUP BY owner""",
    "decode_odd_lines": f"""WITH {ORACLE_FEED}, lines AS (SELECT event_id, message, {_LINE} AS value FROM dns),
            odd AS (SELECT event_id, message, {ODD_LINE} AS value FROM lines)
        SELECT event_id, CASE WHEN event_id % 7 > 4 THEN message END AS message,
               CASE event_id % 7 WHEN 2 THEN '<blank line>' WHEN 3 THEN '<blank line>' WHEN 4 THEN '<null line>'
                    WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE value END AS left_over FROM odd""",
    "indicator_csv_ragged": """SELECT DISTINCT 'client01' AS owner, '10.9.' || i || '.' || s_suppkey AS value2
        FROM supplier, range(1, 4) t(i) WHERE i <= s_suppkey % 3 + 1""",
    "run_all_formats": f"""WITH {ORACLE_FEED}, {_PARSED}, {_DETECTED}, {_ERR}, codes(code) AS (VALUES {", ".join(f"('{c}')" for c in _ID_RULES)})
        SELECT 'alerts' AS output, owner, count(*) AS n FROM detected WHERE detection <> '' GROUP BY owner
        UNION ALL SELECT 'scored', owner, count(*) FROM detected d WHERE detection = '' AND NOT {_IN_BAD} GROUP BY owner
        UNION ALL SELECT 'errors', owner, count(*) FROM err GROUP BY owner
        UNION ALL SELECT 'error_alerts', owner, count(*) FROM etempl JOIN codes USING (code) GROUP BY owner
        UNION ALL SELECT 'access', owner, count(*) FROM base WHERE event_id % 10 <> 0 GROUP BY owner
        UNION ALL SELECT 'unrouted', owner, count(*) FROM base WHERE event_id % 10 = 0 GROUP BY owner""",
}
