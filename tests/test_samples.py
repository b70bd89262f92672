"""The sample feed through parsing, features and rules."""

import pytest
from pyspark.sql import functions as F

from logweir.operators.features import dns_features, dns_features_temporal
from logweir.operators.idrules import apache_id_rules
from logweir.operators.indicators import derive_indicators, match_indicators
from logweir.operators.parse import extract_error_parts, parse_apache_access, parse_apache_error, parse_dnsmasq
from logweir.operators.ruleset import rules_table
from logweir.operators.templates import fit_template_index, index_with_vocabulary, template_vocabulary
from logweir.schema import APACHE_ACCESS, APACHE_ERROR, DNSMASQ, FEATURES_13, FEATURES_18
from logweir.sources.lines import decode, lines_from_list, quarantine, route
from tests.samples import ACCESS, ANSWER, ASKING, DNS, ENCODED, ERRORS, UPDATER, UPSTREAM, as_lines, dns_record

SPREAD = ["message"]


def routed(spark, records, log_format, schema):
    return route(decode(lines_from_list(spark, as_lines(records))), log_format, schema)


@pytest.fixture(scope="module")
def parsed(spark):
    return parse_dnsmasq(routed(spark, DNS, "dnsmasq", DNSMASQ), 2023).cache()


@pytest.fixture(scope="module")
def errors(spark):
    return parse_apache_error(routed(spark, ERRORS, "apache_error", APACHE_ERROR)).cache()


def test_routing(spark):
    decoded = decode(lines_from_list(spark, as_lines(DNS + ERRORS + ACCESS)))
    counts = {r.log_format: r["count"] for r in decoded.groupBy("log_format").count().collect()}
    assert counts == {"dnsmasq": 13, "apache_error": 5, "apache2_access": 2}
    access = parse_apache_access(route(decoded, "apache2_access", APACHE_ACCESS))
    assert access.columns == APACHE_ACCESS.names
    assert [r.size for r in access.orderBy("size").collect()] == ["2048", "512"]


def test_bad_lines_are_set_aside(spark):
    lines = ["{broken", '{"owner":"x"}', '{"log_format":"dnsmasq"}', "", "[1", "17", as_lines(DNS)[0][:-3]]
    decoded = decode(lines_from_list(spark, lines))
    assert decoded.count() == len(lines)
    left = sorted(r._corrupt_record for r in quarantine(decoded).collect())
    assert left == sorted(["{broken", "<blank line>", "[1", "17", as_lines(DNS)[0][:-3]])
    dns = parse_dnsmasq(route(decoded, "dnsmasq", DNSMASQ), 2023)
    row = dns.first()
    assert dns.count() == 1 and row.response is None and row.key is None and row.epoch_timestamp is None


def test_dns_parse(parsed):
    rows = {(r.response, r.value1, r.value2): r for r in parsed.collect()}
    row = rows["query[A]", ENCODED[0], ASKING]
    assert row.key == "query[A] <*> from <*>" and row.epoch_timestamp == 1677921300
    assert ("forwarded", ENCODED[0], UPSTREAM) in rows
    row = rows["reply", "version.example.org", "7:41:9"]
    assert row.key == "reply <*> is <*>" and row.epoch_timestamp == 1677921425
    assert parsed.columns == [
        "ident", "owner", "log_format", "message", "response", "key", "value1", "value2", "epoch_timestamp"
    ]


def test_unparsable_message_gives_empty_parts(spark):
    row = parse_dnsmasq(routed(spark, [dns_record("x", "hello")], "dnsmasq", DNSMASQ), 2023).first()
    assert (row.response, row.value1, row.value2, row.key) == ("", "", "", " <*>  <*>")


def test_template_index(spark, parsed):
    model = fit_template_index(parsed)
    codes = {r.response: r.encoded_key for r in model.transform(parsed).collect()}
    assert codes == {"forwarded": 0, "query[A]": 1, "reply": 2, "query[TXT]": 3}
    unseen = spark.createDataFrame([("zzz", "m"), (None, "n")], "key string, message string")
    assert [r.encoded_key for r in model.transform(unseen).collect()] == [4, 4]
    vocabulary = template_vocabulary(parsed)
    assert {r.key.split()[0]: r.encoded_key for r in vocabulary.collect()} == codes
    assert [r.encoded_key for r in index_with_vocabulary(unseen, vocabulary, SPREAD).collect()] == [4, 4]
    by_table = index_with_vocabulary(parsed, vocabulary, SPREAD)
    assert {r.response: r.encoded_key for r in by_table.collect()} == codes


def test_features_18(parsed):
    features = dns_features(fit_template_index(parsed).transform(parsed))
    assert features.columns[-18:] == FEATURES_18
    row = features.filter("value1 = 'docs.mirror.example.net'").first()
    assert (row.value1_length, row.value1_dot_count, row.value1_hyphen_count, row.key_length) == (23, 3, 0, 21)
    assert (row.value1_capital_count, row.value1_has_file_extensions, row.value2_ip_class) == (0, 1, 0)
    for r in features.filter(F.col("value1").isin(ENCODED)).collect():
        assert r.value1_human_readable == 0
        assert r.value1_capital_count == sum(c.isupper() for c in r.value1)
        assert r.value1_asterisk_count == r.value1.count("*")


def test_features_13(spark, parsed):
    extra = dns_record("Mar 04 09:14:50", f"query[A] {ENCODED[0]} from {ASKING}")
    fourteen = parse_dnsmasq(routed(spark, [extra, *DNS], "dnsmasq", DNSMASQ), 2023)
    keyed = fit_template_index(fourteen).transform(fourteen).withColumn("tie", F.xxhash64("message", "epoch_timestamp"))
    rows = dns_features_temporal(keyed, "tie").collect()
    assert sorted(int(r.time_diff_unix) for r in rows) == [0] * 10 + [10, 25, 40, 60]
    assert {r.day_of_week for r in rows} == {7}
    assert set(FEATURES_13) <= set(rows[0].asDict())
    for value in ("value1", "value2"):
        for r in rows:
            assert r[f"{value}_count"] == sum(o[value] <= r[value] for o in rows)


def test_indicator_hits(spark, parsed):
    def match(*addresses):
        table = spark.createDataFrame([("client01", a) for a in addresses], "owner string, value2 string")
        alerts, remainder = match_indicators(parsed, table, SPREAD)
        return [tuple(r) for r in alerts.collect()], remainder.count()

    label = "Malicious IP Founded in DNSMASQ: "
    for address in (ANSWER, ASKING):
        alerts, left = match(address)
        assert alerts == [("client01", address, label + address, 3)] and left == 4
    assert match() == ([], 13)
    other_owner = spark.createDataFrame([("client02", ASKING)], "owner string, value2 string")
    assert match_indicators(parsed, other_owner, SPREAD).alerts.count() == 0


def test_keep_first_n(spark, parsed):
    table = spark.createDataFrame([("client01", ANSWER)], "owner string, value2 string")
    order = ["epoch_timestamp", "response"]
    kept = match_indicators(parsed, table, SPREAD, keep_first_n=2, order=order).remainder
    assert kept.count() == 4 + 3 * 2
    assert kept.filter("response = 'reply'").count() == 1


def test_derived_indicators(spark, parsed):
    scored = parsed.withColumn("prediction", (F.col("value2") != UPDATER).cast("int"))
    assert [tuple(r) for r in derive_indicators(scored).collect()] == [("client01", ASKING)]
    known = spark.createDataFrame([("client01", ASKING)], "owner string, value2 string")
    assert derive_indicators(scored, known).count() == 0


def test_error_parse(spark, errors):
    parts = extract_error_parts(routed(spark, ERRORS, "apache_error", APACHE_ERROR))
    by_time = parts.orderBy("time").collect()
    assert [r.entity for r in by_time] == ["PHP Notice:"] * 2 + ["script ", "AH01276:", "script "]
    assert [r.problem for r in by_time] == ["Undefined index: page in "] * 2 + ["", "Cannot serve directory ", ""]
    assert by_time[0].detail == "/srv/www/shop/list.php on line 12" and by_time[0].file == by_time[0].referer == ""
    assert by_time[2].file == "'/srv/www/shop/old.php'" and by_time[2].missing == " not found or unable to stat"
    assert by_time[3].detail == "/srv/www/shop/img/: No matching DirectoryIndex"
    assert by_time[3].referer == ", referer:" and by_time[3].referring_page == " https://shop.example.com"
    keys = {r.key for r in errors.collect()}
    assert keys == {
        "PHP Notice: Undefined index: page in <*>",
        "script  <*> not found or unable to stat, referer:<*>",
        "AH01276: Cannot serve directory <*>, referer:<*>",
    }
    assert errors.filter("size(value) = 3").count() == 5


def test_error_parts_of_odd_messages(spark):
    """The single match gives what one match for each part gives."""
    import re

    from logweir.operators.parse import ERROR_MESSAGE, ERROR_PARTS

    texts = ["", "'", "::''", "a", "a:", ":a: b", "'x' y, referer: z", "a'b' not found or unable to stat, referer: q\nrest",
             "two\nlines: x", "sep\x1fin 'it' here", "dollar $1 \\ back: y/z, referer:", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, message string")
    for row, text in zip(extract_error_parts(rows).orderBy("i").collect(), texts, strict=True):
        found = re.search(ERROR_MESSAGE, text) if text else None
        for name, group in ERROR_PARTS.items():
            want = None if text is None else (found and found.group(group)) or ""
            assert row[name] == want, (text, name)


def test_id_rules(spark, errors):
    alerts = apache_id_rules(errors, rules_table(spark), SPREAD).collect()
    label = "Apache: Attempt to access forbidden directory index."
    assert [tuple(r) for r in alerts] == [("client01", "198.51.100.20", label, 1)]


def test_last_id_only(spark):
    codes = ["AH01617", "AH02010", "AH01618", "AH01790", "AH00126"]
    frame = spark.createDataFrame(
        [("client01", f"10.0.0.{i}", f"{code}:", code) for i, code in enumerate(codes)],
        "owner string, client string, entity string, message string",
    )
    every = apache_id_rules(frame, rules_table(spark), SPREAD)
    last = apache_id_rules(frame, rules_table(spark), SPREAD, last_id_only=True)
    assert every.count() == 5
    assert sorted(r.srcip for r in last.collect()) == ["10.0.0.1", "10.0.0.3", "10.0.0.4"]
