"""One query per operator over the test tables. Each takes (spark, sf_dir) and gives a DataFrame."""

import json
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions import capital_count, char_count, day_of_week, entropy, has_file_extension, ip_class
from logweir.functions import is_readable as readable
from logweir.operators.features import dns_features, dns_features_temporal
from logweir.operators.idrules import apache_id_rules, with_source
from logweir.operators.indicators import derive_indicators, match_indicators
from logweir.operators.ordered import first_gaps, running_value_count, time_gap, zip_by_order
from logweir.operators.parse import ERROR_PARTS, extract_error_parts, parse_apache_access, parse_apache_error, parse_dnsmasq
from logweir.operators.ruleset import DEFAULT_RULES, paced, read_rules, rules_table
from logweir.operators.ruletree import frequency_alerts, match_rules, rule_alerts, rule_hits
from logweir.operators.scoring import cross_fit, fit_classifier, score_anomalies, score_with, weak_label
from logweir.operators.templates import fit_template_index, index_with_vocabulary, template_vocabulary
from logweir.plans import feed
from logweir.plans.batch import anomalies, run_batch, score_temporal
from logweir.schema import APACHE_ACCESS, APACHE_ERROR, DNSMASQ, FEATURES_13, FEATURES_18
from logweir.sources.indicators import append_indicators, read_indicator_csv, write_indicator_csv
from logweir.sources.models import load_classifier, load_template_index
from logweir.sources.lines import decode, lines_from_list, quarantine, read_lines, route
from logweir.sources.sinks import write_by_format
from logweir.streaming.queries import encoded_names as fixed_score
from logweir.streaming.queries import (
    stream_dns_alerts,
    stream_frequency_windows,
    stream_late_hits,
    stream_learning,
    stream_owner_names,
    stream_phase_counts,
    stream_rate_lines,
    stream_resumed,
)
from logweir.workspace import new_folder, settle

Query = Callable[[SparkSession, str], DataFrame]
KEY = ["event_id"]


def parsed_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", *DNSMASQ.names]
    return parse_dnsmasq(feed.dns_feed(spark, sf_dir).select(*columns), feed.YEAR)


def parsed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_apache_error(feed.error_feed(spark, sf_dir))


def indexed_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_dns(spark, sf_dir)
    return fit_template_index(parsed).transform(parsed)


def featured_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dns_features(indexed_dns(spark, sf_dir))


# Sources and decoding


def json_decode_route(spark, sf_dir):
    def as_lines(df, schema):
        return df.select(F.to_json(F.struct(*schema.names)).alias("value"))

    lines = (
        as_lines(feed.dns_feed(spark, sf_dir), DNSMASQ)
        .unionByName(as_lines(feed.error_feed(spark, sf_dir), APACHE_ERROR))
        .unionByName(as_lines(feed.access_feed(spark, sf_dir), APACHE_ACCESS))
    )
    decoded = decode(lines)
    return decoded.groupBy("log_format", "owner").agg(
        F.count("*").alias("n"),
        F.count("message").alias("n_messages"),
        F.coalesce(F.sum(F.length("message")), F.lit(0)).alias("message_chars"),
        F.count("path").alias("n_paths"),
    )


def corrupt_quarantine(spark, sf_dir):
    """Lines of large events arrive cut off."""
    lines = feed.dns_lines(spark, sf_dir).select(
        "event_id",
        F.expr("CASE WHEN measure > 100 THEN substr(value, 1, length(value) - 3) ELSE value END").alias("value"),
    )
    return quarantine(decode(lines)).select("event_id", F.col("_corrupt_record").alias("line"))


def text_source_trim(spark, sf_dir):
    folder = new_folder(spark, "lines")
    padded = F.concat(F.lit("  \t"), "value", F.lit(" \t"))
    feed.dns_lines(spark, sf_dir).select(padded.alias("value")).write.text(folder)
    lines = read_lines(spark, folder)
    routed = route(decode(lines.withColumn("chars", F.length("value"))), "dnsmasq", DNSMASQ)
    return routed.groupBy("owner").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


def owners(spark, sf_dir):
    return feed.dns_feed(spark, sf_dir).select("owner").distinct()


def parquet_by_format(spark, sf_dir):
    folder = new_folder(spark, "by-format")
    shared = ("event_id", "owner", "log_format")
    dns = feed.dns_feed(spark, sf_dir).select(*shared, "message")
    errors = feed.error_feed(spark, sf_dir).select(*shared, "message")
    access = feed.access_feed(spark, sf_dir).select(*shared, F.col("path").alias("message"))
    write_by_format(dns.unionByName(errors).unionByName(access), folder)
    written = spark.read.parquet(folder)
    return written.groupBy("log_format", "owner").agg(
        F.count("*").alias("n"), F.sum(F.length("message")).alias("chars")
    )


def list_source(spark, sf_dir):
    """Lines handed over as a list: one record for each nation."""
    nations = feed.table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()
    lines = [
        json.dumps({"time": "Mar 04 10:00:00", "owner": f"region{r.n_regionkey}", "log_format": "dnsmasq", "pid": "1",
                    "message": f"reply {r.n_name.replace(' ', '-')} is 10.0.0.{r.n_nationkey}"})
        for r in nations
    ]
    records = route(decode(lines_from_list(spark, lines)), "dnsmasq", DNSMASQ)
    return parse_dnsmasq(records, feed.YEAR).select("owner", "response", "value1", "value2")


def decode_odd_lines(spark, sf_dir):
    """Lines with a tail, glued to another, blank and missing ones among whole ones."""
    lines = feed.dns_lines(spark, sf_dir).select("event_id", F.expr(feed.ODD_LINE).alias("value"))
    return decode(lines).select("event_id", "message", F.col("_corrupt_record").alias("left_over"))


def all_lines(spark, sf_dir):
    """Lines of every format, some of another one."""

    def as_lines(df, schema):
        return df.select(F.to_json(F.struct(*schema.names)).alias("value"))

    access = feed.access_feed(spark, sf_dir)
    renamed = F.when(F.col("event_id") % 10 == 0, "other").otherwise(F.col("log_format"))
    return (
        feed.dns_lines(spark, sf_dir).select("value")
        .unionByName(as_lines(feed.error_feed(spark, sf_dir), APACHE_ERROR))
        .unionByName(as_lines(access.withColumn("log_format", renamed), APACHE_ACCESS))
    )


def run_all_formats(spark, sf_dir):
    """Rows of each output of a run over all formats, by owner."""
    known = feed.supplier_indicators(spark, sf_dir)
    result = run_batch(settle(all_lines(spark, sf_dir)), known, fixed_score, feed.YEAR)
    outputs = {
        "alerts": (result.alerts, F.sum("count")),
        "scored": (result.scored, F.count("*")),
        "errors": (result.errors, F.count("*")),
        "error_alerts": (result.error_alerts, F.sum("count")),
        "access": (result.access, F.count("*")),
        "unrouted": (result.unrouted, F.count("*")),
    }
    tables = [
        df.groupBy("owner").agg(n.alias("n")).select(F.lit(name).alias("output"), "owner", "n")
        for name, (df, n) in outputs.items()
    ]
    return reduce(DataFrame.unionByName, tables)


# Parsing


def dns_parse(spark, sf_dir):
    return parsed_dns(spark, sf_dir).select("event_id", "response", "value1", "value2", "key")


def dns_template(spark, sf_dir):
    return parsed_dns(spark, sf_dir).groupBy("owner", "key").agg(F.count("*").alias("n"))


def dns_epoch(spark, sf_dir):
    return parsed_dns(spark, sf_dir).select("event_id", "epoch_timestamp")


def apache_error_parse(spark, sf_dir):
    parts = extract_error_parts(feed.error_feed(spark, sf_dir))
    return parts.select("event_id", *ERROR_PARTS)


def apache_error_template(spark, sf_dir):
    return parsed_errors(spark, sf_dir).select(
        "event_id", "key", "epoch_timestamp", F.array_join("value", "|").alias("parameters")
    )


def access_passthrough(spark, sf_dir):
    return parse_apache_access(feed.access_feed(spark, sf_dir))


# Functions


def char_counts(spark, sf_dir):
    names = {"dots": ".", "hyphens": "-", "slashes": "/", "asterisks": "*"}
    counts = [char_count("text", char).alias(name) for name, char in names.items()]
    return feed.documents(spark, sf_dir).select("doc_id", *counts, F.length("text").alias("chars"))


def page_char_counts(spark, sf_dir):
    return feed.table(spark, sf_dir, "pages").select(
        "page_id",
        char_count("url", ".").alias("url_dots"),
        char_count("url", "-").alias("url_hyphens"),
        char_count("url", "/").alias("url_slashes"),
        char_count("html", "/").alias("html_slashes"),
        char_count("html", "*").alias("html_asterisks"),
    )


def capital_counts(spark, sf_dir):
    return feed.documents(spark, sf_dir).select("doc_id", capital_count("text").alias("capitals"))


def file_extension_flag(spark, sf_dir):
    return feed.table(spark, sf_dir, "pages").select(
        "page_id",
        has_file_extension("url").alias("anywhere"),
        has_file_extension("url", "suffix").alias("at_end"),
    )


def ip_classes(spark, sf_dir):
    return parsed_dns(spark, sf_dir).select("event_id", ip_class("value2").alias("value2_ip_class"))


def entropy_readable(spark, sf_dir):
    value = entropy("value1")
    return parsed_dns(spark, sf_dir).select(
        "event_id", F.round(value, 6).alias("entropy"), readable(value).alias("human_readable")
    )


def document_entropy(spark, sf_dir):
    return feed.documents(spark, sf_dir).select("doc_id", F.round(entropy("text"), 6).alias("entropy"))


# Features


def dns_features_18(spark, sf_dir):
    return featured_dns(spark, sf_dir).select("event_id", "owner", *FEATURES_18)


def dns_features_13(spark, sf_dir):
    features = dns_features_temporal(indexed_dns(spark, sf_dir), tie="event_id")
    return features.select("event_id", "owner", *FEATURES_13).withColumn(
        "time_diff_unix", F.col("time_diff_unix").cast("double")
    )


def time_gaps(spark, sf_dir):
    gaps = time_gap(parsed_dns(spark, sf_dir), "owner", "epoch_timestamp", "event_id", "gap")
    return gaps.select("event_id", F.col("gap").cast("double").alias("gap"))


def second_gaps(spark, sf_dir):
    """Pauses of each owner's feed, one row per second with records."""
    return first_gaps(parsed_dns(spark, sf_dir), "owner", "epoch_timestamp", "event_id").select(
        "owner", "epoch_timestamp", F.coalesce("gap", F.lit(0)).alias("gap")
    )


def day_of_weeks(spark, sf_dir):
    return parsed_dns(spark, sf_dir).select("event_id", day_of_week("epoch_timestamp").alias("day_of_week"))


def running_value_counts(spark, sf_dir):
    return running_value_count(parsed_dns(spark, sf_dir), ["owner"], "value1", "running")


# Templates


def template_index(spark, sf_dir):
    return indexed_dns(spark, sf_dir).select("event_id", "key", "encoded_key")


def error_template_vocabulary(spark, sf_dir):
    return template_vocabulary(parsed_errors(spark, sf_dir))


def error_template_index(spark, sf_dir):
    parsed = parsed_errors(spark, sf_dir)
    indexed = index_with_vocabulary(parsed, template_vocabulary(parsed), KEY)
    return indexed.select("event_id", "key", "encoded_key")


# Rules


def rules_xml_table(spark, sf_dir):
    """A rule per page, written as XML files of two rule groups and read back."""
    folder = new_folder(spark, "rules")
    pages = feed.table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", feed.PAGE_HOST, 1)
    page = F.col("page_id")
    rules = pages.select(
        "page_id",
        (page + 100000).alias("_id"),
        (page % 16).alias("_level"),
        F.when(page % 5 == 0, F.lit(1)).alias("_noalert"),
        F.lit("30301").alias("if_sid"),
        # An element with an attribute of its own, and one without, continue one pattern.
        F.array(
            F.struct(F.concat(F.lit("^["), host, F.lit("] |")).alias("_VALUE"), F.lit("plain").alias("_type")),
            F.struct(F.lit("denied ").alias("_VALUE"), F.lit(None).cast("string").alias("_type")),
        ).alias("match"),
        F.concat(F.lit("AH"), page, F.lit("|BH"), page).alias("id"),
        F.concat(F.lit("Page "), host).alias("description"),
        F.struct(
            F.when(page % 3 == 0, F.array()).when(page % 3 == 1, F.array(F.lit("T1190"))).otherwise(
                F.array(F.lit("T1102"), F.concat(F.lit("T"), page + 2000))
            ).alias("id")
        ).alias("mitre"),
        F.array(F.struct(host.alias("_VALUE"), F.lit("link").alias("_type")), F.struct(F.lit("a note").alias("_VALUE"), F.lit("text").alias("_type"))).alias("info"),
        F.concat(F.lit("web,"), F.regexp_extract("url", "^([a-z]+):", 1), F.lit(",")).alias("group"),
    )
    for parity, name in enumerate(("pages,even,", "pages,odd,")):
        made = rules.filter(page % 2 == parity).drop("page_id")
        made.write.format("xml").option("rootTag", f'group name="{name}"').option("rowTag", "rule").save(f"{folder}/{parity}")
    table = read_rules(spark, f"{folder}/*")
    return table.select(
        "rule_id", "level", "noalert", "match", "description",
        F.array_join(F.col("parents").cast("array<string>"), ",").alias("parents"),
        F.array_join("codes", ",").alias("codes"),
        F.array_join("tags", ",").alias("tags"),
        F.array_join("groups", ",").alias("groups"),
        F.coalesce(F.array_join("techniques", ","), F.lit("")).alias("techniques"),
        F.array_join(F.transform("info", lambda i: F.concat(i["_type"], F.lit("="), i["_VALUE"])), ",").alias("info"),
    )


def apache_id_alerts(spark, sf_dir):
    return apache_id_rules(parsed_errors(spark, sf_dir), rules_table(spark), KEY)


def apache_id_alerts_last_id(spark, sf_dir):
    return apache_id_rules(parsed_errors(spark, sf_dir), rules_table(spark), KEY, last_id_only=True)


def matched_errors(spark, sf_dir):
    return match_rules(with_source(parsed_errors(spark, sf_dir)), DEFAULT_RULES)


def rule_matches(spark, sf_dir):
    hits = matched_errors(spark, sf_dir).select("event_id", F.explode_outer("matched").alias("rule_id"))
    return hits.filter(F.col("rule_id").isNotNull())


def rule_every_hit(spark, sf_dir):
    """Rules that hold for errors of every kind that the rule set knows, by kind."""
    parsed = with_source(parse_apache_error(feed.rule_feed(spark, sf_dir)))
    hits = match_rules(parsed, DEFAULT_RULES).select("level", "message", F.explode_outer("matched").alias("rule_id"))
    return hits.filter(F.col("rule_id").isNotNull()).groupBy("rule_id", "level", "message").agg(F.count("*").alias("n"))


def rule_hierarchy(spark, sf_dir):
    return rule_alerts(matched_errors(spark, sf_dir), DEFAULT_RULES, rules_table(spark))


def rule_frequency(spark, sf_dir):
    return frequency_alerts(rule_hits(matched_errors(spark, sf_dir)), paced(DEFAULT_RULES, feed.RULE_PACE))


# Indicators


def indicator_alerts(spark, sf_dir):
    indicators = feed.supplier_indicators(spark, sf_dir)
    return match_indicators(parsed_dns(spark, sf_dir), indicators, KEY).alerts


def indicator_remainder(spark, sf_dir):
    indicators = feed.supplier_indicators(spark, sf_dir)
    remainder = match_indicators(parsed_dns(spark, sf_dir), indicators, KEY).remainder
    return remainder.select("event_id", "owner", "value1", "value2")


def keep_first_n_per_domain(spark, sf_dir):
    remainder = match_indicators(
        parsed_dns(spark, sf_dir),
        feed.supplier_indicators(spark, sf_dir),
        KEY,
        keep_first_n=3,
        order=["epoch_timestamp", "event_id"],
    ).remainder
    return remainder.select("event_id", "owner", "value1", "value2")


def indicator_csv_scan(spark, sf_dir):
    """Indicators that are appended by two batches, and how often each stands in the files."""
    folder = new_folder(spark, "indicators")
    indicators = feed.supplier_indicators(spark, sf_dir)
    write_indicator_csv(indicators.filter("owner <> 'client02'"), folder)
    write_indicator_csv(indicators, folder)
    cells = spark.read.text(folder).select("owner", F.explode(F.split("value", ",")).alias("value2"))
    copies = cells.groupBy("owner", "value2").agg(F.count("*").alias("copies"))
    return read_indicator_csv(spark, folder).join(copies, ["owner", "value2"], "full")


def indicator_table_append(spark, sf_dir):
    """The same with a table of the catalog: its rows, and the copies in its files."""
    folder = new_folder(spark, "indicator-table")
    # The folder's name is unique, and so is the table's.
    name = f"indicators_{folder.rsplit('-', 1)[1]}"
    indicators = feed.supplier_indicators(spark, sf_dir)
    try:
        append_indicators(indicators.filter("owner <> 'client02'"), name, folder)
        append_indicators(indicators, name, folder)
        rows = spark.read.table(name).groupBy("owner", "value2").agg(F.count("*").alias("n_rows"))
        copies = spark.read.parquet(folder).groupBy("owner", "value2").agg(F.count("*").alias("copies"))
        return settle(rows.join(copies, ["owner", "value2"], "full"))
    finally:
        # Its files stay.
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def indicator_csv_ragged(spark, sf_dir):
    """Lists whose lines have one cell or several."""
    folder = new_folder(spark, "ragged")
    cells = F.slice(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.concat(F.lit("10.9."), i, F.lit("."), F.col("s_suppkey"))),
                    F.lit(1), (F.col("s_suppkey") % 3 + 1).cast("int"))
    suppliers = feed.table(spark, sf_dir, "supplier")
    suppliers.orderBy("s_suppkey").select(F.array_join(cells, ",").alias("value")).write.text(folder)
    return read_indicator_csv(spark, folder, "client01")


def zip_orders(spark, sf_dir):
    """The n-th record by address and the n-th by time."""
    parsed = parsed_dns(spark, sf_dir)
    by_address = parsed.select("value2", F.col("event_id").alias("address_event"))
    by_time = parsed.select("epoch_timestamp", F.col("event_id").alias("time_event"))
    return zip_by_order(by_address, by_time, ["value2", "address_event"], ["epoch_timestamp", "time_event"])


# Scoring


def anomaly_score(spark, sf_dir):
    """Each record's weak label, and what a forest that has not seen the record says."""
    scored = cross_fit(weak_label(featured_dns(spark, sf_dir)), KEY, FEATURES_18)
    return scored.select("event_id", "owner", "label", "prediction")


def saved_model_score(spark, sf_dir):
    """Predictions of a forest and a template index that were saved and loaded, by owner."""
    parsed = parsed_dns(spark, sf_dir)
    folder = new_folder(spark, "models")
    fit_template_index(parsed).save(f"{folder}/index")
    labelled = weak_label(dns_features(load_template_index(f"{folder}/index").transform(parsed)))
    fit_classifier(labelled).save(f"{folder}/forest")
    scored = score_anomalies(labelled, load_classifier(f"{folder}/forest"))
    return scored.groupBy("owner", "encoded_key", "label", "prediction").agg(F.count("*").alias("n"))


def capital_scorer():
    """A stand-in for an outside model: long names with many capitals."""
    capitals, length = FEATURES_18.index("value1_capital_count"), FEATURES_18.index("value1_length")

    def predict(rows: np.ndarray) -> np.ndarray:
        return ((rows[:, capitals] >= 8) & (rows[:, length] > 60)).astype(np.int32)

    return predict


def batch_model_score(spark, sf_dir):
    return score_with(featured_dns(spark, sf_dir), capital_scorer).select("event_id", "prediction")


def temporal_anomalies(spark, sf_dir):
    """Anomalies by a stand-in for the 13-feature model: long names within five minutes of the last record."""

    def long_name_soon(df):
        soon = F.col("time_diff_unix") < 300
        return df.withColumn("prediction", (soon & (F.col("value1_length") > 60)).cast("int"))

    return anomalies(score_temporal(indexed_dns(spark, sf_dir), long_name_soon, "event_id"))


def anomaly_score_temporal(spark, sf_dir):
    features = dns_features_temporal(indexed_dns(spark, sf_dir), tie="event_id")
    labelled = features.withColumn("label", (F.col("value1_length") > 60).cast("int"))
    return cross_fit(labelled, KEY, FEATURES_13).select("event_id", "owner", "label", "prediction")


def derived_indicators(spark, sf_dir):
    known = feed.supplier_indicators(spark, sf_dir)
    matches = match_indicators(featured_dns(spark, sf_dir), known, KEY)
    return derive_indicators(fixed_score(matches.remainder), known)


def indicator_feedback(spark, sf_dir):
    """Alerts of the month's second half from what the first half derived."""
    none = spark.createDataFrame([], "owner string, value2 string")
    lines = feed.dns_lines(spark, sf_dir)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    first = run_batch(lines.filter(F.col("ts") < middle).select("value"), none, fixed_score, feed.YEAR)
    learnt = settle(first.indicators)
    second = run_batch(lines.filter(F.col("ts") >= middle).select("value"), learnt, fixed_score, feed.YEAR)
    return second.alerts


QUERIES: dict[str, Query] = {
    "json_decode_route": json_decode_route,
    "corrupt_quarantine": corrupt_quarantine,
    "text_source_trim": text_source_trim,
    "decode_odd_lines": decode_odd_lines,
    "list_source": list_source,
    "owners": owners,
    "parquet_by_format": parquet_by_format,
    "dns_parse": dns_parse,
    "dns_template": dns_template,
    "dns_epoch": dns_epoch,
    "apache_error_parse": apache_error_parse,
    "apache_error_template": apache_error_template,
    "access_passthrough": access_passthrough,
    "char_counts": char_counts,
    "page_char_counts": page_char_counts,
    "capital_count": capital_counts,
    "file_extension_flag": file_extension_flag,
    "ip_class": ip_classes,
    "entropy_readable": entropy_readable,
    "document_entropy": document_entropy,
    "dns_features_18": dns_features_18,
    "dns_features_13": dns_features_13,
    "time_gap": time_gaps,
    "second_gaps": second_gaps,
    "day_of_week": day_of_weeks,
    "running_value_count": running_value_counts,
    "template_index": template_index,
    "error_template_vocabulary": error_template_vocabulary,
    "error_template_index": error_template_index,
    "rules_xml_table": rules_xml_table,
    "apache_id_alerts": apache_id_alerts,
    "apache_id_alerts_last_id": apache_id_alerts_last_id,
    "rule_matches": rule_matches,
    "rule_every_hit": rule_every_hit,
    "rule_hierarchy": rule_hierarchy,
    "rule_frequency": rule_frequency,
    "indicator_alerts": indicator_alerts,
    "indicator_remainder": indicator_remainder,
    "keep_first_n_per_domain": keep_first_n_per_domain,
    "indicator_csv_scan": indicator_csv_scan,
    "indicator_table_append": indicator_table_append,
    "indicator_csv_ragged": indicator_csv_ragged,
    "zip_by_order": zip_orders,
    "anomaly_score": anomaly_score,
    "saved_model_score": saved_model_score,
    "batch_model_score": batch_model_score,
    "temporal_anomalies": temporal_anomalies,
    "anomaly_score_temporal": anomaly_score_temporal,
    "derived_indicators": derived_indicators,
    "indicator_feedback": indicator_feedback,
    "run_all_formats": run_all_formats,
    "stream_dns_alerts": stream_dns_alerts,
    "stream_owner_names": stream_owner_names,
    "stream_frequency_windows": stream_frequency_windows,
    "stream_late_hits": stream_late_hits,
    "stream_learning": stream_learning,
    "stream_resumed": stream_resumed,
    "stream_phase_counts": stream_phase_counts,
    "stream_rate_lines": stream_rate_lines,
}
