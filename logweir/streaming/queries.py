"""Queries over the test tables that run as streams until the source is drained."""

from math import ceil
from uuid import uuid4

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.idrules import with_source
from logweir.operators.ordered import number_rows
from logweir.operators.parse import parse_apache_error, parse_dnsmasq
from logweir.operators.ruleset import DEFAULT_RULES, paced
from logweir.operators.ruletree import match_rules, rule_hits
from logweir.operators.templates import template_vocabulary
from logweir.plans import feed
from logweir.schema import DNSMASQ
from logweir.sources.indicators import SEED, read_indicator_table, write_indicator_batch
from logweir.sources.lines import decode, route, stream_lines
from logweir.sources.sinks import read_batches
from logweir.streaming.frequency import closed_alerts, flush, late_hits, read_alerts, run_frequency
from logweir.streaming.metrics import BatchMetrics, observed_counts
from logweir.streaming.run import PHASE, run_stream
from logweir.workspace import new_folder, settle

# How late a record may come, in seconds.
LATENESS = 600
# Files of a micro-batch.
FILES = 64
# Events of a file of dealt events.
FILE_ROWS = 200_000
ALERTS = "owner string, value2 string, detection string, count bigint"
# Batches between snapshots of a short run, and the one that fails once.
SNAPSHOTS, FAILING = 2, 2


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    # The pattern also fits a folder of files.
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(f"{sf_dir}/events.parquet*")


def stream_dns_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a run that starts with the suppliers' indicators, added up over its micro-batches."""
    out = new_folder(spark, "dns-run")
    write_indicator_batch(feed.supplier_indicators(spark, sf_dir), f"{out}/indicators", SEED)
    parsed = parse_dnsmasq(feed.dns_feed(spark, sf_dir).select(*DNSMASQ.names), feed.YEAR)
    known_templates = settle(template_vocabulary(parsed))
    lines = feed.dns_lines(spark, sf_dir, event_stream(spark, sf_dir)).select("value")

    def nothing_found(df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(0))

    query = run_stream(
        lines, out, nothing_found, known_templates, feed.YEAR, new_folder(spark, "dns-checkpoint"), trigger=None
    )
    query.awaitTermination()
    alerts = read_batches(spark, f"{out}/alerts", ALERTS)
    return alerts.groupBy("owner", "value2", "detection").agg(F.sum("count").alias("count"))


def stream_owner_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run learns for owners whose names could be taken for numbers or for nothing."""
    out = new_folder(spark, "owner-run")
    lines = feed.dns_lines(spark, sf_dir, event_stream(spark, sf_dir)).select("value")
    for plain, odd in feed.ODD_OWNERS.items():
        lines = lines.select(F.replace("value", F.lit(f'"owner":"{plain}"'), F.lit(f'"owner":"{odd}"')).alias("value"))
    query = run_stream(lines, out, encoded_names, None, feed.YEAR, new_folder(spark, "owner-checkpoint"), trigger=None)
    query.awaitTermination()
    return read_indicator_table(spark, f"{out}/indicators")


def encoded_names(df: DataFrame) -> DataFrame:
    """A stand-in for an outside model: long names with many capitals."""
    anomaly = (F.col("value1_capital_count") >= 8) & (F.col("value1_length") > 60)
    return df.withColumn("prediction", F.coalesce(anomaly, F.lit(False)).cast("int"))


class DealtEvents:
    """The events in files that come part by part; each part is one micro-batch."""

    def __init__(self, spark: SparkSession, sf_dir: str, late: bool = False):
        self.spark, self.folder = spark, new_folder(spark, "dealt")
        self._events = settle(feed.dealt_events(spark, sf_dir, late))
        largest = self._events.groupBy("arrival").count().agg(F.max("count")).first()[0] or 0
        self.files = max(1, ceil(largest / FILE_ROWS))

    def deliver(self, *parts: int) -> None:
        for part in parts:
            # Every part has the same number of files, and later ones are younger.
            made = self._events.filter(F.col("arrival") == part).drop("arrival").repartition(self.files)
            made.write.parquet(f"{self.folder}/{part}")

    def stream(self) -> DataFrame:
        schema = self._events.drop("arrival").schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files).parquet(f"{self.folder}/*")


def _frequency_run(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Outputs, checkpoint and batch reports of the frequency rules over parts of the month, some events being late."""
    events = DealtEvents(spark, sf_dir, late=True)
    events.deliver(*range(feed.PARTS))
    parsed = with_source(parse_apache_error(feed.error_feed(spark, sf_dir, events.stream())))
    hits = rule_hits(match_rules(parsed, DEFAULT_RULES))
    out, checkpoint, name = new_folder(spark, "frequency-run"), new_folder(spark, "frequency-checkpoint"), f"frequency-{uuid4().hex}"
    rules = paced(DEFAULT_RULES, feed.RULE_PACE)
    with BatchMetrics(spark, f"{out}/progress", name):
        run_frequency(hits, rules, out, checkpoint, LATENESS, name=name).awaitTermination()
    return out, checkpoint, f"{out}/progress"


def stream_frequency_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the frequency rules over a stream that is drained, and whether the stream itself closed their seconds.

    Its last seconds are still open then, and their alerts come from a flush.
    """
    out, checkpoint, _ = _frequency_run(spark, sf_dir)
    by_stream = settle(closed_alerts(spark, out))
    flush(spark, paced(DEFAULT_RULES, feed.RULE_PACE), out, checkpoint)
    marked = by_stream.withColumn("closed", F.lit(True))
    keys = ["owner", "srcip", "rule_id", "epoch_timestamp"]
    return read_alerts(spark, out).join(marked.drop("hits"), keys, "left").withColumn("closed", F.coalesce("closed", F.lit(False)))


def stream_late_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits that each frequency rule was given, and those that came after their second was closed."""
    out, checkpoint, progress = _frequency_run(spark, sf_dir)
    return late_hits(spark, progress, out, checkpoint)


def _alerts_by_batch(spark: SparkSession, out: str) -> DataFrame:
    alerts = read_batches(spark, f"{out}/alerts", ALERTS)
    return alerts.groupBy("batch_id", "owner", "value2").agg(F.sum("count").alias("count"))


def stream_learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts by micro-batch of a run that starts with no indicators: all it matches it has learnt in earlier batches.

    The run is a continuous one that looks for files every second, and is stopped when it has seen them all.
    """
    events = DealtEvents(spark, sf_dir)
    events.deliver(*range(feed.PARTS))
    out, checkpoint = new_folder(spark, "learning-run"), new_folder(spark, "learning-checkpoint")
    lines = feed.dns_lines(spark, sf_dir, events.stream()).select("value")
    query = run_stream(lines, out, encoded_names, None, feed.YEAR, checkpoint, "1 second", snapshot_every=SNAPSHOTS)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _alerts_by_batch(spark, out)


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts by micro-batch of a run that is drained, resumed with more files, broken off and resumed again.

    It breaks when a batch's outputs stand but the batch does not count as done, so that this batch is run twice.
    """
    events = DealtEvents(spark, sf_dir)
    out, checkpoint = new_folder(spark, "resumed-run"), new_folder(spark, "resumed-checkpoint")
    broken = []

    def break_once(batch_id: int) -> None:
        if batch_id == FAILING and not broken:
            broken.append(batch_id)
            raise RuntimeError("broken off on purpose")

    def run() -> None:
        lines = feed.dns_lines(spark, sf_dir, events.stream()).select("value")
        run_stream(
            lines, out, encoded_names, None, feed.YEAR, checkpoint, None, snapshot_every=SNAPSHOTS, after_batch=break_once
        ).awaitTermination()

    events.deliver(0, 1)
    run()
    events.deliver(*range(2, feed.PARTS))
    try:
        run()
    except StreamingQueryException:
        if not broken:
            raise
    run()
    return _alerts_by_batch(spark, out)


def stream_phase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each phase of each micro-batch: lines as the listener reports them, outputs as the run notes them."""
    events = DealtEvents(spark, sf_dir)
    events.deliver(*range(feed.PARTS))
    out, checkpoint, name = new_folder(spark, "counted-run"), new_folder(spark, "counted-checkpoint"), f"counted-{uuid4().hex}"
    lines = feed.dns_lines(spark, sf_dir, events.stream()).select("value")
    with BatchMetrics(spark, f"{out}/progress", name):
        run_stream(lines, out, encoded_names, None, feed.YEAR, checkpoint, None, name).awaitTermination()
    seen = observed_counts(spark, f"{out}/progress", "lines").select(
        "batch_id", F.concat(F.lit("observed "), "metric").alias("phase"), F.coalesce("rows", F.lit(0)).alias("rows")
    )
    noted = read_batches(spark, f"{out}/phases", PHASE).select("batch_id", "phase", "rows")
    return seen.unionByName(noted)


def stream_rate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by owner of a stream that comes from no files: a clocked source calls each line of a table by its number.

    Two runs on one checkpoint take half of them each.
    """
    table = settle(number_rows(feed.dns_lines(spark, sf_dir), ["event_id"], "place").select("place", F.col("value").alias("line")))
    half = max(1, ceil(table.count() / 2))
    out, checkpoint = new_folder(spark, "rate-run"), new_folder(spark, "rate-checkpoint")
    for _ in range(2):
        calls = stream_lines(spark, "rate-micro-batch", rowsPerBatch=half, numPartitions=4)
        called = calls.join(table, F.col("value").cast("long") + 1 == F.col("place")).select(F.col("line").alias("value"))
        records = route(decode(called), "dnsmasq", DNSMASQ)
        writer = records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    read = spark.read.schema(DNSMASQ).parquet(out)
    return read.groupBy("owner").agg(F.count("*").alias("n"), F.sum(F.length("message")).alias("chars"))
