"""Frequency rules over a stream, on Spark's event time.

Hits are added up by second in Spark's state store. A watermark closes a second once hits ``lateness`` seconds younger
have come: its sums leave the store, once, and hits that come later still are dropped there. Each micro-batch looks
back, with the batch operator, over the seconds it has closed and those that the batch before carried over, which are
the closed ones of one timeframe. What a batch reads and keeps is therefore bounded by the open seconds and a
timeframe, however long the stream has been running.

``flush`` gives the alerts of the seconds that are open when a stream has been drained; it reads them from the state
store of the checkpoint.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.operators.ruleset import Rule
from logweir.operators.ruletree import counted_hits, look_back
from logweir.sources.sinks import batch_folder, path_exists, read_batch, read_batches, write_batch
from logweir.streaming.metrics import observed_counts

ALERT = "owner string, srcip string, rule_id int, epoch_timestamp bigint, hits bigint"
CARRIED = f"{ALERT}, batch bigint"
# The folder of alerts of open seconds, replaced by each flush.
OPEN = -1
# A batch needs what the one before carried over, and replaces what the one before that did.
SLOTS = 2
#: Name of the observed counts, and the rule's number after it.
OBSERVED = "counted_hits"


def seconds_closed(hits: DataFrame, rules: list[Rule], lateness: int) -> DataFrame:
    """A stream of closed seconds (owner, srcip, rule_id, epoch_timestamp, hits) from a stream of hits.

    Every hit moves the time on, also of rules that no frequency rule counts. A hit without a time is left out.
    """
    seconds = hits.filter(F.col("epoch_timestamp").isNotNull()).select(
        "owner", "srcip", "rule_id", F.timestamp_seconds("epoch_timestamp").alias("second")
    )
    counted = counted_hits(seconds.withWatermark("second", f"{lateness} seconds"), rules)
    by_rule = [F.count(F.when(F.col("rule_id") == r.rule_id, 1)).alias(f"rule_{r.rule_id}") for r in rules if r.counted_rule is not None]
    if by_rule:
        counted = counted.observe(OBSERVED, *by_rule)
    summed = counted.groupBy("owner", "srcip", "rule_id", "second").agg(F.count("*").alias("hits"))
    return summed.select("owner", "srcip", "rule_id", F.unix_seconds("second").alias("epoch_timestamp"), "hits")


def frequency_step(closed: DataFrame, batch_id: int, rules: list[Rule], out: str) -> None:
    """Write the alerts of the seconds that one micro-batch closed. A batch run again replaces itself."""
    spark = closed.sparkSession
    # Reading them twice would ask the state store twice.
    closed = closed.persist()
    try:
        carried = _carried(spark, out, batch_id - 1)
        seconds = carried.drop("batch").unionByName(closed)
        before, newest = carried.agg(F.max("epoch_timestamp")).first()[0], seconds.agg(F.max("epoch_timestamp")).first()[0]
        alerts = look_back(seconds, rules)
        # All that a batch closes lies behind what was closed before.
        write_batch(alerts if before is None else alerts.filter(F.col("epoch_timestamp") > before), f"{out}/alerts", batch_id)
        # One row for each rule.
        write_batch(closed.groupBy("rule_id").agg(F.sum("hits").alias("hits")), f"{out}/closed", batch_id)
        longest = max((r.timeframe for r in rules if r.counted_rule is not None), default=0)
        kept = seconds.filter(F.col("epoch_timestamp") >= F.lit(newest) - longest)
        write_batch(kept.withColumn("batch", F.lit(batch_id).cast("bigint")), f"{out}/carried", batch_id % SLOTS)
    finally:
        closed.unpersist()


def _carried(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    if not path_exists(spark, batch_folder(f"{out}/carried", batch_id % SLOTS)):
        return spark.createDataFrame([], CARRIED)
    return read_batch(spark, f"{out}/carried", batch_id % SLOTS, CARRIED)


def open_seconds(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The seconds that no watermark has closed yet, from the state store of a stream that is not running."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.owner", "key.srcip", "key.rule_id", F.unix_seconds("key.second").alias("epoch_timestamp"), F.col("value.count").alias("hits"))


def flush(spark: SparkSession, rules: list[Rule], out: str, checkpoint: str) -> None:
    """Write the alerts of the seconds still open. A stream that goes on closes them later, with what then came."""
    slots = read_batches(spark, f"{out}/carried", CARRIED).drop("batch_id")
    last = slots.agg(F.max("batch")).first()[0]
    carried = slots.filter(F.col("batch") == last).drop("batch")
    upto = carried.agg(F.max("epoch_timestamp")).first()[0]
    alerts = look_back(carried.unionByName(open_seconds(spark, checkpoint)), rules)
    write_batch(alerts if upto is None else alerts.filter(F.col("epoch_timestamp") > upto), f"{out}/open", OPEN)


def closed_alerts(spark: SparkSession, out: str) -> DataFrame:
    """The alerts of seconds that the stream itself has closed."""
    return read_batches(spark, f"{out}/alerts", ALERT).drop("batch_id")


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """All alerts: of closed seconds, and of those open at the last flush that have not been closed since."""
    closed = closed_alerts(spark, out)
    upto = read_batches(spark, f"{out}/carried", CARRIED).agg(F.max("epoch_timestamp")).first()[0]
    still_open = read_batches(spark, f"{out}/open", ALERT).drop("batch_id")
    return closed.unionByName(still_open if upto is None else still_open.filter(F.col("epoch_timestamp") > upto))


def late_hits(spark: SparkSession, progress: str, out: str, checkpoint: str) -> DataFrame:
    """``(rule_id, hits, late)``: how many hits each frequency rule was given, and how many came after their second was closed.

    ``progress`` is the table that ``BatchMetrics`` made of the run. A hit that is in no second that was closed or is
    still open was late. Each batch writes how much it closed, so that no sum grows with the seconds.
    """
    given = observed_counts(spark, progress, OBSERVED).groupBy("metric").agg(F.sum("rows").alias("hits"))
    given = given.select(F.replace("metric", F.lit("rule_"), F.lit("")).cast("int").alias("rule_id"), "hits")
    in_time = read_batches(spark, f"{out}/closed", "rule_id int, hits bigint").drop("batch_id")
    in_time = in_time.unionByName(open_seconds(spark, checkpoint).select("rule_id", "hits"))
    kept = in_time.groupBy("rule_id").agg(F.sum("hits").alias("kept"))
    return given.join(kept, "rule_id", "left").select("rule_id", "hits", (F.col("hits") - F.coalesce("kept", F.lit(0))).alias("late"))


def run_frequency(
    hits: DataFrame, rules: list[Rule], out: str, checkpoint: str, lateness: int, trigger: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Start the run over a stream of hits (owner, srcip, epoch_timestamp, rule_id).

    ``trigger=None`` works off what is there and stops. ``name`` is the query's, by which ``BatchMetrics`` knows it.
    """

    def process(closed: DataFrame, batch_id: int) -> None:
        frequency_step(closed, batch_id, rules, out)

    writer = seconds_closed(hits, rules, lateness).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer if name is None else writer.queryName(name)
    timed = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return timed.start()
