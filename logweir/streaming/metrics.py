"""Row counts and durations of runs."""

import json
import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from logweir.sources.sinks import read_batches, write_batch

PROGRESS = (
    "batch_id bigint, input_rows bigint, rows_per_second double,"
    " durations_ms map<string, bigint>, observed string"
)
#: One row for each observed number (its observation and name), the input rows and the milliseconds of each step.
BATCH_METRIC = "kind string, metric string, rows bigint"
INPUT, STEP_MS = "input", "step_ms"


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The last batches' row counts, step durations and observed counts. Spark keeps a bounded number."""
    rows = []
    for entry in query.recentProgress:
        report = json.loads(entry.json) if hasattr(entry, "json") else dict(entry)
        observed = {name: values for name, values in report.get("observedMetrics", {}).items()}
        rows.append(
            (
                report["batchId"],
                report["numInputRows"],
                float(report.get("processedRowsPerSecond") or 0.0),
                {k: int(v) for k, v in report["durationMs"].items()},
                json.dumps(observed),
            )
        )
    return spark.createDataFrame(rows, PROGRESS)


class BatchMetrics(StreamingQueryListener):
    """Writes what each micro-batch of the query called ``name`` reports to the table at ``path``.

    The rows of a batch are in its own folder, replaced if it is run again, and stand as soon as Spark reports the
    batch: unlike ``progress_table`` nothing is lost with the query or for its length. Used as a context around the
    run; it leaves once the query's end has been reported.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self._id = None
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = event.id
            self._ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name:
            return
        rows = [(INPUT, "rows", progress.numInputRows)]
        rows += [(STEP_MS, step, int(ms)) for step, ms in progress.durationMs.items()]
        for observation, values in progress.observedMetrics.items():
            rows += [(observation, metric, None if n is None else int(n)) for metric, n in values.asDict().items()]
        write_batch(self.spark.createDataFrame(rows, BATCH_METRIC).coalesce(1), self.path, progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self._id:
            self._ended.set()

    def __enter__(self) -> "BatchMetrics":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        # Reports come after the fact; a run that never started has none.
        if self._id is not None:
            self._ended.wait(60)
        self.spark.streams.removeListener(self)


def observed_counts(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """``(batch_id, kind, metric, rows)`` from a table of ``BatchMetrics``."""
    table = read_batches(spark, path, BATCH_METRIC).select("batch_id", "kind", "metric", "rows")
    return table if kind is None else table.filter(F.col("kind") == kind)


def rows_seen(seen: Observation, otherwise: Callable[[], int]) -> int:
    """``rows`` as counted on the way of a write, so that nothing is read back for it.

    Spark drops the counting where it finds beforehand that there are no rows; then ``otherwise`` is asked.
    """
    try:
        return seen.get["rows"]
    except (Py4JJavaError, KeyError):
        return otherwise()


@contextmanager
def timed(durations: dict[str, float], phase: str):
    """Add the seconds spent inside to ``durations[phase]``. Only actions inside take time."""
    start = time.monotonic()
    try:
        yield
    finally:
        durations[phase] = durations.get(phase, 0.0) + time.monotonic() - start
