import os
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logweir.operators.features import dns_features
from logweir.operators.parse import parse_dnsmasq
from logweir.operators.scoring import cross_fit, fit_classifier, score_anomalies, score_with, weak_label
from logweir.operators.templates import fit_template_index, template_vocabulary
from logweir.operators.ruleset import Rule
from logweir.operators.ruletree import frequency_alerts
from logweir.plans.batch import run_batch
from logweir.schema import DNSMASQ, FEATURES_18, INDICATOR
from logweir.sources.indicators import (
    SEED, append_indicators, known_before, read_indicator_csv, read_indicator_table, write_indicator_batch, write_indicator_csv,
    write_snapshot,
)
from logweir.sources.lines import decode, lines_from_list, read_lines, route, stream_lines
from logweir.sources.models import load_classifier, load_template_index
from logweir.sources.sinks import path_exists, read_batches, write_batch, write_by_format
from logweir.streaming.frequency import closed_alerts, flush, frequency_step, late_hits, read_alerts, run_frequency
from logweir.streaming.metrics import BatchMetrics, observed_counts, progress_table, timed
from logweir.streaming.run import run_stream
from logweir.workspace import new_folder, settle, shared_root
from tests.samples import ACCESS, ASKING, DNS, ENCODED, ERRORS, as_lines, dns_record


def many_capitals(df):
    return df.withColumn("prediction", F.coalesce(F.col("value1_capital_count") > 8, F.lit(False)).cast("int"))


def no_indicators(spark):
    return spark.createDataFrame([], INDICATOR)


@pytest.fixture(scope="module")
def features(spark):
    routed = route(decode(lines_from_list(spark, as_lines(DNS))), "dnsmasq", DNSMASQ)
    parsed = parse_dnsmasq(routed, 2023)
    return dns_features(fit_template_index(parsed).transform(parsed)).cache()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert new_folder(spark, "x").startswith(shared_root(spark))
    settled = settle(spark.range(3))
    assert "Scan ExistingRDD" in settled._jdf.queryExecution().toString() and settled.count() == 3


def test_text_lines_are_stripped(spark, tmp_path):
    (tmp_path / "log.txt").write_text("  one \n\ttwo\n")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ["one", "two"]


def test_indicator_csv(spark, tmp_path):
    assert read_indicator_csv(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "a.csv").write_text("1.1.1.1,2.2.2.2\n1.1.1.1,\n")
    got = read_indicator_csv(spark, str(tmp_path / "list"), "c")
    assert sorted(map(tuple, got.collect())) == [("c", "1.1.1.1"), ("c", "2.2.2.2")]
    # An owner is text, and no part of a path is built from it by hand.
    table = spark.createDataFrame([("007", "1.1.1.1"), ("../x", "2.2.2.2")], INDICATOR)
    for _ in range(2):
        write_indicator_csv(table, str(tmp_path / "csv"))
    got = read_indicator_csv(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, got.collect())) == [("../x", "2.2.2.2"), ("007", "1.1.1.1")]
    assert not (tmp_path / "x").exists()


def test_ragged_indicator_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1.1.1.1\n2.2.2.2,3.3.3.3\n\n"4.4.4.4","5.5.5.5",,6.6.6.6\n')
    got = read_indicator_csv(spark, str(tmp_path), "c")
    assert sorted(r.value2 for r in got.collect()) == [f"{i}.{i}.{i}.{i}" for i in range(1, 7)]
    owners = spark.createDataFrame([("", "1.1.1.1"), ("007", "2.2.2.2"), (None, "3.3.3.3")], INDICATOR)
    write_indicator_csv(owners, str(tmp_path / "by-owner"))
    got = read_indicator_csv(spark, str(tmp_path / "by-owner"))
    assert sorted(map(tuple, got.collect())) == [("", "1.1.1.1"), ("007", "2.2.2.2")]


def test_indicator_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_indicator_table(spark, path).count() == 0
    for batch, address in enumerate(["1.1.1.1", "2.2.2.2", "1.1.1.1"]):
        for _ in range(2):  # a batch may be run again
            write_indicator_batch(spark.createDataFrame([("007", address)], INDICATOR), path, batch)
    seen = [{r.value2 for r in read_indicator_table(spark, path, before=b).collect()} for b in range(3)]
    assert seen == [set(), {"1.1.1.1"}, {"1.1.1.1", "2.2.2.2"}]
    assert read_indicator_table(spark, path).count() == 2


def test_snapshots_of_known_indicators(spark, tmp_path):
    path = str(tmp_path / "table")
    assert known_before(spark, path, 0, every=2).count() == 0
    write_indicator_batch(spark.createDataFrame([("007", "seed")], INDICATOR), path, SEED)
    for batch in range(7):
        for _ in range(2):
            known = known_before(spark, path, batch, every=2)
            write_snapshot(spark, path, batch, known, every=2)
            expected = {("007", "seed")} | {("007", f"ip{b % 4}") for b in range(batch)}
            assert Counter(map(tuple, known.collect())) == Counter(expected)
            write_indicator_batch(spark.createDataFrame([("007", f"ip{batch % 4}")], INDICATOR), path, batch)
    assert sorted(os.listdir(f"{path}-snapshots")) == ["batch_id=2", "batch_id=4", "batch_id=6"]


def test_batch_sink_replaces_a_retried_batch(spark, tmp_path):
    for rows in (5, 3):
        write_batch(spark.range(rows), str(tmp_path), 7)
    assert read_batches(spark, str(tmp_path), "id bigint").count() == 3


def test_write_by_format(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "log_format string, x int")
    write_by_format(frame, str(tmp_path / "out"))
    assert sorted(p for p in os.listdir(tmp_path / "out") if "=" in p) == ["log_format=a", "log_format=b"]


def test_models_are_saved_and_loaded(spark, features, tmp_path):
    index = fit_template_index(features)
    index.save(str(tmp_path / "index"))
    assert load_template_index(str(tmp_path / "index")).labels == index.labels
    labelled = weak_label(features)
    assert labelled.filter("label = 1").count() == 9
    fit_classifier(labelled, trees=5).save(str(tmp_path / "forest"))
    scored = score_anomalies(labelled, load_classifier(str(tmp_path / "forest")))
    assert scored.filter("prediction = label").count() == 13
    assert set(features.columns) < set(scored.columns)


def test_outside_model(features):
    def make_predict():
        at = FEATURES_18.index("value1_length")
        return lambda rows: (rows[:, at] > 50).astype(np.int32)

    assert score_with(features, make_predict).filter("prediction = 1").count() == 9


def test_two_batches_feed_back(spark):
    lines = lines_from_list(spark, [*as_lines(DNS), "{broken"])
    first = run_batch(lines, no_indicators(spark), many_capitals, 2023, cache=True)
    assert first.alerts.count() == 0 and first.quarantine.count() == 1 and first.scored.count() == 13
    assert [tuple(r) for r in first.indicators.collect()] == [("client01", ASKING)]
    second = run_batch(lines, first.indicators, many_capitals, 2023)
    assert [(r.value2, r["count"]) for r in second.alerts.collect()] == [(ASKING, 3)]
    assert second.scored.count() == 4 and second.indicators.count() == 0
    first.release()


def test_whole_batch(spark):
    odd = ['{"log_format":"other","owner":"x"}', '{"owner":"x"}', "", None, as_lines(DNS)[0] + " tail", as_lines(DNS)[0] * 2]
    lines = spark.createDataFrame([(x,) for x in as_lines(DNS + ERRORS + ACCESS) + odd], "value string")
    result = run_batch(lines, no_indicators(spark), many_capitals, 2023, cache=True)
    counts = {r.phase: r.rows for r in result.counts.collect()}
    assert counts == {"dnsmasq": 13, "apache_error": 5, "apache2_access": 2, "unrouted": 2, "quarantine": 4}
    assert (result.errors.count(), result.access.count(), result.unrouted.count()) == (5, 2, 2)
    assert [(r.srcip, r["count"]) for r in result.error_alerts.collect()] == [("198.51.100.20", 1)]
    left = {r._corrupt_record for r in result.quarantine.collect()}
    assert left == {"<blank line>", "<null line>", odd[4], odd[5]}
    result.release()


def test_stream_keeps_owner_names(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write_file(source, 0, [dns_record("Mar 04 10:00:00", f"query[A] {ENCODED[0]} from {ASKING}", o) for o in ("007", "", "x")])
    write_file(source, 1, [dns_record("Mar 04 10:01:00", f"query[A] a.example.org from {ASKING}", o) for o in ("007", "", "7")])
    write_file(source, 2, ERRORS + ACCESS + [{"log_format": "other", "owner": "007"}])
    lines = stream_lines(spark, "text", path=str(source), maxFilesPerTrigger="1")
    run_stream(lines, out, many_capitals, None, 2023, str(tmp_path / "c1"), trigger=None).awaitTermination()
    known = {tuple(r) for r in read_indicator_table(spark, f"{out}/indicators").collect()}
    assert known == {("007", ASKING), ("", ASKING), ("x", ASKING)}
    alerts = read_batches(spark, f"{out}/alerts", "owner string, value2 string, detection string, count bigint")
    assert sorted(r.owner for r in alerts.collect()) == ["", "007"]
    phases = read_batches(spark, f"{out}/phases", "phase string, rows bigint, seconds double").filter("batch_id = 2")
    rows = {r.phase: r.rows for r in phases.collect()}
    assert (rows["errors"], rows["error_alerts"], rows["access"], rows["unrouted"], rows["lines unrouted"]) == (5, 1, 2, 1, 1)
    with pytest.raises(ValueError, match="belongs to the run"):
        run_stream(lines, out, many_capitals, None, 2023, str(tmp_path / "c2"), trigger=None)


def test_vocabulary_table_in_place_of_a_model(spark, features):
    lines = lines_from_list(spark, as_lines(DNS))
    by_table = run_batch(lines, no_indicators(spark), many_capitals, 2023, template_vocabulary(features))
    assert {r.key: r.encoded_key for r in by_table.features.collect()} == {
        r.key: r.encoded_key for r in features.collect()
    }


def write_file(folder, number, records):
    path = folder / f"{number}.txt"
    path.write_text("\n".join(as_lines(records)) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def test_stream_feeds_back_and_resumes(spark, features, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()
    index = fit_template_index(features)

    def run():
        lines = stream_lines(spark, "text", path=str(source), maxFilesPerTrigger="1")
        query = run_stream(lines, out, many_capitals, index, 2023, checkpoint, trigger=None)
        query.awaitTermination()
        return query

    def alerts():
        rows = read_batches(spark, f"{out}/alerts", "owner string, value2 string, detection string, count bigint")
        return sorted((r.batch_id, r.value2, r["count"]) for r in rows.collect())

    write_file(source, 0, DNS)
    write_file(source, 1, DNS + [dns_record("Mar 04 09:18:00", f"query[A] new.example.org from {ASKING}")])
    query = run()
    assert alerts() == [(1, ASKING, 4)]
    progress = progress_table(spark, query)
    # The run ends with a look for more files, which may report an empty batch.
    assert [r.input_rows for r in progress.filter("input_rows > 0").orderBy("batch_id").collect()] == [13, 14]
    assert '"rows": 14' in progress.filter("batch_id = 1").first().observed
    # Started again, the run goes on after what it has done, and knows what it has learnt.
    write_file(source, 2, [dns_record("Mar 04 09:19:00", f"query[A] {ENCODED[0]} from {ASKING}", owner)
                           for owner in ("client01", "client02")])
    run()
    assert alerts() == [(1, ASKING, 4), (2, ASKING, 1)]
    known = {tuple(r) for r in read_indicator_table(spark, f"{out}/indicators").collect()}
    assert known == {("client01", ASKING), ("client02", ASKING)}


FREQUENCY_RULES = [
    Rule(11, 5, frequency=3, timeframe=40, counted_rule=1, same_source=True),
    Rule(12, 5, frequency=6, timeframe=25, counted_rule=1),
]
HIT = "owner string, srcip string, epoch_timestamp bigint, rule_id int"


def write_hits(folder, parts):
    """One file a part, younger from part to part; numbers go on from the files there are."""
    folder.mkdir(exist_ok=True)
    for rows in parts:
        number = len(list(folder.iterdir()))
        path = folder / f"{number}.csv"
        path.write_text("".join(",".join(map(str, r)) + "\n" for r in rows))
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def hit_parts(n=5):
    """Each part reaches up to seventy seconds back into those before, and so into closed seconds."""
    rng = np.random.default_rng(5)
    reach = [0, 10, 10, 70, 70]
    return [
        [("a", "s" if rng.random() < 0.6 else "t", int(1000 + part * 60 + rng.integers(-reach[part % 5], 60)), int(rng.integers(1, 3))) for _ in range(80)]
        for part in range(n)
    ]


def split_hits(parts, lateness):
    """Hits that come before their second is closed, and how many of rule 1 come later."""
    kept, late, marks = [], 0, []
    for k, rows in enumerate(parts):
        # What is late is told by the watermark of the batch before, which comes from the batches before that.
        mark = marks[k - 2] if k >= 2 else -1
        kept += [r for r in rows if r[2] > mark]
        late += sum(r[3] == 1 for r in rows if r[2] <= mark)
        marks.append(max([r[2] for r in rows] + [m + lateness for m in marks[-1:]]) - lateness)
    return kept, late, marks[-1]


def run_hits(spark, source, out, checkpoint, lateness, name="hits"):
    stream = spark.readStream.schema(HIT).option("maxFilesPerTrigger", "1").csv(str(source))
    with BatchMetrics(spark, f"{out}/progress", name):
        run_frequency(stream, FREQUENCY_RULES, out, checkpoint, lateness, name=name).awaitTermination()


def tuples(df):
    return sorted(tuple(r) for r in df.select("owner", "srcip", "rule_id", "epoch_timestamp", "hits").collect())


@pytest.mark.parametrize("lateness", [80, 5])
def test_frequency_over_micro_batches_equals_batch(spark, tmp_path, lateness):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    parts = hit_parts()
    write_hits(tmp_path / "hits", parts)
    run_hits(spark, tmp_path / "hits", out, checkpoint, lateness)
    kept, late, mark = split_hits(parts, lateness)
    whole = tuples(frequency_alerts(spark.createDataFrame(kept, HIT), FREQUENCY_RULES))
    assert {r[2] for r in whole} == {11, 12} and len(whole) > 50
    closed = tuples(closed_alerts(spark, out))
    assert closed == [r for r in whole if r[3] <= mark] and len(closed) > 30
    flush(spark, FREQUENCY_RULES, out, checkpoint)
    assert tuples(read_alerts(spark, out)) == whole
    counts = {r.rule_id: (r.hits, r.late) for r in late_hits(spark, f"{out}/progress", out, checkpoint).collect()}
    given = sum(r[3] == 1 for rows in parts for r in rows)
    assert counts == {11: (given, late), 12: (given, late)} and (late > 0) == (lateness == 5)
    # What one batch hands to the next is no longer than a timeframe.
    carried = read_batches(spark, f"{out}/carried", "epoch_timestamp bigint, batch bigint")
    spans = carried.groupBy("batch").agg((F.max("epoch_timestamp") - F.min("epoch_timestamp")).alias("span")).collect()
    assert 0 < len(spans) <= 2 and all(r.span <= 40 for r in spans)


def test_a_flushed_stream_goes_on(spark, tmp_path):
    """Alerts of a flush give way to those of the stream once it closes their seconds."""
    out, checkpoint, parts = str(tmp_path / "out"), str(tmp_path / "checkpoint"), hit_parts(4)
    write_hits(tmp_path / "hits", parts[:2])
    run_hits(spark, tmp_path / "hits", out, checkpoint, 80, "first")
    flush(spark, FREQUENCY_RULES, out, checkpoint)
    assert tuples(read_alerts(spark, out)) == tuples(frequency_alerts(spark.createDataFrame(sum(parts[:2], []), HIT), FREQUENCY_RULES))
    write_hits(tmp_path / "hits", parts[2:])
    run_hits(spark, tmp_path / "hits", out, checkpoint, 80, "second")
    flush(spark, FREQUENCY_RULES, out, checkpoint)
    assert tuples(read_alerts(spark, out)) == tuples(frequency_alerts(spark.createDataFrame(sum(parts, []), HIT), FREQUENCY_RULES))


def test_a_frequency_batch_run_again_replaces_itself(spark, tmp_path):
    schema = "owner string, srcip string, rule_id int, epoch_timestamp bigint, hits bigint"
    batches = [[("a", "s", 11, t, 1) for t in range(k * 10, k * 10 + 10)] for k in range(3)]
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    for k, rows in enumerate(batches):
        closed = spark.createDataFrame(rows, schema)
        frequency_step(closed, k, FREQUENCY_RULES, once)
        for _ in range(2):
            frequency_step(closed, k, FREQUENCY_RULES, twice)
    assert tuples(closed_alerts(spark, once)) == tuples(closed_alerts(spark, twice)) and not closed_alerts(spark, once).isEmpty()


def test_batch_metrics(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k, records in enumerate((DNS, DNS[:4] + ERRORS, ACCESS)):
        write_file(source, k, records)
    calls = []
    with BatchMetrics(spark, f"{out}/progress", "counted"):
        lines = stream_lines(spark, "text", path=str(source), maxFilesPerTrigger="1")
        run_stream(
            lines, out, many_capitals, None, 2023, str(tmp_path / "c"), trigger=None, name="counted", after_batch=calls.append
        ).awaitTermination()
    assert calls == [0, 1, 2]
    seen = {(r.batch_id, r.metric): r.rows for r in observed_counts(spark, f"{out}/progress", "lines").collect()}
    assert [seen[k, "rows"] for k in range(3)] == [13, 9, 2]
    steps = observed_counts(spark, f"{out}/progress", "step_ms").filter("metric = 'addBatch'")
    assert steps.filter("rows > 0").count() == 3
    phases = {(r.batch_id, r.phase): r.rows for r in read_batches(spark, f"{out}/phases", "phase string, rows bigint").collect()}
    assert phases[1, "errors"] == 5 and phases[2, "access"] == 2 and phases[2, "alerts"] == 0
    # Another query's reports are none of its business, and it has left.
    spark.readStream.schema(HIT).csv(str(source)).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "d")).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert observed_counts(spark, f"{out}/progress").select("batch_id").distinct().count() >= 3


def test_a_failed_batch_is_run_again(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in range(3):
        write_file(source, k, DNS)
    seen = []

    def fail_once(batch_id):
        seen.append(batch_id)
        if seen == [0, 1]:
            raise RuntimeError("broken off")

    def run():
        lines = stream_lines(spark, "text", path=str(source), maxFilesPerTrigger="1")
        run_stream(lines, out, many_capitals, None, 2023, str(tmp_path / "c"), None, snapshot_every=2, after_batch=fail_once).awaitTermination()

    with pytest.raises(StreamingQueryException, match="broken off"):
        run()
    run()
    assert seen == [0, 1, 1, 2]
    alerts = read_batches(spark, f"{out}/alerts", "owner string, value2 string, detection string, count bigint")
    assert sorted((r.batch_id, r["count"]) for r in alerts.collect()) == [(1, 3), (2, 3)]
    assert (tmp_path / "out" / "indicators-snapshots" / "batch_id=2").exists()


def test_cross_fit_scores_every_row_once(features):
    rows = features.sparkSession.range(60).select(
        F.col("id").alias("key"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y")
    ).withColumn("label", (F.col("x") > 3).cast("int"))
    scored = cross_fit(rows, ["key"], ["x", "y"], folds=4, trees=10)
    assert scored.columns == [*rows.columns, "prediction"]
    assert sorted(r.key for r in scored.collect()) == list(range(60)) and scored.filter("label != prediction").isEmpty()
    with pytest.raises(ValueError, match="another fold"):
        cross_fit(rows, ["key"], ["x"], folds=1)


def test_cross_fit_does_not_see_the_row(features):
    """Rows whose label is a matter of their key alone can't be told by forests that never saw them."""
    rows = features.sparkSession.range(400).select(F.col("id").alias("key"), F.col("id").cast("double").alias("x"))
    rows = rows.withColumn("label", F.pmod(F.hash("key"), F.lit(2)).cast("int"))
    right = cross_fit(rows, ["key"], ["x"], folds=2, depth=10).filter("label = prediction").count()
    assert 120 < right < 280


def test_indicator_appends_add_what_is_new(spark, tmp_path):
    first = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), (None, "9")], INDICATOR)
    second = spark.createDataFrame([("a", "2"), ("a", "3"), ("b", "1")], INDICATOR)
    want = [("a", "1"), ("a", "2"), ("a", "3"), ("b", "1")]
    for table in (first, second, second):
        write_indicator_csv(table, str(tmp_path / "csv"))
        append_indicators(table, "appended", str(tmp_path / "table"))
    assert sorted(map(tuple, spark.read.table("appended").collect())) == want
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "table")).collect())) == want
    lines = spark.read.text(str(tmp_path / "csv"))
    assert sorted((r.owner, r.value) for r in lines.collect()) == want
    spark.sql("DROP TABLE appended")


def test_path_exists(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "file.txt").write_text("x")
    assert path_exists(spark, str(tmp_path / "empty")) and path_exists(spark, str(tmp_path / "file.txt"))
    assert not path_exists(spark, str(tmp_path / "none"))


def test_timed():
    durations = {}
    for _ in range(2):
        with timed(durations, "phase"):
            pass
    assert durations["phase"] >= 0
