"""Operators against plain Python on skewed rows, with broadcasts refused and many ranges."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logweir.operators import features as feature_operators
from logweir.operators import skew
from logweir.operators.indicators import match_indicators
from logweir.operators.ordered import number_rows, running_value_count, time_gap, zip_by_order
from logweir.operators.ruleset import Rule
from logweir.operators.ruletree import frequency_alerts
from logweir.operators.skew import fits_broadcast, hot_keys, lookup_join


def skewed_rows(n=600, seed=1):
    """Half of the rows belong to one owner and one name."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 2 == 0
        owner = "a" if hot else rng.choice(["a", "b", "c", None])
        name = "hot" if hot else rng.choice([f"n{j}" for j in range(40)] + [None])
        rows.append((i, owner, name, rng.randrange(100) if i % 50 else None))
    return rows


@pytest.fixture(scope="module")
def rows():
    return skewed_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, owner string, value1 string, epoch_timestamp bigint").repartition(3).cache()


def test_fits_broadcast(frame):
    assert fits_broadcast(frame) and not fits_broadcast(frame, max_rows=599)
    assert not fits_broadcast(frame, max_bytes=100)


def test_hot_keys_are_few(frame):
    counts = frame.groupBy("value1").agg(F.count("*").alias("n"))
    # 600 rows, half of them of one name: a piece has 75 rows for two tasks, 15 for ten.
    assert [tuple(r) for r in hot_keys(counts, ["value1"], "n", 2).collect()] == [("hot", 4)]
    assert dict(map(tuple, hot_keys(counts, ["value1"], "n", 10).collect()))["hot"] == 20
    assert hot_keys(counts.limit(0), ["value1"], "n").count() == 0


def test_no_key_fills_a_task(spark):
    """One key has a third of the rows, another a hundredth: at any number of tasks a salt has a piece at most."""
    counts = spark.createDataFrame([("a", 333_000), ("b", 10_000)] + [(f"k{i}", 657) for i in range(1000)], "k string, n long")
    for tasks in (10, 200, 1000):
        piece = 1_000_000 / (4 * tasks)
        hot = {r.k: r._salts for r in hot_keys(counts, ["k"], "n", tasks).collect()}
        assert all(r.n <= piece * hot.get(r.k, 1) for r in counts.collect()) and len(hot) <= 4 * tasks


def test_source_is_computed_once(spark):
    """With broadcasts refused, however often the plans mention it."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(100).select("id", F.lit("a").alias("owner"), (F.col("id") % 5).cast("string").alias("value1"),
                                   counted((F.col("id") % 7).cast("string")).alias("value2"))
    table = spark.createDataFrame([("a", "3")], "owner string, value2 string")
    matches = match_indicators(rows, table, ["id"], max_rows=0)
    assert matches.alerts.collect() and matches.remainder.count() == 0
    assert seen.value == 100


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_refused_broadcast_gives_the_same_join(spark, frame, how):
    lookup = spark.createDataFrame([("a", "hot", 1), ("a", "n3", 2), ("b", "n3", 3)], "owner string, value1 string, x int")
    if how in ("left_semi", "left_anti"):
        lookup = lookup.drop("x")
    keys = ["owner", "value1"]
    small = lookup_join(frame, lookup, keys, how, ["id"])
    large = lookup_join(frame, lookup, keys, how, ["id"], max_rows=0)
    assert "_salt" in large._jdf.queryExecution().toString()
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.select(*small.columns).collect()))


def test_hot_rows_spread_over_partitions(spark):
    big = spark.range(20_000).select("id", F.lit("k").alias("key"))
    lookup = spark.createDataFrame([("k", 1)], "key string, x int")
    joined = lookup_join(big, lookup, ["key"], "left", ["id"], max_rows=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and max(sizes) < 10_000


def test_number_rows(frame, rows, many_ranges):
    numbered = number_rows(frame, ["value1", "id"], "n")
    expected = sorted(rows, key=lambda r: (r[2] is not None, r[2] or "", r[0]))
    got = numbered.orderBy("n").collect()
    assert [r.id for r in got] == [r[0] for r in expected]
    assert [r.n for r in got] == list(range(1, len(rows) + 1))


def test_zip_by_order(spark, frame, rows, many_ranges):
    left = frame.select(F.col("id").alias("l"))
    right = frame.select((-F.col("id")).alias("r"))
    pairs = {(r.l, r.r) for r in zip_by_order(left, right, ["l"], ["r"]).collect()}
    n = len(rows)
    assert pairs == {(i, -(n - 1 - i)) for i in range(n)}


def test_running_count(frame, rows, many_ranges):
    by_owner = defaultdict(list)
    for _, owner, name, _ in rows:
        if owner is not None and name is not None:
            by_owner[owner].append(name)
    got = {(r.owner, r.value1): (r.n, r.c) for r in running_value_count(frame, ["owner"], "value1", "c").collect()}
    expected = {
        (o, v): (names.count(v), sum(x <= v for x in names)) for o, names in by_owner.items() for v in set(names)
    }
    assert got == expected


@pytest.mark.parametrize("max_rows", [skew.BROADCAST_ROWS, 0])
def test_value_count_per_row(frame, rows, max_rows, monkeypatch):
    join = skew.lookup_join
    monkeypatch.setattr(feature_operators, "lookup_join", lambda *a: join(*a, max_rows=max_rows))
    got = {r.id: r.c for r in feature_operators.with_value_counts(frame, "owner", {"value1": "c"}, "id").collect()}
    for i, owner, name, _ in rows:
        peers = [r for r in rows if r[1] == owner and r[2] is not None]
        known = owner is not None and name is not None
        assert got[i] == (sum(r[2] <= name for r in peers) if known else 0)


@pytest.mark.parametrize("max_rows", [skew.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("stretch", [1, 7919])
def test_time_gap(spark, rows, max_rows, stretch):
    # Stretched, the epochs lie days apart.
    stretched = [(i, o, None if e is None else e * stretch) for i, o, _, e in rows]
    frame = spark.createDataFrame(stretched, "id int, owner string, e bigint")
    got = {r.id: int(r.gap) for r in time_gap(frame, "owner", "e", "id", "gap", max_rows).collect()}
    assert len(got) == len(rows)
    expected = {i: 0 for i, *_ in rows}
    for owner in "abc":
        mine = sorted((e, i) for i, o, e in stretched if o == owner and e is not None)
        for (before, _), (e, i) in zip(mine, mine[1:]):
            expected[i] = e - before
    assert got == expected


@pytest.mark.parametrize("max_rows", [skew.BROADCAST_ROWS, 0])
def test_indicators_on_a_hot_name(spark, frame, rows, max_rows):
    named = frame.withColumn("value2", F.concat(F.lit("ip"), (F.col("id") % 97).cast("string")))
    table = spark.createDataFrame([("a", "ip4"), ("b", "ip5")], "owner string, value2 string")
    alerts, remainder = match_indicators(
        named, table, ["id"], keep_first_n=3, order=["epoch_timestamp", "id"], max_rows=max_rows
    )
    hit = {r[0] for r in rows if (r[1], r[0] % 97) in {("a", 4), ("b", 5)}}
    assert sum(r["count"] for r in alerts.collect()) == len(hit)
    bad = {(r[1], r[2]) for r in rows if r[0] in hit and r[2] is not None}
    first = set()
    for owner, name in bad:
        mine = sorted((r[3] is not None, r[3] or 0, r[0]) for r in rows if r[1] == owner and r[2] == name)
        first |= {m[2] for m in mine[:3]}
    expected = {r[0] for r in rows if r[0] not in hit and ((r[1], r[2]) not in bad or r[0] in first)}
    assert Counter(r.id for r in remainder.collect()) == Counter(expected)


def test_frequency_rules(spark):
    rng = random.Random(3)
    hits = []
    for _ in range(900):
        source = "s" if rng.random() < 0.5 else rng.choice(["t", "u", None])
        hits.append((rng.choice(["a", "b"]), source, rng.choice([None, *range(1000, 1400)]), rng.choice([1, 2])))
    rules = [
        Rule(11, 5, frequency=4, timeframe=20, counted_rule=1, same_source=True),
        Rule(12, 5, frequency=30, timeframe=33, counted_rule=2),
        Rule(13, 5, frequency=1, timeframe=7, counted_rule=2, same_source=True),
    ]
    frame = spark.createDataFrame(hits, "owner string, srcip string, epoch_timestamp bigint, rule_id int")
    got = {tuple(r) for r in frequency_alerts(frame, rules).collect()}
    expected = set()
    for rule in rules:
        seen = defaultdict(list)
        for owner, source, epoch, counted in hits:
            if counted == rule.counted_rule and epoch is not None:
                seen[owner, source if rule.same_source else ""].append(epoch)
        for (owner, source), epochs in seen.items():
            for e in set(epochs):
                n = sum(e - rule.timeframe <= x <= e for x in epochs)
                if n >= rule.frequency:
                    expected.add((owner, source, rule.rule_id, e, n))
    assert got == expected and len(got) > 100
