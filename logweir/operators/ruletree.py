"""Evaluation of a rule tree over web-error records.

The rule set has no engine of its own here, so these are our definitions. A rule holds for a record when
its own condition holds and, if it names parents, one of them holds. Patterns are tried on the message and
on the severity head ``[level] ``, which follows a blank in records of the ``module:severity`` form. Rules
of level 0, and those marked as not alerting, only serve their children. A frequency rule fires when the
hits of the rule it counts, within the last ``timeframe`` seconds, reach ``frequency``.
"""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweir.operators.idrules import CODE
from logweir.operators.ruleset import Rule

# The decoder names of rules and the log formats they stand for.
DECODERS = {"apache-errorlog": "apache_error"}

_JAVA_SPECIAL = re.compile(r"[\\^$.|?*+()\[\]{}]")


def _quote(text: str) -> str:
    return _JAVA_SPECIAL.sub(lambda m: "\\" + m.group(), text)


def match_condition(text: Column, match: str) -> Column:
    """Whether ``text`` holds one of the alternatives of a ``match``: literal text, anchored at its ends or not."""

    def piece(pattern: str) -> Column:
        at_start, at_end = pattern.startswith("^"), pattern.endswith("$")
        literal = pattern[at_start : len(pattern) - at_end]
        if at_start and at_end:
            return text == literal
        if at_start:
            return text.startswith(literal)
        return text.endswith(literal) if at_end else text.contains(literal)

    pieces = [piece(p) for p in match.split("|") if p]
    if not pieces:
        raise ValueError(f"the match {match!r} has no alternative")
    return reduce(lambda a, b: a | b, pieces)


def regex_pattern(regex: str) -> str:
    """A ``regex`` as a Java pattern: ``\\.`` is any character, a bracket or a bare dot is literal."""
    classes = {".": ".", "w": "[A-Za-z0-9@_-]", "d": "[0-9]", "s": "[ ]", "t": r"\t",
               "p": r"[()*+,\-.:;<=>?\[\]!\"'#$%&|{}]",
               "W": "[^A-Za-z0-9@_-]", "D": "[^0-9]", "S": "[^ ]"}
    out, i = [], 0
    while i < len(regex):
        char = regex[i]
        if char == "\\" and i + 1 < len(regex):
            following = regex[i + 1]
            out.append(classes.get(following, _quote(following)))
            i += 2
            # Only a class can repeat.
            if following in classes and i < len(regex) and regex[i] in "+*":
                out.append(regex[i])
                i += 1
        else:
            out.append(char if char in "^$|()" else _quote(char))
            i += 1
    return "".join(out)


def _own_condition(rule: Rule) -> Column:
    tests = []
    if rule.decoded_as:
        tests.append(F.col("log_format") == DECODERS.get(rule.decoded_as, rule.decoded_as))
    for text_test in filter(None, [
        rule.match and (lambda text: match_condition(text, rule.match)),
        rule.regex and (lambda text: text.rlike(regex_pattern(rule.regex))),
    ]):
        tests.append(text_test(F.col("message")) | text_test(F.col("_head")))
    if rule.codes:
        tests.append(F.col("_code").isin(rule.codes))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def check_rules(rules: list[Rule]) -> None:
    """Refuse rule sets that can't be evaluated: parents in a circle, and rules that build on a frequency rule."""
    frequency = {r.rule_id for r in rules if r.counted_rule is not None}
    parents = {r.rule_id: r.parents or [] for r in rules}
    for rule in rules:
        bad = frequency & {*parents[rule.rule_id], rule.counted_rule}
        if bad:
            raise ValueError(f"rule {rule.rule_id} builds on the frequency rule {min(bad)}, which no record meets")
        above, seen = list(parents[rule.rule_id]), set()
        while above:
            parent = above.pop()
            if parent == rule.rule_id:
                raise ValueError(f"rule {rule.rule_id} is its own ancestor")
            if parent not in seen:
                seen.add(parent)
                above += parents.get(parent, [])


def match_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``matched``, the ids of the rules that hold, to parsed web errors. One projection.

    The tree becomes one nested expression: a record tries a rule only where a parent holds, and a rule
    with one parent is tried once. Frequency rules are left to ``frequency_alerts``.
    """
    check_rules(rules)
    plain = [r for r in rules if r.counted_rule is None]
    none = F.array().cast("array<int>")

    def held(rule: Rule) -> Column:
        children = [r for r in plain if rule.rule_id in (r.parents or [])]
        ids = F.concat(F.array(F.lit(rule.rule_id)), *[held(child) for child in children])
        return F.when(_own_condition(rule), ids).otherwise(none)

    module = F.col("level").contains(":")
    head = F.concat(F.when(module, " [").otherwise("["), F.col("level"), F.lit("] "))
    texts = df.withColumns(
        {"_head": F.coalesce(head, F.lit("")), "_code": F.regexp_extract("entity", CODE, 1)}
    )
    matched = F.concat(none, *[held(rule) for rule in plain if not rule.parents])
    # A rule with several parents may be found under more than one.
    return texts.select(*df.columns, F.sort_array(F.array_distinct(matched)).alias("matched"))


def alerting(rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.level > 0 and not r.noalert]


def rule_hits(matched: DataFrame) -> DataFrame:
    """One row (owner, srcip, epoch_timestamp, rule_id) per record and rule, with any ``event_time``."""
    kept = [c for c in ("owner", "srcip", "epoch_timestamp", "event_time") if c in matched.columns]
    # The outer form, as the plain one makes Spark infer a filter that tries every pattern a second time.
    hits = matched.select(*kept, F.explode_outer("matched").alias("rule_id"))
    return hits.filter(F.col("rule_id").isNotNull())


def rule_alerts(matched: DataFrame, rules: list[Rule], rules_df: DataFrame) -> DataFrame:
    """Alerts (owner, srcip, rule_id, level, description, count) of the alerting rules.

    Counting comes first, so the rule table meets one row per group and not one per record.
    """
    ids = [r.rule_id for r in alerting(rules)]
    counts = (
        rule_hits(matched)
        .filter(F.col("rule_id").isin(ids))
        .groupBy("owner", "srcip", "rule_id")
        .agg(F.count("*").alias("count"))
    )
    return counts.join(rules_df.select("rule_id", "level", "description"), "rule_id").select(
        "owner", "srcip", "rule_id", "level", "description", "count"
    )


def frequency_rules(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The frequency rules (counted, rule_id, frequency, timeframe, same_source), as a table to join with."""
    rows = [
        (r.counted_rule, r.rule_id, r.frequency, r.timeframe, r.same_source)
        for r in rules
        if r.counted_rule is not None
    ]
    columns = "_counted int, rule_id int, _frequency int, _timeframe int, _same_source boolean"
    return spark.createDataFrame(rows, columns)


def counted_hits(hits: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each hit once for each frequency rule that counts it, whose id it gets.

    ``srcip`` is empty for rules that count over all sources.
    """
    looked_for = frequency_rules(hits.sparkSession, rules).select("_counted", F.col("rule_id").alias("_rule"), "_same_source")
    counted = hits.join(F.broadcast(looked_for), hits["rule_id"] == looked_for["_counted"])
    source = F.when(F.col("_same_source"), F.col("srcip")).otherwise("")
    return counted.withColumns({"srcip": source, "rule_id": F.col("_rule")}).select(*hits.columns)


def hits_per_second(hits: DataFrame, rules: list[Rule]) -> DataFrame:
    """Hits (owner, srcip, rule_id, epoch_timestamp, hits) that each frequency rule counts, added up by second.

    The counting begins in the map tasks, so a hot source shrinks to one row a second there.
    """
    counted = counted_hits(hits.filter(F.col("epoch_timestamp").isNotNull()), rules)
    return counted.groupBy("owner", "srcip", "rule_id", "epoch_timestamp").agg(F.count("*").alias("hits"))


def frequency_alerts(hits: DataFrame, rules: list[Rule]) -> DataFrame:
    """Seconds (owner, srcip, rule_id, epoch_timestamp, hits) at which a frequency rule fires. All rules in one pass."""
    return look_back(hits_per_second(hits, rules), rules)


def look_back(per_second: DataFrame, rules: list[Rule]) -> DataFrame:
    """The seconds of ``hits_per_second`` at which the timeframe's hits reach the rule's frequency.

    A second adds its hits when it comes and takes them back once the timeframe is over; their running sum is the
    look-back. It runs in time buckets as long as the timeframe, each second being handed to the next bucket too, so
    a window holds the seconds of two buckets however long the source was active.
    """
    limits = frequency_rules(per_second.sparkSession, rules).select("rule_id", "_frequency", "_timeframe")
    seconds = per_second.join(limits, "rule_id")
    own = F.floor(F.col("epoch_timestamp") / F.col("_timeframe"))
    # In its own bucket no second ends: the timeframe is as long as the bucket.
    change = F.explode(
        F.array(
            F.struct(own.alias("bucket"), F.lit(True).alias("own"), F.lit(True).alias("comes")),
            F.struct((own + 1).alias("bucket"), F.lit(False).alias("own"), F.lit(True).alias("comes")),
            F.struct((own + 1).alias("bucket"), F.lit(False).alias("own"), F.lit(False).alias("comes")),
        )
    )
    comes = F.col("_change.comes")
    changes = seconds.withColumn("_change", change).select(
        "owner",
        "srcip",
        "rule_id",
        "_frequency",
        "epoch_timestamp",
        F.col("_change.bucket").alias("_bucket"),
        F.col("_change.own").alias("_fires_here"),
        F.when(comes, F.col("epoch_timestamp"))
        .otherwise(F.col("epoch_timestamp") + F.col("_timeframe") + 1)
        .alias("_at"),
        F.when(comes, F.col("hits")).otherwise(-F.col("hits")).alias("_hits"),
    )
    # The default frame takes all changes up to and at the same second.
    so_far = Window.partitionBy("owner", "srcip", "rule_id", "_bucket").orderBy("_at")
    return (
        changes.withColumn("hits", F.sum("_hits").over(so_far))
        .filter(F.col("_fires_here") & (F.col("hits") >= F.col("_frequency")))
        .select("owner", "srcip", "rule_id", "epoch_timestamp", "hits")
    )
