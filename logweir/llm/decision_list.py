"""Learned decision lists: ordered rules that reject documents, grown and pruned by sequential covering.

A rule is a conjunction of thresholds on features, such as ``symbol_share > 0.2 and mean_chars <= 3``. Everything
that touches rows is a Spark aggregation: a growth step counts, for all features and thresholds at once, the good
and bad labelled rows that the rules so far leave over; the driver sees only those counts. The finished list is one
conditional expression.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import SPACES, word_list
from logweir.workspace import settle

SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ("mean_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share")


# --- features -------------------------------------------------------------------------------------------------


def _windows(words: Column) -> Column:
    """A hash of each run of five words."""
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    window = lambda i: F.xxhash64(*(F.get(words, i - 1 + k) for k in range(WINDOW)))
    return F.when(F.size(words) >= WINDOW, F.transform(starts, window)).otherwise(F.array().cast("array<long>"))


def _sorted_windows(windows: Column) -> Column:
    """Windows with their places, equal ones side by side; empty where none repeats, as in most texts."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(none)


def _repeat_starts(placed: Column) -> Column:
    """Places of the windows found twice or more, ascending."""
    near = lambda p, i: (p["h"] == F.get(placed, i - 1)["h"]) | (p["h"] == F.get(placed, i + 1)["h"])
    return F.sort_array(F.transform(F.filter(placed, near), lambda p: p["i"]))


def _covered(starts: Column) -> Column:
    """Words in windows that begin at ``starts``, each counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
    )
    return F.aggregate(starts, zero, step, lambda a: a["n"])


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id as ``doc_id`` and counts of the whole text; null counts as empty.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word, equal to
    an earlier line), ``n_repeat_words`` (words in five-word windows found twice or more in the text), and for the
    learnt rules ``n_upper`` (upper-case letters).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Each step is a column of its own, as an expression within a lambda would be computed for every element.
    rows = rows.withColumn("words", word_list(F.col("text"))).withColumn("windows", _windows(F.col("words")))
    rows = rows.withColumn("placed", _sorted_windows(F.col("windows")))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(_blanks(x))) > 0))
    only = lambda pattern: F.char_length(F.regexp_replace("text", pattern, "")).cast("long")
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        only(f"[{SPACES}]+").alias("word_chars"),
        only(f"[^{_escaped(SYMBOLS)}]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(_repeat_starts(F.col("placed"))).alias("n_repeat_words"),
        only(r"\P{Lu}+").alias("n_upper"),
    )


def _blanks(line: Column) -> Column:
    return F.translate(line, "\t\n\x0b\x0c\r", "     ")


def _escaped(characters: str) -> str:
    return "".join("\\" + c for c in characters)


def text_features(counts: DataFrame) -> DataFrame:
    """``counts`` with the shares that rules are made of; 0 where the text has no words."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counts.withColumns(
        {
            "mean_chars": per("word_chars", "n_words"),
            "symbol_share": per("n_symbols", "word_chars"),
            "dup_line_share": per("n_dup_lines", "n_words"),
            "repeat_share": per("n_repeat_words", "n_words"),
            "upper_share": per("n_upper", "word_chars"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


# --- learning -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.coalesce(F.col(self.feature), F.lit(0.0))
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass
class Rule:
    conditions: list[Condition] = field(default_factory=list)

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, (c.column() for c in self.conditions), F.lit(True))

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _conditions(features: dict[str, list[float]]) -> list[Condition]:
    return [Condition(f, above, t) for f, ts in features.items() for t in ts for above in (True, False)]


def _statistics(rows: DataFrame, features: dict[str, list[float]]) -> dict[Condition, dict[str, tuple[int, int]]]:
    """For each condition, good and bad rows that meet it in the growing part.

    Each row gives one (feature, bin) pair for each feature; bins are counted in the map tasks and the driver adds
    them up from either end.
    """
    bin_of = lambda f, ts: reduce(lambda a, t: a + (F.col(f) > F.lit(t)).cast("int"), ts, F.lit(0))
    cells = F.array(*(F.struct(F.lit(f).alias("f"), bin_of(f, ts).alias("b")) for f, ts in features.items()))
    counted = rows.select("bad", F.explode(cells).alias("cell")).groupBy("cell.f", "cell.b")
    found = counted.agg(F.sum(1 - F.col("bad")).alias("good"), F.sum("bad").alias("bad")).collect()
    by = {(r.f, r.b): (r.good, r.bad) for r in found}
    out = {}
    for f, ts in features.items():
        cells_of = [by.get((f, b), (0, 0)) for b in range(len(ts) + 1)]
        for k, t in enumerate(ts):
            for above, part in ((True, cells_of[k + 1 :]), (False, cells_of[: k + 1])):
                out[Condition(f, above, t)] = (sum(x[0] for x in part), sum(x[1] for x in part))
    return out


def _gain(good: int, bad: int, before: float) -> float:
    """Information gain of a growth step, in bits for each bad row that stays covered."""
    from math import log2

    return bad * (log2(bad / (good + bad)) - before) if bad else 0.0


def _prefix_counts(rows: DataFrame, rule: Rule) -> list[tuple[int, int]]:
    """Good and bad rows met by each prefix of the rule, in one aggregation."""
    sums = []
    for n in range(1, len(rule.conditions) + 1):
        met = Rule(rule.conditions[:n]).column().cast("int")
        sums += [F.sum(met * (1 - F.col("bad"))).alias(f"good{n}"), F.sum(met * F.col("bad")).alias(f"bad{n}")]
    r = rows.agg(*sums).first()
    return [(r[f"good{n}"] or 0, r[f"bad{n}"] or 0) for n in range(1, len(rule.conditions) + 1)]


def learn_list(
    labelled: DataFrame,
    features: tuple[str, ...] = FEATURES,
    thresholds: int = 24,
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.8,
    min_support: int = 5,
) -> list[Rule]:
    """Rules for rows whose ``bad`` is 1, best first; ``labelled`` has ``row_key``, ``bad`` and the features.

    Thresholds are quantiles of each feature over bad and over good rows. Two thirds of the rows, by a hash of the
    key, grow a rule, the others prune it: the prefix with the best balance of bad over good rows there stays. The
    list ends at a rule that meets fewer than ``min_support`` bad rows or whose share of bad ones is below
    ``min_precision``. Rows with a null label take no part. Without bad or without good rows the list is empty.
    """
    ready = labelled.filter("bad is not null").select(
        F.col("bad").cast("int").alias("bad"),
        (F.pmod(F.xxhash64("row_key"), F.lit(3)) == 2).alias("prune"),
        *(F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features),
    )
    rows = settle(ready)
    cuts = [k / (thresholds + 1) for k in range(1, thresholds + 1)]
    quantiles = rows.groupBy("bad").agg(*(F.percentile_approx(f, cuts, 10_000).alias(f) for f in features)).collect()
    if len(quantiles) < 2:
        return []
    grid = {f: sorted({float(x) for q in quantiles for x in q[f]}) for f in features}
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.filter(~F.coalesce(matched(rules), F.lit(False))) if rules else rows
        rule = _grow(left.filter("not prune"), grid, max_conditions)
        if not rule.conditions:
            break
        pruned = _prefix_counts(left.filter("prune"), rule)
        worth = [(bad - good) / (bad + good) if bad + good else -1.0 for good, bad in pruned]
        keep = max(range(len(worth)), key=lambda n: (worth[n], -n)) + 1
        rule = Rule(rule.conditions[:keep])
        good, bad = _prefix_counts(left, rule)[-1]
        if bad < min_support or bad < min_precision * (good + bad):
            break
        rules.append(rule)
    return rules


def _grow(rows: DataFrame, grid: dict[str, list[float]], max_conditions: int) -> Rule:
    from math import log2

    rule, total = Rule(), rows.agg(F.sum(1 - F.col("bad")), F.sum("bad")).first()
    good, bad = total[0] or 0, total[1] or 0
    while bad and good and len(rule.conditions) < max_conditions:
        before = log2(bad / (good + bad))
        counted = _statistics(rows, grid)
        best = max(counted, key=lambda c: (_gain(*counted[c], before), str(c)))
        if _gain(*counted[best], before) <= 1e-9:
            break
        rule.conditions.append(best)
        rows, (good, bad) = rows.filter(best.column()), counted[best]
    return rule


def matched(rules: list[Rule]) -> Column:
    """True where some rule rejects the row."""
    return rule_number(rules).isNotNull()


def rule_number(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression: number of the first rule that holds, else null."""
    numbered = F.lit(None).cast("int")
    for n, rule in reversed(list(enumerate(rules, 1))):
        numbered = F.when(rule.column(), F.lit(n)).otherwise(numbered)
    return numbered


# --- the whole operator ---------------------------------------------------------------------------------------


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``rule`` and ``kept``.

    ``labels`` has the id and ``quality`` (0: bad); labels of ids that ``docs`` lacks are ignored, and so are null
    ones. A document that the base rules fail is not kept; of the others those are kept that no learnt rule meets
    (all, if nothing can be learnt). Texts that are null or blank have no words and fail. Repeated rows get equal
    verdicts, an empty table gives no rows, and other columns of either table are ignored.
    """
    counts = settle(text_counts(docs, id_col, text_col))
    known = labels.filter("quality is not null").groupBy(F.col(id_col).alias("doc_id"))
    known = known.agg(F.min((F.col("quality") == 0).cast("int")).alias("bad"))
    featured = text_features(counts).withColumn("base_failed", base_failed())
    labelled = featured.filter("not base_failed").join(known, "doc_id").withColumn("row_key", F.col("doc_id"))
    rules = learn_list(labelled, **options)
    rule = rule_number(rules) if rules else F.lit(None).cast("int")
    return featured.withColumn("rule", F.when(~F.col("base_failed"), rule)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )
