import re
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from edge import documents, odd_rows, prose
from pyspark.sql import functions as F

from logweir.llm.decision_list import Condition, Rule, judge_documents, learn_list, matched, rule_number, text_counts
from logweir.llm.exact_dedup import drop_exact_copies, exact_groups

BLANK = re.compile(r"[\x20\x09-\x0D]")


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for content, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), m[3] == keep, sha256(content.encode()).hexdigest()) for m in members]
    return Counter(out)


@pytest.mark.parametrize("digest", [None, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_groups_equal_brute_force(spark, digest):
    rows = odd_rows() + [(100 + k, prose(k % 9, 30) + " " * (k % 3), "en") for k in range(60)]
    options = {"digest": digest} if digest else {}
    got = [tuple(r) for r in exact_groups(documents(spark, rows), salts=3, **options).collect()]
    want = expected_groups(rows)
    if digest:  # most texts share a digest here, and still only equal ones are merged
        assert Counter(g[:4] for g in got) == Counter(w[:4] for w in want.elements())
    else:
        assert Counter(got) == want


def test_hot_group(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = exact_groups(docs).groupBy("group_size", "keep_id").count().filter("group_size > 1").collect()
    assert [tuple(r) for r in got] == [(1000, 0, 1000)]


def test_drop_copies(spark):
    docs = documents(spark, odd_rows())
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.filter("doc_id is not null").collect()) == [3, 4, 5, 8, 9, 10, 11]
    assert left.filter("doc_id is null").count() == 1
    assert drop_exact_copies(documents(spark, [])).count() == 0


def expected_counts(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    rows = odd_rows() + [
        (50, "a b c d e a b c d e f\na b c d e\n\nx\nx\n x\nx", "en"),
        (51, "# * $ % & | < > ! # ##", "en"),
        (52, "a a a a a a a a b", "en"),
        (53, "w\r\nw\r\nw", "en"),
    ]
    got = text_counts(documents(spark, rows)).collect()
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == Counter((i, *expected_counts(t)) for i, t, _ in rows)


def test_learnt_list_separates(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("row_key"),
        (F.col("id") % 10 < 3).cast("int").alias("bad"),
        ((F.col("id") % 10) / 10).alias("x"),
        F.rand(1).alias("noise"),
    )
    rules = learn_list(rows, features=("x", "noise"))
    assert rules and all(c.feature == "x" for r in rules for c in r.conditions)
    assert rows.filter(matched(rules)).filter("bad = 0").count() == 0
    assert rows.filter("bad = 1").filter(~matched(rules)).count() == 0


def test_list_needs_both_classes(spark):
    rows = spark.range(50).select(F.col("id").alias("row_key"), F.lit(1).alias("bad"), F.rand(1).alias("x"))
    assert learn_list(rows, features=("x",)) == []
    assert learn_list(rows.limit(0), features=("x",)) == []


def test_rules_are_ordered(spark):
    rules = [Rule([Condition("x", True, 5.0)]), Rule([Condition("x", True, 2.0)])]
    got = spark.createDataFrame([(6.0,), (3.0,), (1.0,), (None,)], "x double").select(rule_number(rules).alias("n")).collect()
    assert [r.n for r in got] == [1, 2, None, None]


def test_judge(spark):
    junk = [(200 + k, " | ".join(prose(k, 40).split()), "en") for k in range(60)]
    good = [(300 + k, prose(1000 + k, 60), "en") for k in range(120)]
    labels = spark.createDataFrame(
        [(i, 0) for i, _, _ in junk[:50]] + [(i, 1) for i, _, _ in good[:100]] + [(None, 1), (1, None), (9999, 0)],
        "doc_id long, quality int",
    )
    got = judge_documents(documents(spark, odd_rows() + junk + good), labels).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert not kept & {i for i, _, _ in junk} and {i for i, _, _ in good} <= kept
    assert {r.doc_id for r in got if r.base_failed} >= {1, 2, 3, 4}
    assert len(got) == len(odd_rows()) + 180
    assert judge_documents(documents(spark, []), labels).count() == 0
    assert all(r.kept != r.base_failed for r in judge_documents(documents(spark, good), labels.limit(0)).collect())
