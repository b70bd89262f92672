import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.functions import (
    capital_count, char_count, day_of_week, entropy, error_log_epoch, has_file_extension, ip_class,
    is_readable, strip, syslog_epoch,
)
from logweir.functions.text import FILE_EXTENSIONS

# Surrogates cannot cross into the JVM.
TEXT = st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=40)
PROPERTY = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def plain_entropy(s):
    return sum(-n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


OCTET = st.integers(0, 255).map(str)
TAIL = st.lists(OCTET, max_size=3)


def dotted(*parts):
    return st.tuples(*parts).map(lambda found: ".".join(x for p in found for x in ([p] if isinstance(p, str) else p)))


# Addresses by what they were made as: 0 for a private range, 1 for others, 2 for what is no address.
CLASSED = st.one_of(
    dotted(st.just("10"), TAIL).map(lambda s: (s, 0)),
    dotted(st.just("172"), st.integers(16, 31).map(str), TAIL).map(lambda s: (s, 0)),
    dotted(st.just("192"), st.just("168"), TAIL).map(lambda s: (s, 0)),
    dotted(OCTET.filter(lambda x: x not in ("10", "172", "192")), TAIL).map(lambda s: (s, 1)),
    dotted(st.just("172"), st.one_of(st.integers(0, 15), st.integers(32, 255)).map(str), TAIL).map(lambda s: (s, 1)),
    dotted(st.just("192"), OCTET.filter(lambda x: x != "168"), TAIL).map(lambda s: (s, 1)),
    st.sampled_from(["172", "192", "", ".", "10.", ".10", "10..1", "a", "10.a", "8.8.8.8x", "1-2"]).map(lambda s: (s, 2)),
    st.sampled_from([("+10.1", 0), (" 10.1", 0), ("-10.1", 1), ("10. 1", 0)]),
)


@PROPERTY
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_counts_equal_plain_python(spark, texts):
    for char in ".-/*":
        assert column(spark, texts, char_count("s", char)) == [t.count(char) for t in texts]
    any_extension = [int(any(e in t.lower() for e in FILE_EXTENSIONS)) for t in texts]
    assert column(spark, texts, has_file_extension("s")) == any_extension
    for got, text in zip(column(spark, texts, entropy("s")), texts, strict=True):
        assert got == pytest.approx(plain_entropy(text), abs=1e-9)


@PROPERTY
@given(st.lists(st.text("aBZÉéßⅣⒶ中1. ", max_size=30), min_size=1, max_size=30))
def test_capitals_equal_plain_python(spark, texts):
    assert column(spark, texts, capital_count("s")) == [sum(c.isupper() for c in t) for t in texts]


@PROPERTY
@given(st.lists(CLASSED, min_size=1, max_size=60))
def test_ip_class_of_known_ranges(spark, cases):
    assert column(spark, [text for text, _ in cases], ip_class("s")) == [kind for _, kind in cases]


def test_ip_class_edges(spark):
    expected = {
        "10": 0, "172": 2, "192": 2, "5": 1, "172.15.0.1": 1, "172.31.0.1": 0, "300.1": 1, "NXDOMAIN": 2, "": 2,
        "010.1": 0, "192.168": 0, "192.169": 1, " 10.1 ": 0, "-10.1": 1, "1_0": 2, "10.": 2, "100.1": 1, "172.160": 1,
    }
    assert column(spark, expected, ip_class("s")) == list(expected.values())
    assert column(spark, [None], ip_class("s")) == [2]


def test_readable_edges(spark):
    texts = ["", "abcdefgh", "aaaa", "aabbccddeeffgghh", "aaabbbcccdddeeefffggghhh", None]
    assert column(spark, texts, is_readable(entropy("s"))) == [1, 0, 1, 0, 0, None]


def test_extension_modes(spark):
    texts = ["a.pdf", "pdf.a", "x.tar.gz", "ww.zz", "A.EXE", "docs.mirror.example.net"]
    assert column(spark, texts, has_file_extension("s", "suffix")) == [1, 0, 1, 0, 1, 0]
    assert column(spark, texts, has_file_extension("s")) == [1, 1, 1, 0, 1, 1]
    with pytest.raises(ValueError):
        has_file_extension("s", "prefix")


def test_null_stays_null(spark):
    for expression in (char_count("s", "."), capital_count("s"), has_file_extension("s"), entropy("s")):
        assert column(spark, [None], expression) == [None]


def test_strip(spark):
    texts = ["  a b \t\n", " x\xa0", "", "\x1cq\x85"]
    assert column(spark, texts, strip("s")) == [t.strip() for t in texts]


def test_times(spark):
    texts = ["Jan 21 00:01:44", "Jan  1 00:01:44", "Feb 29 00:00:00", "nonsense", None]
    assert column(spark, texts, syslog_epoch("s", 2022)) == [1642723304, 1640995304, None, None, None]
    assert column(spark, ["Feb 29 00:00:00"], syslog_epoch("s", 2024)) == [1709164800]
    assert column(spark, ["Jan 18 10:07:23.284717 2022"], error_log_epoch("s")) == [1642500443]
    days = spark.createDataFrame([(1642723304,)], "e bigint").select(day_of_week("e").alias("d")).first().d
    assert days == 6


def test_entropy_of_long_text(spark):
    text = "The quick brown fox jumps over the lazy dog. " * 3000 + "é中" * 50
    rows = spark.createDataFrame([(text,)], "s string")
    assert rows.select(F.round(entropy("s"), 9).alias("x")).first().x == pytest.approx(plain_entropy(text), abs=1e-8)


def test_entropy_of_any_alphabet(spark):
    """Texts of few characters often and of many once, with line ends, marks of patterns and characters of two units."""
    many = "".join(chr(0x4E00 + k % 20_000) for k in range(40_000)) + "".join(chr(0x1F300 + k) for k in range(500))
    texts = [many, "\n\n\r.\\$^*a\n", "😀" * 7 + "a", "ab" * 50_000, "x", " ", "e\u0301" * 9]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(F.round(entropy("s"), 9).alias("x")).collect()
    assert [r.x for r in got] == [pytest.approx(plain_entropy(t), abs=1e-8) for t in texts]
