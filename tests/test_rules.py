import pytest
from pyspark.sql import functions as F

from logweir.operators.ruleset import DEFAULT_RULES, Rule, as_rules, read_rules, rules_table
from logweir.operators.ruletree import check_rules, match_condition, match_rules, regex_pattern, rule_alerts
from logweir.operators.idrules import with_source

RULES_XML = """
<group name="sample,outer, web,">
  <!-- a comment -->
  <rule id="1" level="0"><decoded_as>apache-errorlog</decoded_as><description>All.</description></rule>
  <rule id="2" level="5">
    <if_sid>1</if_sid>
    <match>^[error] |</match>
    <match type="plain">file (x)</match>
    <description>Head.</description>
    <info type="link">http://example.com</info>
    <mitre><id>T1</id><id>T1.002</id></mitre>
    <group>one,two,</group>
  </rule>
  <rule id="3" level="7" frequency="4" timeframe="60">
    <if_matched_sid>2</if_matched_sid><same_source_ip/><description>Often.</description>
  </rule>
  <rule id="4" level="3" noalert="1">
    <if_sid>1, 2</if_sid><id>A1|A2</id><regex>user \\S+ gone</regex><description>Codes.</description>
  </rule>
</group>
"""


@pytest.fixture(scope="module")
def from_xml(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rules") / "sample.xml"
    path.write_text(RULES_XML)
    return {r.rule_id: r for r in read_rules(spark, str(path)).collect()}


def test_xml_rules(from_xml):
    assert sorted(from_xml) == [1, 2, 3, 4]
    two, three, four = from_xml[2], from_xml[3], from_xml[4]
    assert two.match == "^[error] |file (x)" and two.techniques == ["T1", "T1.002"] and two.tags == ["one", "two"]
    assert two.parents == [1] and two.codes is None and not two.same_source
    assert two.info[0]["_type"] == "link" and two.info[0]["_VALUE"] == "http://example.com"
    assert all(rule.groups == ["sample", "outer", "web"] for rule in from_xml.values())
    assert (three.counted_rule, three.frequency, three.timeframe, three.same_source) == (2, 4, 60, True)
    assert four.codes == ["A1", "A2"] and four.noalert and four.parents == [1, 2] and four.regex == r"user \S+ gone"
    assert from_xml[1].decoded_as == "apache-errorlog" and from_xml[1].match is None


def test_rules_outside_groups_and_in_several_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<rules><rule id="8" level="1"><description>Alone.</description></rule></rules>')
    (tmp_path / "b.xml").write_text(
        '<all><group name="x,y"><rule id="9" level="1"><group>own,</group></rule></group>'
        '<group name="z"><rule id="10" level="1"/><rule id="11" level="2"><group>p,</group><group>q</group></rule></group></all>'
    )
    rows = {r.rule_id: (r.tags, r.groups) for r in read_rules(spark, str(tmp_path)).collect()}
    assert rows[8][1] == [] and rows[9] == (["own"], ["x", "y"]) and rows[10][1] == ["z"] and rows[11] == (["p", "q"], ["z"])


def test_rules_survive_the_table(spark):
    assert as_rules(rules_table(spark)) == DEFAULT_RULES


def test_default_rules():
    assert len(DEFAULT_RULES) == 40
    assert sum(len(r.codes or []) for r in DEFAULT_RULES) == 14
    assert sum(r.counted_rule is not None for r in DEFAULT_RULES) == 5
    assert sum(bool(r.parents) for r in DEFAULT_RULES) == 33


@pytest.mark.parametrize(
    ("match", "hits", "misses"),
    [
        ("^[error] ", ["[error] x"], ["x [error] ", "e"]),
        ("a.b|c$", ["xa.by", "abc"], ["aXb", "cx"]),
        ("File: |", ["File: x"], ["file: "]),
        ("^all$", ["all"], ["all of it", "at all"]),
    ],
)
def test_match_language(spark, match, hits, misses):
    texts = spark.createDataFrame([(t,) for t in hits + misses], "t string")
    assert {r.t for r in texts.filter(match_condition(F.col("t"), match)).collect()} == set(hits)


@pytest.mark.parametrize(
    ("regex", "hits", "misses"),
    [
        (r" [\S*:error] ", [" [php7:error] ", " [:error] "], ["[php7:error] ", " [a b:error] "]),
        (r" [\S+:warn] ", [" [a:warn] "], [" [:warn] "]),
        (r"user \S+ in realm \.* not found", ["user u in realm x y not found"], ["user in realm not found"]),
        (r"^a.b\.", ["a.bX"], ["aXbX", "xa.bX"]),
        (r"\d+|\(x\)", ["7", "(x)"], ["x"]),
    ],
)
def test_regex_language(spark, regex, hits, misses):
    texts = spark.createDataFrame([(t, True) for t in hits] + [(t, False) for t in misses], "t string, hit boolean")
    assert texts.filter(F.col("t").rlike(regex_pattern(regex)) != F.col("hit")).count() == 0


def records(spark, rows):
    frame = spark.createDataFrame(
        [("o", "apache_error", *row) for row in rows],
        "owner string, log_format string, level string, client string, entity string, message string",
    )
    return with_source(frame.withColumn("epoch_timestamp", F.lit(1)))


def test_tree(spark):
    frame = records(
        spark,
        [
            ("php7:error", "10.0.0.1:5", "AH01276:", "AH01276: Cannot serve"),
            ("php7:warn", "10.0.0.2", "AH01276:", "AH01276: Cannot serve"),
            ("error", "10.0.0.3", "x", "user bob not found"),
            ("core:error", "10.0.0.4", "x", "ModSecurity: Access denied with code 403"),
            ("error", "10.0.0.5", "x", "failed to find; File does not exist: y"),
            (None, "10.0.0.6", "x", "mod_security-message: Access denied now"),
            ("core:error", "10.0.0.7", None, None),
        ],
    )
    matched = match_rules(frame, DEFAULT_RULES)
    got = {r.srcip: r.matched for r in matched.collect()}
    assert got == {
        "10.0.0.1": [30100, 30301, 30306],
        "10.0.0.2": [30100, 30302],
        "10.0.0.3": [30100, 30101, 30109],
        "10.0.0.4": [30100, 30301, 30402, 30411],
        "10.0.0.5": [30100, 30101, 30112],
        "10.0.0.6": [30100, 30200, 30201],
        "10.0.0.7": [30100, 30301],
    }
    alerts = {(r.srcip, r.rule_id, r.level) for r in rule_alerts(matched, DEFAULT_RULES, rules_table(spark)).collect()}
    assert alerts == {
        ("10.0.0.1", 30306, 5), ("10.0.0.3", 30109, 9), ("10.0.0.4", 30411, 7), ("10.0.0.6", 30201, 6)
    }


def test_one_of_several_parents_is_enough(spark):
    rules = [
        Rule(1, 0, match="a"), Rule(2, 0, match="b"), Rule(3, 5, parents=[1, 2], match="c"), Rule(4, 5, parents=[99])
    ]
    frame = records(spark, [("error", "10.0.0.1", "x", "a c"), ("error", "10.0.0.2", "x", "b c"), ("error", "10.0.0.3", "x", "c")])
    assert {r.srcip: r.matched for r in match_rules(frame, rules).collect()} == {
        "10.0.0.1": [1, 3], "10.0.0.2": [2, 3], "10.0.0.3": []
    }


def test_rule_sets_that_cannot_work_are_refused():
    plain, counting = Rule(1, 5, match="x"), Rule(2, 5, frequency=3, timeframe=9, counted_rule=1)
    check_rules([plain, counting, Rule(3, 5, parents=[1, 99])])
    for wrong in ([plain, counting, Rule(3, 5, parents=[2])], [plain, counting, Rule(3, 5, frequency=2, timeframe=9, counted_rule=2)],
                  [Rule(4, 0, parents=[5]), Rule(5, 0, parents=[6]), Rule(6, 0, parents=[4])], [Rule(7, 0, parents=[7])]):
        with pytest.raises(ValueError):
            check_rules(wrong)
    with pytest.raises(ValueError):
        match_condition(F.lit("x"), "|")
