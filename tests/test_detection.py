import base64
import datetime
import json
import pathlib
import time

import pytest
from pyspark.sql import Window, functions as F

from nightglass import session
from nightglass.operators import detect as d
from nightglass.operators import expect, indicators
from nightglass.operators.rules import CompiledRule, Profile, compile_rules, condition_sql, conversion_results, rules_table, shared_documents
from nightglass.functions.addresses import in_network_sql
from nightglass.operators.values import base64_forms, like_pattern
from nightglass.sources.events import parse_events, read_event_lines, read_events

FIXTURES = pathlib.Path(__file__).parent / "fixtures"
NAMES = sorted({k for line in (FIXTURES / "events.ndjson").read_text().splitlines() if line for k in json.loads(line)})
SCHEMA = ", ".join(f"`{n}` {'bigint' if n == 'destination.port' else 'string'}" for n in NAMES)
ECS = [("ecs", "QueryName", "dns.question.name"), ("ecs", "Image", "process.executable"), ("ecs", "CommandLine", "process.command_line")]
ROUTE = {"category": ("event.category", {"process_creation": "process", "dns_query": "network"})}


@pytest.fixture(scope="module")
def events(spark):
    return parse_events(read_event_lines(spark, str(FIXTURES)), SCHEMA).drop("_corrupt_record", "file").cache()


def rule(rule_id, condition="selection", logsource=None, **selections):
    return {"id": rule_id, "logsource": logsource or {}, "detection": {**selections, "condition": condition}}


UFILE = rule("ufile", selection={"QueryName|contains": "ufile.io"}, logsource={"category": "dns_query"})
SHELL = rule("shell", selection={"Image|endswith": "\\\\powershell.exe"}, logsource={"category": "process_creation"})


def hits(spark, events, docs, profile=Profile("ecs")):
    field_map = session.local_table(spark, ECS, "profile string, rule_field string, event_field string")
    rules = compile_rules(rules_table(spark, docs), events, profile, field_map)
    return {r.rule_id: r.total_hits for r in d.count_matches(d.detect(events, rules, ["@timestamp"]), rules).collect()}


def test_fixture_has_18_documents(events):
    assert events.count() == 18


def test_golden_counts(spark, events):
    docs = [
        UFILE, SHELL, rule("single", selection={"Image|endswith": "\\powershell.exe"}),
        rule("both", selection={"Image|endswith": "\\powershell.exe", "CommandLine|contains": "-enc"}),
        rule("negated", "not selection", selection={"QueryName|contains": "ufile.io"}),
    ]
    assert hits(spark, events, docs) == {"ufile": 2, "shell": 3, "single": 3, "both": 1, "negated": 16}


def test_unmapped_profile_finds_nothing(spark, events):
    assert hits(spark, events, [UFILE], Profile("none")) == {"ufile": 0}


def test_routing(spark, events):
    assert hits(spark, events, [SHELL, UFILE], Profile("ecs", route=ROUTE)) == {"shell": 2, "ufile": 2}


@pytest.mark.parametrize("selection, want", [
    ({"Image": "*\\win\\\\*"}, 6), ({"Image": "?:\\Win\\c?d.exe"}, 1), ({"Image|contains": "win\\c*.exe"}, 2), ({"destination.port": [443, 445]}, 2),
    ({"destination.port|gt": 443}, 2), ({"destination.ip|cidr": "203.0.113.0/26"}, 1), ({"destination.ip|cidr": "203.0.113.0/24"}, 2), ({"host.name": None}, 4),
    ({"user.name|re": "^(ann|bob)$"}, 9), ({"event.action|contains|all": ["process", "created"]}, 4), ({"user.name|cased": "system"}, 0), ({"user.name": "system"}, 1),
    ({"destination.port": "44*"}, 3), ({"user.name|startswith": ["a", "b"]}, 9), ({"destination.port|endswith": "5"}, 1),
])
def test_modifiers(spark, events, selection, want):
    assert hits(spark, events, [rule("r", selection=selection)]) == {"r": want}


def test_selection_lists_and_keywords(spark, events):
    docs = [
        rule("alternatives", selection=[{"destination.port": 4444}, {"event.action": "CreateUser", "source.ip": "203.0.113.50"}]),
        rule("keywords", "words", words=["HOSTNAME", "paste."]),
        rule("counted", "1 of sel_* and not filter", sel_a={"Image|endswith": "cmd.exe"}, sel_b={"destination.port": 445}, filter={"host.name": "PC-2"}),
        rule("all", "all of them", a={"event.category": "network"}, b={"host.name": "PC-1"}, _ignored={"host.name": "none"}),
        rule("precedence", "a or b and not c", a={"event.action": "PutObject"}, b={"event.category": "cloud"}, c={"source.ip|startswith": "203"}),
    ]
    assert hits(spark, events, docs) == {"alternatives": 2, "keywords": 2, "counted": 2, "all": 5, "precedence": 2}


@pytest.mark.parametrize("doc, error", [
    (rule("r", selection={"a|lookup": "x"}), "unsupported modifier: lookup"),
    (rule("r", selection={"a|base64|contains": "x*"}), "wildcard in an encoded value: x*"),
    (rule("r", selection={"a|wide": "x"}), "wide needs base64"),
    (rule("r", selection={"a|expand": "%nobody%"}), "unknown placeholder: nobody"),
    (rule("r", "selection or (selection", selection={"a": "x"}), "[PARSE_SYNTAX_ERROR]"),
    (rule("r", "selection) or (selection", selection={"a": "x"}), "[PARSE_SYNTAX_ERROR]"),
    (rule("r", "selection selection", selection={"a": "x"}), "[PARSE_SYNTAX_ERROR]"),
    (rule("r", "selection and 1=1", selection={"a": "x"}), "unknown word in condition: 1=1"),
    (rule("r", "selection or current_user()", selection={"a": "x"}), "unknown word in condition: current_user"),
    (rule("r", "1 of none*", selection={"a": "x"}), "no selection matches: 1 of none*"),
    (rule("r", "", selection={"a": "x"}), "detection must have a condition"),
    (rule("r", "selection and", selection={"a": "x"}), "[PARSE_SYNTAX_ERROR]"),
    (rule("r", selection={"source.ip|cidr": "fe80::/200"}), "'fe80::/200' does not appear to be"),
    ({"id": "r"}, "detection must have a condition"),
])
def test_rules_that_fail_to_compile(spark, events, doc, error):
    compiled = compile_rules(rules_table(spark, [doc]), events)
    assert compiled[0].sql == "" and compiled[0].error.startswith(error)
    assert d.count_matches(d.detect(events, compiled, ["@timestamp"]), compiled).collect()[0].total_hits == 0


def test_values_cannot_leave_their_quotes(spark, events):
    nasty = "x' or 1=1 or `a`='\\' or true -- \\"
    assert hits(spark, events, [rule("r", selection={"user.name": nasty}), rule("s", selection={"no`such": nasty})]) == {"r": 0, "s": 0}


def test_missing_field_policy(spark, events):
    strict = compile_rules(rules_table(spark, [rule("r", selection={"no.field": "x"})]), events, Profile(missing="error"))
    assert strict[0].error == "unknown field: no.field"


def test_negation_is_wrapped_only_where_negated():
    sql = condition_sql("a and not b", {"a": "p", "b": "q"})
    assert sql == "(p) and not coalesce(q, false)"
    assert "coalesce(p" in condition_sql("not (a or b)", {"a": "p", "b": "q"})


def test_like_pattern():
    assert like_pattern("a%b_c!\\*d*e?") == "a!%b!_c!!*d%e_"


def test_case_policies_and_scan_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("ABC",), ("abc",)], "name string").write.parquet(path)
    table = spark.read.parquet(path)
    doc = rules_table(spark, [rule("r", selection={"name|contains": "AB"})])
    for case, want in (("insensitive", 2), ("exact", 1), ("lowered", 1)):
        compiled = compile_rules(doc, table, Profile(case=case))
        assert d.detect(table, compiled, ["name"]).count() == want
    plan = d.detect(table, compiled, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(name,ab)" in plan


def test_limits_samples_and_counts(spark, events):
    compiled = compile_rules(rules_table(spark, [rule("many", selection={"event.category": "network"})]), events)
    matches = d.detect(events, compiled, ["@timestamp"])
    first = d.first_matches(matches, 3, ["@timestamp"]).orderBy("row_no").collect()
    assert [r.row_no for r in first] == [1, 2, 3]
    assert [r["@timestamp"][11:16] for r in first] == ["09:00", "09:01", "09:02"]
    assert d.first_matches(matches, -1, ["@timestamp"]).count() == 7
    assert d.sample_matches(matches, -1, ["@timestamp"]).count() == 0
    counted = d.row_counts(d.count_matches(matches, compiled), 5).collect()[0]
    assert (counted.total_hits, counted.returned_rows) == (7, 5)
    assert d.row_counts(d.count_matches(matches, compiled), -1).collect()[0].returned_rows == 7


@pytest.mark.parametrize("kind, make", [
    ("double", lambda i: [float("nan"), float("inf"), -float("inf"), None, 1e308, -1e308][i] if i < 6 else i % 7 / 3), ("string", lambda i: None if i == 0 else "aé"[i % 2] * (i % 5)),
    ("bigint", lambda i: 9007199254740993 + i % 3), ("date", lambda i: datetime.date(2024, 1, 1 + i % 9)), ("boolean", lambda i: [True, False, None][i % 3]), ("binary", lambda i: bytes([i % 4])),
])
@pytest.mark.parametrize("limit", [0, 1, 17, 150, 1000])
def test_limit_by_ranges_of_any_type(spark, rows, kind, make, limit):
    """Few ranges hold many rows, one value is shared by most, and the first column decides little."""
    table = spark.createDataFrame([(f"r{i % 3}", make(i), i) for i in range(400)], f"rule_id string, k {kind}, id int")
    got = rows(d.first_matches(table, limit, ["k", "id"], 3).select("rule_id", "id", "row_no"))
    plain = table.withColumn("row_no", F.row_number().over(Window.partitionBy("rule_id").orderBy("k", "id"))).where(F.col("row_no") <= limit)
    assert got == rows(plain.select("rule_id", "id", "row_no"))


def test_limit_leaves_the_session_alone(spark):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    d.first_matches(spark.range(10).selectExpr("'r' AS rule_id", "id"), 50_000, ["id"]).collect()
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))


def test_many_rules_share_tests(spark, events):
    """2000 rules over 30 tests: each test stands once in the plan, and compiling takes no job per rule."""
    tests = [{"destination.port": i} if i % 2 else {"user.name|contains": f"a{i}"} for i in range(30)]
    docs = [rule(f"r{i:04d}", ["a and not b", "a or b", "2 of them"][i % 3], a=tests[i % 30], b=tests[(i * 7 + 1) % 30], c=tests[i // 30 % 30]) for i in range(2000)]
    start = time.perf_counter()
    rules = compile_rules(rules_table(spark, docs), events)
    assert time.perf_counter() - start < 10 and not any(r.error for r in rules)
    assert len({n for r in rules for n, _ in r.tests}) == 30
    found = d.detect(events, rules, ["@timestamp"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") == 15 and plan.count("lower(user.name") == 1
    few = rules[:90]
    alone = {r.rule_id: events.where(r.sql).count() for r in few[::15]}
    counted = {r.rule_id: r.total_hits for r in d.count_matches(d.detect(events, few, ["@timestamp"]), few).collect()}
    assert len(counted) == 90 and alone == {i: counted[i] for i in alone}


@pytest.mark.parametrize("condition, want", [("2 of them", {2, 3}), ("3 of s_*", {3}), ("not 2 of s_*", {0, 1}), ("4 of them", set()), ("0 of them", {0, 1, 2, 3}), ("NOT (s_a or 2 of s_b*)", {0})])
def test_counts_of_selections(spark, condition, want):
    numbers = spark.range(4).withColumnRenamed("id", "n")
    doc = rule("r", condition, s_a={"n|gte": 1}, s_b={"n|gte": 2}, s_c={"n|gte": 3})
    compiled = compile_rules(rules_table(spark, [doc]), numbers)
    assert {r.n for r in d.detect(numbers, compiled, ["n"]).collect()} == want == {r.n for r in numbers.where(compiled[0].sql).collect()}


@pytest.mark.parametrize("text, network, want", [
    ("2001:db8::1", "2001:db8::/32", True), ("2001:DB8:0:0:0:0:0:1", "2001:db8::1/128", True), ("::1", "::1/128", True), ("::", "::/128", True), ("1::", "1::/16", True),
    ("::ffff:1.2.3.4", "::ffff:1.2.3.0/120", True), ("1:2:3:4:5:6:7:8", "1:2:3:4::/64", True), ("1:2:3:4:5:6:7:8", "1:2:3:5::/64", False), ("1:2:3:4:5:6:7", "::/0", None), ("1::2::3", "::/0", None),
    (":1:2:3:4:5:6:7", "::/0", None), ("1:2:3:4:5:6:7:", "::/0", None), ("12345::", "::/0", None), ("1.2.3.4", "::/0", None), ("fe80::1%eth0", "::/0", None), ("1:2:3:4:5:6:7::", "1::/16", True), ("", "::/0", None), (None, "::/0", None),
    ("::1:2:3:4:5:6:7:8", "::/0", None), ("64:ff9b::256.1.1.1", "::/0", None), ("10.1.2.3", "10.0.0.0/8", True), ("10.1.2", "10.0.0.0/8", False), ("::a00:1", "10.0.0.0/8", False),
])
def test_networks(spark, text, network, want):
    got = spark.createDataFrame([(text,)], "ip string").selectExpr(in_network_sql("ip", network)).first()[0]
    assert bool(got) == bool(want)


def test_encoded_forms_stand_at_every_offset():
    for data in (b"a", b"ab", b"abc", "wörter".encode(), b"x" * 20):
        forms = base64_forms(data, 3)
        for before in range(7):
            for after in range(4):
                assert forms[before % 3] in base64.b64encode(b"q" * before + data + b"z" * after).decode()


DYNAMIC = "id int, v variant, m map<string,struct<x:int,y:array<string>>>, s array<struct<a:array<struct<b:string>>,k:string>>, `dot.ted` struct<in:int>"


@pytest.mark.parametrize("selection, want", [
    ({"v.a": 1}, {0, 1}), ({"v.a": "1"}, {0, 1}), ({"v.l": 2}, {1}), ({"v.a.b": "x"}, {2, 3, 4}), ({"v.a.b.c": None}, {0, 1, 2, 3, 4, 5, 6}), ({"v.a.b|contains": "X"}, {2, 3, 4}), ({"v.a.b|cased": "X"}, set()),
    ({"v.l|gt": 2}, {1}), ({"v.l|re": "^[12]$"}, {1}), ({"v|exists": False}, {6}), ({"v.l": None}, {0, 2, 3, 4, 5, 6}), ({"m.k.x": 5}, {0}), ({"m.k.y|endswith": "b"}, {0}), ({"m.no.x": None}, {0, 1, 2, 3, 4, 5, 6}),
    ({"s.k": "K1"}, {0}), ({"s.a.b|startswith": "d"}, {0}), ({"dot.ted.in": 3}, {1}), ({"v.a": True}, {5}), ({"v.l|all|gte": [1, 3]}, {1}),
])
def test_fields_in_open_types(spark, selection, want):
    docs = ['{"a":1}', '{"a":"1","l":[1,2,3]}', '{"a":{"b":"x"}}', '{"a.b":"x"}', '{"a":[{"b":"y"},{"b":"x"},7]}', '{"a":true,"l":null}', None]
    first = "map('k', named_struct('x', 5, 'y', array('a', 'ab')))", "array(named_struct('a', array(named_struct('b', 'deep')), 'k', 'k1'), named_struct('a', null, 'k', null))"
    table = spark.createDataFrame(list(enumerate(docs)), "id int, t string").selectExpr(
        "id", "try_parse_json(t) AS v", f"if(id = 0, {first[0]}, null) AS m", f"if(id = 0, {first[1]}, null) AS s", "named_struct('in', if(id = 1, 3, null)) AS `dot.ted`"
    )
    compiled = compile_rules(rules_table(spark, [rule("r", selection=selection), rule("not", "not selection", selection=selection)]), table, Profile(missing="error"))
    assert [r.error for r in compiled] == ["", ""]
    got = d.detect(table, compiled, ["id"]).collect()
    by_rule = {i: {r.id for r in got if r.rule_id == i} for i in ("r", "not")}
    assert by_rule["r"] == want == {r.id for r in table.where(compiled[1].sql).collect()}, by_rule
    assert by_rule["not"] == set(range(7)) - want


def test_open_fields_are_looked_up_once_for_all_tests(spark):
    """A key of a path is looked up once however long the path, and a field once however many tests read it."""
    table = spark.createDataFrame([(1, '{"a":{"b":{"c":[5,7]}}}')], "id int, t string").selectExpr("id", "try_parse_json(t) AS v")
    docs = [rule("five", selection={"v.a.b.c": 5}), rule("both", selection={"v.a.b.c|all": [5, 7]}), rule("high", selection={"v.a.b.c|gte": 6}), rule("same", selection={"v.a.b.c|fieldref": "v.a.b.c"}), rule("no", selection={"v.a.b.c": None})]
    found = d.detect(table, compile_rules(rules_table(spark, docs), table), ["id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Four ways to cut a.b.c into keys share their first ones: 7 keys, and an array or a value after each and at the root.
    assert plan.count("try_variant_get(") <= 15
    assert {r.rule_id for r in found.collect()} == {"five", "both", "high", "same"}


def test_only_what_no_event_can_have_is_refused(spark):
    table = spark.createDataFrame([], DYNAMIC)
    names = {"v.any.thing": "", "m.any.x": "", "m.any.z": "unknown field: m.any.z", "s.k": "", "s.z": "unknown field: s.z", "dot.ted.out": "unknown field: dot.ted.out", "dot.ted": "", "gone": "unknown field: gone"}
    compiled = compile_rules(rules_table(spark, [rule(n, selection={n: "x"}) for n in names]), table, Profile(missing="error"))
    assert {r.rule_id: r.error for r in compiled} == names


def test_odd_rule_ids_and_documents(spark, events):
    """A rule without an id or a document, ids with quotes, and an empty rule set."""
    good = json.dumps(rule("x", selection={"event.category": "cloud"}))
    table = spark.createDataFrame([(None, good), ("it's `a` \\ rule", good), ("none", None), ("null", "null"), ("list", "[]"), ("twice", good), ("twice", good)], "rule_id string, rule_json string")
    compiled = compile_rules(table, events)
    errors = {r.rule_id: r.error for r in compiled}
    assert errors == {None: "rule id is missing", "it's `a` \\ rule": "", "none": "rule document is missing", "null": "detection must have a condition", "list": "detection must have a condition", "twice": "rule id is used 2 times: twice"}
    assert {r.rule_id for r in d.detect(events, compiled, ["@timestamp"]).collect()} == {"it's `a` \\ rule"}
    assert compile_rules(table.where("false"), events) == [] and d.detect(events, [], ["@timestamp"]).collect() == []


def test_rules_of_equal_documents_are_compiled_once(spark, events, rows):
    """Thousands of rules over two documents: both reach the driver once, and odd rules count as they do one by one."""
    good, other = (json.dumps({"detection": {"s": {"event.category": c}, "condition": "s"}}) for c in ("cloud", "process"))
    odd = [(None, good), (None, good), (None, other), ("none", None), ("list", "[]"), ("twice", good), ("twice", good), ("both", good), ("both", other), ("x", other)]
    table = spark.createDataFrame(odd, "rule_id string, rule_json string")
    count = lambda rules, usable: d.count_matches(d.detect(events, usable, ["@timestamp"]), usable)

    def shared(rules):
        documents, members = shared_documents(rules)
        usable = compile_rules(documents, events)
        return d.count_members(count(rules, usable), members), usable

    assert rows(shared(table)[0]) == rows(count(table, compile_rules(table, events)))
    many = table.unionByName(spark.range(5000).select(F.concat(F.lit("r"), "id").alias("rule_id"), F.when(F.col("id") % 2 == 0, good).otherwise(other).alias("rule_json")))
    found, usable = shared(many)
    assert len(usable) == 4
    hits = {r.rule_id: r.total_hits for r in found.where("rule_id like 'r%'").collect()}
    assert len(hits) == 5000 and all(hits[f"r{i}"] == events.where(F.lower("`event.category`") == ("process" if i % 2 else "cloud")).count() for i in (0, 1, 4998, 4999))


def test_many_rules_are_chunked(spark, events):
    rules = [CompiledRule(f"r{i:03d}", f"`destination.port` = {i}", "", ("destination.port",)) for i in range(400, 720)]
    found = {r.rule_id for r in d.detect(events, rules, ["@timestamp"]).collect()}
    assert found == {"r443", "r445"}


def test_read_events_scan_equals_line_parse(spark, events, rows):
    scanned = read_events(spark, str(FIXTURES), SCHEMA).drop("_corrupt_record")
    assert rows(scanned) == rows(events.drop("ok"))


# ---- runs and expectations ----


def test_modes(spark, events):
    docs = [rule("good", selection={"event.category": "cloud"}), rule("bad", "x", selection={"a": "b"})]
    rules = compile_rules(rules_table(spark, docs), events)
    by_mode = {m: {r.rule_id: r for r in expect.run_rules(events, rules, ["@timestamp"], m, 3).collect()} for m in expect.MODES}
    assert by_mode["compile"]["good"].warning == "good: compile passed; execution not requested"
    assert by_mode["compile"]["good"].total_hits == 0 and by_mode["compile"]["good"].exec_ok is None
    assert by_mode["execute"]["good"].compile_ok is None and by_mode["execute"]["good"].returned_rows == 3
    both = by_mode["both"]
    assert both["good"].passed and not both["bad"].passed and both["bad"].stage_error.startswith("bad: compile failed: unknown word")
    summary = expect.run_summary(expect.run_rules(events, rules, ["@timestamp"], "both")).collect()[0]
    assert (summary.files_checked, summary.passed, summary.failed, summary.compile_failures, summary.status) == (2, 1, 1, 1, "failure")
    with pytest.raises(ValueError):
        expect.run_rules(events, rules, ["@timestamp"], "dry")


def test_expectations(spark):
    results = spark.createDataFrame([("out/a.sql", 0), ("out/b.sql", 7), ("c.sql", 2), ("out/d.sql", 0)], "query_path string, total_hits bigint")
    expected = spark.createDataFrame([("out/a.sql", 1, None), ("b.sql", None, 5), ("c.sql", 1, 2)], "query_key string, min_rows bigint, max_rows bigint")
    expected = expected.withColumn("backend", F.lit("kql")).union(expected.withColumn("backend", F.lit("splunk")).withColumn("min_rows", F.lit(99)))
    got = {r.query_path: r.error for r in expect.check(results, expected, "kql").collect()}
    assert got == {"out/a.sql": "expected >= 1, got 0", "out/b.sql": "expected <= 5, got 7", "c.sql": None, "out/d.sql": None}


def test_minimum_is_tested_first(spark):
    results = spark.createDataFrame([("a", 3)], "query_path string, total_hits bigint")
    expected = spark.createDataFrame([("a", 5, 1)], "query_key string, min_rows bigint, max_rows bigint")
    assert expect.check(results, expected).collect()[0].error == "expected >= 5, got 3"


def test_stage_record_and_summaries(spark, rows):
    stages = spark.createDataFrame(
        [("q", "compile", "success", 0, 5, []), ("q", "execution", "failure", 2, 9, ["no"])],
        "query_file string, stage string, status string, row_count bigint, duration_ms bigint, errors array<string>",
    )
    record = expect.stage_record(stages).collect()[0].stages
    assert set(record) == {"compile", "execution"} and record["execution"].errors == ["no"]
    results = spark.createDataFrame([("success", "execution", None, {"row_count": 4}, None)], "status string, stage string, backend string, metrics map<string,bigint>, errors array<string>")
    assert tuple(expect.compact_summary(results).collect()[0]) == ("success", "execution", "", 4, 0, [])
    queries = spark.createDataFrame([("a", " \n"), ("b", "x"), ("c", None)], "path string, query_text string")
    assert rows(expect.refuse_empty(queries).select("path", "error")) == [("a", "Query file is empty"), ("b", None), ("c", "Query file is empty")]


def test_conversion_results(spark, events, rows):
    docs = [rule("ok", selection={"event.category": "x"}), rule("bad", "y", selection={"a": "b"}),
            {**rule("other", selection={"a": "b"}), "conversion_targets": [" KQL "]}, {**rule("odd", selection={"a": "b"}), "conversion_targets": "kql"}]
    got = rows(conversion_results(spark, compile_rules(rules_table(spark, docs), events)).select("rule_id", "status", "error", "skipped_reason"))
    assert got == [("bad", "failed", "unknown word in condition: y", ""), ("odd", "failed", "conversion_targets must be a list", ""),
                   ("ok", "success", "", ""), ("other", "skipped", "", "target not selected")]


# ---- indicators ----

TEXTS = ["the Quick brown fox", "http://a.example/12?x=the quick", "a", "ab\ncd ef", "éclair ÉCLAIR 42", "", "quick-brown", "abcabcabcd", "xquick browny"]
PATTERNS = ["quick brown", "/1", "a", "b\nc", "ÉCL", "abcd", "brown fox", "zzz", "the quick", " quick ", "", "e", "42", "q", "quick-brown", "cabca"]


def test_contained_equals_brute_force(spark, rows):
    values = spark.createDataFrame([(i, "t", t) for i, t in enumerate(TEXTS)], "id int, field string, value string")
    listed = spark.createDataFrame([(i, "t", p) for i, p in enumerate(PATTERNS)], "indicator_id int, field string, pattern string")
    want = sorted(((i, "t", j) for i, t in enumerate(TEXTS) for j, p in enumerate(PATTERNS) if p and p.lower() in t.lower()), key=repr)
    assert rows(indicators.match_contained(values, listed, ["id"])) == want


def test_anchor_filter_holds_every_anchor_and_little_else(spark):
    listed = spark.createDataFrame([(i, "t", p) for i, p in enumerate(PATTERNS)], "indicator_id int, field string, pattern string")
    side = indicators.anchored(listed.select("indicator_id", "field", F.lower("pattern").alias("pattern")))
    slot = indicators._slot(F.col("field"), F.col("span"), F.col("piece"))
    found = side.select("span", slot.alias("slot")).collect()
    held = spark.range(1).select(indicators.anchor_filter(side).alias("f")).select("f.*").first()
    bits = {64 * w + b for w, x in enumerate(held.words) for b in range(64) if x >> b & 1}
    assert bits == {r.slot for r in found} and len(held.words) == indicators.FILTER_WORDS
    assert set(held.spans) == {r.span for r in found}
    none = indicators.match_contained(spark.createDataFrame([(1, "t", "a text")], "id int, field string, value string"), listed.where("false"), ["id"])
    assert none.collect() == []


def test_equal_with_a_hot_value(spark, rows):
    wide = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("u"))
    values = indicators.field_values(wide, ["id"], ["u"])
    listed = spark.createDataFrame([(1, "u", "hot"), (2, "u", "hot"), (3, "u", "7"), (4, "v", "8")], "indicator_id int, field string, value string")
    got = rows(indicators.match_equal(values, listed, ["id"], salts=8).select("id", "indicator_id"))
    assert got == sorted([(i, j) for i in range(0, 300, 3) for j in (1, 2)] + [(7, 3)], key=repr)


def test_salted_left_join_keeps_unmatched_rows(spark, rows):
    big = spark.createDataFrame([(i, "h" if i < 10 else None if i < 20 else "c") for i in range(22)], "id int, k string")
    side = spark.createDataFrame([("h", 1), ("h", 2), (None, 3)], "k string, v int")
    got = rows(session.salted_join(big, side, ["k"], "left", ["id"], 8).select("id", "v"))
    assert got == sorted([(i, v) for i in range(10) for v in (1, 2)] + [(i, None) for i in range(10, 22)], key=repr)
    kept = rows(session.salted_join(big, side, ["k"], "left_anti", ["id"], 8).select("id"))
    assert kept == sorted([(i,) for i in range(10, 22)], key=repr)
    assert session.salted_join(big, side, ["k"], "left_semi", ["id"], 8).count() == 10
