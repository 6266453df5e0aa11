import json

import pytest
from pyspark.sql import functions as F

from nightglass.operators import conversion, detect as d, lint
from nightglass.operators.rules import Profile, compile_rules, rules_table
from nightglass.sinks import artifacts
from nightglass.sources import events as ev
from nightglass.sources import files

RULE = """title: Odd Query
id: 3f2c6a0e-58d1-4f3e-9a55-0c9a6d8a1b11
date: 2024-01-05
tags: [attack.exfiltration]
detection:
  selection:
    QueryName|contains: "a\\\\b"
  condition: selection
"""


def put(root, **named):
    for name, text in named.items():
        path = root / name.replace("__", "/").replace("_DOT_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")


def test_rule_corpus_scan(spark, tmp_path):
    put(tmp_path, **{
        "sigma-rules__endpoint__a_DOT_yml": RULE, "sigma-rules__deep__er__b_DOT_yaml": "", "sigma-rules__c_DOT_yml": "a: [1",
        "sigma-rules__d_DOT_yml": "- 1\n- 2", "sigma-rules__skip_DOT_txt": "x",
    })
    rules = files.relative_to(files.read_rules(spark, str(tmp_path)), "sigma-rules")
    got = {r.path: r for r in rules.collect()}
    assert sorted(got) == ["sigma-rules/c.yml", "sigma-rules/d.yml", "sigma-rules/deep/er/b.yaml", "sigma-rules/endpoint/a.yml"]
    assert json.loads(got["sigma-rules/endpoint/a.yml"].rule_json)["date"] == "2024-01-05"
    assert got["sigma-rules/c.yml"].rule_json is None and got["sigma-rules/c.yml"].error
    assert got["sigma-rules/deep/er/b.yaml"].rule_json == "null" and got["sigma-rules/d.yml"].rule_json == "[1, 2]"
    one = files.read_rules(spark, str(tmp_path / "sigma-rules" / "endpoint" / "a.yml"))
    assert one.count() == 1
    with pytest.raises(ValueError):
        files.read_rules(spark, str(tmp_path / "sigma-rules" / "skip.txt"))


def test_yaml_parse_takes_the_text_alone_through_python(spark, rows):
    """Wide rows stay out of the Python workers, and a filter on the outcome parses no text again."""
    texts = spark.createDataFrame([(1, "a: 1", "wide" * 1000), (2, "{", "wide"), (3, None, None), (None, "- x", "")], "id int, text string, other string")
    parsed = files.parse_yaml(texts)
    good = parsed.where("error is null")
    plan = good._jdf.queryExecution().executedPlan().toString()
    evaluated = [line for line in plan.splitlines() if "EvalPython" in line]
    assert len(evaluated) == 1 and "MapInPandas" not in plan
    assert parsed.columns == ["id", "text", "other", "rule_json", "error"]
    assert rows(good.select("id", "rule_json")) == [(1, '{"a": 1}'), (3, "null"), (None, '["x"]')]


def test_query_scan_and_precedence(spark, tmp_path, rows):
    put(tmp_path, **{"kql__x__a_DOT_kql": "T | take 1\n", "kql__a_DOT_kql_DOT_meta": "m", "kql__b_DOT_kql_DOT_error": "e", "kql__b_DOT_kql": " ", "kql__c_DOT_txt": "no"})
    folder = str(tmp_path / "kql")
    found = files.read_queries(spark, folder, "kql")
    assert sorted(p.path.rsplit("/", 1)[1] for p in found.collect()) == ["a.kql", "b.kql"]
    assert files.query_files_found(found.where("false")).collect()[0].warning == "No query files found"
    paths = [r.path for r in found.collect() if r.path.endswith("/a.kql")]
    manifest = spark.createDataFrame(
        [([{"outputs": {"kql": paths[0]}}, {"outputs": {"kql": "file:/gone.kql"}}, {"outputs": {"splunk": "s"}}],)], "rules array<struct<outputs: map<string,string>>>"
    )
    assert [r.path for r in files.choose_queries(spark, manifests=manifest, folder=folder, backend="kql").collect()] == paths
    one = files.choose_queries(spark, query=str(tmp_path / "kql" / "c.txt"), manifests=manifest, folder=folder, backend="kql").collect()
    assert [r.query_text for r in one] == ["no"]
    assert files.choose_queries(spark, folder=folder, backend="kql").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_queries(spark, str(tmp_path / "none"), "kql").count()


def test_saved_queries(spark, tmp_path):
    put(tmp_path, **{"a_DOT_json": '{"properties": {"query": "T | x"}}', "b_DOT_json": '{"other": 1}', "c_DOT_kql": "U", "d_DOT_md": "V"})
    got = {r.path.rsplit("/", 1)[1]: (r.query_text, r.is_empty) for r in files.read_saved_queries(spark, str(tmp_path)).collect()}
    assert got == {"a.json": ("T | x", False), "b.json": ("", True), "c.kql": ("U", False)}


def test_expectations_file(spark, tmp_path, rows):
    put(tmp_path, **{"e_DOT_yml": "kql:\n  a.kql: {min: 1}\n  b.kql:\n    max: 4\n    description: d\n  c.kql:\n  d.kql: {}\nsplunk: []\n", "l_DOT_yml": "- 1"})
    got = rows(files.read_expectations(spark, str(tmp_path / "e.yml")))
    assert got == [("kql", "a.kql", 1, None, None), ("kql", "b.kql", None, 4, "d")]
    assert files.read_expectations(spark, str(tmp_path / "none.yml")).count() == 0
    assert files.read_expectations(spark, str(tmp_path / "l.yml")).count() == 0


def test_ndjson_counts(spark, tmp_path):
    put(tmp_path, **{"a_DOT_ndjson": '{"a": 1}\n\n{"a": "x"}\n{"a"\n', "b_DOT_ndjson": '[1]\n7\n{"a": 2}{"a": 3}\n  {"a": 4, "z": []}  \n', "c_DOT_json": '{"a": 9}\n'})
    parsed = ev.parse_events(ev.read_event_lines(spark, str(tmp_path)), "a int")
    counts = ev.ingest_counts(parsed).collect()[0]
    assert (counts.ok_count, counts.error_count, counts.status) == (2, 5, "failure")
    assert sorted(r._corrupt_record for r in parsed.where("not ok").collect())[0] == "7"
    put(tmp_path, **{"none__x_DOT_txt": ""})
    none = ev.ingest_counts(ev.parse_events(ev.read_event_lines(spark, str(tmp_path / "none")), "a int")).collect()[0]
    assert (none.ok_count, none.error_count, none.status) == (0, 0, "success")


def test_open_documents(spark, rows):
    lines = spark.createDataFrame([('{"a.b": 1, "c": "x"}',), ('{"a.b": "2"}',), ("nope",)], "line string")
    docs = ev.parse_open_events(lines)
    assert rows(docs.where("ok").select(ev.field_of(F.col("doc"), "a.b"))) == [("1",), ("2",)]
    assert rows(ev.discovered_schema(docs)) == [("a.b", "BIGINT", 1), ("a.b", "STRING", 1), ("c", "STRING", 1)]


def test_envelope_with_broken_escapes(spark):
    bad = r'{"time": 5, "event": {"Image": "C:\Windows\cmd.exe"}}'
    good = r'{"time": 5, "event": {"Image": "C:\\Windows\\cmd.exe"}}'
    parsed = ev.parse_events(spark.createDataFrame([(bad,), (good,)], "line string"), "time bigint, event struct<Image: string>")
    assert parsed.where("not ok").count() == 1
    assert [r.Image for r in ev.unwrap_envelope(parsed.where("ok")).collect()] == ["C:\\Windows\\cmd.exe"]


def test_index_pattern_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "events")
    frame = spark.createDataFrame([(1, "lake_rows-a"), (2, "lake_rows-b"), (3, "lakexrows-c"), (4, "security")], "id int, index string")
    artifacts.write_events(frame, path, "index")
    assert sorted(r.id for r in ev.read_index(spark, path, "lake_rows-*").collect()) == [1, 2]
    assert [r.id for r in ev.read_index(spark, path, "security").collect()] == [4]
    plan = ev.read_index(spark, path, "lake_rows-*")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index" in plan
    artifacts.write_events(frame.limit(1), path, "index", append=True)
    assert spark.read.parquet(path).count() == 5
    artifacts.write_events(frame.limit(1), path, "index")
    assert spark.read.parquet(path).count() == 1


def test_results_are_appended_as_sorted_json(spark, tmp_path):
    rows = spark.createDataFrame([("success", "testing", "kql", {"files_checked": 2})], "status string, stage string, backend string, metrics map<string,bigint>")
    path = str(tmp_path / "out")
    artifacts.write_results(rows, path)
    artifacts.write_results(rows, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 2
    doc = json.loads(lines[0])
    assert list(doc) == sorted(doc) and doc["rule_id"] is None and doc["errors"] == [] and doc["metrics"] == {"files_checked": 2}


OUTCOMES = [
    ("r1", "p1", "kql", "success", "out/r1.kql", "T", ""), ("r1", "p1", "splunk", "skipped", "out/r1.splunk", "", "target not selected"),
    ("r2", "p2", "kql", "failed", "out/r2.kql", "", ""), ("r3", "p3", "kql", "success", "out/r3.kql", 'U "q"', ""),
]
OUTCOME_SCHEMA = "rule_id string, rule_path string, backend string, status string, query_path string, query string, message string"


def test_documents_are_written_as_valid_json(spark, tmp_path):
    outcomes = spark.createDataFrame(OUTCOMES, OUTCOME_SCHEMA)
    for name, lines in (("bundle", conversion.bundle_lines(outcomes, "kql")), ("manifest", conversion.run_manifest_lines(outcomes, "kql"))):
        path = str(tmp_path / name)
        artifacts.write_lines(lines, path, "section", "key")
        text = "\n".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*")))
        doc = json.loads(text)
        assert doc["status"] == "failure" and [r["rule_id"] for r in doc["rules"]] == ["r1", "r2", "r3"]
    assert doc["generated_count"] == 2 and doc["rules"][0]["outputs"] == {"kql": "out/r1.kql"} and doc["rules"][1]["errors"] == ["conversion failed"]


def test_manifest_rows(spark):
    got = {r.rule_id: r for r in conversion.rule_manifests(spark.createDataFrame(OUTCOMES, OUTCOME_SCHEMA)).collect()}
    assert got["r1"].outputs == {"kql": "out/r1.kql"} and got["r1"].generated == ["kql"] and got["r1"].skipped == ["splunk"] and got["r1"].errors == []


@pytest.mark.parametrize("backend, text, errors", [
    ("elasticsearch", "host.name:WORKSTATION01\n", []), ("kql", "// only\n/* c\n */", ["Query is empty"]), ("splunk", "<!-- ( \n -->", ["Query is empty"]),
    ("elasticsearch", "// x", []), ("kql", "a | where (b", ["Unbalanced parentheses"]), ("splunk", "([{", ["Unbalanced parentheses", "Unbalanced brackets", "Unbalanced braces"]),
    ("kql", "x(\"http://a)\")", ["Unbalanced parentheses"]), ("kql", ")(", []), ("sql", "x", ["Unknown query type: sql"]), ("kql", None, ["Error reading file"]), ("splunk", " \t\n", ["Query is empty"]),
])
def test_lint(spark, backend, text, errors):
    row = lint.lint(spark.createDataFrame([("p", backend, text)], "path string, backend string, query_text string")).collect()[0]
    assert row.errors == errors and row.is_valid == (not errors)


def test_layout_prunes_by_table_and_route(spark, tmp_path, rows):
    path = str(tmp_path / "layout")
    events = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('i-', id % 7)) AS idx", "id % 100 AS port")
    artifacts.write_layout(events.repartition(5), path, ["idx"], ["port"], 6)
    # The index that holds a third of all rows is several files, sorted through.
    hot = spark.read.parquet(path).where("idx = 'hot'").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("port").alias("a"), F.max("port").alias("b")).orderBy("a").collect()
    assert len(hot) > 1 and all(x.b <= y.a for x, y in zip(hot, hot[1:], strict=False))
    wanted = spark.createDataFrame([("i-1",), ("i-4*",), ("gone",), ("i.2",)], "pattern string")
    found = ev.read_indexes(spark, path, wanted, "idx")
    assert rows(found.select("id")) == rows(events.where("idx IN ('i-1', 'i-4')").select("id"))
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    doc = {"id": "r", "logsource": {"category": "c"}, "detection": {"s": {"port|lt": 10}, "condition": "s"}}
    table = spark.read.parquet(path)
    routed = d.detect(table, compile_rules(rules_table(spark, [doc]), table, Profile(route={"category": ("idx", {"c": "i-5"})})), ["id"])
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert rows(routed) == rows(events.where("idx = 'i-5' AND port < 10").selectExpr("id", "'r' AS rule_id"))
    assert "PartitionFilters: [isnotnull(idx" in plan and "= i-5" in plan
