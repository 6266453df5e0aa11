import json

import pytest
from pyspark.sql import functions as F

from nightglass.operators import catalog, conversion, forms, report, validate
from nightglass.operators.conversion import any_target, rule_id
from nightglass.sinks import artifacts

GOOD = {
    "title": "Odd Query", "id": "7d0f2b1c-55aa-4c1e-8f6e-2a9b3c4d5e6f", "status": "test", "description": "Finds an odd query",
    "author": "me", "date": "2024-01-05", "references": ["https://a.example"], "tags": ["attack.exfiltration", "attack.T1567.002"],
    "logsource": {"product": "windows", "category": "dns_query"}, "detection": {"selection": {"a": "b"}, "condition": "selection"},
    "level": "low", "falsepositives": ["known"], "version": "1.0.0",
}
DROP = object()


def changed(**keys):
    doc = {**GOOD, **keys}
    return {k: v for k, v in doc.items() if v is not DROP}


def errors(spark, doc, check, error=None):
    text = doc if isinstance(doc, str) or doc is None else json.dumps(doc)
    rules = spark.createDataFrame([("sigma-rules/endpoint/endpoint_odd_query.yml", text, error)], "path string, rule_json string, error string")
    return {r.check: r.errors for r in validate.validate(rules).collect()}[check]


def test_good_rule_passes_every_check(spark):
    for check in ("naming", "structure", "metadata", "quality", "schema"):
        assert errors(spark, GOOD, check) == []


@pytest.mark.parametrize("path, want", [
    ("r/endpoint/endpoint_suspicious_powershell.yml", []), ("r/cloud/cloud_aws_api.yaml", []),
    ("r/example/example_rule.yml", ["Category 'example' is not valid. Must be one of: endpoint, cloud, macos, network, web"]),
    ("r/web/cloud_rule.yml", ["Category 'cloud' in filename does not match directory 'web'"]),
    ("r/web/web_ab.yml", ["Descriptive name must be at least 3 characters long"]),
    ("r/web/web__ab_.yml", ["Descriptive name cannot start or end with underscore"]),
    ("r/web/web_a__b.yml", ["Descriptive name cannot contain consecutive underscores"]),
])
def test_naming(value, path, want):
    assert value(validate.naming_errors(F.lit(path))) == want


def test_name_off_the_pattern_has_one_error(value):
    got = value(validate.naming_errors(F.lit("r/web/endpoint-x.yml")))
    assert len(got) == 1 and got[0].startswith("Filename 'endpoint-x.yml' does not match pattern")


@pytest.mark.parametrize("doc, want", [
    ("null", "Rule file is empty"), ("{}", "Rule file is empty"), ('""', "Rule file is empty"), ("0", "Rule file is empty"),
    ('"text"', "Rule file must deserialize to a YAML mapping/object"), ("[1]", "Rule file must deserialize to a YAML mapping/object"),
    (changed(logsource="windows"), "logsource must be a dictionary"), (changed(logsource=None), "logsource must be a dictionary"),
    (changed(logsource={"definition": "x"}), "logsource must have either 'category' or 'product'"),
    (changed(detection=[1]), "detection must be a dictionary"), (changed(detection={"selection": {}}), "detection must have 'condition'"),
    (changed(detection={"condition": "x", "timeframe": "5m"}), "detection must include at least one selection block"),
    (changed(id=5), "id must be a string"), (changed(id="abc"), "id should be a UUID format: abc"),
])
def test_structure(spark, doc, want):
    assert errors(spark, doc, "structure") == [want]


def test_structure_looks_at_keys_only(spark):
    assert errors(spark, changed(logsource={"category": ""}, detection=DROP, id=DROP), "structure") == []
    assert errors(spark, changed(logsource={"category": ""}), "quality") == ["logsource must include product, category, or service"]
    assert errors(spark, None, "structure", "bad indent") == ["YAML parsing error: bad indent"]


@pytest.mark.parametrize("key, bad, want", [
    ("title", DROP, "Missing required metadata field: title"), ("status", "draft", "status must be one of: deprecated, experimental, stable, test"),
    ("level", "severe", "level must be one of: critical, high, informational, low, medium"), ("date", "5.1.2024", "date must be in YYYY/MM/DD or YYYY-MM-DD format"),
    ("references", "x", "references must be a list"), ("tags", "x", "tags must be a list"), ("tags", ["attack.t1059.1"], "tags must include at least one ATT&CK technique tag (attack.t####)"),
    ("falsepositives", "x", "falsepositives must be a list"), ("version", "1.0", "version must follow semantic versioning (e.g., 1.2.3)"),
    ("conversion_targets", "kql", "conversion_targets must be a list"), ("conversion_targets", ["KQL", "sql"], "conversion_targets entries must be 'kql', 'splunk', and/or 'elasticsearch'"),
])
def test_metadata(spark, key, bad, want):
    assert errors(spark, changed(**{key: bad}), "metadata") == [want]


@pytest.mark.parametrize("keys", [{"status": ""}, {"level": None}, {"date": ""}, {"version": 0}, {"references": None}, {"tags": None}, {"conversion_targets": []}, {"date": "2024/01/05"}])
def test_metadata_skips_empty_values(spark, keys):
    assert errors(spark, changed(**keys), "metadata") == []


def test_tags_without_attack(spark):
    assert errors(spark, changed(tags=["x", 5]), "metadata") == [
        "tags must include at least one attack.* tag", "tags must include at least one ATT&CK technique tag (attack.t####)",
    ]


@pytest.mark.parametrize("keys, want", [
    ({"logsource": DROP}, "logsource must be a dictionary"), ({"detection": "x"}, "detection must be a dictionary"),
    ({"detection": {"condition": "x"}}, "detection must include at least one selection block"), ({"detection": {"s": 1, "condition": ""}}, "detection must include a condition"),
    ({"falsepositives": []}, "falsepositives must be populated with known benign scenarios"), ({"tags": ""}, "tags must include ATT&CK mappings and detection context"),
])
def test_quality(spark, keys, want):
    assert errors(spark, changed(**keys), "quality") == [want]


@pytest.mark.parametrize("keys, want", [
    ({"title": DROP, "version": DROP}, ["'title' is a required property", "'version' is a required property"]), ({"title": "ab"}, ["'ab' is too short"]),
    ({"version": 1, "author": None}, ["None is not of type 'string'", "1 is not of type 'string'"]), ({"tags": ["a", 5, True]}, ["5 is not of type 'string'", "True is not of type 'string'"]),
    ({"references": "x"}, ["'x' is not of type 'array'"]), ({"detection": []}, ["[] is not of type 'object'"]), ({"extra": 1, "falsepositives": DROP}, []),
])
def test_contract(spark, keys, want):
    assert errors(spark, changed(**keys), "schema") == want


def test_contract_of_side_metadata(value):
    doc = F.try_parse_json(F.lit('{"version": "1", "status": 2}'))
    assert value(validate.contract_errors(doc, validate.META_CONTRACT)) == ["'owner' is a required property", "2 is not of type 'string'"]


def test_sample_rule_satisfies_the_contract_but_not_the_rest(spark):
    sample = changed(references=DROP, tags=DROP, falsepositives=DROP)
    assert errors(spark, sample, "schema") == []
    assert len(errors(spark, sample, "metadata")) == 3 and len(errors(spark, sample, "quality")) == 2


def test_gate(spark, rows):
    rules = spark.createDataFrame([("r/web/web_good.yml", json.dumps(GOOD), None), ("r/web/bad.yml", "{}", None)], "path string, rule_json string, error string")
    got = {r.check: (r.checked, r.failing, r.status) for r in validate.gate(validate.validate(rules)).collect()}
    assert got["naming"] == (2, 1, "failure") and got["all"] == (10, 5, "failure")


def test_versions(spark):
    base = spark.createDataFrame([("a", "1.0.0"), ("b", "1.2.0"), ("c", None), ("gone", "1.0.0"), ("odd", "x")], "path string, version string")
    now = spark.createDataFrame([("a", "1.0.1"), ("b", "1.2.0"), ("c", "0.0.1"), ("new", "1.0.0"), ("odd", "1.0.0")], "path string, version string")
    got = {r.path: (r.state, r.error) for r in validate.version_changes(base, now).collect()}
    assert got == {
        "a": ("bumped", None), "b": ("not bumped", "version not bumped (1.2.0 -> 1.2.0)"), "c": ("bumped", None), "gone": ("deleted", None),
        "new": ("new", None), "odd": ("unreadable", "version is not numeric (x -> 1.0.0)"),
    }


def test_versions_without_a_base(spark, rows):
    now = spark.createDataFrame([("a", None), ("b", "1.0.0")], "path string, version string")
    assert rows(validate.version_changes(None, now)) == [("a", None, "0.0.0", "skipped", None), ("b", None, "1.0.0", "skipped", None)]


@pytest.mark.parametrize("path, want", [("sigma-rules/a/b.yml", True), ("sigma-rules/a/b.YAML", True), ("sigma-rules/a/b.meta.yml", False), ("docs/b.yml", False), ("sigma-rules/b.txt", False)])
def test_changed_rule(value, path, want):
    assert value(validate.is_changed_rule(F.lit(path))) is want


def test_links(spark, rows):
    rules = validate.with_document(spark.createDataFrame([(json.dumps({"references": ["http://a", 5, "ftp://b", "http://a", "httpx"]}),), ("{}",)], "rule_json string"))
    assert rows(validate.link_set(validate.rule_references(rules))) == [("http://a",), ("httpx",)]
    fetches = spark.createDataFrame(
        [("a", 200, None, None), ("b", 405, 200, None), ("c", 405, 404, None), ("d", 429, None, None), ("e", 503, None, None), ("f", 404, None, None), ("g", None, None, "timeout")],
        "link string, head_status int, get_status int, error string",
    )
    got = {r.link: r.outcome for r in validate.link_status(fetches).collect()}
    assert got == {"a": "ok", "b": "ok", "c": "failed", "d": "transient", "e": "transient", "f": "failed", "g": "failed"}


def test_misspellings(spark, rows):
    texts = spark.createDataFrame([("p", "Teh cat, teh KQL; don’t recieve-it"), ("q", "fine")], "path string, text string")
    dictionary = spark.createDataFrame([("teh", "the"), ("kql", "x"), ("don’t", "do not")], "word string, correction string")
    allowed = spark.createDataFrame([("KQL",)], "word string")
    assert rows(validate.misspellings(texts, dictionary, allowed)) == [("p", "don’t", "do not", 1), ("p", "teh", "the", 2)]


def test_rule_id_and_targets(spark, value):
    assert value(rule_id(F.lit(""), F.lit("a/b.c.yml"))) == "b.c" and value(rule_id(F.lit("x"), F.lit("a"))) == "x"
    rules = spark.createDataFrame([(None,), ([" SPLUNK ", ""],)], "targets array<string>")
    assert tuple(any_target(rules).collect()[0]) == (True, False, False, False)


def test_report(spark, rows):
    paths = ["sigma-rules/web/a.yml", "/x/sigma-rules/web/b.yaml", "sigma-rules/web/b.meta.yml", "sigma-rules/web/deep/c.yml", "sigma-rules/d.yml", "sigma-rules/macOS/e.yml"]
    found = report.rules_by_category(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert rows(found) == [("macOS", 1), ("web", 2)]
    queries = spark.createDataFrame([("o/a.kql", "kql"), ("o/a.kql.meta", "kql"), ("o/b.kql.error", "kql")], "path string, backend string")
    counts = report.converted_counts(spark, queries, ("kql", "splunk"))
    covered = report.coverage(counts, spark.range(3))
    assert rows(covered) == [("kql", 1, 3, 33.3), ("splunk", 0, 3, 0.0)]
    assert rows(report.coverage(counts, spark.range(0))) == [("kql", 1, 0, 0.0), ("splunk", 0, 0, 0.0)]
    lines = [r.line for r in report.report_lines(found, covered).orderBy("section", "key").collect()]
    assert "- **Macos**: 1 rules" in lines and "- Kql: 1/3 rules converted (33.3%)" in lines and lines[0].startswith("# ")


def test_catalogue(spark, rows):
    texts = spark.createDataFrame([
        ("t", '{"NAME": "T1", "Properties": [{"Name": "a:b", "Type": "BigInt", "Description": "say \\"name\\": x"}], "isResourceCentric": true}'),
        ("f", '{"FunctionName": "F1", "FunctionParameters": [{"Name": "p", "Type": "odd"}], "Query": "T1"}'), ("o", '{"Name": "x"}'), ("bad", "{"),
    ], "path string, text string")
    manifests = catalog.parse_manifests(texts).cache()
    assert {r.path: r.object_kind for r in manifests.collect()} == {"t": "table", "f": "function", "o": "other", "bad": "unreadable"}
    assert rows(catalog.schema_columns(manifests).select("object_name", "column_kind", "ordinal", "col_name", "col_type")) == [
        ("F1", "parameter", 0, "p", "unknown"), ("T1", "column", 0, "a:b", "long"), ("T1", "column", 1, "Type", "string"), ("T1", "column", 2, "_ResourceId", "string"),
    ]
    assert rows(catalog.function_bodies(manifests)) == [("F1", "T1")]
    assert rows(catalog.manifest_warnings(manifests)) == [("bad", "Skipping manifest bad")]


def test_diagnostics(spark):
    rows = [("a", "Error", "m", 2, 4, "abcdef"), ("a", "Warning", "n", 0, 1, "abcdef"), ("b", "Hint", "o", 0, 1, "x\ny")]
    lines = catalog.diagnostic_lines(spark.createDataFrame(rows, "file string, severity string, message string, start int, end int, query_text string"))
    assert sorted(r.text for r in lines.collect())[0] == "Error: m [2-4] near 'abcdef'"
    per_file = {r.file: (r.errors, r.warnings, r.status) for r in catalog.diagnostic_counts(lines, "file").collect()}
    assert per_file == {"a": (1, 1, "failure"), "b": (0, 1, "success")}
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    assert tuple(catalog.diagnostic_totals(files, lines).collect()[0]) == (3, 1, 3)


FORM_SCHEMA = ", ".join(f"{n} string" for n in (
    "category filename title rule_path rule_id status description references author date tags conversion_kql conversion_splunk conversion_elasticsearch "
    "logsource_product logsource_category logsource_service detection falsepositives level").split())


def test_submissions(spark):
    blank = dict.fromkeys([c.split()[0] for c in FORM_SCHEMA.split(", ")])
    full = {**blank, "category": "web", "title": "My Rule", "references": "a\n\n b ", "logsource_product": "windows", "logsource_category": ""}
    rows = [full, {**full, "category": "nope"}, {**full, "title": "!!"}, {**full, "filename": "given", "conversion_elasticsearch": "on", "rule_id": "i"}]
    made, rejected = forms.submissions(spark.createDataFrame(rows, FORM_SCHEMA), F.lit("2024-02-03").cast("date"))
    got = {r.path: r for r in made.collect()}
    first, second = got["sigma-rules/web/web_my_rule.yml"], got["sigma-rules/web/web_given.yml"]
    assert len(first.id) == 36 and first.references == ["a", "b"] and first.conversion_targets == ["kql", "splunk"] and first.logsource == {"product": "windows"}
    assert first.date == "2024/02/03" and json.loads(first.detection)["condition"] == "selection" and first.version == "0.1.0"
    assert second.conversion_targets == ["elasticsearch"] and second.id == "i"
    assert sorted(r.reason for r in rejected.collect()) == ["Filename or title required", "Invalid category"]


def test_gate_over_every_check(spark, rows):
    now = spark.createDataFrame([("a", "1.0.0"), ("b", "1.0.0rc1"), ("c", "1.0.0.post1")], "path string, version string")
    base = spark.createDataFrame([("a", "1.0.0rc1"), ("b", "1.0.0"), ("c", "1.0.0")], "path string, version string")
    versions = validate.as_check(validate.version_changes(base, now), "versions")
    assert rows(versions) == [("a", "versions", []), ("b", "versions", ["version not bumped (1.0.0 -> 1.0.0rc1)"]), ("c", "versions", [])]
    refs = spark.createDataFrame([("a", ["http://x", "http://x", "http://y", "ftp://x"]), ("b", []), ("c", None), ("d", ["http://z", None])], "path string, refs array<string>")
    fetched = spark.createDataFrame([("http://x", "failed"), ("http://x", "failed"), ("http://y", "ok"), ("http://z", "transient")], "link string, outcome string")
    links = validate.link_errors(refs, fetched)
    assert rows(links) == [("a", "links", ["Broken link: http://x"]), ("b", "links", []), ("c", "links", []), ("d", "links", [])]
    texts = spark.createDataFrame([("a", "teh cat, Teh dog"), ("b", "fine"), ("c", None)], "path string, text string")
    words = spark.createDataFrame([("teh", "the"), ("fine", "phine")], "word string, correction string")
    spelling = validate.spelling_errors(texts, words, spark.createDataFrame([("FINE",)], "word string"))
    assert rows(spelling) == [("a", "spelling", ["teh ==> the"]), ("b", "spelling", []), ("c", "spelling", [])]
    counted = {r.check: (r.checked, r.failing, r.status) for r in validate.gate(versions.unionByName(links).unionByName(spelling)).collect()}
    assert counted == {"versions": (3, 1, "failure"), "links": (4, 1, "failure"), "spelling": (3, 1, "failure"), "all": (10, 3, "failure")}


def test_the_gate_writes_no_check_into_a_filter(spark):
    """A filter on the list of checks would write all of them out again below the projection."""
    rules = spark.createDataFrame([("a", "{}", None)], "path string, rule_json string, error string")
    plan = validate.gate(validate.validate(rules))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 150_000 and "Filter" not in plan


def test_documents_of_many_parts(spark, rows):
    """Lines are numbered without gaps over several partitions, and only the first one lacks its comma."""
    outcomes = spark.range(500).selectExpr("concat('r', id % 250) AS rule_id", "concat('p/', id % 250) AS rule_path", "'kql' AS backend", "if(id % 3 = 0, 'failed', 'success') AS status", "concat('q', id) AS query_path", "concat('text ', id) AS query", "'' AS message")
    lines = conversion.bundle_lines(outcomes, "kql").orderBy("section", "key", F.regexp_replace("line", "^,", "")).collect()
    document = json.loads("".join(r.line for r in lines))
    assert len(document["rules"]) == 500 and document["metrics"] == {"failed_count": 167, "generated_count": 333, "processed_rules": 500, "skipped_count": 0}
    manifest = conversion.run_manifest_lines(outcomes, "kql").orderBy("section", "key").collect()
    assert len(json.loads("".join(r.line for r in manifest))["rules"]) == 250
    given = spark.range(1000).selectExpr("cast(id * 7919 % 1000 AS int) AS n", "'x' AS line").repartition(7)
    assert rows(artifacts.numbered(given, F.col("n").desc()).select("n", "line_no")) == sorted([(i, 999 - i) for i in range(1000)], key=repr)
    assert artifacts.numbered(given.where("false"), "n").collect() == [] and conversion.bundle_lines(outcomes.where("false"), "kql").collect() == []
