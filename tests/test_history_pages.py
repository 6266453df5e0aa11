import json

from pyspark.sql import functions as F

from nightglass.functions.times import parse_offset_time
from nightglass.operators import changelog as ch
from nightglass.operators import pages
from nightglass.operators.validate import with_document

COMMITS = [
    ("abcdef1234567890", "Ann", "2026-03-27T12:00:00+00:00", "Update rule"), ("bbb", "Bob", "2026-03-31T23:30:00-04:00", "Move"),
    ("ccc", "Cy", "2026-02-01T00:00:00Z", "Add"),
]
FILES = [
    ("abcdef1234567890", "M", "sigma-rules/endpoint/example.yml", None, "-detection:\n+detection:\n +title : x\n"),
    ("abcdef1234567890", "M", "sigma-rules/endpoint/other.yml", None, "@@ shuffle @@"), ("bbb", "R100", "sigma-rules/a/x.yml", "sigma-rules/b/x.yml", None),
    ("bbb", "R090", "sigma-rules/a/y.yml", "sigma-rules/a/z.yml", None), ("ccc", "A", "sigma-rules/a/new.yml", None, None), ("ccc", "T", "sigma-rules/a/odd.yml", None, None),
]


def changes(spark, files=FILES):
    commits = spark.createDataFrame(COMMITS, "commit string, author string, datetime string, message string")
    frame = spark.createDataFrame(files, "commit string, code string, file string, new_file string, diff string")
    return ch.change_rows(commits, frame).withColumn("changed_at", parse_offset_time(F.col("datetime")))


def test_diff_labels(value):
    diff = "\n+title: Updated\n-description: old\n+description: new\n-level: low\n-detection:\n+detection:\n"
    assert value(ch.diff_labels(F.lit(diff))) == ["Title updated", "Description updated", "Severity changed", "Detection logic updated"]
    assert value(ch.diff_labels(F.lit("@@ metadata shuffle @@"))) == ["Misc rule metadata updated"]
    assert value(ch.diff_labels(F.lit(" title: x\n+ my title: y"))) == ["Misc rule metadata updated"]


def test_change_rows(spark, rows):
    assert rows(changes(spark).select("file", "status", "change")) == [
        ("sigma-rules/a/new.yml", "Created", ""), ("sigma-rules/a/odd.yml", "T", ""), ("sigma-rules/a/x.yml", "Moved", "Moved to sigma-rules/b"),
        ("sigma-rules/a/y.yml", "Renamed", "Renamed to sigma-rules/a/z.yml"), ("sigma-rules/endpoint/example.yml", "Modified", "Detection logic updated"),
        ("sigma-rules/endpoint/example.yml", "Modified", "Title updated"), ("sigma-rules/endpoint/other.yml", "Modified", "Misc rule metadata updated"),
    ]
    counts = ch.change_counts(changes(spark)).collect()[0]
    assert (counts.commit_count, counts.change_count) == (3, 7)


def test_rendered_changelog(spark):
    lines = [r.line for r in ch.in_line_order(ch.changelog_lines(changes(spark), "month", "https://git.example/repo")).collect()]
    assert lines == [
        "# Rule Changelog", "",
        "## 2026-04-01 to 2026-05-01", "",
        "### Moved", "- `sigma-rules/a/x.yml` - Moved to sigma-rules/b ([bbb](https://git.example/repo/commit/bbb), Bob: Move)", "",
        "### Renamed", "- `sigma-rules/a/y.yml` - Renamed to sigma-rules/a/z.yml ([bbb](https://git.example/repo/commit/bbb), Bob: Move)", "",
        "## 2026-03-01 to 2026-04-01", "",
        "### Modified",
        "- `sigma-rules/endpoint/example.yml` - Title updated ([abcdef1](https://git.example/repo/commit/abcdef1234567890), Ann: Update rule)",
        "- `sigma-rules/endpoint/example.yml` - Detection logic updated ([abcdef1](https://git.example/repo/commit/abcdef1234567890), Ann: Update rule)",
        "- `sigma-rules/endpoint/other.yml` - Misc rule metadata updated ([abcdef1](https://git.example/repo/commit/abcdef1234567890), Ann: Update rule)", "",
        "## 2026-02-01 to 2026-03-01", "",
        "### Created", "- `sigma-rules/a/new.yml` ([ccc](https://git.example/repo/commit/ccc), Cy: Add)", "",
        "### Other", "- `sigma-rules/a/odd.yml` ([ccc](https://git.example/repo/commit/ccc), Cy: Add)", "",
    ]


def test_empty_changelog(spark):
    lines = [r.line for r in ch.in_line_order(ch.changelog_lines(changes(spark).where("false"), "week")).collect()]
    assert lines == ["# Rule Changelog", "", "No Sigma rule changes found for the requested time range."]


def test_parsed_lines(spark, rows):
    lines = spark.createDataFrame([("c\tM\tsigma-rules/a/b.yml",), ("c\tR100\tsigma-rules/a/b.yml\tsigma-rules/c/b.yaml",), ("c\tA\tdocs/b.yml",), ("c\tA\tsigma-rules/top.yml",), ("bad",)], "line string")
    assert rows(ch.parse_file_changes(lines)) == [("c", "M", "sigma-rules/a/b.yml", None), ("c", "R100", "sigma-rules/a/b.yml", "sigma-rules/c/b.yaml")]
    commits = ch.parse_commits(spark.createDataFrame([("sha\x1fAnn\x1f2026-01-01T00:00:00Z\x1fsub\x1fject",)], "line string"))
    assert rows(commits) == [("sha", "Ann", "2026-01-01T00:00:00Z", "sub\x1fject")]


def test_date_range(spark):
    made = spark.createDataFrame([(c, t) for c, _, t, _ in COMMITS], "commit string, t string").withColumn("at", parse_offset_time(F.col("t")))
    assert [r.commit for r in ch.in_range(made, "at", "2026-02-15", "2026-03-31").collect()] == ["abcdef1234567890"]
    assert ch.in_range(made, "at").count() == 3


PAGE = """# Odd Query

**Rule ID:** i1  
**Status:** test  
**Version:** 1.0.0  
**Owner:** team

## Description
Finds it

## Log Source
- Product: windows
- Category: dns_query
- Service: n/a

## Tags
- attack.a
- attack.b


## References
- https://a.example


## False Positives
- none
"""


def test_page_and_overlay(spark):
    doc = {"title": "Odd Query", "id": "i1", "status": "test", "version": "1.0.0", "description": "Finds it", "logsource": {"product": "windows", "category": "dns_query"},
           "tags": ["attack.a", "attack.b"], "references": ["https://a.example"], "falsepositives": ["none"]}
    rules = with_document(spark.createDataFrame([("r/a/odd.yml", json.dumps(doc)), ("r/a/bare.yaml", '{"level": null, "status": null}')], "path string, rule_json string"))
    meta = spark.createDataFrame([("r/a/odd.meta.yml", "team"), ("r/b/odd.meta.yml", "other")], "path string, owner string")
    got = {r.path: r.page for r in pages.with_meta(rules, meta).select("path", pages.detection_page(F.col("path"), F.col("doc"), F.col("owner")).alias("page")).collect()}
    assert got["r/a/odd.yml"] == PAGE
    assert got["r/a/bare.yaml"].startswith("# bare\n\n**Rule ID:**   \n**Status:** None  \n") and "- Product: n/a\n" in got["r/a/bare.yaml"]


def test_index(spark):
    rules = spark.createDataFrame([("r/b.yml",), ("r/a.yml",), ("r/a.meta.yml",)], "path string")
    lines = [r.line for r in pages.index_lines(rules).orderBy("section", "key").collect()]
    assert lines == ["# Documentation Index", "", "## Detections", "- documentation/detections/a.md", "- documentation/detections/b.md"]


def test_release_notes(spark):
    tags = spark.createDataFrame([("v1", 10), ("v2", 20), ("v3", 30)], "name string, created int")
    commits = spark.createDataFrame([("aaaaaaaaa", 15, "A", "one"), ("bbbbbbbbb", 21, "B", "two"), ("ccccccccc", 30, "C", "three"), ("d", 31, "D", "x")], "commit string, at int, author string, message string")
    lines = [r.line for r in pages.release_notes(tags, commits).orderBy("section", F.col("at").desc()).collect()]
    assert lines == ["# Release Notes: v3", "", "Changes since v2:", "", "* ccccccc three (C)", "* bbbbbbb two (B)"]
    assert pages.release_notes(tags.limit(1), commits).count() == 0
