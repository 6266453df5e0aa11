"""Queries of file contents, stage records and written results, over rows derived from the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from nightglass.operators import conversion, expect, report, validate
from nightglass.plans import standins as st
from nightglass.plans.corpus import SQL_ALL, category_rows, converted_rows, documents, link_status, outcomes, sql_words, version_bump
from nightglass.plans.registry import ORACLE, query, table
from nightglass.session import run_folder
from nightglass.sinks import artifacts
from nightglass.sources import files

# ---- rule files, query files, expectations -------------------------------------------------------

YAML = """CASE doc_id % 7 WHEN 0 THEN 'title: [' WHEN 1 THEN '' WHEN 2 THEN NULL
  ELSE 'title: ' || source || ' rule' || chr(10) || 'number: ' || doc_id || chr(10) || 'tags:' || chr(10) || '  - attack.' || lang || chr(10) || 'date: 2024-01-05' || chr(10) END"""
SQL_YAML = """CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN 'null'
  ELSE '{"title": "' || source || ' rule", "number": ' || doc_id || ', "tags": ["attack.' || lang || '"], "date": "2024-01-05"}' END"""


@query("rule_files", f"SELECT {st.RULE_PATH} AS path, {SQL_YAML} AS rule_json, doc_id % 7 = 0 AS unreadable FROM documents")
def rule_files(spark, folder):
    """Rule texts in YAML to JSON documents; one that cannot be parsed keeps its row."""
    texts = documents(spark, folder).selectExpr(f"{st.RULE_PATH} AS path", f"{YAML} AS text")
    return files.parse_yaml(texts).select("path", "rule_json", F.col("error").isNotNull().alias("unreadable"))


@query("query_files", f"SELECT count(*) AS files_checked, CASE WHEN count(*) = 0 THEN 'No query files found' END AS warning FROM (SELECT {st.QUERY_PATH} AS path FROM documents) WHERE path LIKE '%.query'")
def query_files(spark, folder):
    return files.query_files_found(st.query_rows(documents(spark, folder)).where(F.col("path").endswith(".query")))


SAVED_PATH = "CASE WHEN doc_id % 3 = 0 THEN 'saved/' || doc_id || '.JSON' ELSE 'saved/' || doc_id || '.kql' END"


@query(
    "saved_queries",
    f"""SELECT {SAVED_PATH} AS path, CASE WHEN doc_id % 3 > 0 THEN text WHEN doc_id % 2 = 0 THEN 'T | where lang == ' || lang ELSE '' END AS query_text FROM documents""",
)
def saved_queries(spark, folder):
    saved = """CASE WHEN doc_id % 3 > 0 THEN text WHEN doc_id % 2 = 0 THEN '{"properties":{"query":"T | where lang == ' || lang || '"}}' ELSE '{"properties":{}}' END"""
    rows = documents(spark, folder).selectExpr(f"{SAVED_PATH} AS path", f"{saved} AS saved")
    return rows.select("path", files.saved_rule_query(F.col("path"), F.col("saved")).alias("query_text"))


@query(
    "expectation_rows",
    """SELECT backend, query_key, min_rows, max_rows, description FROM (
         SELECT 'kql' AS backend, 'q' || doc_id || '.kql' AS query_key, doc_id AS min_rows, CAST(NULL AS BIGINT) AS max_rows, lang AS description FROM documents WHERE doc_id % 4 = 0
         UNION ALL SELECT 'splunk', 'q' || doc_id || '.spl', NULL, doc_id + 1, NULL FROM documents WHERE doc_id % 4 IN (0, 1))""",
)
def expectation_rows(spark, folder):
    """Expectation documents, with back ends that hold no entries and entries that hold nothing."""
    text = """CASE doc_id % 4
      WHEN 0 THEN '{"kql":{"q' || doc_id || '.kql":{"min":' || doc_id || ',"description":"' || lang || '"},"none":null},"splunk":{"q' || doc_id || '.spl":{"max":' || (doc_id + 1) || '}}}'
      WHEN 1 THEN '{"splunk":{"q' || doc_id || '.spl":{"max":' || (doc_id + 1) || '}},"kql":null}'
      WHEN 2 THEN '[]' END"""
    return files.expectations_of(documents(spark, folder).selectExpr(f"{text} AS rule_json"))


# ---- stages and results --------------------------------------------------------------------------

STAGES = """SELECT 'q' || (user_id % 500) AS query_file, event_type AS stage, CASE WHEN event_id % 5 = 0 THEN 'failure' ELSE 'success' END AS status,
  event_id % 100 AS row_count, event_id % 1000 AS duration_ms FROM events"""


def stages(spark, folder):
    table(spark, folder, "events").createOrReplaceTempView("_events_for_stages")
    rows = spark.sql(STAGES.replace("FROM events", "FROM _events_for_stages"))
    return rows.withColumn("errors", F.when(F.col("status") == "failure", F.array(F.lit("broken"))).otherwise(F.array().cast("array<string>")))


@query(
    "stage_records",
    f"""SELECT query_file, stage, s.status AS status, s.row_count AS row_count, s.duration_ms AS duration_ms FROM (
          SELECT query_file, stage, max({{'status': status, 'row_count': row_count, 'duration_ms': duration_ms}}) AS s FROM ({STAGES}) GROUP BY query_file, stage)""",
)
def stage_records(spark, folder):
    """Stages listed again and again: the greatest entry of each stays."""
    records = expect.stage_record(stages(spark, folder))
    return records.select("query_file", F.explode("stages").alias("stage", "s")).select("query_file", "stage", "s.status", "s.row_count", "s.duration_ms")


@query(
    "compact_summaries",
    f"""SELECT status, stage, CASE WHEN row_count % 2 = 0 THEN 'kql' ELSE '' END AS backend, CASE WHEN row_count % 3 = 0 THEN 0 ELSE row_count END AS row_count,
        duration_ms, CASE WHEN status = 'failure' THEN 'broken' ELSE '' END AS errors FROM ({STAGES})""",
)
def compact_summaries(spark, folder):
    n = F.col("row_count")
    metrics = F.when(n % 3 == 0, F.create_map(F.lit("duration_ms"), "duration_ms")).otherwise(F.create_map(F.lit("duration_ms"), "duration_ms", F.lit("row_count"), "row_count"))
    errors = F.when(F.size("errors") > 0, F.col("errors"))
    rows = stages(spark, folder).select("status", "stage", F.when(n % 2 == 0, "kql").alias("backend"), metrics.alias("metrics"), errors.alias("errors"))
    return expect.compact_summary(rows).withColumn("errors", F.array_join("errors", ","))


@query("empty_queries", f"SELECT doc_id, CASE WHEN trim(coalesce(query_text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 'Query file is empty' END AS error FROM (SELECT doc_id, {st.QUERY_TEXT} AS query_text FROM documents)")
def empty_queries(spark, folder):
    return expect.refuse_empty(st.query_rows(documents(spark, folder))).select("doc_id", "error")


@query(
    "result_lines",
    f"""SELECT '{{"artifacts":{{}},"backend":"kql","context":{{}},"errors":[],"metrics":{{"row_count":' || row_count || '}},"rule_id":' ||
        CASE WHEN row_count % 2 = 0 THEN 'null' ELSE '"r' || row_count || '"' END || ',"stage":"' || stage || '","status":"' || status || '","timestamp_utc":"","warnings":[]}}' AS line FROM ({STAGES})""",
)
def result_lines(spark, folder):
    """Result artifacts as they are written, without their clock."""
    n = F.col("row_count")
    rule = F.when(n % 2 == 1, F.concat(F.lit("r"), n))
    rows = stages(spark, folder).select(rule.alias("rule_id"), "stage", "status", F.lit("kql").alias("backend"), F.create_map(F.lit("row_count"), n).alias("metrics"))
    lines = artifacts.result_json(artifacts.operation_results(rows))
    return lines.select(F.regexp_replace("line", r'"timestamp_utc":"[^"]*"', '"timestamp_utc":""').alias("line"))


SQL_RULE_LINE = """'{"errors":[' || coalesce(string_agg('"' || CASE WHEN message = '' THEN 'conversion failed' ELSE message END || '"', ',') FILTER (status = 'failed'), '')
  || '],"generated":[' || coalesce(string_agg('"kql"', ',') FILTER (status = 'success'), '') || '],"outputs":{' ||
  coalesce(string_agg('"kql":"' || query_path || '"', ',') FILTER (status = 'success'), '') || '},"rule_id":"' || rule_id || '","skipped":[' ||
  coalesce(string_agg('"kql"', ',') FILTER (status = 'skipped'), '') || ']}'"""


@query(
    "run_manifest",
    f"""WITH o AS (SELECT * FROM {st.SQL_OUTCOMES} WHERE backend = 'kql'),
        c AS (SELECT count(*) FILTER (status = 'failed') AS f, count(*) FILTER (status = 'success') AS g, count(*) FILTER (status = 'skipped') AS s FROM o)
        SELECT 0 AS section, '' AS key, '{{"backend":"kql","failed_count":' || f || ',"generated_count":' || g || ',"skipped_count":' || s || ',"status":"'
          || CASE WHEN f > 0 THEN 'failure' ELSE 'success' END || '","rules":[' AS line FROM c
        UNION ALL SELECT 1, rule_id, CASE WHEN rule_id = (SELECT min(rule_id) FROM o) THEN '' ELSE ',' END || {SQL_RULE_LINE} FROM o GROUP BY rule_id
        UNION ALL SELECT 2, '', ']}}'""",
)
def run_manifest(spark, folder):
    return conversion.run_manifest_lines(outcomes(spark, folder), "kql")


# ---- sinks ---------------------------------------------------------------------------------------


@query("lines_written", f"SELECT '- **' || upper(left(category, 1)) || substr(category, 2) || '**: ' || rules || ' rules' AS line FROM ({ORACLE['category_counts']})")
def lines_written(spark, folder):
    """The category lines of the report, written as text and read back."""
    categories = category_rows(spark, folder)
    covered = report.coverage(converted_rows(spark, folder), documents(spark, folder).select("doc_id"))
    path = run_folder(spark, "report")
    artifacts.write_lines(report.report_lines(categories, covered), path, "section", "key")
    return spark.read.text(path).select(F.col("value").alias("line")).where("line LIKE '- **%**: % rules'")


@query("events_written", "SELECT event_type, 2 * count(*) AS events, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def events_written(spark, folder):
    """The target is dropped and made anew, then appended to; partitions are read back."""
    path, events = run_folder(spark, "events"), table(spark, folder, "events").select("event_id", "event_type")
    artifacts.write_events(events.where("event_id % 2 = 0"), path, "event_type")
    artifacts.write_events(events, path, "event_type")
    artifacts.write_events(events, path, "event_type", append=True)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("events"), F.countDistinct("event_id").alias("ids"))


# ---- the contract of side documents --------------------------------------------------------------

META = """CASE doc_id % 5 WHEN 0 THEN '[]' WHEN 1 THEN '{"version":"1.0.0","owner":"' || lang || '","status":"stable"}' WHEN 2 THEN '{"version":1,"owner":"x"}'
  WHEN 3 THEN '{"version":"1","owner":"x","status":"s","last_modified":5}' END"""


@query(
    "meta_contract",
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '[] is not of type ''object''' WHEN 1 THEN '' WHEN 2 THEN '''status'' is a required property | 1 is not of type ''string'''
         WHEN 3 THEN '5 is not of type ''string''' ELSE 'None is not of type ''object''' END AS errors FROM documents""",
)
def meta_contract(spark, folder):
    rows = validate.with_document(documents(spark, folder).selectExpr("doc_id", f"{META} AS rule_json"))
    return rows.select("doc_id", F.array_join(validate.contract_errors(F.col("doc"), validate.META_CONTRACT), " | ").alias("errors"))


# ---- the whole gate ------------------------------------------------------------------------------

SQL_GATE = f"""SELECT path, check_name, errors <> '' AS bad FROM ({SQL_ALL})
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'meta', errors <> '' FROM ({ORACLE['meta_contract']})
  UNION ALL SELECT path, 'versions', state IN ('not bumped', 'unreadable') FROM ({ORACLE['version_bump']}) WHERE state <> 'deleted'
  UNION ALL SELECT CAST(page_id AS VARCHAR), 'links', bool_or(outcome = 'failed') FROM (SELECT page_id, outcome FROM pages JOIN ({ORACLE['link_status']}) ON link = url) GROUP BY page_id
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'spelling', coalesce(bool_or(word IN (SELECT {sql_words('text')} FROM benchmark) AND word NOT IN (SELECT {sql_words('url')} FROM pages)), FALSE)
    FROM documents LEFT JOIN (SELECT doc_id, {sql_words('text')} AS word FROM documents) USING (doc_id) GROUP BY doc_id"""


@query(
    "rule_gate_all",
    f"""SELECT coalesce(check_name, 'all') AS "check", count(*) AS checked, count(*) FILTER (bad) AS failing,
        CASE WHEN count(*) FILTER (bad) > 0 THEN 'failure' ELSE 'success' END AS status FROM ({SQL_GATE}) GROUP BY ROLLUP (check_name)""",
)
def rule_gate_all(spark, folder):
    """Every check in one gate: the five of a rule document, its side document, versions against the base, links and spelling."""
    meta = validate.with_document(documents(spark, folder).selectExpr("CAST(doc_id AS STRING) AS path", f"{META} AS rule_json"))
    words = lambda name, column: table(spark, folder, name).select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(validate.WORD_PATTERN), F.lit(0))).alias("word")).distinct()
    references = table(spark, folder, "pages").select(F.col("page_id").cast("string").alias("path"), F.array("url", F.lit("ftp://x")).alias("refs"))
    parts = [
        validate.validate(st.rule_rows(documents(spark, folder))),
        meta.select("path", F.lit("meta").alias("check"), validate.contract_errors(F.col("doc"), validate.META_CONTRACT).alias("errors")),
        validate.as_check(version_bump(spark, folder).where("state <> 'deleted'"), "versions"),
        validate.link_errors(references, link_status(spark, folder)),
        validate.spelling_errors(
            documents(spark, folder).select(F.col("doc_id").cast("string").alias("path"), "text"), words("benchmark", "text").withColumn("correction", F.reverse("word")), words("pages", "url")
        ),
    ]
    return validate.gate(reduce(DataFrame.unionByName, parts))
