"""Queries of generated pages, the schema catalogue, diagnostics, submissions and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightglass.functions.text import slug, snippet, text_lines
from nightglass.operators import catalog, forms, pages
from nightglass.plans import standins as st
from nightglass.plans.corpus import is_list, js, jt, rules, sql_lines, sql_strip
from nightglass.plans.registry import query, spread_table, table
from nightglass.session import run_folder
from nightglass.sinks import artifacts
from nightglass.sources import events as ev


def documents(spark, folder):
    return spread_table(spark, folder, "documents")


# ---- pages ---------------------------------------------------------------------------------------


def shown(name: str, default: str) -> str:
    return f"CASE WHEN {jt(name)} = 'NULL' THEN 'None' ELSE coalesce({js(name)}, {default}) END"


def bullets(name: str) -> str:
    items = f"[('- ' || x || chr(10)) FOR x IN from_json(json_extract(j, '$.{name}'), '[\"VARCHAR\"]')]"
    return f"CASE WHEN {is_list(name)} THEN array_to_string({items}, '') ELSE '' END"


SQL_PAGE = " || ".join(
    [
        "'# '", shown("title", f"{st.RULE_CATEGORY} || '_' || {st.RULE_NAME}"),
        "chr(10) || chr(10) || '**Rule ID:** '", shown("id", "''"),
        "'  ' || chr(10) || '**Status:** '", shown("status", "''"),
        "'  ' || chr(10) || '**Version:** '", shown("version", "''"),
        "'  ' || chr(10) || '**Owner:** '", "coalesce('team' || quality, '')",
        "chr(10) || chr(10) || '## Description' || chr(10)", shown("description", "''"),
        "chr(10) || chr(10) || '## Log Source' || chr(10) || '- Product: '", shown("logsource.product", "'n/a'"),
        "chr(10) || '- Category: '", shown("logsource.category", "'n/a'"),
        "chr(10) || '- Service: '", shown("logsource.service", "'n/a'"),
        "chr(10) || chr(10) || '## Tags' || chr(10)", bullets("tags"),
        "chr(10) || chr(10) || '## References' || chr(10)", bullets("references"),
        "chr(10) || chr(10) || '## False Positives' || chr(10)", bullets("falsepositives"),
    ]
)


@query(
    "detection_page",
    f"""SELECT doc_id, md5(page) AS digest, length(page) AS size FROM (SELECT doc_id, {SQL_PAGE} AS page
        FROM {st.SQL_RULES} JOIN documents USING (doc_id) LEFT JOIN labels USING (doc_id))""",
)
def detection_page(spark, folder):
    owners = documents(spark, folder).join(table(spark, folder, "labels"), "doc_id").selectExpr(
        f"regexp_replace({st.RULE_PATH}, '[.]yml$', '.meta.yml') AS path", "'team' || quality AS owner"
    )
    overlaid = pages.with_meta(rules(spark, folder), owners)
    page = overlaid.select("doc_id", pages.detection_page(F.col("path"), F.col("doc"), F.col("owner")).alias("page"))
    return page.select("doc_id", F.md5("page").alias("digest"), F.length("page").cast("bigint").alias("size"))


@query(
    "docs_index",
    f"""SELECT section, '' AS key, line FROM (VALUES (0, '# Documentation Index'), (1, ''), (2, '## Detections')) v(section, line)
        UNION ALL SELECT 3, path, '- documentation/detections/' || {st.RULE_CATEGORY} || '_' || {st.RULE_NAME} || '.md' FROM (SELECT *, {st.RULE_PATH} AS path FROM documents)""",
)
def docs_index(spark, folder):
    return pages.index_lines(documents(spark, folder).selectExpr(f"{st.RULE_PATH} AS path"))


# ---- catalogue -----------------------------------------------------------------------------------

TYPE = "CASE p_partkey % 7 WHEN 0 THEN 'BigInt' WHEN 1 THEN 'URI' WHEN 2 THEN ' Date Time ' WHEN 3 THEN 'curie' WHEN 4 THEN 'Dynamic' WHEN 5 THEN p_type ELSE 'String' END"
SQL_NORMAL = "replace(replace(replace(lower({}), 'bigint', 'long'), 'uri', 'string'), ' ', '')"
SYMBOLS = "('" + "', '".join(catalog.SCALAR_TYPES) + "')"
SQL_SYMBOL = f"CASE WHEN {SQL_NORMAL} IN {SYMBOLS} THEN {SQL_NORMAL} ELSE 'unknown' END"


@query("type_normalise", f"SELECT p_partkey, {SQL_NORMAL.format(TYPE)} AS name, {SQL_SYMBOL.format(TYPE, TYPE)} AS symbol FROM part")
def type_normalise(spark, folder):
    named = table(spark, folder, "part").selectExpr("p_partkey", f"{TYPE} AS t")
    return named.select("p_partkey", catalog.normalise_type(F.col("t")).alias("name"), catalog.type_symbol(F.col("t")).alias("symbol"))


OBJECT = "'obj' || p_partkey"
MANIFEST = f"""CASE p_partkey % 6
  WHEN 0 THEN '{{"Name":"' || {OBJECT} || '","PROPERTIES":[{{"Name":"' || p_brand || '","Type":"' || {TYPE} || '","Description":"' || p_name || '"}}],"IsResourceCentric":true}}'
  WHEN 1 THEN '{{"name": "' || {OBJECT} || '", "properties" : [{{"name":"_ResourceId","type":"string"}},{{"NAME":"Id","TYPE":"' || {TYPE} || '"}}], "isResourceCentric":true}}'
  WHEN 2 THEN '{{"FunctionName":"' || {OBJECT} || '","FunctionParameters":[{{"Name":"p","Type":"' || {TYPE} || '"}}],"FunctionResultColumns":[{{"Name":"c","Type":"long"}}],"Query":"q' || p_size || '"}}'
  WHEN 3 THEN '{{"FunctionName":"' || {OBJECT} || '","FunctionParameters":[],"Query":"T | where size == ' || p_size || '"}}'
  WHEN 4 THEN '{{"Name":"' || {OBJECT} || '"}}' ELSE '{{"Name": ' || {OBJECT} END"""


def manifests(spark, folder):
    return catalog.parse_manifests(table(spark, folder, "part").selectExpr("p_partkey AS path", f"{MANIFEST} AS text"))


def sql_column(kind: str, column_kind: str, ordinal: int, name: str, typ: str, description: str, where: str) -> str:
    return f"""SELECT {OBJECT} AS object_name, '{kind}' AS object_kind, '{column_kind}' AS column_kind, {ordinal} AS ordinal, {name} AS col_name,
      {SQL_SYMBOL.format(typ, typ)} AS col_type, {description} AS description FROM part WHERE p_partkey % 6 = {where}"""


@query(
    "schema_columns",
    " UNION ALL ".join(
        [
            sql_column("table", "column", 0, "p_brand", TYPE, "p_name", "0"),
            sql_column("table", "column", 1, "'Type'", "'String'", "NULL", "0"),
            sql_column("table", "column", 2, "'_ResourceId'", "'String'", "NULL", "0"),
            sql_column("table", "column", 0, "'_ResourceId'", "'string'", "NULL", "1"),
            sql_column("table", "column", 1, "'Id'", TYPE, "NULL", "1"),
            sql_column("table", "column", 2, "'Type'", "'String'", "NULL", "1"),
            sql_column("function", "parameter", 0, "'p'", TYPE, "NULL", "2"),
            sql_column("function", "result", 0, "'c'", "'long'", "NULL", "2"),
        ]
    ),
)
def schema_columns(spark, folder):
    return catalog.schema_columns(manifests(spark, folder))


@query(
    "function_bodies",
    f"SELECT {OBJECT} AS object_name, CASE WHEN p_partkey % 6 = 3 THEN 'T | where size == ' || p_size END AS body FROM part WHERE p_partkey % 6 IN (2, 3)",
)
def function_bodies(spark, folder):
    return catalog.function_bodies(manifests(spark, folder))


@query("manifest_warnings", "SELECT p_partkey AS path, 'Skipping manifest ' || p_partkey AS warning FROM part WHERE p_partkey % 6 = 5")
def manifest_warnings(spark, folder):
    return catalog.manifest_warnings(manifests(spark, folder))


DIAGNOSTIC = [
    "source AS file",
    "CASE doc_id % 3 WHEN 0 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'error' END AS severity",
    "'message ' || (doc_id % 4) AS message",
    "CAST(CASE doc_id % 5 WHEN 0 THEN 0 WHEN 1 THEN length(text) ELSE floor(length(text) / 2) END AS INT) AS start",
    "text AS query_text",
]
SQL_DIAGNOSTIC = f"(SELECT *, start + (doc_id % 9) AS stop FROM (SELECT doc_id, {', '.join(DIAGNOSTIC)} FROM documents))"
SQL_SNIPPET = """replace(replace(substr(query_text, greatest(start - 15, 0) + 1, least(stop + 15, length(query_text)) - greatest(start - 15, 0)), chr(13), ' '), chr(10), ' ')"""
SQL_DIAGNOSTIC_LINES = f"""SELECT file, lower(severity) = 'error' AS is_error, severity || ': ' || message || ' [' || start || '-' || stop || '] near ''' || {SQL_SNIPPET} || '''' AS text
  FROM {SQL_DIAGNOSTIC}"""


def diagnostics(spark, folder):
    rows = documents(spark, folder).selectExpr("doc_id", *DIAGNOSTIC)
    return rows.withColumn("end", (F.col("start") + F.col("doc_id") % 9).cast("int"))


@query("snippet", f"SELECT doc_id, {SQL_SNIPPET} AS near FROM {SQL_DIAGNOSTIC}")
def snippets(spark, folder):
    return diagnostics(spark, folder).select("doc_id", snippet(F.col("query_text"), F.col("start"), F.col("end")).alias("near"))


@query("diagnostics", SQL_DIAGNOSTIC_LINES)
def diagnostic_lines(spark, folder):
    return catalog.diagnostic_lines(diagnostics(spark, folder))


@query(
    "diagnostic_counts",
    f"""SELECT file, count(*) FILTER (is_error) AS errors, count(*) FILTER (NOT is_error) AS warnings,
        CASE WHEN bool_or(is_error) THEN 'failure' ELSE 'success' END AS status FROM ({SQL_DIAGNOSTIC_LINES}) GROUP BY file""",
)
def diagnostic_counts(spark, folder):
    return catalog.diagnostic_counts(catalog.diagnostic_lines(diagnostics(spark, folder)), "file")


@query(
    "diagnostic_totals",
    f"""SELECT count(DISTINCT doc_id) AS files_checked, count(*) FILTER (lower(severity) = 'error') AS failed_files, count(*) AS diagnostics_count FROM {SQL_DIAGNOSTIC}""",
)
def diagnostic_totals(spark, folder):
    lines = catalog.diagnostic_lines(diagnostics(spark, folder).withColumn("file", F.col("doc_id").cast("string")))
    return catalog.diagnostic_totals(documents(spark, folder).select(F.col("doc_id").cast("string").alias("file")), lines)


@query(
    "result_zip",
    """SELECT event_id, r AS row_no, CASE WHEN r = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS a,
       CASE WHEN r = 0 THEN props END AS b, CAST(NULL AS VARCHAR) AS c FROM events, (SELECT unnest([0, 1]) AS r) WHERE event_id % 4 <> 0""",
)
def result_zip(spark, folder):
    """Answers with a PrimaryResult of three names; rows are shorter or longer than that."""
    answers = table(spark, folder, "events").selectExpr(
        "event_id",
        """array(
          named_struct('name', 'Other', 'columns', array(named_struct('name', 'z')), 'rows', array(array('0'))),
          named_struct('name', if(event_id % 4 = 0, 'Second', 'PrimaryResult'), 'columns', array(named_struct('name', 'a'), named_struct('name', 'b')),
            'rows', array(array(event_type, props, 'dropped'), array(cast(user_id as string))))) AS tables""",
    )
    cell = lambda n: F.try_element_at("row", F.lit(n)).alias(n)
    return catalog.primary_rows(answers).select("event_id", "row_no", cell("a"), cell("b"), cell("c"))


# ---- submissions ---------------------------------------------------------------------------------

SQL_SLUG = "trim(regexp_replace(regexp_replace(lower({}), '[^a-zA-Z0-9_]+', '_', 'g'), '_+', '_', 'g'), '_')"


@query("form_slug", f"SELECT doc_id, {SQL_SLUG.format(sql_strip('text'))} AS slug FROM documents")
def form_slug(spark, folder):
    return documents(spark, folder).select("doc_id", slug(F.col("text")).alias("slug"))


RAW_LINES = "'  ' || lang || ' ' || chr(10) || chr(13) || chr(10) || text || chr(9)"


@query("form_lists", f"SELECT doc_id, len(l) AS items, md5(array_to_string(l, '|')) AS digest FROM (SELECT doc_id, {sql_lines(RAW_LINES)} AS l FROM documents)")
def form_lists(spark, folder):
    lines = documents(spark, folder).selectExpr("doc_id", f"{RAW_LINES} AS t").select("doc_id", text_lines(F.col("t")).alias("l"))
    return lines.select("doc_id", F.size("l").cast("bigint").alias("items"), F.md5(F.array_join("l", "|")).alias("digest"))


FORM = {
    "category": st.texts("doc_id", ["endpoint", "cloud", "web", "other", None, "macos"]),
    "filename": st.cases("doc_id", ["''", "NULL", "'My File ' || doc_id", "' -- '"]),
    "title": st.cases("doc_id", ["''", "source || ' / ' || lang || doc_id", "'Title ' || doc_id"]),
    "rule_path": st.cases("doc_id", ["'sigma-rules/given/' || doc_id || '.yml'"] + ["''"] * 7),
    "rule_id": "'id-' || doc_id",
    "status": "'test'",
    "description": "text",
    "references": "'https://a.example/' || doc_id || chr(10) || ' ' || chr(10) || 'https://b.example '",
    "author": "lang",
    "date": st.texts("doc_id", ["2024/02/03", "", None]),
    "tags": "'attack.' || lang",
    "falsepositives": "''",
    "detection": st.cases("doc_id", ["''", "'   '", "'pick:' || chr(10) || '  user: ' || lang || chr(10) || 'condition: pick'", "NULL", "'{\"pick\":{\"user\":\"' || lang || '\"},\"condition\":\"pick\"}'", "'- a list'", "'{ open'"]),
    "level": "'low'",
    "logsource_product": st.texts("doc_id", ["windows", "", None]),
    "logsource_category": st.texts("doc_id", ["", "proxy"]),
    "logsource_service": "NULL",
    "conversion_kql": st.texts("doc_id", ["on", "", None]),
    "conversion_splunk": st.texts("doc_id", ["", "on", None, ""]),
    "conversion_elasticsearch": st.texts("doc_id", [None, None, None, None, "on"]),
}
SQL_FORM = "(SELECT doc_id, " + ", ".join(f'{v} AS "{k}"' for k, v in FORM.items()) + " FROM documents)"
SQL_NAMED = f"""(SELECT *, {SQL_SLUG.format(sql_strip("CASE WHEN coalesce(filename, '') <> '' THEN filename ELSE title END"))} AS s,
  coalesce(category IN ('endpoint', 'cloud', 'macos', 'network', 'web'), FALSE) AS known FROM {SQL_FORM})"""


def form_rows(spark, folder):
    columns = [F.expr(v).cast("string").alias(k) for k, v in FORM.items()]
    return forms.submissions(documents(spark, folder).select(*columns), F.lit("2024-05-06").cast("date"))


@query(
    "form_rows",
    f"""SELECT CASE WHEN coalesce(rule_path, '') <> '' THEN rule_path ELSE 'sigma-rules/' || category || '/' || category || '_' || s || '.yml' END AS path,
        title, rule_id AS id, md5(description) AS description, array_to_string({sql_lines('"references"')}, ',') AS refs, CASE WHEN coalesce("date", '') <> '' THEN "date" ELSE '2024/05/06' END AS date,
        '2024/05/06' AS modified, tags, CASE WHEN t = '' THEN 'kql,splunk' ELSE t END AS targets, concat_ws(',', CASE WHEN logsource_product <> '' THEN 'product=' || logsource_product END,
        CASE WHEN logsource_category <> '' THEN 'category=' || logsource_category END) AS logsource, CASE WHEN trim(coalesce(detection, '')) = '' THEN '{forms.DEFAULT_DETECTION}'
          ELSE '{{"pick": {{"user": "' || author || '"}}, "condition": "pick"}}' END AS detection, 0 AS falsepositives, '0.1.0' AS version
        FROM (SELECT *, concat_ws(',', CASE WHEN conversion_kql <> '' THEN 'kql' END, CASE WHEN conversion_splunk <> '' THEN 'splunk' END,
          CASE WHEN conversion_elasticsearch <> '' THEN 'elasticsearch' END) AS t FROM {SQL_NAMED}) WHERE known AND s <> '' AND doc_id % 7 < 5""",
)
def form_rules(spark, folder):
    made, _ = form_rows(spark, folder)
    listed = lambda c: F.array_join(c, ",")
    parts = F.transform(F.map_entries("logsource"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return made.select(
        "path", "title", "id", F.md5("description").alias("description"), listed("references").alias("refs"), "date", "modified",
        listed("tags").alias("tags"), listed("conversion_targets").alias("targets"), listed(parts).alias("logsource"),
        "detection", F.size("falsepositives").alias("falsepositives"), "version",
    )


@query(
    "form_rejects",
    f"SELECT title, category, CASE WHEN NOT known THEN 'Invalid category' WHEN s = '' THEN 'Filename or title required' ELSE 'Detection is not a mapping' END AS reason FROM {SQL_NAMED} WHERE NOT known OR s = '' OR doc_id % 7 >= 5",
)
def form_rejects(spark, folder):
    _, rejected = form_rows(spark, folder)
    return rejected


# ---- ingest --------------------------------------------------------------------------------------

BAD_LINES = ["'{\"port\": '", "'[1]'", "'   '", "'{\"event.action\":\"x\",\"port\":\"high\"}'", "'{\"port\":1} trailing'"]
LINE = f"coalesce({st.cases('event_id', BAD_LINES + [None] * 12)}, '{{\"event.action\":\"' || event_type || '\",\"port\":' || user_id || ',\"inner\":' || props || '}}')"


def event_lines(spark, folder):
    return table(spark, folder, "events").selectExpr("event_id", "event_type", f"{LINE} AS line")


LINE_SCHEMA = "`event.action` string, port bigint, inner struct<k: bigint>"


@query(
    "ingest_counts",
    """SELECT event_type, ok_count, error_count, CASE WHEN error_count > 0 THEN 'failure' ELSE 'success' END AS status FROM (SELECT event_type,
       count(*) FILTER (event_id % 17 > 4) AS ok_count, count(*) FILTER (event_id % 17 IN (0, 1, 3, 4)) AS error_count FROM events WHERE event_id % 17 <> 2 GROUP BY event_type)""",
)
def ingest_counts(spark, folder):
    return ev.ingest_counts(ev.parse_events(event_lines(spark, folder), LINE_SCHEMA), "event_type")


@query(
    "ingest_quarantine",
    f"""SELECT event_id, CASE WHEN event_id % 17 > 4 THEN event_type END AS action, CASE WHEN event_id % 17 > 4 THEN user_id END AS port,
        CASE WHEN event_id % 17 > 4 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 17 <= 4 THEN {LINE} END AS refused
        FROM events WHERE event_id % 17 <> 2""",
)
def ingest_quarantine(spark, folder):
    parsed = ev.parse_events(event_lines(spark, folder), LINE_SCHEMA)
    return parsed.selectExpr("event_id", "`event.action` AS action", "port", "inner.k AS k", "_corrupt_record AS refused")


@query(
    "variant_fields",
    """SELECT event_id, CASE event_id % 17 WHEN 3 THEN 'x' ELSE event_type END AS action, CASE event_id % 17 WHEN 3 THEN NULL ELSE user_id END AS port
       FROM events WHERE event_id % 17 = 3 OR event_id % 17 > 4""",
)
def variant_fields(spark, folder):
    docs = ev.parse_open_events(event_lines(spark, folder)).where("ok")
    return docs.select("event_id", ev.field_of(F.col("doc"), "event.action").alias("action"), ev.field_of(F.col("doc"), "port", "bigint").alias("port"))


@query(
    "discovered_schema",
    """WITH e AS (SELECT event_id % 17 AS m FROM events WHERE event_id % 17 = 3 OR event_id % 17 > 4) SELECT 'event.action' AS field, 'STRING' AS kind, count(*) AS documents FROM e
       UNION ALL SELECT 'port', CASE m WHEN 3 THEN 'STRING' ELSE 'BIGINT' END AS k, count(*) FROM e GROUP BY k
       UNION ALL SELECT 'inner', 'OBJECT<k: BIGINT>', count(*) FROM e WHERE m <> 3""",
)
def discovered_schema(spark, folder):
    return ev.discovered_schema(ev.parse_open_events(event_lines(spark, folder)))


ENVELOPE = """'{"time":' || (1700000000 + event_id) || ',"event":{"EventCode":' || user_id || ',"Image":"C:' || chr(92) || chr(92) || event_type || '.exe","userIdentity":{"type":"IAMUser","userName":"u' || user_id || '"}}}'"""


@query(
    "envelope",
    """SELECT strftime(make_timestamp((1700000000 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS event_time, user_id AS event_code,
       'C:' || chr(92) || event_type || '.exe' AS image, 'u' || user_id AS user_name FROM events""",
)
def envelope(spark, folder):
    lines = table(spark, folder, "events").selectExpr(f"{ENVELOPE} AS line")
    schema = "time bigint, event struct<EventCode: bigint, Image: string, userIdentity: struct<type: string, userName: string>>"
    flat = ev.unwrap_envelope(ev.parse_events(lines, schema).where("ok"))
    return flat.selectExpr(
        "date_format(event_time, 'yyyy-MM-dd HH:mm:ss') AS event_time", "EventCode AS event_code", "Image AS image", "userIdentity.userName AS user_name"
    )


INDEX = "CASE WHEN event_type IN ('click', 'view') THEN 'web-' || event_type ELSE 'security_' || event_type END"


@query("index_scan", f"SELECT idx, count(*) AS events FROM (SELECT {INDEX} AS idx FROM events) WHERE starts_with(idx, 'security_') GROUP BY idx")
def index_scan(spark, folder):
    """The table is laid out by index and time first; the scan opens the matching partitions only."""
    path = run_folder(spark, "indexed")
    artifacts.write_layout(table(spark, folder, "events").selectExpr("event_id", "ts", f"{INDEX} AS idx"), path, ["idx"], ["ts"])
    return ev.in_index(spark.read.parquet(path), "security_*", "idx").groupBy("idx").agg(F.count("*").alias("events"))


@query("index_list_scan", f"SELECT idx, count(*) AS events, min(event_id) AS first FROM (SELECT event_id, {INDEX} AS idx FROM events) WHERE starts_with(idx, 'security_') OR idx IN (SELECT 'web-' || CASE n_nationkey WHEN 3 THEN 'view' ELSE 'none' END FROM nation) GROUP BY idx")
def index_list_scan(spark, folder):
    """Indexes named by a table: partitions are pruned while the query runs."""
    path = run_folder(spark, "indexed")
    artifacts.write_layout(table(spark, folder, "events").selectExpr("event_id", "ts", f"{INDEX} AS idx"), path, ["idx"], ["ts"])
    wanted = table(spark, folder, "nation").selectExpr("'web-' || CASE n_nationkey WHEN 3 THEN 'view' ELSE 'none' END AS pattern").unionByName(spark.range(1).selectExpr("'security_*' AS pattern"))
    return ev.read_indexes(spark, path, wanted, "idx").groupBy("idx").agg(F.count("*").alias("events"), F.min("event_id").alias("first"))
