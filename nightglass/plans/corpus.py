"""Queries of the corpus checks, lint, conversion accounting and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightglass.functions.text import normalise_query, strip_markup_comments, strip_slash_comments
from nightglass.operators import conversion, lint, report, validate
from nightglass.operators.indicators import field_values, match_contained
from nightglass.plans import standins as st
from nightglass.plans.registry import query, spread_table, table
from nightglass.sources.files import queries_of_run

SP = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SP}+|{SP}+$', '', 'g')"


def sql_lines(text: str, extra: str = "TRUE") -> str:
    return f"[x FOR x IN [{sql_strip('y')} FOR y IN string_split_regex({text}, '{BREAK}')] IF x <> '' AND {extra}]"


def documents(spark, folder):
    return spread_table(spark, folder, "documents")


def joined(name: str, separator: str = " | "):
    return F.array_join(name, separator)


# ---- query texts ---------------------------------------------------------------------------------

RAW = "text || chr(10) || '  # ' || source || chr(10) || '   ' || lang || ' '"


@query(
    "query_normalise",
    f"""SELECT doc_id, md5(q) AS digest, length(q) AS size FROM (
        SELECT doc_id, array_to_string({sql_lines(RAW, "NOT starts_with(x, '#')")}, ' ') AS q FROM documents)""",
)
def query_normalise(spark, folder):
    text = documents(spark, folder).selectExpr("doc_id", f"{RAW} AS q").withColumn("q", normalise_query(F.col("q")))
    return text.select("doc_id", F.md5("q").alias("digest"), F.length("q").cast("bigint").alias("size"))


@query(
    "lint_strip",
    r"""SELECT page_id, md5(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) AS markup,
        md5(regexp_replace(regexp_replace(html || ' /* ' || url || ' */', '(?m)//.*?$', '', 'g'), '(?s)/\*.*?\*/', '', 'g')) AS slashes FROM pages""",
)
def lint_strip(spark, folder):
    pages = spread_table(spark, folder, "pages")
    both = F.concat("html", F.lit(" /* "), "url", F.lit(" */"))
    return pages.select(
        "page_id", F.md5(strip_markup_comments(F.col("html"))).alias("markup"), F.md5(strip_slash_comments(both)).alias("slashes")
    )


SQL_CLEAN = r"""CASE backend WHEN 'splunk' THEN regexp_replace(q, '(?s)<!--.*?-->', '', 'g')
  WHEN 'kql' THEN regexp_replace(regexp_replace(q, '(?m)//.*?$', '', 'g'), '(?s)/\*.*?\*/', '', 'g') ELSE q END"""


def sql_count(piece: str) -> str:
    return f"(length(c) - length(replace(c, '{piece}', '')))"


SQL_LINT = f"""SELECT path, backend, errors, errors = '' AS is_valid FROM (SELECT path, backend, CASE
  WHEN backend = 'sql' THEN 'Unknown query type: sql' WHEN q IS NULL THEN 'Error reading file'
  WHEN {sql_strip('c')} = '' THEN 'Query is empty' ELSE concat_ws(' | ',
    CASE WHEN {sql_count('(')} <> {sql_count(')')} THEN 'Unbalanced parentheses' END,
    CASE WHEN {sql_count('[')} <> {sql_count(']')} THEN 'Unbalanced brackets' END,
    CASE WHEN {sql_count('{')} <> {sql_count('}')} THEN 'Unbalanced braces' END) END AS errors
  FROM (SELECT *, {SQL_CLEAN} AS c FROM {st.SQL_QUERIES}))"""


def linted(spark, folder):
    return lint.lint(st.query_rows(documents(spark, folder)))


@query("lint_balance", SQL_LINT)
def lint_balance(spark, folder):
    return linted(spark, folder).select("path", "backend", joined("errors").alias("errors"), "is_valid")


@query(
    "lint_summary",
    f"""SELECT backend, count(*) AS files_checked, count(*) FILTER (NOT is_valid) AS failed_files,
        CASE WHEN bool_and(is_valid) THEN 'success' ELSE 'failure' END AS status FROM ({SQL_LINT}) GROUP BY backend""",
)
def lint_summary(spark, folder):
    return lint.lint_summary(linted(spark, folder), "backend")


@query("lint_messages", f"SELECT path, path || ': ' || replace(errors, ' | ', ', ') AS message FROM ({SQL_LINT}) WHERE NOT is_valid")
def lint_messages(spark, folder):
    return lint.lint_messages(linted(spark, folder))


# ---- corpus checks -------------------------------------------------------------------------------

CATEGORY = st.texts("page_id", ["endpoint", "cloud", "macos", "network", "web"])
SHAPES = [
    "c || '-' || page_id || '.yml'", "c || '__x' || page_id || '_.yaml'", "c || '_a.yml'", "'other_' || page_id || '.yml'", "c || '_' || slug || '.yml'",
    "c || '_' || slug || '.yaml'", "c || '_' || slug || '.txt'",
]


def page_paths(slug: str) -> str:
    inner = f"SELECT page_id, {slug} AS slug, {CATEGORY} AS c, CASE WHEN page_id % 11 = 0 THEN 'web' ELSE {CATEGORY} END AS f FROM pages"
    return f"SELECT page_id, 'sigma-rules/' || f || '/' || ({st.cases('page_id', SHAPES)}) AS path, f FROM ({inner}) p"


SQL_NAMES = page_paths("regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g')")
NAME = "^([a-z]+)_([a-z0-9_]+)[.](yml|yaml)$"


@query(
    "filename_check",
    f"""SELECT path, CASE WHEN NOT regexp_matches(n, '{NAME}') THEN 'Filename ''' || n ||
          ''' does not match pattern: <category>_<descriptive_name>.yml' || chr(10) || '  Example: endpoint_suspicious_powershell.yml'
        ELSE concat_ws(' | ',
          CASE WHEN c <> f THEN 'Category ''' || c || ''' in filename does not match directory ''' || f || '''' END,
          CASE WHEN c NOT IN ('endpoint', 'cloud', 'macos', 'network', 'web') THEN 'Category ''' || c ||
            ''' is not valid. Must be one of: endpoint, cloud, macos, network, web' END,
          CASE WHEN length(d) < 3 THEN 'Descriptive name must be at least 3 characters long' END,
          CASE WHEN starts_with(d, '_') OR suffix(d, '_') THEN 'Descriptive name cannot start or end with underscore' END,
          CASE WHEN contains(d, '__') THEN 'Descriptive name cannot contain consecutive underscores' END) END AS errors
        FROM (SELECT path, f, n, regexp_extract(n, '{NAME}', 1) AS c, regexp_extract(n, '{NAME}', 2) AS d
          FROM (SELECT path, f, regexp_extract(path, '[^/]*$') AS n FROM ({SQL_NAMES})))""",
)
def filename_check(spark, folder):
    table(spark, folder, "pages").createOrReplaceTempView("_pages_for_names")
    paths = spark.sql(page_paths("regexp_replace(lower(url), '[^a-z0-9]+', '_')").replace("FROM pages", "FROM _pages_for_names"))
    return paths.select("path", joined(validate.naming_errors(F.col("path"))).alias("errors"))


def errs(*pairs: tuple[str, str]) -> str:
    return "concat_ws(' | ', " + ", ".join(f"CASE WHEN {cond} THEN {msg} END" for cond, msg in pairs) + ")"


def jt(name: str) -> str:
    return f"json_type(j, '$.{name}')"


def js(name: str) -> str:
    return f"json_extract_string(j, '$.{name}')"


def key_count(block: str) -> str:
    return f"len([k FOR k IN json_keys(j, '$.{block}') IF k NOT IN ('condition', 'timeframe')])"


def filled(name: str) -> str:
    return f"coalesce({jt(name)} <> 'NULL' AND {js(name)} NOT IN ('', '[]', '{{}}'), FALSE)"


SQL_STRUCTURE = f"""SELECT doc_id, path, CASE WHEN error IS NOT NULL THEN 'YAML parsing error: ' || error
  WHEN json_type(j) = 'NULL' OR CAST(j AS VARCHAR) IN ('{{}}', '[]') THEN 'Rule file is empty'
  WHEN json_type(j) <> 'OBJECT' THEN 'Rule file must deserialize to a YAML mapping/object' ELSE """ + errs(
    (f"{jt('logsource')} <> 'OBJECT'", "'logsource must be a dictionary'"),
    (f"{jt('logsource')} = 'OBJECT' AND {jt('logsource.category')} IS NULL AND {jt('logsource.product')} IS NULL AND {jt('logsource.service')} IS NULL",
     "'logsource must have either ''category'' or ''product'''"),
    (f"{jt('detection')} <> 'OBJECT'", "'detection must be a dictionary'"),
    (f"{jt('detection')} = 'OBJECT' AND {jt('detection.condition')} IS NULL", "'detection must have ''condition'''"),
    (f"{jt('detection')} = 'OBJECT' AND {key_count('detection')} = 0", "'detection must include at least one selection block'"),
    (f"{jt('id')} <> 'VARCHAR'", "'id must be a string'"),
    (f"{jt('id')} = 'VARCHAR' AND (length({js('id')}) <> 36 OR length({js('id')}) - length(replace({js('id')}, '-', '')) <> 4)",
     f"'id should be a UUID format: ' || {js('id')}"),
) + f" END AS errors FROM {st.SQL_RULES}"

# The keys that a rule must have.
REQUIRED = ["title", "id", "status", "description", "author", "date", "references", "tags", "logsource", "detection", "level", "falsepositives", "version"]


def list_any(name: str, cond: str) -> str:
    return f"len([x FOR x IN from_json(json_extract(j, '$.{name}'), '[\"VARCHAR\"]') IF {cond}]) > 0"


def is_list(name: str) -> str:
    return f"coalesce({jt(name)} = 'ARRAY', FALSE)"


def not_list(name: str) -> tuple[str, str]:
    return f"{jt(name)} NOT IN ('NULL', 'ARRAY')", f"'{name} must be a list'"


SQL_METADATA = "SELECT doc_id, path, " + errs(
    *[(f"{jt(n)} IS NULL", f"'Missing required metadata field: {n}'") for n in REQUIRED],
    (f"{filled('status')} AND {js('status')} NOT IN ('stable', 'experimental', 'test', 'deprecated')",
     "'status must be one of: deprecated, experimental, stable, test'"),
    (f"{filled('level')} AND {js('level')} NOT IN ('informational', 'low', 'medium', 'high', 'critical')",
     "'level must be one of: critical, high, informational, low, medium'"),
    (f"{filled('date')} AND NOT regexp_matches({js('date')}, '^[0-9]{{4}}[-/][0-9]{{2}}[-/][0-9]{{2}}$')",
     "'date must be in YYYY/MM/DD or YYYY-MM-DD format'"),
    not_list("references"),
    not_list("tags"),
    (f"{is_list('tags')} AND NOT " + list_any("tags", "starts_with(lower(x), 'attack.')"), "'tags must include at least one attack.* tag'"),
    (f"{is_list('tags')} AND NOT " + list_any("tags", "regexp_matches(lower(x), '^attack[.]t[0-9]{4}([.][0-9]{3})?$')"),
     "'tags must include at least one ATT&CK technique tag (attack.t####)'"),
    not_list("falsepositives"),
    (f"{filled('version')} AND NOT regexp_matches({js('version')}, '^[0-9]+[.][0-9]+[.][0-9]+$')",
     "'version must follow semantic versioning (e.g., 1.2.3)'"),
    not_list("conversion_targets"),
    (f"{is_list('conversion_targets')} AND " + list_any("conversion_targets", "lower(x) NOT IN ('kql', 'splunk', 'elasticsearch')"),
     "'conversion_targets entries must be ''kql'', ''splunk'', and/or ''elasticsearch'''"),
) + f" AS errors FROM {st.SQL_RULES}"

SQL_QUALITY = "SELECT doc_id, path, " + errs(
    (f"coalesce({jt('logsource')}, '') <> 'OBJECT'", "'logsource must be a dictionary'"),
    (f"{jt('logsource')} = 'OBJECT' AND NOT ({filled('logsource.product')} OR {filled('logsource.category')} OR {filled('logsource.service')})",
     "'logsource must include product, category, or service'"),
    (f"coalesce({jt('detection')}, '') <> 'OBJECT'", "'detection must be a dictionary'"),
    (f"{jt('detection')} = 'OBJECT' AND {key_count('detection')} = 0", "'detection must include at least one selection block'"),
    (f"{jt('detection')} = 'OBJECT' AND NOT {filled('detection.condition')}", "'detection must include a condition'"),
    (f"NOT {filled('falsepositives')}", "'falsepositives must be populated with known benign scenarios'"),
    (f"NOT {filled('tags')}", "'tags must include ATT&CK mappings and detection context'"),
) + f" AS errors FROM {st.SQL_RULES}"

# The keys of the contract that are required, and those that are lists.
CONTRACT = ["title", "id", "status", "description", "author", "date", "logsource", "detection", "level", "version"]
LISTS = ("conversion_targets", "falsepositives", "references", "tags")


def shown(value: str) -> str:
    return (
        f"CASE json_type({value}) WHEN 'NULL' THEN 'None' WHEN 'VARCHAR' THEN '''' || json_extract_string({value}, '$') || '''' "
        f"ELSE CAST({value} AS VARCHAR) END"
    )


def contract_part(name: str) -> list[tuple[str, str]]:
    value = f"json_extract(j, '$.{name}')"
    if name in LISTS:
        wrong = f"[x FOR x IN from_json({value}, '[\"JSON\"]') IF json_type(x) <> 'VARCHAR']"
        items = f"array_to_string([({shown('x')}) || ' is not of type ''string''' FOR x IN {wrong}], ' | ')"
        return [(f"{jt(name)} <> 'ARRAY'", f"({shown(value)}) || ' is not of type ''array'''"), (f"{jt(name)} = 'ARRAY' AND len({wrong}) > 0", items)]
    kind = "object" if name in ("logsource", "detection") else "string"
    off = (f"{jt(name)} <> '{'OBJECT' if kind == 'object' else 'VARCHAR'}'", f"({shown(value)}) || ' is not of type ''{kind}'''")
    least = {"title": 3, "description": 10}.get(name)
    return [off] + ([(f"{jt(name)} = 'VARCHAR' AND length({js(name)}) < {least}", f"({shown(value)}) || ' is too short'")] if least else [])


SQL_CONTRACT = f"SELECT doc_id, path, CASE WHEN coalesce(json_type(j), 'x') <> 'OBJECT' THEN coalesce({shown('j')}, 'None') || ' is not of type ''object''' ELSE " + errs(
    *[(f"{jt(n)} IS NULL", f"'''{n}'' is a required property'") for n in CONTRACT],
    *[pair for n in sorted([*CONTRACT, *LISTS]) for pair in contract_part(n)],
) + f" END AS errors FROM {st.SQL_RULES}"


def rules(spark, folder):
    return validate.with_document(st.rule_rows(documents(spark, folder)))


def checked(spark, folder, errors):
    return rules(spark, folder).select("doc_id", "path", joined(errors).alias("errors"))


@query("rule_structure", SQL_STRUCTURE)
def rule_structure(spark, folder):
    return checked(spark, folder, validate.structure_errors(F.col("doc"), F.col("error")))


@query("rule_metadata", SQL_METADATA)
def rule_metadata(spark, folder):
    return checked(spark, folder, validate.metadata_errors(F.col("doc")))


@query("rule_quality", SQL_QUALITY)
def rule_quality(spark, folder):
    return checked(spark, folder, validate.quality_errors(F.col("doc")))


@query("schema_contract", SQL_CONTRACT)
def schema_contract(spark, folder):
    return checked(spark, folder, validate.contract_errors(F.col("doc")))


SQL_NAMING = f"""SELECT doc_id, path, CASE WHEN NOT regexp_matches(n, '{NAME}') THEN 'off' ELSE concat_ws(' | ', CASE WHEN c <> f THEN 'folder' END,
    CASE WHEN c NOT IN ('endpoint', 'cloud', 'macos', 'network', 'web') THEN 'category' END, CASE WHEN length(d) < 3 THEN 'short' END,
    CASE WHEN starts_with(d, '_') OR suffix(d, '_') THEN 'edge' END, CASE WHEN contains(d, '__') THEN 'double' END) END AS errors
  FROM (SELECT *, regexp_extract(n, '{NAME}', 1) AS c, regexp_extract(n, '{NAME}', 2) AS d
    FROM (SELECT doc_id, path, regexp_extract(path, '[^/]*$') AS n, regexp_extract(path, '([^/]*)/[^/]*$', 1) AS f FROM (SELECT doc_id, {st.RULE_PATH} AS path FROM documents)))"""
SQL_ALL = " UNION ALL ".join(
    f"SELECT path, '{name}' AS check_name, errors FROM ({sql})"
    for name, sql in (("naming", SQL_NAMING), ("structure", SQL_STRUCTURE), ("metadata", SQL_METADATA), ("quality", SQL_QUALITY), ("schema", SQL_CONTRACT))
)


@query(
    "rule_gate",
    f"""SELECT coalesce(check_name, 'all') AS "check", count(*) AS checked, count(*) FILTER (errors <> '') AS failing,
        CASE WHEN count(*) FILTER (errors <> '') > 0 THEN 'failure' ELSE 'success' END AS status FROM ({SQL_ALL}) GROUP BY ROLLUP (check_name)""",
)
def rule_gate(spark, folder):
    return validate.gate(validate.validate(st.rule_rows(documents(spark, folder))))


@query(
    "rule_gate_matrix",
    "SELECT path, " + ", ".join(
        f"max(CASE WHEN check_name = '{n}' THEN errors <> '' END) AS {n}" for n in ("naming", "structure", "metadata", "quality", "schema")
    ) + f" FROM ({SQL_ALL}) GROUP BY path",
)
def rule_gate_matrix(spark, folder):
    names = ["naming", "structure", "metadata", "quality", "schema"]
    matrix = validate.gate_matrix(validate.checked(st.rule_rows(documents(spark, folder))), names)
    return matrix.select("path", *[(F.col(n) > 0).alias(n) for n in names])


# ---- versions, links, spelling -------------------------------------------------------------------


def rule_file(key: str) -> str:
    return f"'sigma-rules/a/a_' || {key} || ({st.texts(key, ['.meta.yml', '.txt', '.YAML', '.yml', '.yml', '.yml', '.yaml'])})"


# Release numbers, also behind an epoch, with every kind of phase after them.
PHASES = ["''", "'rc1'", "'.post2'", "'.dev3'", "'-ALPHA.4'", "'b2.dev1'", "'+build.7'", "'.post'", "''"]
BASE = f"""SELECT {rule_file('doc_id')} AS path, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'x.1'
  ELSE (doc_id % 3) || '.' || (doc_id % 10) || '.' || (doc_id % 7) || ({st.cases('doc_id', PHASES)}) END AS version FROM documents"""
CURRENT = f"""SELECT {rule_file('k')} AS path, CASE WHEN k % 17 = 0 THEN '1.0' WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN '1!0.1' WHEN k % 5 = 1 THEN (k % 3) || '.' || (k % 10) || '.' || (k % 7) || '.0'
  ELSE (p_size % 3) || '.' || (k % 12) || '.' || (k % 5) || ({st.cases('p_size', PHASES)}) END AS version FROM (SELECT p_partkey + 500 AS k, p_size FROM part) p"""
CHANGED = "starts_with(path, 'sigma-rules/') AND regexp_matches(lower(path), '[.](yml|yaml)$') AND NOT suffix(path, '.meta.yml')"


def version_number(v: str) -> str:
    """One number per version of the forms used here: release, then development, alpha, beta, candidate, the release itself, local and post."""
    release = f"regexp_extract({v}, '^(?:[0-9]+!)?([0-9.]*[0-9])', 1)"
    part = lambda i: f"coalesce(TRY_CAST(split_part({release}, '.', {i}) AS BIGINT), 0)"
    phase = f"""CASE WHEN contains({v}, 'post') THEN 900 + coalesce(TRY_CAST(regexp_extract({v}, 'post([0-9]+)', 1) AS BIGINT), 0) WHEN contains({v}, '+') THEN 801
      WHEN contains({v}, 'rc') THEN 700 WHEN contains({v}, 'b2.dev') THEN 600 WHEN contains({v}, 'ALPHA') THEN 500 WHEN contains({v}, 'dev') THEN 400 ELSE 800 END"""
    epoch = f"CASE WHEN contains({v}, '!') THEN 1000000000000000 ELSE 0 END"
    return f"CASE WHEN {v} <> 'x.1' THEN {epoch} + ({part(1)} * 1000000 + {part(2)} * 1000 + {part(3)}) * 1000 + {phase} END"


@query(
    "version_bump",
    f"""SELECT path, base_version, current_version, state, CASE state WHEN 'not bumped' THEN 'version not bumped (' || base_version || ' -> ' || current_version || ')'
          WHEN 'unreadable' THEN 'version is not numeric (' || base_version || ' -> ' || current_version || ')' END AS error
        FROM (SELECT *, CASE WHEN c IS NULL THEN 'deleted' WHEN b IS NULL THEN 'new' WHEN o IS NULL OR n IS NULL THEN 'unreadable'
          WHEN n > o THEN 'bumped' ELSE 'not bumped' END AS state
          FROM (SELECT coalesce(b.path, c.path) AS path, b.path AS b, c.path AS c,
            CASE WHEN b.path IS NOT NULL THEN coalesce(b.version, '0.0.0') END AS base_version,
            CASE WHEN c.path IS NOT NULL THEN coalesce(c.version, '0.0.0') END AS current_version,
            {version_number("coalesce(b.version, '0.0.0')")} AS o, {version_number("coalesce(c.version, '0.0.0')")} AS n
            FROM (SELECT * FROM ({BASE}) WHERE {CHANGED}) b FULL JOIN (SELECT * FROM ({CURRENT}) WHERE {CHANGED}) c ON b.path = c.path))""",
)
def version_bump(spark, folder):
    sides = []
    for name, text in (("documents", BASE), ("part", CURRENT)):
        table(spark, folder, name).createOrReplaceTempView(f"_{name}_for_versions")
        side = spark.sql(text.replace(f"FROM {name}", f"FROM _{name}_for_versions"))
        sides.append(side.where(validate.is_changed_rule(F.col("path"))))
    return validate.version_changes(*sides)


@query(
    "link_set",
    """SELECT DISTINCT link FROM (SELECT unnest([url, 'ftp://' || page_id, NULL, 'https://example.net/' || (page_id % 7)]) AS link FROM pages)
       WHERE starts_with(link, 'http')""",
)
def link_set(spark, folder):
    refs = F.array("url", F.concat(F.lit("ftp://"), "page_id"), F.lit(None), F.concat(F.lit("https://example.net/"), F.col("page_id") % 7))
    return validate.link_set(table(spark, folder, "pages").select(refs.alias("refs")))


HEAD = "CASE WHEN quality IS NULL THEN 405 WHEN toxic = 1 THEN 429 WHEN quality = 0 THEN 404 ELSE 200 END"
GET = "CASE page_id % 4 WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 500 END"
TIMEOUT = "CASE WHEN page_id % 10 = 3 THEN 'timeout' END"


@query(
    "link_status",
    f"""SELECT link, code, CASE WHEN error IS NOT NULL OR code IS NULL THEN 'failed' WHEN code IN (429, 503) THEN 'transient'
        WHEN code >= 400 THEN 'failed' ELSE 'ok' END AS outcome FROM (SELECT url AS link, {TIMEOUT} AS error,
        CASE WHEN {HEAD} = 405 THEN {GET} ELSE {HEAD} END AS code FROM pages LEFT JOIN labels ON page_id = doc_id)""",
)
def link_status(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    fetched = pages.join(table(spark, folder, "labels"), F.col("page_id") == F.col("doc_id"), "left")
    fetches = fetched.selectExpr("url AS link", f"{HEAD} AS head_status", f"{GET} AS get_status", f"{TIMEOUT} AS error")
    return validate.link_status(fetches).select("link", "code", "outcome")


def sql_words(text: str) -> str:
    return f"unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_''’-]+'))"


@query(
    "spelling",
    f"""SELECT word, reverse(word) AS correction, count(DISTINCT doc_id) AS texts, count(*) AS times FROM (SELECT doc_id, {sql_words('text')} AS word FROM documents)
        WHERE word IN (SELECT {sql_words('text')} FROM benchmark) AND word NOT IN (SELECT {sql_words('url')} FROM pages) GROUP BY word""",
)
def spelling(spark, folder):
    words = lambda name, column: table(spark, folder, name).select(
        F.explode(F.regexp_extract_all(F.lower(column), F.lit(validate.WORD_PATTERN), F.lit(0))).alias("word")
    ).distinct()
    dictionary = words("benchmark", "text").withColumn("correction", F.reverse("word"))
    texts = documents(spark, folder).select(F.col("doc_id").alias("path"), "text")
    found = validate.misspellings(texts, dictionary, words("pages", "url"))
    return found.groupBy("word").agg(
        F.min("correction").alias("correction"), F.count("*").alias("texts"), F.sum("times").alias("times")
    )


@query(
    "indicator_passages",
    "SELECT doc_id, 'text' AS field, item_id AS indicator_id FROM documents JOIN benchmark b ON contains(lower(documents.text), lower(b.text))",
)
def indicator_passages(spark, folder):
    """Whole benchmark passages inside whole texts."""
    values = field_values(documents(spark, folder).select("doc_id", "text"), ["doc_id"], ["text"])
    listed = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("indicator_id"), F.lit("text").alias("field"), F.col("text").alias("pattern")
    )
    return match_contained(values, listed, ["doc_id"])


# ---- conversion accounting -----------------------------------------------------------------------

ID_GIVEN = "CASE page_id % 3 WHEN 0 THEN '' WHEN 2 THEN 'id-' || page_id END"


@query(
    "rule_id",
    f"""SELECT page_id, coalesce(nullif({ID_GIVEN}, ''), 'rule.' || page_id) AS rule_id FROM pages""",
)
def rule_id(spark, folder):
    pages = table(spark, folder, "pages").selectExpr("page_id", f"{ID_GIVEN} AS given", "url || '/rule.' || page_id || '.yml' AS path")
    return pages.select("page_id", conversion.rule_id(F.col("given"), F.col("path")).alias("rule_id"))


TARGETS = st.texts("doc_id", [None, " Splunk ,KQL", "elasticsearch,", "", "kql,other"])


def sql_targets() -> str:
    return "[lower(trim(x)) FOR x IN string_split(t, ',')]"


@query(
    "target_filter",
    f"""SELECT doc_id, backend, t IS NULL OR list_contains({sql_targets()}, backend) AS selected
        FROM (SELECT doc_id, {TARGETS} AS t FROM documents), (SELECT unnest(['splunk', 'kql', 'elasticsearch']) AS backend)""",
)
def target_filter(spark, folder):
    targets = documents(spark, folder).selectExpr("doc_id", f"split({TARGETS}, ',') AS targets")
    return conversion.per_backend(targets).select("doc_id", "backend", "selected")


@query(
    "target_flags",
    f"""SELECT source, any_splunk, any_kql, any_elasticsearch, NOT (any_splunk OR any_kql OR any_elasticsearch) AS skip_conversion FROM (SELECT source, """
    + ", ".join(f"bool_or(coalesce(list_contains({sql_targets()}, '{b}'), FALSE)) AS any_{b}" for b in conversion.BACKENDS)
    + f" FROM (SELECT source, {TARGETS} AS t FROM documents) GROUP BY source)",
)
def target_flags(spark, folder):
    targets = documents(spark, folder).selectExpr("source", f"split({TARGETS}, ',') AS targets")
    return conversion.any_target(targets, "source")


def outcomes(spark, folder):
    text = st.OUTCOME
    for name in ("documents", "labels"):
        table(spark, folder, name).createOrReplaceTempView(f"_{name}_for_outcomes")
        text = text.replace(f" {name} ", f" _{name}_for_outcomes ")
    return spark.sql(text)


@query(
    "conversion_counts",
    f"""SELECT backend, count(*) AS processed_rules, count(*) FILTER (status = 'success') AS generated_count,
        count(*) FILTER (status = 'skipped') AS skipped_count, count(*) FILTER (status = 'failed') AS failed_count,
        CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failure' ELSE 'success' END AS status FROM {st.SQL_OUTCOMES} GROUP BY backend""",
)
def conversion_counts(spark, folder):
    return conversion.status_counts(outcomes(spark, folder))


def sql_agg(value: str, cond: str, order: str = "backend") -> str:
    return f"coalesce(string_agg({value}, ',' ORDER BY {order}) FILTER ({cond}), '')"


@query(
    "manifest_rows",
    f"""SELECT rule_id, {sql_agg("backend || '=' || query_path", "status = 'success'")} AS outputs, {sql_agg('backend', "status = 'success'")} AS generated,
        {sql_agg('backend', "status = 'skipped'")} AS skipped, {sql_agg("CASE WHEN message = '' THEN 'conversion failed' ELSE message END", "status = 'failed'", 'message')} AS errors
        FROM {st.SQL_OUTCOMES} GROUP BY rule_id""",
)
def manifest_rows(spark, folder):
    rows = conversion.rule_manifests(outcomes(spark, folder))
    pairs = F.transform(F.map_entries("outputs"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select(
        "rule_id", F.array_join(pairs, ",").alias("outputs"), *[joined(n, ",").alias(n) for n in ("generated", "skipped", "errors")]
    )


@query(
    "bundle_rows",
    f"""SELECT rule_id, rule_path, status, backend, query_path, md5(CASE WHEN status = 'success' THEN query ELSE '' END) AS query,
        CASE WHEN status = 'failed' THEN message ELSE '' END AS error, CASE WHEN status = 'skipped' THEN message ELSE '' END AS skipped_reason
        FROM {st.SQL_OUTCOMES}""",
)
def bundle_rows(spark, folder):
    return conversion.bundle_rows(outcomes(spark, folder)).withColumn("query", F.md5("query"))


SQL_BUNDLE_ROW = """to_json({'backend': backend, 'error': CASE WHEN status = 'failed' THEN message ELSE '' END,
  'query': CASE WHEN status = 'success' THEN query ELSE '' END, 'query_path': query_path, 'rule_id': rule_id, 'rule_path': rule_path,
  'skipped_reason': CASE WHEN status = 'skipped' THEN message ELSE '' END, 'status': status})"""


@query(
    "bundle_document",
    f"""WITH o AS (SELECT * FROM {st.SQL_OUTCOMES} WHERE backend = 'kql'),
        c AS (SELECT count(*) FILTER (status = 'failed') AS f, count(*) FILTER (status = 'success') AS g, count(*) AS p, count(*) FILTER (status = 'skipped') AS s FROM o)
        SELECT 0 AS section, '' AS key, '{{"backend":"kql","metrics":{{"failed_count":' || f || ',"generated_count":' || g || ',"processed_rules":' || p
          || ',"skipped_count":' || s || '}},"status":"' || CASE WHEN f > 0 THEN 'failure' ELSE 'success' END || '","rules":[' AS line FROM c
        UNION ALL SELECT 1, rule_path, CASE WHEN rule_path = (SELECT min(rule_path) FROM o) THEN '' ELSE ',' END || {SQL_BUNDLE_ROW} FROM o
        UNION ALL SELECT 2, '', ']}}'""",
)
def bundle_document(spark, folder):
    return conversion.bundle_lines(outcomes(spark, folder), "kql")


@query(
    "manifest_scan",
    f"""SELECT path FROM (SELECT 'output/kql/rule-' || doc_id || '.kql' AS path FROM labels WHERE toxic = 0)
        WHERE path IN (SELECT query_path FROM {st.SQL_OUTCOMES} WHERE status = 'success' AND backend = 'kql')""",
)
def manifest_scan(spark, folder):
    manifests = conversion.rule_manifests(outcomes(spark, folder)).select(F.array(F.struct("rule_id", "outputs")).alias("rules"))
    listing = table(spark, folder, "labels").where("toxic = 0").selectExpr("'output/kql/rule-' || doc_id || '.kql' AS path")
    return queries_of_run(manifests, listing, "kql")


# ---- report --------------------------------------------------------------------------------------

CORPUS_PATH = "'sigma-rules/' || " + st.cases(
    "doc_id", ["source || '/sub/r' || doc_id || '.yml'", "source || '/r' || doc_id || '.meta.yml'", "source || '/r' || doc_id || '.txt'"]
    + ["source || '/r' || doc_id || '.yml'"] * 4 + ["source || '/r' || doc_id || '.yaml'"] * 2,
)
SQL_CATEGORIES = f"""SELECT source AS category, count(*) AS rules FROM (SELECT source, {CORPUS_PATH} AS path FROM documents)
  WHERE regexp_matches(path, '^sigma-rules/[^/]+/[^/]+[.](yml|yaml)$') AND NOT suffix(path, '.meta.yml') GROUP BY source"""


def corpus_paths(spark, folder):
    return documents(spark, folder).selectExpr(f"{CORPUS_PATH} AS path")


def category_rows(spark, folder):
    return report.rules_by_category(corpus_paths(spark, folder))


@query("category_counts", SQL_CATEGORIES)
def category_counts(spark, folder):
    return category_rows(spark, folder)


SIDE = "query_path || CASE WHEN status = 'success' THEN '' WHEN status = 'skipped' THEN '.meta' ELSE '.error' END"
SQL_CONVERTED = f"""SELECT b AS backend, count(o.path) AS converted FROM (SELECT unnest(['splunk', 'kql', 'elasticsearch', 'spark']) AS b)
  LEFT JOIN (SELECT backend, {SIDE} AS path FROM {st.SQL_OUTCOMES}) o ON o.backend = b AND NOT suffix(path, '.meta') AND NOT suffix(path, '.error') GROUP BY b"""


def converted_rows(spark, folder):
    files = outcomes(spark, folder).selectExpr("backend", f"{SIDE} AS path")
    return report.converted_counts(spark, files, ("splunk", "kql", "elasticsearch", "spark"))


@query("converted_counts", SQL_CONVERTED)
def converted_counts(spark, folder):
    return converted_rows(spark, folder)


SQL_COVERAGE = f"""SELECT backend, converted, total_rules, CASE WHEN total_rules > 0 THEN round(converted * 100.0::DOUBLE / total_rules, 1) ELSE 0.0::DOUBLE END AS percent
  FROM ({SQL_CONVERTED}), (SELECT count(*) AS total_rules FROM documents)"""


@query("coverage_pct", SQL_COVERAGE)
def coverage_pct(spark, folder):
    return report.coverage(converted_rows(spark, folder), documents(spark, folder).select("doc_id"))


LEVEL = st.texts("doc_id", ["low", "medium", "high", "critical"])
TAGS = st.texts("doc_id", ["attack.execution,attack.t1059", "attack.t1059,car.1", "ATTACK.impact", "other", ""])


@query(
    "coverage_cube",
    f"""SELECT category, level, tag, count(*) AS rules, GROUPING(category, level, tag)::INTEGER AS "grouping" FROM (SELECT source AS category, {LEVEL} AS level,
        unnest(string_split({TAGS}, ',')) AS tag FROM documents) WHERE starts_with(lower(tag), 'attack.') GROUP BY CUBE (category, level, tag)""",
)
def coverage_cube(spark, folder):
    rows = documents(spark, folder).selectExpr("source AS category", f"{LEVEL} AS level", f"split({TAGS}, ',') AS tags")
    return report.coverage_cube(rows)


@query(
    "report_lines",
    f"""SELECT section, '' AS key, line FROM (VALUES (0, '# Detection Coverage Report'), (1, ''), (2, '## Summary'), (3, ''), (6, ''),
          (7, '## Rules by Category'), (8, ''), (10, ''), (11, '## Conversion Status'), (12, '')) v(section, line)
        UNION ALL SELECT 4, '', '- **Total Rules**: ' || coalesce(sum(rules), 0)::BIGINT FROM ({SQL_CATEGORIES})
        UNION ALL SELECT 5, backend, '- **' || upper(backend[1]) || lower(backend[2:]) || ' Queries Generated**: ' || converted FROM ({SQL_CONVERTED})
        UNION ALL SELECT 9, category, '- **' || upper(category[1]) || lower(category[2:]) || '**: ' || rules || ' rules' FROM ({SQL_CATEGORIES})
        UNION ALL SELECT 13, backend, format('- {{}}: {{}}/{{}} rules converted ({{:.1f}}%)', upper(backend[1]) || lower(backend[2:]), converted, total_rules, percent)
          FROM ({SQL_COVERAGE})""",
)
def report_lines(spark, folder):
    covered = report.coverage(converted_rows(spark, folder), documents(spark, folder).select("doc_id"))
    return report.report_lines(category_rows(spark, folder), covered)
