"""Inputs that the driver tables have no column for, derived from whole tables.

Each is a SQL text that both Spark and the comparison engine read, so it holds no back-slash and
no dialect words. The derived rows grow with the table they come from.
"""

from __future__ import annotations


def cases(subject: str, options: list[str | None], otherwise: str = "NULL") -> str:
    """CASE over `subject` modulo the number of options; None gives NULL."""
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options) if o is not None)
    return f"CASE {subject} % {len(options)} {arms} ELSE {otherwise} END"


def texts(subject: str, options: list[str | None], otherwise: str = "NULL") -> str:
    quoted = [None if o is None else "'" + o.replace("'", "''") + "'" for o in options]
    return cases(subject, quoted, otherwise)


# ---- rule documents from `documents` -------------------------------------------------------------

UUID = " || '-' || ".join(f"substr(md5(CAST(doc_id AS STRING)), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
# Known categories, languages in their place, names that are too short, end in a mark or lie in another folder.
RULE_CATEGORY = f"({cases('doc_id', ["'endpoint'", "'cloud'", 'lang', "'network'"])})"
RULE_NAME = f"({cases('doc_id', ["source || '_' || doc_id", "source || '_' || doc_id", "'x'", "source || '__' || doc_id", "source || '_' || doc_id", "source || '_' || doc_id || '_'", "source || '-' || doc_id"])})"
RULE_FOLDER = f"CASE WHEN doc_id % 7 = 2 THEN doc_id || '/' ELSE '' END || CASE WHEN doc_id % 9 = 5 THEN 'other' ELSE {RULE_CATEGORY} END"
RULE_PATH = f"'sigma-rules/' || {RULE_FOLDER} || '/' || {RULE_CATEGORY} || '_' || {RULE_NAME} || '.yml'"

# Each part of a rule in good and bad shapes; the number of shapes differs per part so that the
# combinations vary. NULL leaves the key out.
PARTS = [
    cases("doc_id", [None, "'\"title\":\"ab\"'", "'\"title\":5'"] + ["'\"title\":\"' || source || ' rule ' || doc_id || '\"'"] * 10),
    cases("doc_id", [None, "'\"id\":\"not-a-uuid\"'", "'\"id\":42'"] + [f"'\"id\":\"' || {UUID} || '\"'"] * 4),
    texts("doc_id", ['"status":"draft"', '"status":""', '"status":"stable"', '"status":"test"', None]),
    cases("doc_id", [None, "'\"author\":null'"] + ["'\"author\":\"' || lang || '\"'"] * 4),
    texts("doc_id", ['"date":"2024-01-05"', '"date":"2024/01/05"', '"date":"05.01.2024"', None]),
    texts("doc_id", ['"references":["https://example.org/a"]', '"references":"https://example.org/a"', '"references":["x",7]', None,
                     '"references":null', '"references":[]']),
    texts("doc_id", ['"tags":["attack.execution","attack.t1059.001"]', '"tags":["ATTACK.T1059"]', '"tags":["attack.execution"]',
                     '"tags":["other"]', '"tags":"attack.t1059"', '"tags":[]', None, '"tags":null']),
    texts("doc_id", [None, '"logsource":"windows"', '"logsource":{}', '"logsource":{"product":""}',
                     '"logsource":{"product":"windows","category":"dns_query"}', '"logsource":{"service":null}',
                     '"logsource":{"definition":"x"}', '"logsource":null', '"logsource":{"category":"proxy"}']),
    texts("doc_id", [None, '"detection":"x"', '"detection":{}', '"detection":{"condition":"selection"}',
                     '"detection":{"selection":{"a":"b"}}', '"detection":{"selection":{"a":"b"},"condition":""}',
                     '"detection":{"selection":{"a|contains":["x","y"]},"condition":"selection"}',
                     '"detection":{"timeframe":"5m","condition":"selection"}', '"detection":null', '"detection":[]']),
    texts("doc_id", [None, '"level":"low"', '"level":"severe"', '"level":"high"', '"level":3', '"level":""']),
    texts("doc_id", [None, '"falsepositives":[]', '"falsepositives":"none"', '"falsepositives":["known"]', '"falsepositives":null']),
    texts("doc_id", ['"version":"1.2.3"', '"version":"1.2"', '"version":2', None, '"version":""', '"version":"10.0.12"']),
    texts("doc_id", [None, '"conversion_targets":["kql","Splunk"]', '"conversion_targets":["kql","sql"]', '"conversion_targets":"kql"',
                     '"conversion_targets":[]', '"conversion_targets":null', '"conversion_targets":["elasticsearch",5]']),
]
# Documents that are not a rule at all, and files that could not be read.
WHOLE = texts("doc_id", ["{}", "[]", '"text"', "null"] + [None] * 25)
RULE_ERROR = "CASE WHEN doc_id % 31 = 4 THEN 'bad indent' END"


def _rule_json(text_json: str) -> str:
    description = f"CASE doc_id % 17 WHEN 0 THEN NULL WHEN 1 THEN '\"description\":\"too short\"' ELSE '\"description\":' || {text_json} END"
    body = "'{' || concat_ws(',', " + ", ".join([*PARTS, description]) + ") || '}'"
    return f"CASE WHEN doc_id % 31 = 4 THEN NULL ELSE coalesce({WHOLE}, {body}) END"


SPARK_TEXT_JSON = "substr(to_json(named_struct('t', text)), 6, length(to_json(named_struct('t', text))) - 6)"
SPARK_RULE_JSON = _rule_json(SPARK_TEXT_JSON)
SQL_RULES = f"(SELECT doc_id, {RULE_PATH} AS path, {RULE_ERROR} AS error, CAST({_rule_json('CAST(to_json(text) AS VARCHAR)')} AS JSON) AS j FROM documents) r"


def rule_rows(documents):
    """(doc_id, path, rule_json, error) for every document; its whole text is the description."""
    return documents.selectExpr("doc_id", f"{RULE_PATH} AS path", f"{SPARK_RULE_JSON} AS rule_json", f"{RULE_ERROR} AS error")


# ---- query texts from `documents` ----------------------------------------------------------------

QUERY_BACKEND = texts("doc_id", ["splunk", "kql", "elasticsearch", "splunk", "kql", "sql"])
QUERY_TEXT = cases(
    "doc_id",
    ["''", "text || ' ('", "'<!-- ' || text || ' -->'", "'/* ' || text || ' */'", "text || ' [x]]{'", "'  ' || chr(10)", "NULL",
     "text || ' // ( '", "text", "'search ' || text || ' | where (a) in [1] {b}'"],
)
QUERY_PATH = f"'output/' || ({QUERY_BACKEND}) || '/' || source || '_' || doc_id || '.query'"
SQL_QUERIES = f"(SELECT doc_id, {QUERY_PATH} AS path, {QUERY_BACKEND} AS backend, {QUERY_TEXT} AS q FROM documents) q"


def query_rows(documents):
    return documents.selectExpr("doc_id", f"{QUERY_PATH} AS path", f"{QUERY_BACKEND} AS backend", f"{QUERY_TEXT} AS query_text")


# ---- conversion outcomes from `documents` and `labels` -------------------------------------------

OUTCOME = """SELECT 'rule-' || doc_id AS rule_id, 'sigma-rules/' || source || '/r_' || doc_id || '.yml' AS rule_path, backend, status,
  'output/' || backend || '/rule-' || doc_id || '.' || backend AS query_path, text AS query,
  CASE WHEN status = 'skipped' THEN 'target not selected' WHEN status = 'failed' AND doc_id % 2 = 0 THEN 'error in ' || lang ELSE '' END AS message
  FROM (SELECT d.doc_id, d.source, d.lang, d.text, b.backend,
    CASE WHEN l.quality IS NULL THEN 'skipped' WHEN l.quality = 1 AND (d.doc_id + b.n) % 4 <> 0 THEN 'success' ELSE 'failed' END AS status
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    {BACKENDS}) o"""
# Three rows per document: a list unfolded, which each engine writes in its own way.
OUTCOME_SQL = OUTCOME.replace("{BACKENDS}", ", (VALUES (0, 'splunk'), (1, 'kql'), (2, 'elasticsearch')) AS b(n, backend)")
OUTCOME = OUTCOME.replace("{BACKENDS}", "LATERAL VIEW posexplode(array('splunk', 'kql', 'elasticsearch')) b AS n, backend")
SQL_OUTCOMES = f"({OUTCOME_SQL}) o"


# ---- commits from `orders`, changed files from `lineitem` ----------------------------------------

OFFSET = texts("o_orderkey", ["-04:00", "Z", "+05:30"])
SHA = "md5(CAST({} AS STRING))"
FILE_CODE = "CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'M' ELSE " + texts("l_linenumber", ["R100", "D", "T", "R090"]) + " END"
FILE_ROOT = "CASE WHEN l_partkey % 10 = 0 THEN 'docs' ELSE 'sigma-rules' END"
FILE_FOLDER = texts("l_suppkey", ["endpoint", "cloud", "web/deep"])
FILE_TYPE = texts("l_partkey", ["yml", "yaml", "yml", "yml", "md"])
FILE_OLD = f"{FILE_ROOT} || '/' || ({FILE_FOLDER}) || '/rule_' || l_partkey || '_' || l_linenumber || '.' || ({FILE_TYPE})"
FILE_NEW = f"""CASE WHEN l_linenumber % 4 = 0 THEN 'sigma-rules/moved/rule_' || l_partkey || '_' || l_linenumber || '.' || ({FILE_TYPE})
  ELSE {FILE_ROOT} || '/' || ({FILE_FOLDER}) || '/renamed_' || l_partkey || '.yml' END"""
FILE_DIFF = cases(
    "l_suppkey",
    ["'+title: a' || chr(10) || '-  level : low'", "'@@ shuffle @@'", "'x' || chr(10) || ' +version: 1.0.' || l_linenumber", "''",
     "'-detection:' || chr(10) || '+detection:' || chr(10) || '+tags:'", "'title: no sign'"],
)
