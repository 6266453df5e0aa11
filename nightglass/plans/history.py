"""Queries of the change history: orders stand for commits, lineitems for the files they change."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightglass.functions.text import with_once
from nightglass.functions.times import parse_offset_time
from nightglass.operators import changelog as ch
from nightglass.operators.pages import release_notes
from nightglass.plans import standins as st
from nightglass.plans.registry import query, spread_table, table
from nightglass.session import run_folder

COMMIT_SHA = st.SHA.format("o_orderkey")
SQL_AT = f"o_orderdate + CASE {st.OFFSET} WHEN '-04:00' THEN INTERVAL 240 MINUTE WHEN '+05:30' THEN INTERVAL (-330) MINUTE ELSE INTERVAL 0 MINUTE END"
SQL_COMMITS = f"""SELECT {COMMIT_SHA} AS commit, 'user' || (o_custkey % 50) AS author, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || {st.OFFSET} AS datetime,
  o_orderpriority AS message, {SQL_AT} AS happened FROM orders"""


def commits(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        f"{COMMIT_SHA} AS commit",
        "'user' || (o_custkey % 50) AS author",
        f"date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") || {st.OFFSET} AS datetime",
        "o_orderpriority AS message",
    )
    return rows.withColumn("at", parse_offset_time(F.col("datetime")))


@query("commit_scan", f"SELECT commit, author, datetime, message || chr(31) || author AS message FROM ({SQL_COMMITS})")
def commit_scan(spark, folder):
    line = F.concat_ws("\u001f", "commit", "author", "datetime", "message", "author")
    return ch.parse_commits(commits(spark, folder).select(line.alias("line")))


FILE_COLUMNS = {"commit": st.SHA.format("l_orderkey"), "code": st.FILE_CODE, "file": st.FILE_OLD, "new_file": st.FILE_NEW, "diff": st.FILE_DIFF}
FILES = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in FILE_COLUMNS.items()) + " FROM lineitem"
RULE_FILE = "^sigma-rules/.*/.*[.](yml|yaml)$"
SQL_FILES = f"""SELECT commit, code, file, CASE WHEN starts_with(code, 'R') THEN new_file END AS new_file, diff FROM ({FILES})
  WHERE regexp_matches(file, '{RULE_FILE}') OR (starts_with(code, 'R') AND regexp_matches(new_file, '{RULE_FILE}'))"""


def all_files(spark, folder):
    columns = {name: F.expr(text) for name, text in FILE_COLUMNS.items()}
    return with_once(spread_table(spark, folder, "lineitem"), **columns).select(*columns)


def files(spark, folder):
    found = all_files(spark, folder).withColumn("new_file", F.when(F.col("code").startswith("R"), F.col("new_file")))
    return found.where(ch.is_rule_path(F.col("file")) | F.coalesce(ch.is_rule_path(F.col("new_file")), F.lit(False)))


@query("change_scan", f"SELECT commit, code, file, new_file FROM ({SQL_FILES})")
def change_scan(spark, folder):
    renamed = F.when(F.col("code").startswith("R"), F.col("new_file"))
    return ch.parse_file_changes(all_files(spark, folder).select(F.concat_ws("\t", "commit", "code", "file", renamed).alias("line")))


SQL_LABEL = "CASE left(code, 1) WHEN 'A' THEN 'Created' WHEN 'M' THEN 'Modified' WHEN 'D' THEN 'Deleted' WHEN 'R' THEN 'Renamed' ELSE code END"


@query("change_label", f"SELECT code, {SQL_LABEL} AS label, count(*) AS files FROM ({FILES}) GROUP BY ALL")
def change_label(spark, folder):
    labelled = all_files(spark, folder).select("code", ch.status_label(F.col("code")).alias("label"))
    return labelled.groupBy("code", "label").agg(F.count("*").alias("files"))


# The labels that the comparison expects, in reporting order.
LABELS = [
    ("title", "Title updated"), ("description", "Description updated"), ("status", "Status changed"), ("level", "Severity changed"), ("version", "Version updated"),
    ("references", "References updated"), ("tags", "ATT&CK/context tags updated"), ("falsepositives", "False positive guidance updated"), ("logsource", "Logsource updated"),
    ("detection", "Detection logic updated"), ("related", "Related rule mapping updated"),
]
NO_LABEL = "Misc rule metadata updated"


def sql_labels(diff: str) -> str:
    found = ", ".join(rf"CASE WHEN regexp_matches({diff}, '(?m)^\s*[+-]\s*{k}\s*:') THEN '{v}' END" for k, v in LABELS)
    listed = f"[x FOR x IN [{found}] IF x IS NOT NULL]"
    return f"CASE WHEN len({listed}) > 0 THEN {listed} ELSE ['{NO_LABEL}'] END"


LINES = [f"chr(10) || '+{k}: x'" if i % 2 else f"chr(10) || '  -  {k} :'" for i, (k, _) in enumerate(LABELS)]
DOC_DIFF = f"text || ({st.cases('doc_id', LINES + ['chr(10)'])}) || ({st.cases('doc_id', [*LINES[2:7], 'chr(10)'])})"


@query("diff_classify", f"SELECT doc_id, array_to_string({sql_labels('diff')}, '; ') AS labels FROM (SELECT doc_id, {DOC_DIFF} AS diff FROM documents)")
def diff_classify(spark, folder):
    diffs = spread_table(spark, folder, "documents").selectExpr("doc_id", f"{DOC_DIFF} AS diff")
    return diffs.select("doc_id", F.array_join(ch.diff_labels(F.col("diff")), "; ").alias("labels"))


SQL_BASE = "regexp_extract({}, '[^/]*$')"
SQL_DIR = "regexp_extract({}, '^(.*)/[^/]*$', 1)"
SQL_MOVED = f"{SQL_BASE.format('file')} = {SQL_BASE.format('new_file')} AND {SQL_DIR.format('file')} <> {SQL_DIR.format('new_file')}"


@query("rename_move", f"SELECT commit, file, new_file, {SQL_MOVED} AS moved FROM ({SQL_FILES}) WHERE starts_with(code, 'R')")
def rename_move(spark, folder):
    renamed = files(spark, folder).where(F.col("code").startswith("R"))
    return renamed.select("commit", "file", "new_file", ch.is_move(F.col("file"), F.col("new_file")).alias("moved"))


SQL_CHANGES = f"""SELECT datetime, commit, message, author, file, {SQL_BASE.format('file')} AS filename, {SQL_DIR.format('file')} AS filepath, status,
  unnest(listed) AS change, unnest(range(len(listed))) AS position, happened FROM (SELECT f.*, c.datetime, c.message, c.author, c.happened, CASE WHEN label = 'Renamed' AND {SQL_MOVED} THEN 'Moved' ELSE label END AS status,
    CASE WHEN label = 'Modified' THEN {sql_labels('diff')} WHEN label = 'Renamed' AND {SQL_MOVED} THEN ['Moved to ' || {SQL_DIR.format('new_file')}]
      WHEN label = 'Renamed' THEN ['Renamed to ' || new_file] ELSE [''] END AS listed
  FROM (SELECT *, {SQL_LABEL} AS label FROM ({SQL_FILES})) f JOIN ({SQL_COMMITS}) c USING (commit))"""


def changes(spark, folder):
    meta = commits(spark, folder).drop("at")
    return ch.change_rows(meta, files(spark, folder)).withColumn("changed_at", parse_offset_time(F.col("datetime")))


@query("change_flatten", f"SELECT * EXCLUDE (happened, position) FROM ({SQL_CHANGES})")
def change_flatten(spark, folder):
    return changes(spark, folder).drop("position", "changed_at")


@query("change_counts", f"SELECT status, count(DISTINCT commit) AS commit_count, count(*) AS change_count FROM ({SQL_CHANGES}) GROUP BY status")
def change_counts(spark, folder):
    return ch.change_counts(changes(spark, folder), "status")


STEPS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH"}


def add_bucket(bucket: str) -> None:
    @query(
        f"bucket_{bucket}",
        f"""SELECT strftime(s, '%Y-%m-%d') AS bucket_start, strftime(s + {STEPS[bucket]}, '%Y-%m-%d') AS bucket_end, count(*) AS commits
            FROM (SELECT date_trunc('{bucket}', happened) AS s FROM ({SQL_COMMITS})) GROUP BY s""",
    )
    def counted(spark, folder):
        rows = ch.with_bucket(commits(spark, folder).select("at"), "at", bucket)
        counts = rows.groupBy("bucket_start", "bucket_end").agg(F.count("*").alias("commits"))
        day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
        return counts.select(day("bucket_start"), day("bucket_end"), "commits")


for _bucket in STEPS:
    add_bucket(_bucket)


@query(
    "history_range",
    f"""SELECT DISTINCT c.commit, c.datetime FROM ({SQL_COMMITS}) c JOIN ({SQL_FILES}) f USING (commit)
        WHERE happened >= TIMESTAMP '1996-01-01' AND happened <= TIMESTAMP '1997-12-31'""",
)
def history_range(spark, folder):
    """Commits of a date range that touch a rule, newest first."""
    chosen = ch.in_range(commits(spark, folder), "at", "1996-01-01", "1997-12-31")
    return ch.touching(chosen, files(spark, folder)).orderBy(F.col("at").desc(), "commit").select("commit", "datetime")


URL = "https://git.example.org/rules"
SQL_HEADING = "CASE WHEN status IN ('Created', 'Modified', 'Deleted', 'Moved', 'Renamed') THEN status ELSE 'Other' END"
SQL_RANK = "list_position(['Created', 'Modified', 'Deleted', 'Moved', 'Renamed', 'Other'], h) - 1"


@query(
    "change_render",
    f"""WITH r AS (SELECT *, date_trunc('month', happened) AS b, {SQL_HEADING} AS h FROM ({SQL_CHANGES})),
        l AS (SELECT NULL AS b, -1 AS rank, 0 AS part, '' AS file, '' AS commit, 0 AS position, '# Rule Changelog' AS line UNION ALL SELECT NULL, -1, 1, '', '', 0, ''
        UNION ALL SELECT b, -1, unnest([0, 1]), '', '', 0, unnest(['## ' || strftime(b, '%Y-%m-%d') || ' to ' || strftime(b + INTERVAL 1 MONTH, '%Y-%m-%d'), ''])
          FROM (SELECT DISTINCT b FROM r)
        UNION ALL SELECT b, {SQL_RANK}, unnest([0, 2]), '', '', 0, unnest(['### ' || h, '']) FROM (SELECT DISTINCT b, h FROM r)
        UNION ALL SELECT b, {SQL_RANK}, 1, file, commit, position, '- `' || file || '`' || CASE WHEN change <> '' THEN ' - ' || change ELSE '' END || ' ([' || left(commit, 7)
          || ']({URL}/commit/' || commit || '), ' || author || ': ' || message || ')' FROM r)
        SELECT row_number() OVER (ORDER BY b DESC NULLS FIRST, rank, part, file, commit, position, line) - 1 AS line_no, strftime(b, '%Y-%m-%d') AS bucket, file, line FROM l""",
)
def change_render(spark, folder):
    # Headings and entries read the same rows, so these are joined once and written first, without what no line shows.
    path, joined = run_folder(spark, "changes"), changes(spark, folder).drop("datetime", "filename", "filepath")
    joined.write.parquet(path)
    lines = ch.with_line_numbers(ch.changelog_lines(spark.read.schema(joined.schema).parquet(path), "month", URL))
    return lines.select("line_no", F.date_format("bucket_start", "yyyy-MM-dd").alias("bucket"), "file", "line")


@query(
    "release_notes",
    """SELECT 0 AS section, '# Release Notes: v' || y AS line FROM (SELECT max(year(o_orderdate)) AS y FROM orders) UNION ALL SELECT 1, ''
       UNION ALL SELECT 2, 'Changes since v' || max(y) || ':' FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) WHERE y < (SELECT max(year(o_orderdate)) FROM orders)
       UNION ALL SELECT 3, ''
       UNION ALL SELECT 4, '* ' || left(md5(CAST(o_orderkey AS VARCHAR)), 7) || ' ' || o_orderpriority || ' (user' || (o_custkey % 50) || ')' FROM orders,
         (SELECT max(t) AS hi, arg_max(t, t) AS x FROM (SELECT min(o_orderdate) AS t FROM orders GROUP BY year(o_orderdate))) a
       WHERE o_orderdate <= hi AND o_orderdate > (SELECT max(t) FROM (SELECT min(o_orderdate) AS t FROM orders GROUP BY year(o_orderdate)) z WHERE t < hi)""",
)
def notes(spark, folder):
    orders = table(spark, folder, "orders")
    tags = orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.min("o_orderdate").alias("created"))
    made = orders.selectExpr(f"{COMMIT_SHA} AS commit", "o_orderdate AS at", "'user' || (o_custkey % 50) AS author", "o_orderpriority AS message")
    named = tags.select(F.concat(F.lit("v"), "y").alias("name"), "created")
    return release_notes(named, made).select(F.col("section").cast("int"), "line")
