"""Rule history: commits and changed files to labelled, bucketed change rows and Markdown lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import SPACE, file_name, once, parent_path
from nightglass.functions.times import bucket_end, bucket_start
from nightglass.session import salted_join
from nightglass.sinks.artifacts import numbered

# Status letters, changed keys with their label in reporting order, and heading order.
STATUS_LABELS = {"A": "Created", "M": "Modified", "D": "Deleted", "R": "Renamed"}
KEY_LABELS = (
    ("title", "Title updated"),
    ("description", "Description updated"),
    ("status", "Status changed"),
    ("level", "Severity changed"),
    ("version", "Version updated"),
    ("references", "References updated"),
    ("tags", "ATT&CK/context tags updated"),
    ("falsepositives", "False positive guidance updated"),
    ("logsource", "Logsource updated"),
    ("detection", "Detection logic updated"),
    ("related", "Related rule mapping updated"),
)
UNLABELLED = "Misc rule metadata updated"
HEADINGS = ("Created", "Modified", "Deleted", "Moved", "Renamed", "Other")
RULE_ROOT = "sigma-rules/"


def parse_commits(lines: DataFrame) -> DataFrame:
    """Lines of sha, author, date and subject separated by 0x1F; the subject may hold more of them."""
    p = F.split("line", "\u001f", 4)
    at = lambda i: F.get(p, F.lit(i))
    return lines.select(at(0).alias("commit"), at(1).alias("author"), at(2).alias("datetime"), at(3).alias("message"))


def parse_file_changes(lines: DataFrame) -> DataFrame:
    """Lines of commit, status, path and, for renames, new path, separated by tabs. Rules only."""
    p = F.split("line", "\t")
    status = F.get(p, F.lit(1))
    renamed = status.startswith("R") & (F.size(p) >= 4)
    rows = lines.where(F.size(p) >= 3).select(
        F.get(p, F.lit(0)).alias("commit"),
        status.alias("code"),
        F.get(p, F.lit(2)).alias("file"),
        F.when(renamed, F.get(p, F.lit(3))).alias("new_file"),
    )
    return rows.where(is_rule_path(F.col("file")) | F.coalesce(is_rule_path(F.col("new_file")), F.lit(False)))


def is_rule_path(path: Column) -> Column:
    """A .yml or .yaml file in a folder below the rule root."""
    below = F.substring(path, F.lit(len(RULE_ROOT) + 1), F.length(path)).contains("/")
    return path.startswith(RULE_ROOT) & (path.endswith(".yml") | path.endswith(".yaml")) & below


def status_label(code: Column) -> Column:
    """Label of the first letter; other codes stay as they are."""
    cases = reduce(lambda c, kv: c.when(F.left(code, F.lit(1)) == kv[0], kv[1]), STATUS_LABELS.items(), F)
    return cases.otherwise(code)


def diff_labels(diff: Column) -> Column:
    """Labels of the rule keys that a diff touches, in reporting order. One pass over the text."""
    names = "|".join(k for k, _ in KEY_LABELS)
    found = F.regexp_extract_all(diff, F.lit(rf"(?md)^{SPACE}*[+-]{SPACE}*({names}){SPACE}*:"), F.lit(1))
    table = F.create_map(*[x for i, (k, v) in enumerate(KEY_LABELS) for x in (F.lit(k), F.struct(F.lit(i).alias("no"), F.lit(v).alias("label")))])
    ranked = F.array_sort(F.array_distinct(F.transform(found, lambda k: table[k])))
    labels = F.transform(ranked, lambda t: t["label"])
    return once(labels, lambda names: F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(UNLABELLED))))


def is_move(old: Column, new: Column) -> Column:
    return (file_name(old) == file_name(new)) & (parent_path(old) != parent_path(new))


def change_rows(commits: DataFrame, files: DataFrame, salts: int = 1) -> DataFrame:
    """One row per (commit, file, change): commits(commit, author, datetime, message) joined with
    files(commit, code, file, new_file, diff). A file without a change text has one row with ''.

    With `salts` a commit that touches very many files is spread over tasks by the file path.
    """
    label, old, new = status_label(F.col("code")), F.col("file"), F.col("new_file")
    renamed = (label == "Renamed") & new.isNotNull()
    moved = renamed & is_move(old, new)
    changes = (
        F.when(label == "Modified", diff_labels(F.coalesce("diff", F.lit(""))))
        .when(moved, F.array(F.concat(F.lit("Moved to "), parent_path(new))))
        .when(renamed, F.array(F.concat(F.lit("Renamed to "), new)))
        .otherwise(F.array(F.lit("")))
    )
    labelled = files.select(
        "commit",
        "file",
        file_name(old).alias("filename"),
        parent_path(old).alias("filepath"),
        F.when(moved, "Moved").otherwise(label).alias("status"),
        F.posexplode(changes).alias("position", "change"),
    )
    joined = salted_join(labelled, commits, ["commit"], "inner", ["file", "position"], salts)
    return joined.select(
        "datetime", "commit", "message", "author", "file", "filename", "filepath", "status", "change", "position"
    )


def in_range(commits: DataFrame, time: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Commits from start to end, both optional. On a date-partitioned table this prunes."""
    if start:
        commits = commits.where(F.col(time) >= F.lit(start).cast("timestamp"))
    if end:
        commits = commits.where(F.col(time) <= F.lit(end).cast("timestamp"))
    return commits


def touching(commits: DataFrame, files: DataFrame) -> DataFrame:
    """Commits that change a file of `files`. The commits of the files are made distinct map-side first."""
    return commits.join(files.select("commit").distinct(), "commit", "left_semi")


def with_bucket(changes: DataFrame, time: str, bucket: str) -> DataFrame:
    start = bucket_start(F.col(time), bucket)
    return changes.withColumn("bucket_start", start).withColumn("bucket_end", bucket_end(F.col("bucket_start"), bucket))


def change_counts(changes: DataFrame, *by: str) -> DataFrame:
    return changes.groupBy(*by).agg(F.countDistinct("commit").alias("commit_count"), F.count("*").alias("change_count"))


def changelog_lines(changes: DataFrame, bucket: str, repo_url: str = "", time: str = "changed_at") -> DataFrame:
    """The Markdown changelog as ordered lines, newest bucket first.

    Order for writing: bucket_start descending (NULL is the title), then status_rank, part, file,
    commit, position. Entries stay separate rows, so no bucket or status is gathered in one place.
    """
    rows = with_bucket(changes, time, bucket)
    ranks = F.create_map(*[F.lit(x) for i, s in enumerate(HEADINGS) for x in (s, i)])
    known = F.when(F.col("status").isin(*HEADINGS), F.col("status")).otherwise("Other")
    rows = rows.withColumn("heading", known).withColumn("status_rank", ranks[F.col("heading")])
    sha = F.left("commit", F.lit(7))
    link = F.concat(F.lit("["), sha, F.lit(f"]({repo_url}/commit/"), "commit", F.lit(")")) if repo_url else sha
    note = F.when(F.col("change") != "", F.concat(F.lit(" - "), "change")).otherwise("")
    entry = F.concat(F.lit("- `"), "file", F.lit("`"), note, F.lit(" ("), link, F.lit(", "), "author", F.lit(": "), "message", F.lit(")"))
    key = ["bucket_start", "status_rank"]
    blank = [F.lit("").alias("file"), F.lit("").alias("commit"), F.lit(0).alias("position")]
    entries = rows.select(*key, F.lit(1).alias("part"), "file", "commit", "position", entry.alias("line"))
    groups = rows.groupBy(*key, "bucket_end", "heading").agg(F.count("*").alias("n"))
    status_lines = groups.select(
        *key,
        F.explode(F.array(F.struct(F.lit(0).alias("part"), F.concat(F.lit("### "), "heading").alias("line")), F.struct(F.lit(2).alias("part"), F.lit("").alias("line")))).alias("l"),
        *blank,
    ).select(*key, "l.part", "file", "commit", "position", "l.line")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    title = F.concat(F.lit("## "), day("bucket_start"), F.lit(" to "), day("bucket_end"))
    buckets = groups.groupBy("bucket_start", "bucket_end").agg(F.lit(-1).alias("status_rank"))
    bucket_lines = buckets.select(
        *key,
        F.explode(F.array(F.struct(F.lit(0).alias("part"), title.alias("line")), F.struct(F.lit(1).alias("part"), F.lit("").alias("line")))).alias("l"),
        *blank,
    ).select(*key, "l.part", "file", "commit", "position", "l.line")
    none = F.lit("No Sigma rule changes found for the requested time range.")
    counted = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    parts = F.array(F.lit("# Rule Changelog"), F.lit(""))
    opening = F.when(F.col("n") == 0, F.concat(parts, F.array(none))).otherwise(parts)
    start = counted.select(
        F.lit(None).cast("timestamp").alias("bucket_start"), F.lit(-1).alias("status_rank"),
        F.posexplode(opening).alias("part", "line"), *blank,
    ).select(*key, "part", "file", "commit", "position", "line")
    return start.unionByName(bucket_lines).unionByName(status_lines).unionByName(entries)


LINE_ORDER = ("status_rank", "part", "file", "commit", "position", "line")


def in_line_order(lines: DataFrame) -> DataFrame:
    """Changelog lines in document order, by a range-partitioned sort."""
    return lines.orderBy(F.col("bucket_start").desc_nulls_first(), *LINE_ORDER)


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Changelog lines with `line_no`, their place in the document from 0."""
    return numbered(lines, F.col("bucket_start").desc_nulls_first(), *LINE_ORDER)
