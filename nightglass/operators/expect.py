"""Row-count expectations, run summaries and stage records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import file_name, is_blank
from nightglass.operators.detect import count_matches, row_counts
from nightglass.operators.rules import CompiledRule
from nightglass.session import local_table

MODES = ("compile", "execute", "both")


def find_expectation(results: DataFrame, expectations: DataFrame) -> DataFrame:
    """Adds `expected` {min_rows, max_rows} by query_path, else by its file name; NULL without one."""
    entry = F.struct("min_rows", "max_rows")
    by_path = expectations.select(F.col("query_key").alias("query_path"), entry.alias("_by_path"))
    by_name = expectations.select(F.col("query_key").alias("_name"), entry.alias("_by_name"))
    named = results.withColumn("_name", file_name(F.col("query_path")))
    joined = named.join(by_path, "query_path", "left").join(by_name, "_name", "left")
    return joined.select(*results.columns, F.coalesce("_by_path", "_by_name").alias("expected"))


def expectation_error(expected: Column, row_count: Column) -> Column:
    """Message of a missed minimum (default 0), else of a missed maximum, else NULL."""
    low = F.coalesce(expected["min_rows"], F.lit(0))
    high = expected["max_rows"]
    shown = lambda sign, bound: F.concat(F.lit(f"expected {sign} "), bound, F.lit(", got "), row_count)
    missed = F.when(row_count < low, shown(">=", low)).when(row_count > high, shown("<=", high))
    return F.when(expected.isNotNull(), missed)


def check(results: DataFrame, expectations: DataFrame, backend: str | None = None) -> DataFrame:
    """results(query_path, total_hits, ..) with `error` and `passed`, by the expectations of one back end.

    A key may stand once per back end, so name the back end when the table holds several.
    """
    if backend is not None:
        expectations = expectations.where(F.col("backend") == backend)
    found = find_expectation(results, expectations)
    error = expectation_error(F.col("expected"), F.col("total_hits"))
    return found.withColumn("error", error).withColumn("passed", F.col("error").isNull()).drop("expected")


def run_rules(
    events: DataFrame, rules: list[CompiledRule], keep: list[str], mode: str = "execute", limit: int = 1000, expectations: DataFrame | None = None, folder: str = "output"
) -> DataFrame:
    """Per rule: compile_ok, exec_ok, counts, stage errors, a warning, and passed.

    A rule passes only if no stage that was asked for failed. Execution fails where a rule did not compile, or where its count
    misses the expectation of its query file, `folder`/<rule_id>.sql. In mode `compile` no event is read.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of: {', '.join(MODES)}")
    from nightglass.operators.detect import detect

    spark = events.sparkSession
    compiled = local_table(spark, [(r.rule_id, r.error) for r in rules], "rule_id string, compile_error string")
    if mode == "compile":
        counts = compiled.select("rule_id", F.lit(0).cast("bigint").alias("total_hits"))
    else:
        counts = count_matches(detect(events, rules, keep), rules)
    joined = compiled.join(row_counts(counts, limit), "rule_id").withColumn("query_path", F.concat(F.lit(f"{folder}/"), "rule_id", F.lit(".sql")))
    if expectations is None or mode == "compile":
        joined = joined.withColumn("error", F.lit(None).cast("string"))
    else:
        joined = check(joined, expectations)
    ok, missed = F.col("compile_error") == "", F.col("error")
    ran = ok & missed.isNull()
    passed_only = F.concat("rule_id", F.lit(": compile passed; execution not requested"))
    return joined.select(
        "rule_id",
        (ok if mode != "execute" else F.lit(None).cast("boolean")).alias("compile_ok"),
        (ran if mode != "compile" else F.lit(None).cast("boolean")).alias("exec_ok"),
        "total_hits",
        "returned_rows",
        F.when(~ok, F.concat("rule_id", F.lit(": compile failed: "), "compile_error")).when(~ran, F.concat("rule_id", F.lit(": "), missed)).alias("stage_error"),
        F.when(ok & F.lit(mode == "compile"), passed_only).alias("warning"),
        ran.alias("passed"),
    )


def run_summary(checks: DataFrame, *by: str) -> DataFrame:
    """files_checked, passed, failed, compile_failures, execution_failures, duration_ms and the status of a run.

    `checks` holds passed, compile_ok / exec_ok where those stages ran, and duration_ms where it was measured.
    """
    has = set(checks.columns)
    compile_bad = F.count_if(~F.col("compile_ok")) if "compile_ok" in has else F.lit(0).cast("bigint")
    exec_bad = F.count_if(~F.col("exec_ok")) if "exec_ok" in has else F.count_if(~F.col("passed"))
    summary = checks.groupBy(*by).agg(
        F.count("*").alias("files_checked"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        compile_bad.alias("compile_failures"),
        exec_bad.alias("execution_failures"),
        *([F.coalesce(F.sum("duration_ms"), F.lit(0)).cast("bigint").alias("duration_ms")] if "duration_ms" in has else []),
    )
    return summary.withColumn("status", F.when(F.col("failed") > 0, "failure").otherwise("success"))


def refuse_empty(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """Adds `error` to a query without text, so that it counts as a failure."""
    return queries.withColumn("error", F.when(is_blank(F.col(text)), "Query file is empty"))


def stage_record(stages: DataFrame) -> DataFrame:
    """(query_file, stage, status, row_count, duration_ms, errors) to one map of stages per query.

    A stage listed more than once keeps its greatest entry, so a group holds a handful of rows.
    """
    entry = F.struct("status", "row_count", "duration_ms", "errors")
    last = stages.groupBy("query_file", "stage").agg(F.max(entry).alias("summary"))
    return last.groupBy("query_file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("stage", "summary")))).alias("stages"))


def compact_summary(results: DataFrame) -> DataFrame:
    """The six summary fields of a result, with defaults."""
    metric = lambda name: F.coalesce(F.col("metrics").getItem(name), F.lit(0).cast("bigint")).alias(name)
    return results.select(
        "status",
        "stage",
        F.coalesce("backend", F.lit("")).alias("backend"),
        metric("row_count"),
        metric("duration_ms"),
        F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
    )


def workflow_summary(results: DataFrame) -> DataFrame:
    """Jobs, failures and matches per stage and backend, with sub-totals and a grand total."""
    return results.rollup("stage", "backend").agg(
        F.count("*").alias("jobs"),
        F.count_if(F.col("status") != "success").alias("failures"),
        F.sum("matches").alias("matches"),
        F.grouping_id().cast("int").alias("level"),
    )
