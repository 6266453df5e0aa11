"""Lexical checks of query texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import (
    collect_errors, count_of, is_blank, once, strip_markup_comments, strip_slash_comments, with_once,
)

# Bracket pairs and the message for each, in reporting order.
PAIRS = (
    ("(", ")", "Unbalanced parentheses"),
    ("[", "]", "Unbalanced brackets"),
    ("{", "}", "Unbalanced braces"),
)
BACKENDS = ("splunk", "kql", "elasticsearch")


def without_comments(backend: Column, text: Column) -> Column:
    """Splunk drops <!-- -->, KQL drops // and /* */, Elasticsearch keeps the text."""
    return (
        F.when(backend == "splunk", strip_markup_comments(text))
        .when(backend == "kql", strip_slash_comments(text))
        .otherwise(text)
    )


def balance_errors(text: Column) -> Column:
    return collect_errors(*[(count_of(text, a) != count_of(text, b), message) for a, b, message in PAIRS])


def lint(queries: DataFrame) -> DataFrame:
    """queries(path, backend, query_text) with `errors` and `is_valid`. An unreadable query has NULL text."""
    backend, raw = F.col("backend"), F.col("query_text")
    judge = lambda clean: F.when(is_blank(clean), F.array(F.lit("Query is empty"))).otherwise(balance_errors(clean))
    errors = (
        F.when(~backend.isin(*BACKENDS), F.array(F.concat(F.lit("Unknown query type: "), backend)))
        .when(raw.isNull(), F.array(F.lit("Error reading file")))
        .otherwise(once(without_comments(backend, raw), judge))
    )
    return with_once(queries, errors=errors).withColumn("is_valid", F.size("errors") == 0)


def lint_summary(linted: DataFrame, *by: str) -> DataFrame:
    counts = linted.groupBy(*by).agg(
        F.count("*").alias("files_checked"), F.count_if(~F.col("is_valid")).alias("failed_files")
    )
    return counts.withColumn("status", F.when(F.col("failed_files") > 0, "failure").otherwise("success"))


def lint_messages(linted: DataFrame) -> DataFrame:
    """One line `path: error, error` per failing query. Sort by path when writing."""
    failed = linted.where(~F.col("is_valid"))
    return failed.select("path", F.concat_ws(": ", "path", F.array_join("errors", ", ")).alias("message"))
