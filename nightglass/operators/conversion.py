"""Accounting of conversion outcomes: targets, counts, manifests and bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import present, stem, strip
from nightglass.sinks.artifacts import numbered

BACKENDS = ("splunk", "kql", "elasticsearch")
NOT_SELECTED = "target not selected"


def rule_id(given: Column, path: Column) -> Column:
    """The rule's own id, else the file stem."""
    return F.when(present(given), given).otherwise(stem(path))


def clean_targets(targets: Column) -> Column:
    """Lower-cased, trimmed, non-empty names; NULL stays NULL."""
    return F.filter(F.transform(targets, lambda t: F.lower(strip(t))), lambda t: t != "")


def target_selected(targets: Column, backend: Column | str) -> Column:
    """NULL targets select every back end."""
    return F.coalesce(F.array_contains(clean_targets(targets), backend), F.lit(True))


def per_backend(rules: DataFrame, backends=BACKENDS, targets: str = "targets") -> DataFrame:
    """One row per rule and back end with `selected`."""
    spread = rules.withColumn("backend", F.explode(F.array(*[F.lit(b) for b in backends])))
    return spread.withColumn("selected", target_selected(F.col(targets), F.col("backend")))


def any_target(rules: DataFrame, *by: str, backends=BACKENDS, targets: str = "targets") -> DataFrame:
    """Does any rule name the back end? Rules without the list name none."""
    named = lambda b: F.coalesce(F.array_contains(clean_targets(F.col(targets)), b), F.lit(False))
    flags = [F.bool_or(named(b)).alias(f"any_{b}") for b in backends]
    found = rules.groupBy(*by).agg(*flags)
    none = ~F.greatest(*[F.col(f"any_{b}") for b in backends])
    return found.withColumn("skip_conversion", none)


def status_counts(outcomes: DataFrame) -> DataFrame:
    """Per back end: processed, generated, skipped, failed and the run status."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    counts = outcomes.groupBy("backend").agg(
        F.count("*").alias("processed_rules"),
        is_("success").alias("generated_count"),
        is_("skipped").alias("skipped_count"),
        is_("failed").alias("failed_count"),
    )
    return counts.withColumn("status", F.when(F.col("failed_count") > 0, "failure").otherwise("success"))


def last_entries(entries: Column) -> Column:
    """Sorted (key, value) entries as a map; the last entry of a key counts."""
    keys = F.transform(entries, lambda e: e["backend"])
    return F.map_from_entries(F.filter(entries, lambda e, i: F.coalesce(F.get(keys, i + 1) != e["backend"], F.lit(True))))


def rule_manifests(outcomes: DataFrame) -> DataFrame:
    """One manifest row per rule. A rule has few outcomes, so its lists are short.

    Two files with one rule id are one manifest; of two outputs for a back end the last by path counts.
    """
    made = F.col("status") == "success"
    names = lambda s: F.sort_array(F.collect_list(F.when(F.col("status") == s, F.col("backend"))))
    failure = F.when(F.col("status") == "failed", F.when(present(F.col("message")), F.col("message")).otherwise("conversion failed"))
    return outcomes.groupBy("rule_id").agg(
        last_entries(F.sort_array(F.collect_list(F.when(made, F.struct("backend", "query_path"))))).alias("outputs"),
        names("success").alias("generated"),
        names("skipped").alias("skipped"),
        F.sort_array(F.collect_list(failure)).alias("errors"),
    )


def bundle_rows(outcomes: DataFrame) -> DataFrame:
    """Query text only on success, error only on failure, reason only when skipped."""
    only = lambda s, c: F.when(F.col("status") == s, F.col(c)).otherwise("")
    return outcomes.select(
        "rule_id",
        "rule_path",
        "status",
        "backend",
        "query_path",
        only("success", "query").alias("query"),
        only("failed", "message").alias("error"),
        only("skipped", "message").alias("skipped_reason"),
    )


def document_lines(rows: DataFrame, key: str, head, *facts: Column) -> DataFrame:
    """One JSON document as ordered lines (section, key, line), for sinks.write_lines.

    `rows` become its `rules` array, one line each, so that a run of any size is written in parallel instead of gathered into
    one value. `head` makes the one row whose fields open the document from the rows' `facts`. The rows are made once; every line
    but number 0 opens with a comma.
    """
    text = F.to_json(F.struct(*sorted(rows.columns)))
    lines = numbered(rows.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), text.alias("json"), *facts), "key", "json")
    opened = head(lines)
    opening = F.regexp_replace(F.to_json(F.struct(*sorted(opened.columns))), r"\}\z", "")
    ends = F.array(
        F.struct(F.lit(0).alias("section"), F.concat(opening, F.lit(',"rules":[')).alias("line")),
        F.struct(F.lit(2).alias("section"), F.lit("]}").alias("line")),
    )
    around = opened.select(F.explode(ends).alias("e")).select("e.section", F.lit("").alias("key"), "e.line")
    body = lines.select(F.lit(1).alias("section"), "key", F.concat(F.when(F.col("line_no") == 0, "").otherwise(","), "json").alias("line"))
    return around.unionByName(body)


def bundle_lines(outcomes: DataFrame, backend: str) -> DataFrame:
    """The bundle of one back end: status, metrics and every rule row."""
    own = outcomes.where(F.col("backend") == backend)
    metrics = F.struct("failed_count", "generated_count", "processed_rules", "skipped_count").alias("metrics")

    def head(lines: DataFrame) -> DataFrame:
        return status_counts(lines.select(F.lit(backend).alias("backend"), "status")).select("backend", metrics, "status")

    return document_lines(bundle_rows(own), "rule_path", head, F.col("status"))


def run_manifest_lines(outcomes: DataFrame, backend: str) -> DataFrame:
    """The run manifest of one back end: counts, status and every rule manifest."""
    own = outcomes.where(F.col("backend") == backend)
    failed = F.size("errors").cast("bigint").alias("failed")
    sizes = [F.size("generated").cast("bigint").alias("made"), F.size("skipped").cast("bigint").alias("left"), failed]

    def head(lines: DataFrame) -> DataFrame:
        sums = lines.groupBy(F.lit(backend).alias("backend")).agg(F.sum("made").alias("generated_count"), F.sum("left").alias("skipped_count"), F.sum("failed").alias("failed_count"))
        return sums.withColumn("status", F.when(F.col("failed_count") > 0, "failure").otherwise("success"))

    return document_lines(rule_manifests(own), "rule_id", head, *sizes)
