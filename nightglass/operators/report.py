"""Coverage of the rule corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import capitalise, file_name
from nightglass.session import local_table


def category_of(path: Column, root: str = "sigma-rules") -> Column:
    """Folder of a rule that lies directly below <root>/<category>/, else NULL."""
    pattern = rf"(?:^|/){root}/([^/]+)/[^/]+\.(?:yml|yaml)$"
    return F.when(path.rlike(pattern) & ~path.endswith(".meta.yml"), F.regexp_extract(path, pattern, 1))


def rules_by_category(rules: DataFrame) -> DataFrame:
    found = rules.select(category_of(F.col("path")).alias("category")).where("category is not null")
    return found.groupBy("category").agg(F.count("*").alias("rules"))


def converted_counts(spark, queries: DataFrame, backends=("splunk", "kql", "elasticsearch")) -> DataFrame:
    """Converted queries per back end; side files do not count and a back end without files has 0."""
    name = file_name(F.col("path"))
    real = queries.where(~name.endswith(".meta") & ~name.endswith(".error"))
    counts = real.groupBy("backend").agg(F.count("*").alias("n"))
    wanted = local_table(spark, [(b,) for b in backends], "backend string")
    return wanted.join(counts, "backend", "left").select("backend", F.coalesce("n", F.lit(0).cast("bigint")).alias("converted"))


def coverage(converted: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds total_rules and percent (one decimal, 0.0 without rules). The total is a scalar subquery."""
    total = F.coalesce(rules.select(F.count("*")).scalar(), F.lit(0).cast("bigint"))
    percent = F.when(F.col("total_rules") > 0, F.round(F.col("converted") * 100.0 / F.col("total_rules").cast("double"), 1))
    return converted.withColumn("total_rules", total).withColumn("percent", F.coalesce(percent, F.lit(0.0).cast("double")))


def coverage_cube(rules: DataFrame) -> DataFrame:
    """rules(category, level, tags): rules per category, severity and ATT&CK tag with all sub-totals."""
    tagged = rules.select("category", "level", F.explode("tags").alias("tag")).where(F.lower("tag").startswith("attack."))
    return tagged.cube("category", "level", "tag").agg(
        F.count("*").alias("rules"), F.grouping_id().cast("int").alias("grouping")
    )


def report_lines(categories: DataFrame, covered: DataFrame) -> DataFrame:
    """The Markdown report as ordered lines (section, key, line)."""
    total = F.coalesce(categories.select(F.sum("rules")).scalar(), F.lit(0).cast("bigint"))
    spark = categories.sparkSession
    # Headings by their place in the document.
    heads = [
        (0, "# Detection Coverage Report"), (1, ""), (2, "## Summary"), (3, ""),
        (6, ""), (7, "## Rules by Category"), (8, ""), (10, ""), (11, "## Conversion Status"), (12, ""),
    ]
    fixed = local_table(spark, heads, "section int, line string").select("section", F.lit("").alias("key"), "line")
    summary = fixed.where("section = 0").select(
        F.lit(4).alias("section"), F.lit("").alias("key"), F.concat(F.lit("- **Total Rules**: "), total).alias("line")
    )
    per_category = categories.select(
        F.lit(9).alias("section"), F.col("category").alias("key"),
        F.concat(F.lit("- **"), capitalise(F.col("category")), F.lit("**: "), "rules", F.lit(" rules")).alias("line"),
    )
    made = F.concat(F.lit("- **"), capitalise(F.col("backend")), F.lit(" Queries Generated**: "), "converted")
    share = F.format_string("- %s: %d/%d rules converted (%.1f%%)", capitalise(F.col("backend")), "converted", "total_rules", "percent")
    # Both lines of a back end from one pass over its count.
    both = F.array(F.struct(F.lit(5).alias("section"), made.alias("line")), F.struct(F.lit(13).alias("section"), share.alias("line")))
    backends = covered.select(F.col("backend").alias("key"), F.explode(both).alias("l")).select("l.section", "key", "l.line")
    return fixed.unionByName(summary).unionByName(per_category).unionByName(backends)
