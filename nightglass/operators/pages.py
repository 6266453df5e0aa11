"""Generated documents: rule pages, the index and release notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import stem
from nightglass.operators.validate import part
from nightglass.session import local_table


def with_meta(rules: DataFrame, meta: DataFrame) -> DataFrame:
    """Left join of rules(path) with meta(path of <stem>.meta.yml, owner) on the path without suffix."""
    key = lambda c: F.regexp_replace(c, r"(\.meta)?\.(yml|yaml)$", "")
    side = meta.select(key(F.col("path")).alias("_key"), "owner")
    return rules.withColumn("_key", key(F.col("path"))).join(side, "_key", "left").drop("_key")


def _bullets(items: Column) -> Column:
    """`- item` per line, each with its line end."""
    return F.array_join(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda i: F.concat(F.lit("- "), i, F.lit("\n"))), "")


def _rendered(value: Column) -> Column:
    """Text of a scalar as the template prints it: a JSON null is None, a boolean True or False."""
    kind, shown = F.schema_of_variant(value), value.try_cast("string")
    return F.when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(shown)).otherwise(shown)


def detection_page(path: Column, doc: Column, owner: Column) -> Column:
    """The Markdown page of one rule. Missing scalars are empty, missing log source parts are n/a."""
    blank = lambda name: F.coalesce(_rendered(part(doc, name)), F.lit(""))
    source = lambda name: F.coalesce(_rendered(F.try_variant_get(doc, f"$.logsource.{name}", "variant")), F.lit("n/a"))
    items = lambda name: _bullets(part(doc, name).try_cast("array<string>"))
    return F.concat(
        F.lit("# "), F.coalesce(_rendered(part(doc, "title")), stem(path)),
        F.lit("\n\n**Rule ID:** "), blank("id"),
        F.lit("  \n**Status:** "), blank("status"),
        F.lit("  \n**Version:** "), blank("version"),
        F.lit("  \n**Owner:** "), F.coalesce(owner, F.lit("")),
        F.lit("\n\n## Description\n"), blank("description"),
        F.lit("\n\n## Log Source\n- Product: "), source("product"),
        F.lit("\n- Category: "), source("category"),
        F.lit("\n- Service: "), source("service"),
        F.lit("\n\n## Tags\n"), items("tags"),
        F.lit("\n\n## References\n"), items("references"),
        F.lit("\n\n## False Positives\n"), items("falsepositives"),
    )


def page_name(path: Column) -> Column:
    return F.concat(stem(path), F.lit(".md"))


def index_lines(rules: DataFrame, folder: str = "documentation/detections") -> DataFrame:
    """The index as ordered lines (section, key, line): one per page, in path order."""
    heads = local_table(
        rules.sparkSession, [(0, "", "# Documentation Index"), (1, "", ""), (2, "", "## Detections")], "section int, key string, line string"
    )
    pages = rules.where(~F.col("path").endswith(".meta.yml")).select(
        F.lit(3).alias("section"), F.col("path").alias("key"), F.concat(F.lit(f"- {folder}/"), page_name(F.col("path"))).alias("line")
    )
    return heads.unionByName(pages)


def release_notes(tags: DataFrame, commits: DataFrame) -> DataFrame:
    """Commits after the second newest tag up to the newest, as ordered lines (section, at, line).

    tags(name, created), commits(commit, at, author, message). Fewer than two tags give no line. The
    two tags are found by a top-2 and enter as scalar subqueries, so the range reaches the scan.
    """
    two = tags.orderBy(F.col("created").desc(), F.col("name").desc()).limit(2)
    pair = two.agg(
        F.max_by("name", F.struct("created", "name")).alias("current"),
        F.min_by("name", F.struct("created", "name")).alias("previous"),
        F.max("created").alias("upto"),
        F.min("created").alias("since"),
        F.count("*").alias("n"),
    ).where("n = 2")
    bound = lambda name: pair.select(name).scalar()
    line = F.concat(F.lit("* "), F.left("commit", F.lit(7)), F.lit(" "), "message", F.lit(" ("), "author", F.lit(")"))
    inside = commits.where((F.col("at") > bound("since")) & (F.col("at") <= bound("upto")))
    entries = inside.select(F.lit(4).alias("section"), F.col("at"), line.alias("line"))
    heads = pair.select(
        F.posexplode(
            F.array(
                F.concat(F.lit("# Release Notes: "), "current"), F.lit(""),
                F.concat(F.lit("Changes since "), "previous", F.lit(":")), F.lit(""),
            )
        ).alias("section", "line")
    ).select("section", F.lit(None).cast(commits.schema["at"].dataType).alias("at"), "line")
    return heads.unionByName(entries)
