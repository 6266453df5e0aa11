"""Schema manifests, diagnostics and tabular query answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import snippet

# Scalar type names of the query language that have a symbol; others are unknown.
SCALAR_TYPES = (
    "bool", "datetime", "decimal", "dynamic", "guid", "int", "long", "real", "string", "timespan",
)


def normalise_type(name: Column) -> Column:
    """Lower case, bigint to long, uri to string, no blanks. Replaces inside longer names as well."""
    aliased = F.replace(F.replace(F.lower(name), F.lit("bigint"), F.lit("long")), F.lit("uri"), F.lit("string"))
    return F.replace(aliased, F.lit(" "), F.lit(""))


def type_symbol(name: Column) -> Column:
    known = normalise_type(name)
    return F.when(known.isin(*SCALAR_TYPES), known).otherwise("unknown")


MANIFEST = """
    name string, functionname string, isresourcecentric boolean, query string,
    properties array<struct<name: string, type: string, description: string>>,
    functionparameters array<struct<name: string, type: string, description: string>>,
    functionresultcolumns array<struct<name: string, type: string, description: string>>
"""


def parse_manifests(texts: DataFrame) -> DataFrame:
    """texts(path, text) to manifests with `object_kind` table, function, other or unreadable.

    Keys are compared in lower case: they are lowered in the JSON text before it is read.
    """
    lowered = F.regexp_replace("text", r'"([A-Za-z_]+)"(\s*:)', "\u0001$1\u0002$2")
    pieces = F.split(lowered, "\u0001")
    folded = F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(
                p.contains("\u0002"),
                F.concat(F.lit('"'), F.lower(F.split_part(p, F.lit("\u0002"), F.lit(1))), F.lit('"'), F.split_part(p, F.lit("\u0002"), F.lit(2))),
            ).otherwise(p),
        ),
        "",
    )
    readable = F.try_parse_json("text").isNotNull()
    parsed = texts.select("path", readable.alias("_ok"), F.from_json(folded, MANIFEST).alias("m"))
    state = (
        F.when(~F.col("_ok"), "unreadable")
        .when(F.col("m.properties").isNotNull(), "table")
        .when(F.col("m.functionparameters").isNotNull(), "function")
        .otherwise("other")
    )
    return parsed.select("path", state.alias("object_kind"), "m.*")


def manifest_warnings(manifests: DataFrame) -> DataFrame:
    bad = manifests.where("object_kind = 'unreadable'")
    return bad.select("path", F.concat(F.lit("Skipping manifest "), "path").alias("warning"))


def _columns(rows: DataFrame, object_name: Column, *kinds: tuple[str, Column]) -> DataFrame:
    """Columns of each kind, unfolded in one pass over the manifests."""

    def listed(kind: str, columns: Column) -> Column:
        entries = F.transform(columns, lambda c, i: F.struct(F.lit(kind).alias("kind"), i.alias("ordinal"), c.alias("c")))
        return F.coalesce(entries, F.array().cast("array<struct<kind:string,ordinal:int,c:struct<name:string,type:string,description:string>>>"))

    spread = rows.select(object_name.alias("object_name"), "object_kind", F.explode(F.concat(*[listed(k, c) for k, c in kinds])).alias("e"))
    return spread.select(
        "object_name",
        "object_kind",
        F.col("e.kind").alias("column_kind"),
        F.col("e.ordinal").alias("ordinal"),
        F.col("e.c.name").alias("col_name"),
        type_symbol(F.col("e.c.type")).alias("col_type"),
        F.col("e.c.description").alias("description"),
    )


def _text_column(name: str) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit("String").alias("type"), F.lit(None).cast("string").alias("description"))


def _full_columns() -> Column:
    """Columns of a table manifest, with Type added, and _ResourceId where resource centric and absent."""
    props = F.concat("properties", F.array(_text_column("Type")))
    has_id = F.exists(props, lambda p: p["name"] == "_ResourceId")
    wanted = F.coalesce("isresourcecentric", F.lit(False)) & ~has_id
    return F.when(wanted, F.concat(props, F.array(_text_column("_ResourceId")))).otherwise(props)


def table_columns(manifests: DataFrame) -> DataFrame:
    return _columns(manifests.where("object_kind = 'table'"), F.col("name"), ("column", _full_columns()))


def function_columns(manifests: DataFrame) -> DataFrame:
    """Parameters and result columns of function manifests."""
    functions = manifests.where("object_kind = 'function'")
    return _columns(functions, F.col("functionname"), ("parameter", F.col("functionparameters")), ("result", F.col("functionresultcolumns")))


def function_bodies(manifests: DataFrame) -> DataFrame:
    """The body counts only for a function with a query and no result columns."""
    results = F.coalesce(F.size("functionresultcolumns"), F.lit(0))
    body = F.when((results <= 0) & (F.coalesce("query", F.lit("")) != ""), F.col("query"))
    return manifests.where("object_kind = 'function'").select(F.col("functionname").alias("object_name"), body.alias("body"))


def schema_columns(manifests: DataFrame) -> DataFrame:
    """Columns of tables and functions. The manifests are read and parsed once."""
    is_table, is_function = F.col("object_kind") == "table", F.col("object_kind") == "function"
    known = manifests.where(is_table | is_function)
    name = F.when(is_table, F.col("name")).otherwise(F.col("functionname"))
    return _columns(
        known, name, ("column", F.when(is_table, _full_columns())),
        ("parameter", F.when(is_function, F.col("functionparameters"))), ("result", F.when(is_function, F.col("functionresultcolumns"))),
    )


def diagnostic_lines(diagnostics: DataFrame) -> DataFrame:
    """diagnostics(file, severity, message, start, end, query_text) with is_error and the shown text."""
    near = snippet(F.col("query_text"), F.col("start"), F.col("end"))
    shown = F.concat(
        "severity", F.lit(": "), "message", F.lit(" ["), "start", F.lit("-"), "end", F.lit("] near '"), near, F.lit("'")
    )
    return diagnostics.select("file", (F.lower("severity") == "error").alias("is_error"), shown.alias("text"))


def diagnostic_counts(lines: DataFrame, *by: str) -> DataFrame:
    """Errors and warnings per group; a file fails on errors only."""
    counts = lines.groupBy(*by).agg(
        F.count_if(F.col("is_error")).alias("errors"), F.count_if(~F.col("is_error")).alias("warnings")
    )
    return counts.withColumn("status", F.when(F.col("errors") > 0, "failure").otherwise("success"))


def diagnostic_totals(files: DataFrame, lines: DataFrame) -> DataFrame:
    """files(file) checked, files failed, and diagnostics in total; one row."""
    per_file = diagnostic_counts(lines, "file")
    joined = files.select("file").join(per_file, "file", "left")
    return joined.agg(
        F.count("*").alias("files_checked"),
        F.count_if(F.col("errors") > 0).alias("failed_files"),
        F.coalesce(F.sum(F.col("errors") + F.col("warnings")), F.lit(0).cast("bigint")).alias("diagnostics_count"),
    )


def primary_rows(answers: DataFrame) -> DataFrame:
    """answers(tables array<{name, columns[{name}], rows[[..]]}>) to one map per row of PrimaryResult.

    Names and values are paired up to the shorter of the two, and the last of equal names counts; an answer without
    that table has no row.
    """
    table = F.get(F.filter("tables", lambda t: t["name"] == "PrimaryResult"), F.lit(0))
    others = [c for c in answers.columns if c != "tables"]
    rows = answers.select(
        *others, F.transform(table["columns"], lambda c: c["name"]).alias("names"), F.posexplode(table["rows"]).alias("row_no", "cells")
    )
    width = F.least(F.size("names"), F.size("cells"))
    names = F.slice("names", F.lit(1), width)
    cells = F.zip_with(names, F.slice("cells", F.lit(1), width), lambda k, v: F.struct(k, v))
    pairs = F.map_from_entries(F.filter(cells, lambda _, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.get(names, i))))
    return rows.select(*others, "row_no", pairs.alias("row"))
