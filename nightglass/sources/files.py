"""Rule files, query files, saved-rule JSON, expectations and schema manifests."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from nightglass.functions.text import file_name, is_blank
from nightglass.session import local_table

try:
    import yaml
except ImportError:  # rule tables that already hold JSON need no YAML
    yaml = None

RULE_SUFFIXES = ("yml", "yaml")
EXPECTATION_SCHEMA = "backend string, query_key string, min_rows bigint, max_rows bigint, description string"


def read_texts(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Whole files below a path whose names match a glob, as (path, text). Empty files have the text ''."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    found = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    # The scan lists empty files but gives no row for them.
    listed = local_table(spark, [(f,) for f in reader.text(path, wholetext=True).inputFiles()], "path string")
    # The list and the rows differ in the slashes after the scheme.
    plain = F.regexp_replace("path", "^([A-Za-z0-9]+):/+", "$1:/").alias("plain")
    empty = listed.select("path", plain).join(found.select(plain), "plain", "left_anti").select("path", F.lit("").alias("text"))
    return found.unionByName(empty)


def relative_to(df: DataFrame, anchor: str) -> DataFrame:
    """Cut `path` before the folder named anchor, e.g. `sigma-rules`, if it occurs."""
    return df.withColumn("path", F.regexp_replace("path", rf"^.*/(?={re.escape(anchor)}/)", ""))


def parse_yaml(texts: DataFrame) -> DataFrame:
    """Adds `rule_json` (the YAML document as JSON) and `error`. Dates become text.

    Only the text goes through Python; a parse is never made a second time for a filter on what it gives.
    """

    def one(text):
        try:
            return json.dumps(yaml.safe_load(text or ""), default=str), None
        except (yaml.YAMLError, ValueError, TypeError) as exc:
            return None, str(exc)

    @F.pandas_udf("rule_json string, error string")
    def parsed(part: pd.Series) -> pd.DataFrame:
        done = [one(t) for t in part]
        return pd.DataFrame({"rule_json": [d[0] for d in done], "error": [d[1] for d in done]}, dtype=object)

    made = texts.withColumn("_parsed", parsed.asNondeterministic()("text"))
    return made.select(*[F.col(f"`{c}`") for c in texts.columns], "_parsed.rule_json", "_parsed.error")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """All *.yml and *.yaml rules below a path, or one file: (path, text, rule_json, error)."""
    suffix = re.search(r"\.([A-Za-z][A-Za-z0-9]*)$", path.rstrip("/"))
    if suffix and suffix.group(1).lower() not in RULE_SUFFIXES:
        raise ValueError(f"a rule must be a .yml or .yaml file or a folder: {path}")
    return parse_yaml(read_texts(spark, path, "*.{yml,yaml}"))


def read_queries(spark: SparkSession, path: str, backend: str) -> DataFrame:
    """Query files `*.<backend>` below a path. The glob leaves out the .meta and .error side files."""
    found = read_texts(spark, path, f"*.{backend}")
    return found.select("path", F.lit(backend).alias("backend"), F.col("text").alias("query_text"))


def query_files_found(queries: DataFrame) -> DataFrame:
    """One row: number of query files, and the warning for an empty set."""
    counted = queries.agg(F.count("*").alias("files_checked"))
    none = F.lit("No query files found")
    return counted.withColumn("warning", F.when(F.col("files_checked") == 0, none))


def saved_rule_query(path: Column, text: Column) -> Column:
    """Query inside a saved-rule JSON file, else the text itself; a JSON without one gives ''."""
    inner = F.coalesce(F.get_json_object(text, "$.properties.query"), F.lit(""))
    return F.when(F.lower(path).endswith(".json"), inner).otherwise(text)


def read_saved_queries(spark: SparkSession, path: str, name_pattern: str = r"\.(json|kql)$") -> DataFrame:
    """Files whose name matches the pattern, as (path, query_text, is_empty)."""
    files = read_texts(spark, path, "*").where(file_name(F.col("path")).rlike(name_pattern))
    found = files.select("path", saved_rule_query(F.col("path"), F.col("text")).alias("query_text"))
    return found.withColumn("is_empty", is_blank(F.col("query_text")))


def manifest_outputs(manifests: DataFrame, backend: str) -> DataFrame:
    """Output paths for a backend named in run manifests with a `rules` array: (path)."""
    rules = manifests.select(F.explode("rules").alias("rule"))
    return rules.select(F.col("rule.outputs").getItem(backend).alias("path")).where("path is not null and path <> ''")


def queries_of_run(manifests: DataFrame, listing: DataFrame, backend: str) -> DataFrame:
    """The listed queries that a run produced. Outputs that no longer exist drop out by themselves."""
    return listing.join(manifest_outputs(manifests, backend).distinct(), "path", "left_semi")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Schema manifest files *.json below a path, as (path, text) for catalog.parse_manifests."""
    return read_texts(spark, path, "*.json")


def choose_queries(spark, *, query=None, manifests=None, folder=None, backend: str) -> DataFrame:
    """An explicit query file comes first, then a manifest, then the folder."""
    if query:
        one = spark.read.text(query, wholetext=True)
        return one.select(
            F.col("_metadata.file_path").alias("path"), F.lit(backend).alias("backend"), F.col("value").alias("query_text")
        )
    listing = read_queries(spark, folder, backend)
    return listing if manifests is None else queries_of_run(manifests, listing, backend)


def expectations_of(documents: DataFrame) -> DataFrame:
    """Expectation documents in `rule_json`, {backend: {key: {min, max, description}}}, to rows. Anything else, and empty entries, give none."""
    doc = F.try_parse_json("rule_json")
    backends = documents.select(F.explode(F.try_variant_get(doc, "$", "map<string,variant>")).alias("backend", "entries"))
    keys = backends.select("backend", F.explode(F.try_variant_get("entries", "$", "map<string,variant>")).alias("query_key", "e"))
    filled = keys.where(F.schema_of_variant("e").startswith("OBJECT<") & (F.schema_of_variant("e") != "OBJECT<>"))
    entry = lambda name, kind: F.try_variant_get("e", f"$.{name}", kind)
    return filled.select("backend", "query_key", entry("min", "bigint").alias("min_rows"), entry("max", "bigint").alias("max_rows"), entry("description", "string").alias("description"))


def expectations_table(spark: SparkSession, document: object) -> DataFrame:
    """The rows of one expectation document given as a mapping."""
    return expectations_of(local_table(spark, [(json.dumps(document),)], "rule_json string"))


def read_expectations(spark: SparkSession, path: str) -> DataFrame:
    """Expectations of a YAML file or of all files of a folder; a path that is not there gives none."""
    try:
        parsed = parse_yaml(spark.read.text(path, wholetext=True).withColumnRenamed("value", "text"))
    except AnalysisException:
        return local_table(spark, [], EXPECTATION_SCHEMA)
    return expectations_of(parsed)


def read_change_lines(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lines `commit, status, old path[, new path]`, or any text lines, as (line)."""
    return spark.read.text(path).withColumnRenamed("value", "line")


