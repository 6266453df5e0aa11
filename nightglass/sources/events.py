"""Log events: NDJSON lines, envelopes, open schemas, and wildcard choice of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightglass.functions.text import is_blank, once, with_once

CORRUPT = "_corrupt_record"


def read_event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all *.ndjson files of a folder as (line, file). No file gives an empty table."""
    lines = spark.read.option("pathGlobFilter", "*.ndjson").text(folder)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def stream_event_lines(spark: SparkSession, folder: str, names: str = "*.ndjson", files_per_trigger: int | None = None) -> DataFrame:
    """The same folder as a stream: each file is read once, when it appears."""
    reader = spark.readStream.option("pathGlobFilter", names)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(folder)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def is_document(line: Column) -> Column:
    """True for a line that is exactly one JSON object."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]"))).try_cast("array<variant>")
    single = lambda w: (F.size(w) == 1) & F.schema_of_variant(F.get(w, F.lit(0))).startswith("OBJECT")
    return F.coalesce(once(wrapped, single), F.lit(False)) & line.rlike(r"\}\s*\z")


def parse_events(lines: DataFrame, schema: str) -> DataFrame:
    """Blank lines dropped; one row per other line with `ok`, the fields of `schema`, and the raw
    line in `_corrupt_record` when it is not a document or does not fit the schema."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    doc = F.from_json("line", f"{schema}, {CORRUPT} string", options)
    kept = [F.col(c) for c in lines.columns if c != "line"]
    # inline() makes one parse per line: filters on the fields cannot move below it and repeat the parse.
    once = F.inline(F.array(F.struct(is_document(F.col("line")).alias("_is"), doc.alias("_doc"))))
    rows = lines.where(~is_blank(F.col("line"))).select(*kept, "line", once)
    ok = F.col("_is") & F.col(f"_doc.{CORRUPT}").isNull()
    names = [f.name for f in rows.schema["_doc"].dataType.fields if f.name != CORRUPT]
    fields = [F.when(ok, F.col("_doc").getField(n)).alias(n) for n in names]
    return rows.select(*kept, ok.alias("ok"), *fields, F.when(~ok, F.col("line")).alias(CORRUPT))


def read_events(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The *.ndjson files of a folder through Spark's JSON scan, which takes filters and prunes fields.

    Looser than parse_events on a line that goes on after its object; use that one to count refusals.
    """
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", "*.ndjson").json(folder)


def parse_open_events(lines: DataFrame) -> DataFrame:
    """Without a schema: each document is one VARIANT column `doc`, and unknown fields are kept."""
    kept = [F.col(c) for c in lines.columns if c != "line"]
    judged = with_once(lines.where(~is_blank(F.col("line"))), ok=is_document(F.col("line")))
    doc = F.when(F.col("ok"), F.try_parse_json("line"))
    return judged.select(*kept, "ok", doc.alias("doc"), F.when(~F.col("ok"), F.col("line")).alias(CORRUPT))


def field_of(doc: Column, name: str, kind: str = "string") -> Column:
    """One field of an open document. Dots in the name are part of the name."""
    safe = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(doc, f"$['{safe}']", kind)


def discovered_schema(events: DataFrame) -> DataFrame:
    """(field, kind, documents): the fields seen in open documents. Fields are counted map-side."""
    fields = events.where("ok").select(F.explode(F.expr("map_entries(cast(doc as map<string,variant>))")).alias("e"))
    typed = fields.select(F.col("e.key").alias("field"), F.schema_of_variant(F.col("e.value")).alias("kind"))
    return typed.groupBy("field", "kind").agg(F.count("*").alias("documents"))


def ingest_counts(parsed: DataFrame, *by: str) -> DataFrame:
    """Documents taken and refused, and the status of the load."""
    counts = parsed.groupBy(*by).agg(
        F.count_if(F.col("ok")).alias("ok_count"), F.count_if(~F.col("ok")).alias("error_count")
    )
    return counts.withColumn("status", F.when(F.col("error_count") > 0, "failure").otherwise("success"))


def unwrap_envelope(parsed: DataFrame, time: str = "time", event: str = "event") -> DataFrame:
    """{time, event{..}} to event columns plus `event_time`."""
    return parsed.select(F.timestamp_seconds(F.col(time)).alias("event_time"), f"{event}.*")


def in_index(events: DataFrame, pattern: str, column: str = "index") -> DataFrame:
    """Events whose index matches a wildcard such as `security-*`. On a partition column this prunes."""
    quoted = pattern.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%")
    literal = "'" + quoted.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if "*" not in pattern:
        return events.where(F.col(column) == pattern)
    return events.where(F.expr(f"`{column}` like {literal} escape '!'"))


def read_index(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Parquet events laid out as folder/index=<name>/..., limited to the indexes that match."""
    return in_index(spark.read.parquet(folder), pattern)


def read_indexes(spark: SparkSession, folder: str, wanted: DataFrame, column: str = "index") -> DataFrame:
    """Events of the indexes that a table names, such as those of a rule set: wanted(pattern), with `*` as wildcard.

    The folder's own index names are listed from its partitions, which reads no event; the names that match are joined with the events, and
    Spark prunes partitions by them while the query runs.
    """
    events = spark.read.parquet(folder)
    names = events.select(column).distinct()
    patterns = F.collect_set(F.concat(F.lit("^\\Q"), F.replace("pattern", F.lit("*"), F.lit("\\E.*\\Q")), F.lit("\\E$")))
    # Patterns are configuration: one value for all of them.
    listed = wanted.select(patterns).scalar()
    joined_pattern = F.array_join(listed, "|")
    matching = names.where(F.rlike(F.col(column).cast("string"), joined_pattern))
    return events.join(F.broadcast(matching), column, "left_semi")
