"""Result rows and documents written in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightglass.session import run_folder

RESULT_FIELDS = ("artifacts", "backend", "context", "errors", "metrics", "rule_id", "stage", "status", "timestamp_utc", "warnings")


def operation_results(rows: DataFrame) -> DataFrame:
    """Rows with status, stage and backend to the full result shape. Absent fields get their default."""
    texts, numbers = "array<string>", "map<string,bigint>"
    defaults: dict[str, Column] = {
        "rule_id": F.lit(None).cast("string"),
        "errors": F.array().cast(texts),
        "warnings": F.array().cast(texts),
        "metrics": F.create_map().cast(numbers),
        "artifacts": F.create_map().cast("map<string,string>"),
        "context": F.create_map().cast("map<string,string>"),
    }
    for name, value in defaults.items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), value) if name in rows.columns else value)
    return rows.withColumn("timestamp_utc", F.current_timestamp()).select(*RESULT_FIELDS)


def result_json(results: DataFrame) -> DataFrame:
    """One JSON object per result, keys sorted, NULL rule ids kept."""
    return results.select(F.to_json(F.struct(*RESULT_FIELDS), {"ignoreNullFields": "false"}).alias("line"))


def write_results(rows: DataFrame, path: str) -> None:
    """Append result rows as JSON lines."""
    result_json(operation_results(rows)).write.mode("append").text(path)


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """Write ordered lines as text. Part files in name order make up the document."""
    ordered = lines.orderBy(*order) if order else lines
    ordered.select(F.coalesce("line", F.lit(""))).write.mode("overwrite").text(path)


# A row's place in its partition: the lower bits of Spark's increasing ids.
PLACES = (1 << 33) - 1


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """The rows with `line_no`, gapless from 0 in the given order.

    They are written once, range-partitioned and sorted, with their partition and place in it; then only the partitions' sizes, a
    row each, are added up. No task sees more than its range, and what reads the result does not sort again.
    """
    path, spark = run_folder(rows.sparkSession, "numbered"), rows.sparkSession
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(PLACES)))
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    joined = written.join(F.broadcast(starts), "_part")
    return joined.withColumn("line_no", F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def write_events(events: DataFrame, path: str, *partitions: str, append: bool = False) -> None:
    """Drop and recreate the target, or append to it; partition columns such as date and index prune scans."""
    events.write.mode("append" if append else "overwrite").partitionBy(*partitions).parquet(path)


def write_layout(events: DataFrame, path: str, partitions: list[str], order: list[str], tasks: int | None = None) -> None:
    """Events as a layout for scans: a folder per value of `partitions`, files sorted by `order`.

    Ranges cover the partitions and the order together, so a partition that holds a third of all events is several files, each a
    range of its own; filters on the order then skip files and row groups by their statistics. Without a number of `tasks` adaptive
    execution merges small ranges.
    """
    keys = [*partitions, *order]
    events.repartitionByRange(*([tasks] if tasks else []), *keys).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """pages(name, content) as JSON lines, one document per row."""
    pages.select("name", "content").write.mode("overwrite").json(path)
