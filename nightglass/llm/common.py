"""What several operators share: row keys, written intermediate tables and distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nightglass.session import run_folder

# Rows of one rank block: what a single task sorts at a time.
BLOCK_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(docs: DataFrame, keep: list[Column] | None = None) -> DataFrame:
    """(doc_id, key, text) of every row, and the kept columns; a null text is empty.

    (doc_id, key) names a row's content: rows that share both are repeats of each other and get
    equal results. All other columns are left behind, so their names cannot clash.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *(keep or [])).withColumn(
        "key", F.xxhash64("text", F.octet_length("text"))
    )


def join_rows(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """left joined with right on (doc_id, key), null ids matching each other; right's copies of both are dropped."""
    named = right.withColumnsRenamed({"doc_id": "_doc_id", "key": "_key"})
    return left.join(named, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key")), how).drop("_doc_id", "_key")


# Rows that one task writes of a table of short rows whose size is known beforehand.
ROWS_PER_TASK = 50_000


def write_out(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written to the shared folder and read back: later jobs do not depend on its lineage.

    `rows`, an upper bound of its rows where one is known, keeps small tables from being made by as many tasks as a shuffle
    has partitions; large ones keep all.
    """
    path = run_folder(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks_for(rows: int) -> int:
    """How many rank blocks hold `rows` rows at about BLOCK_ROWS each; a power of two."""
    return 1 << max(4, (rows // BLOCK_ROWS).bit_length())


def ranked(df: DataFrame, groups: list[str], block: Column, order: list[Column], name: str) -> DataFrame:
    """df with column `name`: the gapless rank from 0 within `groups`, by (block, order).

    No group is gathered: rows are numbered inside (group, block) and each block adds the number of rows
    before it. Only the table of block counts is summed up in order.
    """
    spread = df.withColumn("_block", block)
    inner = Window.partitionBy(*groups, "_block").orderBy(*order)
    counts = spread.groupBy(*groups, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = spread.withColumn("_in", F.row_number().over(inner) - 1).alias("a")
    keys = [*groups, "_block"]
    on = None
    for k in keys:
        same = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = same if on is None else on & same
    joined = numbered.join(starts.alias("b"), on)
    return joined.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("b._start") + F.col("a._in")).cast("long").alias(name))


def attach(docs: DataFrame, values: DataFrame, names: list[str], also: str | None = None) -> DataFrame:
    """(row, names) for every row of docs, from values(doc_id, key, names), which has one row per row of docs.

    Rows that repeat each other share doc_id and key and take their values in turn; with `also`, a string column that
    values has too, only if they share that as well. The texts are shuffled once: the join and the numbering of repeats
    use the same partitioning.
    """
    same = ["_key", "_id", "_none"] + (["_also", "_blank"] if also else [])

    def named(df: DataFrame) -> DataFrame:
        if also:
            df = df.withColumn("_also", F.coalesce(also, F.lit(""))).withColumn("_blank", F.col(also).isNull()).drop(also)
        return df.withColumn("_key", F.col("key")).withColumn("_id", F.coalesce("doc_id", F.lit(0))).withColumn("_none", F.col("doc_id").isNull()).drop("doc_id", "key")

    text = F.coalesce("row.text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    carried = [F.col(f"row.`{also}`").cast("string").alias(also)] if also else []
    rows = named(rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(text, F.octet_length(text)).alias("key"), *carried))
    lists = named(values).groupBy(*same).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("_list"))
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    joined = rows.join(lists, same).withColumn("_value", F.element_at("_list", nth))
    return joined.select("row", *[F.col(f"_value.{n}").alias(n) for n in names])
