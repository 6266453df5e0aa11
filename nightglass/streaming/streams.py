"""The batch operators on Structured Streaming.

Every run here uses availableNow: it takes what is there, stops, and can be resumed from its
checkpoint after a lost executor or driver. Checkpoints and outputs live in the shared folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.state import GroupState

from nightglass.operators.detect import detect
from nightglass.operators.rules import CompiledRule
from nightglass.session import run_folder
from nightglass.sources.events import parse_events


def stream_table(spark: SparkSession, folder: str, table: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of files.

    The last character is written as a glob, since a stream may not name a single file directly.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{table}.parque[t]")


def with_event_time(events: DataFrame, column: str, watermark: str) -> DataFrame:
    """Cast to TIMESTAMP, which watermarks need, and set the watermark."""
    return events.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, watermark)


def detect_stream(events: DataFrame, rules: list[CompiledRule], keep: list[str]) -> DataFrame:
    """The same expressions as in batch; stateless."""
    return detect(events, rules, keep)


def windowed_counts(matches: DataFrame, time: str, width: str, *by: str) -> DataFrame:
    """Matches per tumbling window and key. Partial counts are made before the shuffle to the state."""
    grouped = matches.groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("matches"))
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "matches")


def threshold(matches: DataFrame, time: str, timeframe: str, least: int, *by: str) -> DataFrame:
    """Windows of `timeframe` in which a key has at least `least` matches."""
    return windowed_counts(matches, time, timeframe, *by).where(F.col("matches") >= least)


# Units of a rule's timeframe.
UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}
MICROS = {"s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}


def timeframe_text(timeframe: str) -> str:
    """`15m` to `15 minutes`."""
    number, unit = timeframe[:-1], timeframe[-1:]
    if not number.isdigit() or unit not in UNITS:
        raise ValueError(f"unreadable timeframe: {timeframe}")
    return f"{number} {UNITS[unit]}"


def timeframe_micros(timeframe: str) -> int:
    timeframe_text(timeframe)
    return int(timeframe[:-1]) * MICROS[timeframe[-1]]


SPANS = "span_start timestamp, span_end timestamp"
# The rows that a group of keys holds, as one Arrow table.
HELD = "held binary"
# Keys are dealt to so many groups, each with one call of Python and one state a batch. A checkpoint keeps its number.
GROUPS = 512


def spans(matches: DataFrame, rules: list[CompiledRule], time: str, least: int, *by: str, groups: int = GROUPS) -> DataFrame:
    """(rule_id, by.., span_start, span_end) for every match that completes `least` matches of its rule and key within the rule's timeframe.

    A span ends at a match and starts at the one `least - 1` before it; both may lie anywhere. Times are kept per (rule, key) until the
    watermark passes them, and are then judged in order, so rows may come in any order within the delay; an event-time timer
    judges groups that get no more rows, and clears those with nothing left to wait for. State holds the times inside the delay and up to
    `least - 1` more of each key, those that a later match can still reach. Keys share a state with those of their hash, so that calls
    do not grow with the keys; they go to Python as texts and come back in their types. All timeframes share one stream; rules
    without one have no threshold. Rows without a time never count.
    """
    frames = {r.rule_id: timeframe_micros(r.timeframe) for r in rules if r.timeframe and r.sql}
    if not frames:
        raise ValueError("no rule has a timeframe")
    keys = ["rule_id", *by]
    known = matches.where(F.col("rule_id").isin(list(frames)) & F.col(time).isNotNull())
    types = {f.name: f.dataType for f in known.select(*keys).schema.fields}
    group = F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("_group")
    narrow = known.select(group, *[F.col(k).cast("string").alias(k) for k in keys], F.col(time).alias("at"))
    held_schema = pa.schema([*[(k, pa.string()) for k in keys], ("at", pa.int64()), ("passed", pa.bool_())])

    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # `passed` marks the times that the watermark had passed before this call.
        parts = [b[keys].assign(at=b["at"].astype("datetime64[us]").astype("int64"), passed=False) for b in batches if len(b)]
        if state.exists:
            parts.insert(0, pa.ipc.open_stream(state.get[0]).read_pandas())
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        mark = state.getCurrentWatermarkMs() * 1000
        number = rows.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        order = np.lexsort((~rows["passed"].to_numpy(), rows["at"].to_numpy(), number))
        rows, number = rows.iloc[order], number[order]
        at, passed, frame = rows["at"].to_numpy(), rows["passed"].to_numpy(), rows["rule_id"].map(frames).to_numpy("int64")
        due, gap = at <= mark, least - 1
        # The time `gap` places before each, and whether it is of the same key.
        here = np.arange(len(at))
        before, after = np.maximum(here - gap, 0), np.minimum(here + gap, len(at) - 1)
        found = due & ~passed & (here >= gap) & (number[before] == number) & (at - at[before] <= frame)
        # Of the times passed each key's last ones are needed, if a later match can reach them.
        followed = (here + gap < len(at)) & (number[after] == number) & due[after]
        kept = ~due | (~followed & (at + frame >= mark))
        if kept.any():
            held = pa.Table.from_pandas(rows[kept].assign(passed=due[kept]), held_schema, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held_schema) as out:
                out.write_table(held)
            state.update((sink.getvalue().to_pybytes(),))
            # The first waiting time, or when the last passed one is out of reach; a timer must lie behind the watermark.
            timer = at[~due].min() if not due.all() else (at + frame)[kept].max()
            state.setTimeoutTimestamp(int(max(timer // 1000, mark // 1000)) + 1)
        elif state.exists:
            state.remove()
        if found.any():
            yield rows.loc[found, keys].assign(span_start=at[before][found], span_end=at[found]).reset_index(drop=True)

    kinds = ", ".join(f"`{k}` string" for k in keys)
    judged = narrow.groupBy("_group").applyInPandasWithState(judge, f"{kinds}, span_start bigint, span_end bigint", HELD, "append", "EventTimeTimeout")
    return judged.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], *[F.timestamp_micros(c).alias(c) for c in ("span_start", "span_end")])


def spans_in_batch(matches: DataFrame, rules: list[CompiledRule], time: str, least: int, *by: str) -> DataFrame:
    """The same spans over a table that is there whole."""
    frames = {r.rule_id: timeframe_micros(r.timeframe) for r in rules if r.timeframe and r.sql}
    width = F.element_at(F.from_json(F.lit(json.dumps(frames)), "map<string,bigint>"), F.col("rule_id"))
    before = F.lag(time, least - 1).over(Window.partitionBy("rule_id", *by).orderBy(time))
    known = matches.where(F.col("rule_id").isin(list(frames)) & F.col(time).isNotNull())
    found = known.select("rule_id", *by, before.alias("span_start"), F.col(time).alias("span_end"))
    return found.where(F.unix_micros("span_end") - F.unix_micros("span_start") <= width)


def drop_repeats(events: DataFrame, key: list[str]) -> DataFrame:
    """One event per key within the watermark."""
    return events.dropDuplicatesWithinWatermark(key)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an append-mode stream into Parquet, exactly once per file."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()


def updates_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an update-mode stream. Each batch overwrites its own folder, so a retried batch stays single."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()


MARKS = "latest timestamp"


def counts_and_late(events: DataFrame, time: str, delay: str, width: str, folder: str, *by: str) -> None:
    """Counts per window of `width` and key, and the rows that came too late for them, as two tables.

    A row is late if its window ended before the watermark that held when its batch began: the latest time of all earlier batches
    less `delay`. Late rows, and rows without a time, go whole to folder/late; the others are counted into
    folder/counts, partial counts per batch that `window_totals` adds up. The latest time stands in folder/marks, a row per
    batch. Each batch overwrites its own folders and reads the mark of the one before it, so a retried batch and a
    restarted stream give the same tables; no count is kept in a progress report.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        mark = spark.read.schema(MARKS).parquet(f"{folder}/marks/batch={number - 1}").first().latest if number else None
        end = F.timestamp_micros(F.floor(F.unix_micros(time) / F.lit(_micros(width))) * _micros(width) + _micros(width))
        late = F.col(time).isNull() | (F.coalesce(end <= F.lit(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False)) if mark is not None else F.lit(False))
        windowed = batch.withColumn("_end", end).withColumn("_late", late)
        windowed.persist()
        windowed.where("_late").drop("_late", "_end").write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        counted = windowed.where("not _late").groupBy((F.col("_end") - F.expr(f"INTERVAL {width}")).alias("window_start"), F.col("_end").alias("window_end"), *by).agg(F.count("*").alias("n"))
        counted.write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")
        seen = windowed.agg(F.max(time).cast("timestamp").alias("latest"))
        seen.select(F.greatest("latest", F.lit(mark).cast("timestamp")).alias("latest")).write.mode("overwrite").parquet(f"{folder}/marks/batch={number}")
        windowed.unpersist()

    query = events.writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()


def _micros(width: str) -> int:
    number, unit = width.split()
    return int(number) * next(MICROS[k] for k, name in UNITS.items() if name.rstrip("s") == unit.rstrip("s"))


def window_totals(spark: SparkSession, folder: str, schema: str, *by: str) -> DataFrame:
    """(window_start, window_end, by.., matches) of counts_and_late so far; `schema` names the types of `by`."""
    parts = spark.read.schema(f"window_start timestamp, window_end timestamp, {schema}, n bigint").parquet(f"{folder}/counts")
    return parts.groupBy("window_start", "window_end", *by).agg(F.sum("n").alias("matches"))


def late_table(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The late rows of counts_and_late so far, with the batch that met them."""
    return spark.read.schema(schema).parquet(f"{folder}/late")


def latest(updates: DataFrame, *key: str) -> DataFrame:
    """The newest row per key of an update log. Rows are combined map-side; keys are windows, not events."""
    values = [c for c in updates.columns if c not in key and c != "batch"]
    newest = updates.groupBy(*key).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*key, "v.*")


def arriving(parts: list[DataFrame], folder: str, run, kind: str = "parquet", stops: int = 2) -> None:
    """Write each part as a file of folder/part=<n> and call `run()` at `stops` points: with some of the parts there, and then with all.

    What `run` starts must stop by itself and go on from its checkpoint.
    """
    every = -(-len(parts) // stops)
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("overwrite").format(kind).save(f"{folder}/part={i}")
        if (i + 1) % every == 0 or i == len(parts) - 1:
            run()


def run_appended(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    folder = run_folder(spark, name)
    schema = stream.schema
    append_to(stream, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(schema).parquet(f"{folder}/out")


def run_updated(spark: SparkSession, stream: DataFrame, name: str, *key: str) -> DataFrame:
    folder = run_folder(spark, name)
    schema = stream.schema
    updates_to(stream, f"{folder}/out", f"{folder}/checkpoint")
    return latest(spark.read.schema(schema.add("batch", "long")).parquet(f"{folder}/out"), *key)


def ingest(lines: DataFrame, schema: str, good: str, bad: str, checkpoint: str, tags: list[str] = []) -> None:
    """Parse a stream of lines; documents go to one Parquet table and refused lines to another.

    `tags` are columns of the input, such as the file, that a refused line keeps.
    """
    parsed = parse_events(lines, schema)

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        batch.where("ok").drop("ok", "_corrupt_record").write.mode("overwrite").parquet(f"{good}/batch={number}")
        batch.where("not ok").select(*tags, "_corrupt_record").write.mode("overwrite").parquet(f"{bad}/batch={number}")
        batch.unpersist()

    query = (
        parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()
