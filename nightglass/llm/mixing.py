"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks. With weight w, block j (from 1) of a source may not run before slot
floor((j - 1) / w) (its release) and must be done by slot ceil(j / w) (its deadline). In every slot the released block
with the earliest deadline runs, so after any number of slots each source that has not run out is less than one block away
from its weight's share. Weights are taken as given, as exact fractions: nothing is rounded, however long the run.
The driver goes through the blocks, not the rows, and keeps one block per source at a time.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightglass.llm.common import blocks_for, ranked
from nightglass.session import run_folder

# Documents in a block.
BLOCK = 64
# Blocks that the driver writes at a time; up to so many are broadcast to the rows, more are joined by a shuffle.
BLOCKS_AT_ONCE, BLOCKS_BROADCAST = 20_000, 200_000
# Without given weights, a source's weight is its number of documents to this power, which lifts small sources.
TEMPERATURE = 0.7


def shares(weights: dict, period: int) -> dict:
    """Slots per period of each source: at least one, adding up to the period, nearest to the weights."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (slots[s] - exact[s], s is not None, s or ""))
    for s in by_rest[: max(0, period - sum(slots.values()))]:
        slots[s] += 1
    while sum(slots.values()) > period:
        slots[max((s for s in slots if slots[s] > 1), key=lambda s: (slots[s] - exact[s], slots[s]))] -= 1
    return slots


def pfair(weights: dict, blocks: dict) -> Iterator[tuple]:
    """(source, block from 0, slot, release, deadline) of all blocks, by slot: earliest deadline first among the released ones.

    blocks has how many each source has. Those that a source would have beyond them leave their slots empty, or to blocks
    that are released by then.
    """
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    pace = [total / w for w in exact.values()]
    steps = [(p.numerator, p.denominator) for p in pace]
    names, ready, slot = list(weights), [], 0
    # Of each source at most one block is in either heap.
    waiting = [(0, i, 0) for i, s in enumerate(names) if blocks[s]]
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, i, j = heapq.heappop(waiting)
            n, d = steps[i]
            heapq.heappush(ready, (-(-(j + 1) * n // d), i, j, release))
        deadline, i, j, release = heapq.heappop(ready)
        yield names[i], j, slot, release, deadline
        if j + 1 < blocks[names[i]]:
            n, d = steps[i]
            heapq.heappush(waiting, ((j + 1) * n // d, i, j + 1))
        slot += 1


def one_period(slots: dict, period: int) -> list[tuple]:
    """(source, block in period, slot, release, deadline) of a period with whole slots per source."""
    return list(pfair(slots, slots))


def slot_table(spark: SparkSession, weights: dict, blocks: dict) -> DataFrame:
    """(source, j, s, r, d): slot, release and deadline of each block, written in parts as they are worked out."""
    kind, path = "array<struct<source:string,j:bigint,s:bigint,r:bigint,d:bigint>>", run_folder(spark, "mix-slots")
    order = pfair(weights, blocks)
    while part := list(itertools.islice(order, BLOCKS_AT_ONCE)):
        if max(p[4] for p in part) >= 1 << 63:
            raise ValueError("a weight is so small that its blocks need slots of more than 63 bits")
        rows = json.dumps([{"source": s, "j": j, "s": slot, "r": r, "d": d} for s, j, slot, r, d in part])
        spark.range(1).select(F.inline(F.from_json(F.lit(rows), kind))).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema("source string, j bigint, s bigint, r bigint, d bigint").parquet(path)


def source_weights(docs: DataFrame) -> dict:
    """Weight per source from its number of documents. Sources are a configuration dimension: one row each."""
    return {r["source"]: r["n"] ** TEMPERATURE for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}


def target_weights(sizes: dict, weights: dict | None) -> dict:
    """Weight of each source that has rows, in a fixed order. Sources without a given one get the least given one."""
    least = min((weights or {}).values(), default=1.0)
    if not least > 0:
        raise ValueError(f"weights must be positive: {weights}")
    order = sorted(sizes, key=lambda s: (s is not None, s or ""))
    return {s: sizes[s] ** TEMPERATURE if weights is None else weights.get(s, least) for s in order}


def in_turn(numbered: DataFrame, weights: dict, blocks: dict, block: int) -> DataFrame:
    """numbered with (block, place, release, deadline, slot) in place of _rank, a row's number from 0 within its source."""
    if not weights:
        extra = ("block", "place", "release", "deadline", "slot")
        return numbered.drop("_rank").select("*", *[F.lit(0).cast("long").alias(c) for c in extra])
    slots = slot_table(numbered.sparkSession, weights, blocks)
    if sum(blocks.values()) <= BLOCKS_BROADCAST:
        slots = F.broadcast(slots)
    turns = numbered.withColumn("block", F.floor(F.col("_rank") / block).cast("long")).withColumn("place", F.col("_rank") % block).alias("t")
    joined = turns.join(slots.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source")) & (F.col("t.block") == F.col("p.j")))
    return joined.select(
        *[F.col(f"t.`{c}`") for c in numbered.columns if c != "_rank"], "t.block", "t.place", F.col("p.r").alias("release"), F.col("p.d").alias("deadline"), F.col("p.s").alias("slot")
    )


def schedule(docs: DataFrame, weights: dict | None = None, block: int = BLOCK, keep: list[Column] | None = None) -> DataFrame:
    """(kept columns, source, block, place, release, deadline, slot) of every row of docs.

    Read in order of (slot, place). A block belongs to one slot; slots of a source that has run out stay empty,
    and the others keep their shares of the rest. Every row comes once: none is dropped or repeated. Rows with a
    null source are a source of their own. A source without a given weight gets the least given one; weights must
    be positive. Within a source rows are in a fixed mixed order (by hash of id and text, so that rows without an id are spread
    too), ties being repeats of one row.
    """
    keep = [F.col("doc_id")] if keep is None else keep
    rows = docs.select(*keep, F.col("source").cast("string").alias("source"), F.xxhash64("doc_id", "text").alias("_h"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_t"))
    sizes = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}
    count = blocks_for(sum(sizes.values()))
    numbered = ranked(rows, ["source"], F.pmod("_h", F.lit(count)), [F.col("_h"), F.col("_id"), F.col("_t")], "_rank").drop("_h", "_id", "_t")
    return in_turn(numbered, target_weights(sizes, weights), {s: -(-n // block) for s, n in sizes.items()}, block)


def mixed(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """The rows of docs, with all their columns, range-partitioned and sorted by slot and place.

    Written out, the files in name order hold the mix: any prefix has the target weights to within a block.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    placed = schedule(docs, weights, keep=[row])
    return placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")
