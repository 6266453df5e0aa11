"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every round counts, by joins and pre-aggregated groups, where the members
of each group are. A group that fits into a shard asks, whole, for the shard with room for it that holds most of it; quotas on what a shard
may take decide which groups move. A larger group settles on as many shards as it fills. A last exact step moves the excess of
overfull shards, unlinked documents first, so that the row counts of any two shards differ by one at most.

In the pipeline the slots of each shard follow the order in which the mixing stage wrote the rows; rows that come from no file
are numbered by a Pfair order of each shard's own (mixing.py), so that a shard's first slots hold the sources by weight.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from nightglass.llm import mixing
from nightglass.llm.common import BLOCK_ROWS, attach, blocks_for, keyed_texts, ranked, write_out

SHARDS = 16
ROUNDS = 10


def spread_hash() -> Column:
    """A hash of a row that says nothing of its first shard, which comes from another."""
    return F.xxhash64("key", "doc_id")


def documents_state(docs: DataFrame, keep: list[Column] | None = None) -> DataFrame:
    """(doc_id, key, kept columns, bytes, crc, linked) per row; key names the text, so rows with equal texts share it."""
    keyed = keyed_texts(docs, keep)
    kept = [c for c in keyed.columns if c not in ("doc_id", "key", "text")]
    texts = keyed.select("doc_id", "key", *kept, F.octet_length("text").cast("long").alias("bytes"), F.crc32(F.col("text").cast("binary")).alias("crc"))
    links = texts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("linked"))
    return texts.join(links, "key", "left").select("doc_id", "key", *kept, "bytes", "crc", F.coalesce("linked", F.lit(False)).alias("linked"))


def fair_shares(rows: int, held: list[int]) -> list[int]:
    """Rows per shard at the end; the larger shares go to the shards that hold most."""
    low, more = divmod(rows, len(held))
    lucky = set(sorted(range(len(held)), key=lambda s: (-held[s], s))[:more])
    return [low + (s in lucky) for s in range(len(held))]


def by_shard(state: DataFrame, shards: int) -> list[int]:
    held = [0] * shards
    for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect():
        held[r["shard"]] = r["n"]
    return held


def group_targets(state: DataFrame, quota: int, room: list[int], turn: int) -> DataFrame:
    """(key, target, moving) of the groups that fit into a shard but stand in several: the shard, of those with room for the rest of the
    group, that holds most of it, and how many rows would move. Groups without such a shard have no row."""
    counts = state.groupBy("key", "shard").agg(F.count("*").alias("n"))
    homes = counts.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("places"), F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("held"))
    cut = homes.where((F.col("places") > 1) & (F.col("total") <= quota))
    options = [
        F.struct(F.coalesce(F.element_at("held", F.lit(s)), F.lit(0)).alias("n"), F.xxhash64("key", F.lit(s), F.lit(turn)).alias("tie"), F.lit(s).alias("shard"), F.lit(free).alias("free"))
        for s, free in enumerate(room)
    ]
    best = F.array_max(F.filter(F.array(*options), lambda o: F.col("total") - o["n"] <= o["free"]))
    return cut.withColumn("best", best).where("best IS NOT NULL").select("key", F.col("best.shard").alias("target"), (F.col("total") - F.col("best.n")).alias("moving"))


def propagate(state: DataFrame, quota: int, shards: int, rounds: int) -> DataFrame:
    """Labels of linked rows after `rounds` rounds of moves within quotas.

    Unlinked rows can be displaced later, so a shard has room for as many linked rows as its share of all rows. Groups that
    fit move whole or not at all. A group larger than a share settles on the shards that hold most of it.
    """
    for turn in range(rounds):
        held = by_shard(state, shards)
        room = [max(0, quota - h) for h in held]
        wishes = write_out(group_targets(state, quota, room, turn), "shard-wishes")
        # At most `shards` sums reach the driver, where the quotas are set.
        coming = {r["target"]: r["n"] for r in wishes.groupBy("target").agg(F.sum("moving").alias("n")).collect()}
        rate = [min(1.0, room[s] / coming[s]) if coming.get(s) else 0.0 for s in range(shards)]
        luck = F.pmod(F.xxhash64("key", F.lit(turn + 1000)), F.lit(1_000_000)) / 1_000_000
        allowed = wishes.where(luck < F.element_at(F.array(*[F.lit(float(x)) for x in rate]), F.col("target") + 1)).select("key", "target")
        counts = state.groupBy("key", "shard").agg(F.count("*").alias("n"))
        large = counts.groupBy("key").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("n", F.xxhash64("key", "shard").alias("tie"), "shard")), asc=False).alias("places")).where(F.col("total") > quota)
        wanted = F.ceil(F.col("total") / F.lit(max(quota, 1))).cast("int") + 1
        mains = large.select("key", F.transform(F.slice("places", 1, wanted), lambda p: p["shard"]).alias("mains"))
        choice = F.element_at("mains", (F.pmod(F.xxhash64("doc_id", "key", F.lit(turn)), F.size("mains")) + 1).cast("int"))
        target = F.when(F.col("target").isNotNull(), F.col("target")).when(F.col("mains").isNull() | F.array_contains("mains", F.col("shard")), F.col("shard")).otherwise(choice)
        asked = write_out(state.join(allowed, "key", "left").join(mains, "key", "left").withColumn("to", target.cast("int")).withColumn("whole", F.col("mains").isNull()).drop("mains", "target"), "shard-asked")
        flows = {(r["shard"], r["to"]): r["n"] for r in asked.where("NOT whole").groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}
        if not coming and all(a == b for a, b in flows):
            break
        arriving = [sum(n for (a, b), n in flows.items() if b == s and a != s) for s in range(shards)]
        rates = [min(1.0, room[s] / arriving[s]) if arriving[s] else 0.0 for s in range(shards)]
        own = F.pmod(F.xxhash64("doc_id", "key", F.lit(turn + 2000)), F.lit(1_000_000)) / 1_000_000
        moves = F.col("whole") | (own < F.element_at(F.array(*[F.lit(float(x)) for x in rates]), F.col("to") + 1))
        state = write_out(asked.withColumn("shard", F.when(moves, F.col("to")).otherwise(F.col("shard"))).drop("to", "whole"), "shard-round")
    return state


def starting_at(index: Column, widths: list[int]) -> Column:
    """The shard whose stretch of `widths`, laid end to end, holds the index."""
    out, end = F.lit(None).cast("int"), sum(widths)
    for s in reversed(range(len(widths))):
        if widths[s]:
            out = F.when(index < end, s).otherwise(out)
        end -= widths[s]
    return out


def even_out(state: DataFrame, shards: int) -> DataFrame:
    """Exact row counts: each overfull shard gives its excess, unlinked rows first, to those with room."""
    held = by_shard(state, shards)
    goal = fair_shares(sum(held), held)
    excess = [max(0, h - g) for h, g in zip(held, goal, strict=True)]
    lacking = [max(0, g - h) for h, g in zip(held, goal, strict=True)]
    if not any(excess):
        return state
    count = blocks_for(max(held))
    block = F.when(F.col("linked"), count).otherwise(0) + F.pmod(spread_hash(), F.lit(count))
    order = ranked(state, ["shard"], block, [F.col("doc_id"), F.col("key")], "_at")
    before = [sum(excess[:s]) for s in range(shards)]
    leaves = F.col("_at") < F.element_at(F.array(*[F.lit(x) for x in excess]), F.col("shard") + 1)
    index = F.col("_at") + F.element_at(F.array(*[F.lit(x) for x in before]), F.col("shard") + 1)
    return order.withColumn("shard", F.when(leaves, starting_at(index, lacking)).otherwise(F.col("shard")).cast("int")).drop("_at")


def settled(docs: DataFrame, shards: int, rounds: int, keep: list[Column] | None = None) -> DataFrame:
    """The state of every row of docs with its shard at the end, written out."""
    first = F.pmod(F.xxhash64("doc_id", "key"), F.lit(shards)).cast("int")
    start = write_out(documents_state(docs, keep).withColumn("shard", first), "shard-start")
    quota = -(-start.count() // shards)
    moved = propagate(start.where("linked"), quota, shards, rounds)
    return write_out(even_out(start.where("NOT linked").unionByName(moved), shards), "shard-even")


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, key, size, text_crc32, law, shard, slot, grown_shard) per row of docs.

    Law `rows`: any two shards differ by one row at most. Null texts count as empty, and link like equal texts do.
    Null ids and repeated rows are rows like any other. A group of equal texts larger than a shard fills several.
    """
    even = settled(docs, shards, rounds)
    block = F.pmod(spread_hash(), F.lit(blocks_for(max(by_shard(even, shards)))))
    slotted = ranked(even, ["shard"], block, [F.col("doc_id"), F.col("key")], "slot")
    return slotted.select(
        "doc_id", "key", (F.col("bytes") + 1).alias("size"), F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def mixed_slots(even: DataFrame, weights: dict | None = None, block: int = mixing.BLOCK) -> DataFrame:
    """even(doc_id, key, source, shard, ...) with column `slot`: in every shard the rows are numbered in Pfair order.

    Weights are those of the whole table. A shard's first rows hold each source to within a block of its weight's
    share, until a source has no more rows in that shard.
    """
    counts = even.groupBy("shard", "source").agg(F.count("*").alias("n")).collect()
    sizes, longest = {}, {}
    for r in counts:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["n"]
        longest[r["source"]] = max(longest.get(r["source"], 0), -(-r["n"] // block))
    hashed = even.withColumn("_h", spread_hash())
    by_hash = F.pmod("_h", F.lit(blocks_for(max((r["n"] for r in counts), default=0))))
    numbered = ranked(hashed, ["shard", "source"], by_hash, [F.col("_h"), F.col("doc_id"), F.col("key")], "_rank").drop("_h")
    turns = mixing.in_turn(numbered, mixing.target_weights(sizes, weights), longest, block).withColumnRenamed("slot", "_turn")
    # Rank blocks follow the turns, of which each holds a block's rows at most.
    run = sum(longest.values())
    stretch = F.floor(F.col("_turn") / max(1, min(BLOCK_ROWS // block, run // 16)))
    return ranked(turns, ["shard"], stretch, [F.col("_turn"), F.col("place")], "slot").select(*even.columns, "slot")


def in_file_order(even: DataFrame) -> DataFrame:
    """even(_file, _row, shard, ...) with column `slot`: in every shard the rows are numbered as they stand in the files, by name and row."""
    stretch = F.struct("_file", F.floor(F.col("_row") / BLOCK_ROWS).alias("b"))
    return ranked(even, ["shard"], stretch, [F.col("_row")], "slot")


def with_places(docs: DataFrame) -> DataFrame | None:
    """docs with the file and row that each row comes from; None if they are not read from Parquet files."""
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        placed.schema
    except AnalysisException:
        return None
    return placed


def sharded(docs: DataFrame, shards: int = SHARDS, weights: dict | None = None) -> DataFrame:
    """The rows of docs with all their columns, and size, text_crc32, shard and slot; these win over columns of docs of the same name.

    A shard's slots follow the order of the files that docs are read from, such as those of the mixing stage; rows from no file are numbered by
    a mix of the sources for each shard (mixed_slots). Columns named _file and _row are only for use in here.
    """
    added = ["shard", "slot", "size", "text_crc32"]
    placed = with_places(docs.drop("_file", "_row"))
    if placed is not None:
        even = settled(placed, shards, ROUNDS, [F.col("_file"), F.col("_row")])
        values = in_file_order(even).select("_file", "_row", "shard", "slot", (F.col("bytes") + 1).alias("size"), F.col("crc").alias("text_crc32"))
        kept = [c for c in docs.columns if c not in added]
        return placed.select(*[F.col(f"`{c}`") for c in {*kept, "_file", "_row"}]).join(values, ["_file", "_row"]).select(*[F.col(f"`{c}`") for c in kept], *added)
    even = settled(docs, shards, ROUNDS, [F.col("source").cast("string").alias("source")])
    values = mixed_slots(even, weights).select("doc_id", "key", "source", "shard", "slot", (F.col("bytes") + 1).alias("size"), F.col("crc").alias("text_crc32"))
    rows = attach(docs, values, added, "source")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in added], *added)
