"""Positions of pattern matches, in code points, by built-in functions alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
CHUNK = 256


@dataclass(frozen=True)
class Kind:
    """A pattern with a check of each of its leftmost non-overlapping matches; failing matches are dropped."""

    name: str
    pattern: str
    check: Callable[[Column], Column] = lambda m: F.lit(True)


def running(numbers: Column) -> Column:
    """Sums of all elements before each element; two levels, so that long arrays stay cheap."""

    def sums(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / CHUNK).cast("int")), lambda k: sums(F.slice(numbers, k * CHUNK + 1, CHUNK)))
    offsets = sums(F.transform(chunks, lambda c: F.element_at(c, -1)))
    pairs = F.arrays_zip(chunks.alias("c"), F.slice(offsets, 1, F.size(chunks)).alias("o"))
    return F.flatten(F.transform(pairs, lambda p: F.transform(F.slice(p["c"], 1, F.size(p["c"]) - 1), lambda v: v + p["o"])))


def with_spans(df: DataFrame, kinds: list[Kind], prefix: str = "s_") -> DataFrame:
    """df (with a non-null `text`) plus one column `<prefix><kind>` of SPAN type per kind.

    Matches come from extracting, the gaps between them from splitting by the same pattern; their
    lengths add up to the positions. Texts without a match are not split.
    """
    names = df.columns
    found = df.select(*names, *[F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)).alias(f"_f_{k.name}") for k in kinds])
    gaps = found.select(
        "*", *[F.when(F.size(f"_f_{k.name}") > 0, F.transform(F.split("text", k.pattern, -1), lambda g: F.char_length(g))).alias(f"_g_{k.name}") for k in kinds]
    )
    steps = gaps.select(
        "*", *[F.when(F.col(f"_g_{k.name}").isNotNull(), running(F.zip_with(f"_f_{k.name}", F.slice(f"_g_{k.name}", 1, F.size(f"_f_{k.name}")), lambda m, g: F.char_length(m) + g))).alias(f"_b_{k.name}") for k in kinds]
    )

    def spans(rank: int, k: Kind) -> Column:
        parts = F.arrays_zip(F.col(f"_f_{k.name}"), F.col(f"_g_{k.name}"), F.col(f"_b_{k.name}"))
        first = lambda p: p[f"_b_{k.name}"] + p[f"_g_{k.name}"]
        value = lambda p: p[f"_f_{k.name}"]
        placed = F.transform(
            F.filter(F.slice(parts, 1, F.size(f"_f_{k.name}")), lambda p: k.check(value(p))),
            lambda p: F.struct(first(p).alias("start"), F.lit(rank).alias("rank"), (first(p) + F.char_length(value(p))).alias("end"), F.lit(k.name).alias("kind"), value(p).alias("value")),
        )
        return F.coalesce(F.when(F.col(f"_g_{k.name}").isNotNull(), placed), F.array()).cast(SPAN)

    return steps.select(*names, *[spans(i, k).alias(prefix + k.name) for i, k in enumerate(kinds)])


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind in its order, comma-joined."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
