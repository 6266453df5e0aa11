"""Indicators as data: value lists too long to be rule code, matched by equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightglass.session import salted_join

# Patterns without an inner word are looked up by pieces of this many characters.
PIECE = 4


def field_values(events: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Wide events to (key.., field, value) rows, one per non-NULL field."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields])
    long = events.select(*key, F.explode(pairs).alias("p"))
    return long.select(*key, "p.field", "p.value").where("value is not null")


def match_equal(values: DataFrame, indicators: DataFrame, key: list[str], salts: int = 1) -> DataFrame:
    """(key.., field, value, indicator_id) where an indicator (indicator_id, field, value) is equal.

    With `salts` a hot event value is spread by the event key.
    """
    return salted_join(values, indicators.select("indicator_id", "field", "value"), ["field", "value"], "inner", key, salts)


# Span 0 stands for whole words, other spans for pieces of that many characters.
WORDS = 0
WORD = r"[\p{L}\p{N}]+"
# A word with something else on both sides, so that a text holding the pattern holds it as a whole word.
INNER_WORD = r"(?<=[^\p{L}\p{N}])[\p{L}\p{N}]+(?=[^\p{L}\p{N}])"


def _pieces(text, span: int):
    """All pieces of a span, in one pass over the text; pieces of a fixed size overlap."""
    if span == WORDS:
        return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{span}}}))"), F.lit(1))


def _listed(text, span: int):
    """The different pieces of a text as {span, piece}."""
    return F.transform(F.array_distinct(_pieces(text, span)), lambda p: F.struct(F.lit(span).alias("span"), p.alias("piece")))


# Bits of the filter that every text's pieces are tested against where they are found: 256 KB, whatever the number of patterns.
FILTER_BITS = 1 << 21
FILTER_WORDS = FILTER_BITS // 64


def anchored(indicators: DataFrame) -> DataFrame:
    """Adds to (indicator_id, field, pattern) the piece of the pattern that the fewest patterns hold, and its span.

    Of pieces held by equally few the longest is taken, as texts hold it least. A pattern with an inner word is found by that
    word, others by PIECE characters, and one shorter than that is its own piece. Empty patterns never match and drop out.
    The patterns are read once: holders are counted over the pieces themselves.
    """
    pattern, size = F.col("pattern"), F.length("pattern")
    inner = F.regexp_extract_all(pattern, F.lit(INNER_WORD), F.lit(0))
    span = F.when(F.size(inner) > 0, WORDS).otherwise(F.least(size, F.lit(PIECE)))
    pieces = F.when(F.size(inner) > 0, inner).when(size >= PIECE, _pieces(pattern, PIECE)).otherwise(F.array(pattern))
    held = indicators.where(size > 0).select("*", span.alias("span"), F.explode(F.array_distinct(pieces)).alias("piece"))
    counted = held.withColumn("holders", F.count("*").over(Window.partitionBy("field", "span", "piece")))
    best = F.min_by("piece", F.struct("holders", -F.length("piece"), "piece")).alias("piece")
    return counted.groupBy("indicator_id", "field", "pattern", "span").agg(best)


def _slot(field: Column, span: Column, piece: Column) -> Column:
    return F.pmod(F.xxhash64(field, span, piece), F.lit(FILTER_BITS))


def anchor_filter(side: DataFrame) -> Column:
    """{words, spans}: a bit per hash of an anchor, and the spans that anchors have, as one value of fixed size.

    An anchor's bit is always set; other pieces share a set bit seldom while anchors are few against FILTER_BITS, and always are tested in
    full later.
    """
    slots = side.select("span", _slot(F.col("field"), F.col("span"), F.col("piece")).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(pmod(slot, 64) as int))")
    set_words = slots.groupBy(F.expr("slot div 64").alias("id")).agg(F.bit_or(bit).alias("bits"), F.collect_set("span").alias("spans"))
    # Every word of the filter, so one row of FILTER_WORDS numbers whatever the number of patterns.
    every = side.sparkSession.range(FILTER_WORDS).join(set_words, "id", "left")
    listed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    whole = every.agg(F.transform(listed, lambda w: w["bits"]).alias("words"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    return whole.select(F.struct("words", "spans")).scalar()


def match_contained(values: DataFrame, indicators: DataFrame, key: list[str], case: str = "insensitive") -> DataFrame:
    """(key.., field, indicator_id) where the value of an event field contains the pattern.

    Each pattern is found through one of its pieces by an equi-join and then tested in full, so no event meets a
    pattern with which it shares no piece, and nothing is left out. Pieces of a text that are no pattern's anchor are dropped by a
    filter of fixed size in the task that finds them, so what is shuffled is about as many rows as anchors met.
    """
    fold = F.lower if case == "insensitive" else (lambda c: c)
    side = anchored(indicators.select("indicator_id", "field", fold(F.col("pattern")).alias("pattern")))
    folded = values.select(*key, "field", fold(F.col("value")).alias("value"))
    anchors = anchor_filter(side)
    # Words and pieces of a text are told apart by their span; each is listed once per text, and only if a pattern needs its span.
    none = F.array().cast("array<struct<span:int,piece:string>>")
    listed = [F.when(F.array_contains(anchors["spans"], span), _listed(F.col("value"), span)).otherwise(none) for span in range(PIECE + 1)]

    found = F.explode(F.concat(*listed)).alias("p")
    pieces = folded.select(*key, "field", found).select(*key, "field", "p.span", "p.piece")
    slot = _slot(F.col("field"), F.col("span"), F.col("piece"))
    bit = F.getbit(F.get(anchors["words"], F.floor(slot / 64).cast("int")), F.pmod(slot, F.lit(64)).cast("int"))
    pieces = pieces.where(bit == 1)
    candidates = pieces.join(side, ["field", "span", "piece"]).drop("span", "piece").distinct()
    return candidates.join(folded, [*key, "field"]).where(F.contains("value", "pattern")).select(*key, "field", "indicator_id").distinct()
