"""Many rules over one event set, in one scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, NumericType

from nightglass.operators.fields import column, quote
from nightglass.operators.rules import NAMED, CompiledRule
from nightglass.operators.values import LOWERED, VALUES, Test, lowered_sql, open_values_sql
from nightglass.session import local_table

# Up to this many rules on this few columns, "any rule matches" also goes to the scan as a filter of
# its own. Catalyst derives one constraint per subset of the renamed columns in a filter, so a
# filter over many columns costs more to plan than it saves.
PREFILTER_RULES = 64
PREFILTER_COLUMNS = 6
# Columns that hold the results of an event's tests and of the rules as bits, WIDTH in each.
BITS, MET = "_bits:", "_met:"
WIDTH = 32


def any_of(tests: list[Column]) -> Column:
    """Balanced OR, so that a long list does not make a deep expression."""
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def bit(k: int) -> int:
    """The 32-bit number with bit k alone."""
    return 1 << k if k < WIDTH - 1 else -(1 << k)


def packed(tests: list[str]) -> list[Column]:
    """The results of tests as bits of 32-bit numbers. A test that is NULL is not met."""
    words = [tests[i : i + WIDTH] for i in range(0, len(tests), WIDTH)]
    return [F.expr(" | ".join(f"if({t}, {bit(j)}, 0)" for j, t in enumerate(word))) for word in words]


def with_tests(events: DataFrame, tests: dict[str, Test]) -> tuple[DataFrame, dict[str, str]]:
    """(events with the result of every test as one bit, {name: SQL that reads it}).

    Fields are looked up in VARIANT values and lowered once for all tests, and a test is evaluated once however many rules name it.
    """
    schema = events.schema
    values = {VALUES + f: F.expr(open_values_sql(schema, f)) for f in sorted({f for t in tests.values() for f in t.values})}
    events = events.withColumns(values) if values else events
    lower = {LOWERED + f: F.expr(lowered_sql(schema, f)) for f in sorted({t.lowered for t in tests.values() if t.lowered is not None})}
    events = events.withColumns(lower) if lower else events
    bits = {f"{BITS}{k}": c for k, c in enumerate(packed([t.scan_sql for t in tests.values()]))}
    reads = {n: f"({column(f'{BITS}{i // WIDTH}')} & {bit(i % WIDTH)}) <> 0" for i, n in enumerate(tests)}
    return (events.withColumns(bits) if bits else events), reads


def detect(events: DataFrame, rules: list[CompiledRule], keep: list[str]) -> DataFrame:
    """One row per (event, matching rule): the `keep` columns and rule_id. Works on streams as well.

    Rules that failed to compile match nothing. Events are read once and never shuffled. Every different test of all rules is
    evaluated once per event; conditions read the results, and of what they give only numbers with a bit set become rows.
    """
    usable = [r for r in rules if r.sql]
    kept = [F.col(f"`{c}`") for c in keep]
    if not usable:
        return events.where(F.lit(False)).select(*kept, F.lit("").alias("rule_id"))
    few = len(usable) <= PREFILTER_RULES and len({f for r in usable for f in r.fields}) <= PREFILTER_COLUMNS
    if few and all(r.tests and all(t.pushable for _, t in r.tests) for r in usable):
        events = events.where(any_of([F.expr(r.sql) for r in usable]))
    tested, reads = with_tests(events, {n: t for r in usable for n, t in r.tests})
    conditions = [NAMED.sub(lambda m: reads[m[1]], r.condition) if r.condition else r.sql for r in usable]
    # As columns of their own the conditions are compiled; inside a generator or a lambda they would be interpreted.
    results = {f"{MET}{k}": c for k, c in enumerate(packed(conditions))}
    judged = tested.select(*kept, *[c.alias(n) for n, c in results.items()])
    # The outer form: for the plain one Spark would put the conditions, written out, into a filter on the array's size.
    met = judged.select(*kept, F.posexplode_outer(F.array(*[column(n) for n in results])).alias("_word", "_met")).where("_met <> 0")
    # Rule ids by word and bit; empty ones fill up the last word.
    ids = [quote(r.rule_id) for r in usable] + ["''"] * (-len(usable) % WIDTH)
    words = ", ".join(f"array({', '.join(ids[i : i + WIDTH])})" for i in range(0, len(ids), WIDTH))
    named = F.expr(f"filter(get(array({words}), _word), (id, i) -> (_met & shiftleft(1, i)) <> 0)")
    return met.select(*kept, F.explode(named).alias("rule_id"))


def rule_names(matches: DataFrame, rules: list[CompiledRule]) -> DataFrame:
    return local_table(matches.sparkSession, [(r.rule_id,) for r in rules], "rule_id string")


def count_matches(matches: DataFrame, rules: list[CompiledRule]) -> DataFrame:
    """(rule_id, total_hits) for every rule, zero included. Counts are combined before the shuffle."""
    counts = matches.groupBy("rule_id").agg(F.count("*").alias("hits"))
    named = rule_names(matches, rules).join(counts, "rule_id", "left")
    return named.select("rule_id", F.coalesce("hits", F.lit(0).cast("bigint")).alias("total_hits"))


def count_members(counts: DataFrame, members: DataFrame) -> DataFrame:
    """(rule_id, total_hits) for every row of members(rule_id, document), from the counts of the documents.

    As in `compile_rules` a rule without an id, or with an id that other rows have too, matches nothing. Rows are counted before any shuffle.
    """
    rules = members.groupBy("rule_id", "document").agg(F.count("*").cast("int").alias("_rows"))
    alone = F.col("rule_id").isNotNull() & (F.sum("_rows").over(Window.partitionBy("rule_id")) == 1)
    found = rules.withColumn("_alone", alone).join(counts.withColumnRenamed("rule_id", "document"), "document", "left")
    hits = F.when(F.col("_alone"), F.coalesce("total_hits", F.lit(0).cast("bigint"))).otherwise(0).cast("bigint").alias("total_hits")
    return found.select("rule_id", hits, F.explode(F.sequence(F.lit(1), "_rows"))).select("rule_id", "total_hits")


# Ranges of the order key that are counted per rule.
RANGES = 4096
NUMBERS = {"timestamp": F.unix_micros, "date": F.unix_date, "string": lambda c: F.conv(F.rpad(F.left(F.hex(c), F.lit(14)), 14, "0"), 16, 10)}


def order_number(matches: DataFrame, name: str) -> Column:
    """A number that never falls where the column rises; NULL for NULL, 0 for types without one."""
    kind = matches.schema[name].dataType
    if isinstance(kind, (NumericType, BooleanType)):
        # Infinities and NaN, which sorts last, share the outermost numbers.
        number = F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(1e300))
        return F.when(number.isNotNull(), F.greatest(F.least(number, F.lit(1e300)), F.lit(-1e300)))
    made = NUMBERS.get(kind.simpleString())
    return made(F.col(f"`{name}`")).cast("double") if made else F.lit(0.0)


def first_matches(matches: DataFrame, limit: int, order: list[str], salts: int = 64) -> DataFrame:
    """The first `limit` matches of each rule in the given order, numbered by row_no; `order` must be unique per rule.

    A negative limit keeps all and numbers none. Counts per range of the first order column, at most RANGES a rule, say in which
    range a rule's limit falls; only rows up to it are shuffled, and they are numbered range by range, so no rule is sorted
    whole or meets in one task. In the last range rows are cut per salt first, as many rows may share one value.
    """
    if limit < 0:
        return matches.withColumn("row_no", F.lit(None).cast("int"))
    numbered = matches.withColumn("_at", order_number(matches, order[0]))
    ends = numbered.groupBy("rule_id").agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    share = F.try_divide(F.col("_at") - F.col("_low"), F.col("_high") - F.col("_low"))
    # NULL comes first; a rule whose rows share one value has one range.
    place = F.when(F.col("_at").isNull(), -1).otherwise(F.floor(F.coalesce(share, F.lit(0.0)) * (RANGES - 1)).cast("int"))
    ranged = numbered.join(F.broadcast(ends), "rule_id").withColumn("_range", place)
    counts = ranged.groupBy("rule_id", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("rule_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    wanted = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < limit)
    kept = ranged.join(F.broadcast(wanted), ["rule_id", "_range"]).drop("_at", "_low", "_high")
    spread = kept.withColumn("_salt", F.when(F.col("_before") + F.col("_n") <= limit, 0).otherwise(F.pmod(F.xxhash64(*order), F.lit(salts))))
    part = Window.partitionBy("rule_id", "_range", "_salt").orderBy(*order)
    whole = Window.partitionBy("rule_id", "_range").orderBy(*order)
    cut = spread.withColumn("_no", F.row_number().over(part)).where(F.col("_no") + F.col("_before") <= limit)
    ranked = cut.withColumn("row_no", (F.row_number().over(whole) + F.col("_before")).cast("int")).where(F.col("row_no") <= limit)
    return ranked.select(*matches.columns, "row_no")


def sample_matches(matches: DataFrame, size: int, order: list[str]) -> DataFrame:
    """A sample of the first rows per rule; a negative size gives none."""
    return first_matches(matches, max(size, 0), order)


def row_counts(counts: DataFrame, limit: int) -> DataFrame:
    """Adds returned_rows, the count after the row limit, to total_hits, the count before it."""
    total = F.col("total_hits")
    return counts.withColumn("returned_rows", total if limit < 0 else F.least(total, F.lit(limit).cast("bigint")))
