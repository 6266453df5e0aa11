"""Personal data: four fixed patterns, and terms whose co-occurrence gives a protected value away.

Information-theoretic sanitisation. A protected entity is a value that a pattern found. Over the whole corpus, how
much a term t tells of an entity e is their pointwise mutual information relative to the information content of e:

    disclosure(t, e) = log(p(e | t) / p(e)) / -log p(e) = 1 - log p(e | t) / log p(e)

with p(e | t) the share of the documents holding t that hold e, anywhere in them. A term at or above GENERALISE
for some entity is generalised, at or above REMOVE it is removed, wherever it stands in any document. Terms seen with
an entity in fewer than SUPPORT different contexts of the entity are no evidence and stay; a context is
what stands within REACH code points on either side of the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.llm.common import join_rows, keyed_texts, write_out
from nightglass.llm.spans import SPAN, Kind, listed, with_spans

DIGITS = r"[^0-9]"


def passes_luhn(match: Column) -> Column:
    """14 to 19 digits with a Luhn sum that 10 divides."""
    digits = F.regexp_replace(match, DIGITS, "")
    n = F.char_length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.try_to_number(F.substring(digits, n - i + 1, F.lit(1)), F.lit("9")).cast("int")
        return acc + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.when((n >= 14) & (n <= 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def in_byte_range(match: Column) -> Column:
    part = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return match.rlike(rf"^{part}(\.{part}){{3}}$")


def has_phone_digits(match: Column) -> Column:
    return F.char_length(F.regexp_replace(match, DIGITS, "")).between(10, 15)


# A match can start only where its first run starts, or where the last match ended: said in front (\G and a look
# behind), this keeps long runs linear. A run of digits that is too short for a card has no longer one inside it.
BASE = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", in_byte_range),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){13,}+", passes_luhn),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", has_phone_digits),
]
REACH = 80
WORD = r"[\p{L}\p{N}_]{3,}+"
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
# Up to so many disclosing terms are broadcast to the texts, more are joined by a shuffle.
TERMS_BROADCAST = 100_000


def blanked(text: Column, spans: Column) -> Column:
    """text with a space for each code point of the spans, so that positions stay."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.when(s["start"] > acc["at"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(before, blank)).alias("out"))

    return F.aggregate(F.sort_array(spans), start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))


def scan(texts: DataFrame) -> DataFrame:
    """(doc_id, key, spans per kind, near, rest) per row.

    near holds entity and context of each span, rest the text without the spans; both are null without spans.
    """
    found = with_spans(texts, BASE)
    every = found.withColumn("base", F.concat(*[F.col(f"s_{k.name}") for k in BASE]))
    from_ = lambda s: F.greatest(s["start"] - REACH, F.lit(0))
    near = F.transform(
        "base",
        lambda s: F.struct(
            F.concat_ws(":", s["kind"], F.lower(s["value"])).alias("entity"),
            F.xxhash64(F.substring("text", from_(s) + 1, s["start"] - from_(s)), F.substring("text", s["end"] + 1, F.lit(REACH))).alias("context"),
        ),
    )
    some = F.size("base") > 0
    return every.select("doc_id", "key", *[f"s_{k.name}" for k in BASE], F.when(some, near).alias("near"), F.when(some, blanked(F.col("text"), F.col("base"))).alias("rest"))


def terms_in(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w)))


def entity_rows(scanned: DataFrame) -> DataFrame:
    """(doc_id, key, entity, contexts, copies): the entities with enough contexts, once for all copies of a row.

    A term's contexts are some of its entity's, so an entity with fewer than SUPPORT has no disclosing term.
    """
    near = scanned.select("doc_id", "key", F.explode("near").alias("n")).select("doc_id", "key", "n.entity", "n.context")
    enough = near.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).select("entity")
    rows = near.join(enough, "entity", "left_semi").groupBy("doc_id", "key", "entity").agg(F.collect_set("context").alias("contexts"))
    copies = scanned.where("near IS NOT NULL").groupBy("doc_id", "key").agg(F.count("*").alias("copies"))
    return join_rows(rows, copies, "inner")


def disclosures(texts: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms at or above GENERALISE, counted in whole documents over the whole corpus.

    entities is that of entity_rows, terms has (doc_id, key, term) of the rows that hold an entity.
    """
    docs = texts.count()
    pairs = join_rows(entities, terms, "inner")
    together = pairs.groupBy("entity", "term").agg(F.sum("copies").alias("n_both"))
    per_entity = entities.groupBy("entity").agg(F.sum("copies").alias("n_entity"))
    counts = texts.select(F.explode(terms_in(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    score = F.when(F.col("n_entity") < docs, 1 - F.log(F.least(F.lit(1.0), F.col("n_both") / F.col("n_term"))) / F.log(F.col("n_entity") / F.lit(float(docs))))
    # A term that is cut by a span's end may stand nowhere else as a word of its own.
    scored = together.join(counts, "term", "left").withColumn("n_term", F.greatest("n_term", "n_both")).join(per_entity, "entity").select("entity", "term", score.alias("disclosure"))
    high = write_out(scored.where(F.col("disclosure") >= GENERALISE), "pii-scores")
    seen = pairs.join(high, ["entity", "term"]).select("entity", "term", "disclosure", F.explode("contexts").alias("context")).distinct()
    return seen.groupBy("entity", "term", "disclosure").agg(F.count("*").alias("support")).where(F.col("support") >= SUPPORT).drop("support")


def term_spans(texts: DataFrame, scanned: DataFrame, terms: DataFrame, revealing: DataFrame) -> DataFrame:
    """(doc_id, key, s_term): every place where a disclosing term stands outside the base spans, once per (doc_id, key)."""
    worst = write_out(revealing.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii-worst")
    if worst.count() <= TERMS_BROADCAST:
        worst = F.broadcast(worst)
    words = texts.select("doc_id", "key", F.explode(terms_in(F.col("text"))).alias("term")).unionByName(terms)
    action = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    hits = words.join(worst, "term").groupBy("doc_id", "key").agg(F.map_from_entries(F.collect_set(F.struct("term", action))).alias("hits"))
    rest = scanned.where("rest IS NOT NULL").select("doc_id", "key", "rest").dropDuplicates(["doc_id", "key"])
    held = join_rows(join_rows(texts, hits, "inner").dropDuplicates(["doc_id", "key"]), rest).withColumn("text", F.coalesce("rest", "text")).drop("rest")
    placed = with_spans(held, [Kind("term", WORD)])
    of = lambda s: F.element_at(F.col("hits"), F.lower(s["value"]))
    span = F.transform(
        F.filter("s_term", lambda s: F.map_contains_key(F.col("hits"), F.lower(s["value"]))),
        lambda s: F.struct(s["start"].alias("start"), F.lit(len(BASE)).alias("rank"), s["end"].alias("end"), F.lit("term").alias("kind"), of(s).alias("value")),
    )
    return placed.select("doc_id", "key", span.cast(SPAN).alias("s_term"))


def find_personal(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, key, spans per kind, s_term): base spans, and spans of disclosing terms.

    A term's span has kind `term`, its value is `remove` or `generalise`. Null texts are empty. Repeated rows are
    all kept. A row is named by (doc_id, key), null ids included.
    """
    texts = keyed_texts(docs)
    scanned = write_out(scan(texts), "pii-scan")
    entities = write_out(entity_rows(scanned), "pii-entities")
    holders = entities.select("doc_id", "key").distinct()
    terms = join_rows(scanned.where("rest IS NOT NULL").select("doc_id", "key", F.explode(terms_in(F.col("rest"))).alias("term")), holders, "left_semi").distinct()
    revealing = write_out(disclosures(texts, entities, terms), "pii-disclosures")
    every = scanned.where("rest IS NOT NULL").select("doc_id", "key", F.explode(terms_in(F.col("rest"))).alias("term"))
    extra = term_spans(texts, scanned, every, revealing)
    return join_rows(scanned.drop("near", "rest"), extra).withColumn("s_term", F.coalesce("s_term", F.array().cast(SPAN)))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, counts per kind, base_sha256, spans, n_term) per row of docs."""
    found = find_personal(docs)
    base = F.concat(*[F.col(f"s_{k.name}") for k in BASE])
    return found.select(
        "doc_id",
        *[F.size(f"s_{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.concat(base, "s_term")).alias("spans"),
        F.size("s_term").cast("long").alias("n_term"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text) per row: base spans replaced by [KIND], disclosing terms by [TERM] or by nothing.

    Of overlapping spans the one that starts first goes whole, the rest of the others goes with it.
    """
    texts, found = keyed_texts(docs), find_personal(docs).dropDuplicates(["doc_id", "key"])
    spans = found.select("doc_id", "key", F.sort_array(F.concat(*[F.col(f"s_{k.name}") for k in BASE], F.col("s_term"))).alias("all"))
    label = lambda s: F.when(s["value"] == "remove", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= acc["at"], F.concat(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), label(s))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.char_length(F.col("text"))))
    return join_rows(texts, spans).select("doc_id", F.when(F.size("all") > 0, F.aggregate("all", start, step, rest)).otherwise(F.col("text")).alias("text"))
