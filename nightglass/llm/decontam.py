"""Benchmark decontamination: a hash set of benchmark word windows scanned over whole documents.

Words are maximal runs of digits, letters and non-ASCII characters with A-Z lower-cased. A window is 13
consecutive words of a benchmark item; an item of fewer words is one window. Windows are found through their rarest
word and the hash of all their words, and verified word by word before they count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.llm.common import join_rows, keyed_texts

WIDTH = 13
# What a word holds is named, the commonest first: a class of what it does not hold takes ten times as long.
WORD = r"[a-z0-9A-Z\x{80}-\x{10FFFF}]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The window set is broadcast only when measured to be within both bounds; beyond them the join shuffles.
BROADCAST_WINDOWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(hash, gram, items) of every distinct window. Items without words have none; a null id is never listed."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    grams = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item_id").alias("items")).select(F.xxhash64("gram").alias("hash"), "gram", "items")


def anchored(windows: DataFrame) -> DataFrame:
    """Adds to each window the hash of the word that the fewest windows hold, and where it stands in the window."""
    parts = windows.select("gram", F.posexplode("gram").alias("at", "word"))
    held = parts.groupBy("word").agg(F.count("*").alias("n"))
    rarest = parts.join(held, "word").groupBy("gram").agg(F.min(F.struct("n", -F.char_length("word"), "word", "at")).alias("m"))
    return windows.join(rarest, "gram").select(F.xxhash64("m.word").alias("word_hash"), "m.at", "hash", "gram", "items")


def find_hits(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, key, pos, len, items): every verified occurrence of a window; pos counts words from 1.

    Every word of every text is looked up among the windows' rarest words; where one is met, the hash of the text's
    window around it is compared with the window's, and then the words themselves.
    """
    measured = windows.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.concat_ws(" ", "gram")) + 8 * F.size("items")).alias("b")).first()
    small = measured["n"] <= BROADCAST_WINDOWS and (measured["b"] or 0) <= BROADCAST_BYTES
    table = anchored(windows)
    words = texts.select("doc_id", "key", words_of(F.col("text")).alias("w"))
    seen = words.select("doc_id", "key", "w", F.posexplode("w").alias("i", "word")).select("doc_id", "key", "w", "i", F.xxhash64("word").alias("word_hash"))
    met = seen.join(F.broadcast(table) if small else table, "word_hash")
    start, n = F.col("i") - F.col("at") + 1, F.size("gram")
    window = F.slice("w", F.greatest(start, F.lit(1)), n)
    found = met.where((start >= 1) & (start + n - 1 <= F.size("w"))).where((F.xxhash64(window) == F.col("hash")) & (window == F.col("gram")))
    return found.select("doc_id", "key", start.alias("pos"), n.alias("len"), "items")


def hit_words(spans: Column) -> Column:
    """Words covered by the union of (pos, len) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        stop = s["pos"] + s["len"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), stop - F.greatest(s["pos"], acc["end"]))).cast("long").alias("n"), F.greatest(acc["end"], stop).alias("end"))

    return F.aggregate(F.sort_array(spans), start, step, lambda acc: acc["n"])


def document_hits(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, spans, items) of the documents with at least one hit."""
    hits = find_hits(texts, benchmark_windows(benchmark))
    return hits.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("pos", "len")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: n_words, n_hit, n_items, items_sha256 and contaminated (at least a twentieth hit).

    A null or empty text has no words and is clean. Repeated rows are kept, each with its result. With an empty
    benchmark every document is clean.
    """
    texts = keyed_texts(docs)
    hits = document_hits(texts, benchmark).withColumn("n_hit", hit_words(F.col("spans"))).drop("spans")
    all_docs = texts.select("doc_id", "key", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"))
    ids = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda x: x.cast("string")))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return join_rows(all_docs, hits).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated rows, all columns kept."""
    keys = keyed_texts(docs)
    hits = document_hits(keys, benchmark)
    names = docs.columns
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text")
    ).withColumn("key", F.xxhash64("text", F.octet_length("text")))
    bad = hits.select("doc_id", "key", hit_words(F.col("spans")).alias("n_hit"))
    joined = join_rows(marked, bad)
    dirty = F.coalesce("n_hit", F.lit(0)) * 20 >= F.regexp_count("text", F.lit(WORD))
    return joined.where(F.col("n_hit").isNull() | ~dirty).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) of every row with all hit words, and what separates them from the next word, cut out."""
    texts = keyed_texts(docs)
    hits = document_hits(texts, benchmark)
    joined = join_rows(texts, hits)
    covered = lambda i: F.exists("spans", lambda s: (s["pos"] <= i + 1) & (i + 1 < s["pos"] + s["len"]))
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}{GAP}*"), F.lit(0))
    kept = F.array_join(F.filter(pieces, lambda _, i: ~covered(i)), "")
    cut = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(F.regexp_extract("text", f"^{GAP}*", 0), kept))
    return joined.select("doc_id", cut.alias("text"))
