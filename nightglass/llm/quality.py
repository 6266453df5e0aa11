"""Quality rules as a ledger: every rule is evaluated once per document, its failure is one bit.

Policies are versioned masks over the bits. Changing a policy, or asking what a rule costs, needs the
ledger only and never the texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter")

# Bit number and SQL condition of each rule over the measurements. Bits are never reused.
RULES = {
    "too_few_words": (0, "n_words < 10"),
    "repeated_windows": (1, "100 * n_repeat_words > 20 * n_words"),
    "symbols": (2, "10 * n_symbols > n_words"),
    "repeated_lines": (3, "100 * n_dup_lines > 40 * n_lines"),
    "stuttering": (4, "100 * n_stutter > 25 * n_words"),
    "long_words": (5, "word_chars > 25 * n_words"),
}
BASE = ("too_few_words", "repeated_windows")
# A policy rejects what fails any of its rules. Published versions are not changed; a new one is added.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "stuttering", "long_words"),
}
CURRENT = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES[r][0] for r in rules)


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; all 0 for a null."""
    words = WORDS.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    covered = 0
    if len(set(windows)) < len(windows):
        counts, end = Counter(windows), 0
        for i, w in enumerate(windows):
            if counts[w] > 1:
                covered += i + WINDOW - max(i, end)
                end = i + WINDOW
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return len(words), sum(map(len, words)), len(SYMBOLS.findall(text or "")), len(lines), len(lines) - len(set(lines)), covered, stutter


@pandas_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=list(MEASURES), dtype="int64")


def failure_bits() -> Column:
    parts = [F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, condition in RULES.values()]
    bits = parts[0]
    for part in parts[1:]:
        bits = bits.bitwiseOR(part)
    return bits


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, kept columns, measurements, bits) per row; a null or empty text has no words and fails rule 0.

    Rows are never joined or grouped, so repeated rows, null ids and clashing column names do no harm.
    """
    rows = docs.select("doc_id", *keep, measures(F.col("text")).alias("_m")).select("doc_id", *keep, *[F.col(f"_m.{n}").alias(n) for n in MEASURES])
    return rows.withColumn("bits", failure_bits())


def verdict(bits: Column, policy: str = CURRENT) -> Column:
    """True if the policy keeps a document with these failure bits."""
    return bits.bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, and documents that only it rejects (kept without it).

    The ledger is folded to one row per bit pattern first, of which there are at most 2 ** len(RULES).
    """
    mask = mask_of(POLICIES[policy])
    patterns = rows.groupBy("bits").agg(F.count("*").alias("n"))
    named = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).alias("bit")) for r in POLICIES[policy]]))
    each = patterns.select("bits", "n", named.alias("r")).select("bits", "n", "r.rule", "r.bit")
    within = F.col("bits").bitwiseAND(F.lit(mask))
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(within.bitwiseAND(F.col("bit")) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(within == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"),
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of docs that the policy keeps, with all their columns."""
    m = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("_m", measures(F.col("row.text")))
    return m.select("row", "_m.*").where(verdict(failure_bits(), policy)).select("row.*")
