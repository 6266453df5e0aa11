"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightglass.llm import bagminhash, chat, decontam, license, mixing, negatives, periodic, pii, quality, secrets, sharding, subtrees, suffix
from nightglass.llm.common import table
from nightglass.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def add(function):
        QUERIES[name] = function
        return function

    return add


@query("op2_decontam")
def op2(spark, folder):
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_quality")
def op7(spark, folder):
    rows = quality.ledger(table(spark, folder, "documents"))
    base = ~quality.verdict(F.col("bits"), "v1")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), quality.verdict(F.col("bits")).alias("kept"), "n_lines", "n_stutter", "bits"
    )


@query("op8_chat")
def op8(spark, folder):
    return chat.chat_digest(chat.format_chats(chat.with_conflict(spark, table(spark, folder, "conversations"))))


@query("op9_secrets")
def op9(spark, folder):
    return secrets.find_secrets(table(spark, folder, "documents"))


@query("op4_pii")
def op4(spark, folder):
    return pii.report(table(spark, folder, "documents"))


@query("op3_sharding")
def op3(spark, folder):
    return sharding.assign(table(spark, folder, "documents")).drop("key")


@query("op5_mixing")
def op5(spark, folder):
    return mixing.schedule(table(spark, folder, "documents"))


@query("op10_bagminhash")
def op10(spark, folder):
    return bagminhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_suffix")
def op6(spark, folder):
    return suffix.remove_repeats(table(spark, folder, "documents"))


@query("op1_license")
def op1(spark, folder):
    return license.scan(table(spark, folder, "documents"))


@query("op11_negatives")
def op11(spark, folder):
    rows = negatives.usable(table(spark, folder, "embeddings"), "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query("op12_subtrees")
def op12(spark, folder):
    return subtrees.passage_digest(subtrees.remove_passages(table(spark, folder, "documents")))


@query("op13_periodic")
def op13(spark, folder):
    return periodic.run_digest(periodic.find_runs(table(spark, folder, "documents"), periodic.planted))
