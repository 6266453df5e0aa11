r"""Chat formatting with a grammar round trip.

Template: one turn is `### role: text\n</turn>\n`. The grammar does not allow the control strings `### ` and
`</turn>` inside a text. Rendering starts from the plain text; the result is reparsed, and what does not come back
identical is escaped by one more back-slash before each control string (back-slashes before it included), until the
reparsed turns equal the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CONTROL = r"(\\*)(### |</turn>)"
ESCAPED = r"\\(\\*)(### |</turn>)"
PLAIN_CONTROL = r"(?<!\\)(### |</turn>)"
END = "\n</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def escape_role(role: Column) -> Column:
    return escape(F.regexp_replace(role, r"([\\:])", r"\\$1"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(unescape(role), r"\\([\\:])", "$1")


def reads_back(rendered: Column, source: Column) -> Column:
    """True if the grammar accepts a rendered text and gives the source."""
    return ~rendered.rlike(PLAIN_CONTROL) & (unescape(rendered) == source)


def render_text(text: Column) -> Column:
    """The plain text if it reads back, else the escaped one; escaping always reads back, and is checked too."""
    escaped = escape(text)
    wrong = F.raise_error(F.concat(F.lit("text does not survive the round trip: "), text)).cast("string")
    return F.when(reads_back(text, text), text).when(reads_back(escaped, text), escaped).otherwise(wrong)


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted) per conversation; turns in order of turn, ties by role and text, nulls first.

    Null roles and texts are empty. Turns with a null conv_id make up one conversation. A conversation is one training
    sample and so one value: it must fit in a row, as each of its texts does. Texts are rendered row by row before
    anything is grouped.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rendered = turns.select(
        "conv_id",
        F.struct(F.col("turn"), role.alias("role"), text.alias("text"), F.concat(F.lit("### "), escape_role(role), F.lit(": "), render_text(text), F.lit(END)).alias("shown")).alias("t"),
    )
    in_order = F.sort_array(F.collect_list("t"))
    return rendered.groupBy("conv_id").agg(F.array_join(F.transform(in_order, lambda t: t["shown"]), "").alias("formatted"))


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, text>> read from formatted text by the grammar alone."""
    head = r"^### ((?:[^\\:]|\\.)*+): "
    turns = F.split(formatted, r"\n</turn>\n")
    return F.transform(
        F.slice(turns, 1, F.size(turns) - 1),
        lambda p: F.struct(unescape_role(F.regexp_extract(p, f"(?s){head}", 1)).alias("role"), unescape(F.regexp_replace(p, f"(?s){head}", "")).alias("text")),
    )


def loss_texts(parsed: Column) -> Column:
    """What the loss mask covers: the assistant's texts."""
    return F.transform(F.filter(parsed, lambda t: t["role"] == "assistant"), lambda t: t["text"])


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Per conversation the digests of what is read back from the formatted text."""
    parsed = formatted.select("conv_id", "formatted", parse_chat(F.col("formatted")).alias("p"))
    turns = F.array_join(F.transform("p", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(loss_texts(F.col("p")), "")
    return parsed.select(
        "conv_id",
        F.size("p").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def with_conflict(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts hold the template's own control strings."""
    text = r"\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast("long").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(added)
