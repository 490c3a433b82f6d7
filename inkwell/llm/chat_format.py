"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent
turns of one role are merged (the second header is replaced by a joiner); the
pieces are concatenated into one training string with a loss mask.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``; merged texts are parted by
``<|im_join|>``.  Inside roles and texts a backslash is doubled, and a control
string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``,
``<</SYS>>``) gets a backslash after its first character, so neither this
template's marks nor another's can be forged, and ``read_back`` restores every
text exactly.  Roles also have line breaks escaped as ``\\n``.

The mask is a run-length list over the string: ``(n_chars, loss)`` in order.
Loss covers exactly the texts of the assistant.

Edge cases: a NULL text is empty, a NULL role is the empty role; turns order by
(turn, role, text) with NULL turns first, so ties have one order; repeated rows
are turns of their own; rows with a NULL conv_id are one conversation; an empty
table gives an empty result; other columns are not read.  One conversation is
one output string, so its turns meet in one row; map-side sorting is left to
Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks.
OPEN, CLOSE, JOIN = "<|im_start|>", "<|im_end|>\n", "<|im_join|>"
ASSISTANT = "assistant"
# First character of a control string, then the rest of it.
CONTROL = r"([<\[])(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
ESCAPED = r"([<\[])\\(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, ESCAPED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # a line break is an odd backslash before n; doubled ones are parked under a control character first
    parked = F.replace(role, F.lit("\\\\"), F.lit("\u0000"))
    broken = F.replace(F.regexp_replace(parked, ESCAPED, "$1$2"), F.lit("\\n"), F.lit("\n"))
    return F.replace(broken, F.lit("\u0000"), F.lit("\\"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, mask array<struct<n_chars, loss>>``."""
    turns = conversations.select("conv_id", F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        turns = F.col("turns")
        joined = (i > 0) & (F.get(turns, i - 1)["role"] == t["role"])
        goes_on = F.coalesce(F.get(turns, i + 1)["role"] == t["role"], F.lit(False))
        return F.struct(
            F.when(joined, F.lit(JOIN)).otherwise(F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n"))).alias("head"),
            escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("loss"),
            F.when(goes_on, F.lit("")).otherwise(F.lit(CLOSE)).alias("tail"))

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    mask = F.flatten(F.transform("pieces", lambda p: F.array(
        F.struct(F.length(p["head"]).alias("n_chars"), F.lit(False).alias("loss")),
        F.struct(F.length(p["body"]).alias("n_chars"), p["loss"].alias("loss")),
        F.struct(F.length(p["tail"]).alias("n_chars"), F.lit(False).alias("loss")))))
    return pieces.select("conv_id", formatted.alias("formatted"),
                         F.filter(mask, lambda m: m["n_chars"] > 0).alias("mask"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string, one per input turn."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")
    opened = F.transform(blocks, lambda b: F.substring(b, len(OPEN) + 1, 2 ** 31 - 1 - len(OPEN)))
    parted = F.transform(opened, lambda b: F.struct(
        F.substring_index(b, "\n", 1).alias("role"),
        F.split(b.substr(F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b)), r"<\|im_join\|>", -1).alias("texts")))
    return F.flatten(F.transform(parted, lambda p: F.transform(p["texts"], lambda t: F.struct(
        unescape_role(p["role"]).alias("role"), unescape(t).alias("text")))))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Digests of what the formatted strings hold, read back from them."""
    turns = format_conversations(conversations).withColumn("turns", read_back(F.col("formatted")))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), "")
    masked = F.aggregate(F.filter("mask", lambda m: m["loss"]), F.lit(0).cast("long"), lambda a, m: a + m["n_chars"])
    return turns.select(
        "conv_id", F.array_size("turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), masked.alias("masked_chars"))
