r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it are context and
only its text is trainable.  Turns after the last reply (or a conversation
without replies) give one more example without a target, so that nothing is
lost.  A turn is written ``<|turn|>role<|text|>text<|end|>``.  Inside roles and
texts every ``\``, ``<`` and ``[`` is followed by an inserted ``\``, so no
control string (``<|...|>``, ``</s>``, ``[INST]`` ...) can appear there, and
``unescape`` undoes it exactly.

All steps are DataFrame operations.  The examples of a conversation grow with
the square of its turns, as the method has it; they are made row by row from
the conversation's turns, which are the only thing shuffled.

Defined cases: turns are ordered by ``turn`` (nulls first), then role and text,
so ties and repeated rows have one order; a null role or text is empty; a null
conversation id is a conversation; an empty table gives no example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Role whose texts are trained on.
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", r"$1")


def expand(turns: DataFrame, target: str = TARGET) -> DataFrame:
    """Examples of every conversation: conv_id, example (from 1), formatted,
    loss_start and loss_length (code points; null where nothing is trainable),
    last (the example that holds all turns)."""
    empty = F.lit("")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    listed = turns.select(
        "conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("text")).alias("turn_row")
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn_row")).alias("turns"))
    listed = listed.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(
            (t["role"] == target).alias("reply"),
            F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
            escape(t["text"]).alias("body"),
        )).alias("turns"),
    )
    listed = listed.select(
        "conv_id", "turns",
        F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))).alias("written"),
        F.filter(F.sequence(F.lit(1), F.size("turns")),
                 lambda i: F.get("turns", i - 1)["reply"] | (i == F.size("turns"))).alias("stops"),
    )
    each = listed.select("conv_id", "turns", "written", F.posexplode("stops").alias("pos", "stop"))
    here = F.get("turns", F.col("stop") - 1)
    before = F.array_join(F.slice("written", F.lit(1), F.col("stop") - 1), "")
    each = each.select(
        "conv_id", (F.col("pos") + 1).cast("long").alias("example"), before.alias("before"),
        here.alias("here"), (F.col("stop") == F.size("turns")).alias("last"),
    )
    start = F.char_length("before") + F.char_length("here.head") + 1
    return each.select(
        "conv_id", "example",
        F.concat("before", "here.head", "here.body", F.lit(END)).alias("formatted"),
        F.when(F.col("here.reply"), start.cast("long")).alias("loss_start"),
        F.when(F.col("here.reply"), F.char_length("here.body").cast("long")).alias("loss_length"),
        "last",
    )


def parse(formatted: Column) -> Column:
    """The turns written in an example: array of (role, text), unescaped."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.split(p, r"<\|text\|>", 2)[0]).alias("role"),
        unescape(F.split(F.split(p, r"<\|text\|>", 2)[1], r"<\|end\|>", 2)[0]).alias("text"),
    ))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, their digest, the
    text under the loss mask and its digest, and all characters written."""
    loss = F.when(
        F.col("loss_start").isNotNull(),
        unescape(F.substring("formatted", F.col("loss_start").cast("int"), F.col("loss_length").cast("int"))),
    )
    rows = examples.select(
        "conv_id",
        F.when(F.col("last"), F.col("formatted")).alias("whole"),
        F.when(loss.isNotNull(), F.struct("example", loss.alias("text"))).alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    per = rows.groupBy("conv_id").agg(
        F.collect_list("whole")[0].alias("whole"),
        F.array_join(F.sort_array(F.collect_list("loss"))["text"], "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    read = per.select("conv_id", "loss", "formatted_chars", parse(F.col("whole")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
