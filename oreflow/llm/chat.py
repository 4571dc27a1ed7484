"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply is trainable. Turns behind the last assistant turn
(or all of them, where there is none) make one more example without a trainable
part, so that the output holds every turn.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can close
or open a turn; in roles a line end becomes ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: a backslash stands for the character behind it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """Backslash pairs are set aside first, so a text ``\\n`` stays one."""
    aside = F.replace(role, F.lit("\\\\"), F.lit("\\\x00"))
    ended = F.regexp_replace(aside, r"\\n", "\n")
    return F.replace(F.replace(ended, F.lit("\\|"), F.lit("|")), F.lit("\\\x00"), F.lit("\\"))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, target_turn, n_turns, formatted, loss_start, loss_end).

    ``formatted[loss_start:loss_end]`` in code points is the trainable reply.
    ``target_turn`` numbers the turns of a conversation from 0 in order of
    ``turn``, then role and text; repeated rows are turns of their own. Null
    roles and texts count as empty, and a null conv_id is one conversation. An
    empty table gives no rows; further columns are not read.

    The expansion repeats contexts, so output grows with turns times length;
    the rows of one conversation meet in one row, as its longest example does.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        "conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    rendered = F.transform("t", lambda t: F.struct(
        (t.role == "assistant").alias("reply"),
        F.concat(F.lit(OPEN), escape_role(t.role), F.lit("\n")).alias("head"),
        escape(t.text).alias("body")))
    whole = F.transform("r", lambda r: F.concat(r["head"], r["body"], F.lit(CLOSE)))
    spots = F.transform("r", lambda r, i: F.when(r["reply"] | (i == F.size("r") - 1), i))
    return (
        grouped.select("conv_id", F.inline(F.array(F.struct(rendered.alias("r")))))
        .select("conv_id", "r", F.inline(F.array(F.struct(whole.alias("w"), spots.alias("at")))))
        .select("conv_id", "r", "w",
                F.explode(F.filter("at", lambda i: i.isNotNull())).alias("target_turn"))
        .select("conv_id", "target_turn", F.size("r").alias("n_turns"),
                F.element_at("r", F.col("target_turn") + 1).alias("last"),
                F.array_join(F.slice("w", 1, F.col("target_turn") + 1), "").alias("formatted"))
        .withColumn("end", F.length("formatted") - len(CLOSE))
        .select(
            "conv_id", "target_turn", "n_turns", "formatted",
            F.when(F.col("last.reply"), F.col("end") - F.length("last.body"))
            .otherwise(F.col("end")).cast("long").alias("loss_start"),
            F.col("end").cast("long").alias("loss_end"))
    )


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of one formatted example."""
    turns = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")
    bare = F.transform(turns, lambda x: F.substring(x, len(OPEN) + 1, 2_000_000_000))
    return F.transform(bare, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.lit(2_000_000_000))
                 ).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples."""
    loss = unescape(F.substring(
        F.col("formatted"), F.col("loss_start").cast("int") + 1,
        (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = formatted.select("conv_id", "target_turn", "formatted", loss.alias("loss"))
    grouped = per.groupBy("conv_id").agg(
        F.max_by("formatted", "target_turn").alias("longest"),
        F.sort_array(F.collect_list(F.struct("target_turn", "loss"))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"))
    parts = grouped.select(
        "conv_id", "formatted_chars",
        F.inline(F.array(F.struct(
            read_back(F.col("longest")).alias("turns"),
            F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss")))))
    text = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parts.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars")
