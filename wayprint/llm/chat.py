"""Chat formatting: one training example per assistant turn.

The example of an assistant turn is the conversation up to and with it. All turns
before it are context; only the text of this reply is trainable. When the last turn
is not the assistant's, one more example holds the whole conversation without a
trainable part, so that no turn is lost.

A turn is ``<turn>role``, a line feed, the text and ``</turn>`` with a line feed. Inside
roles and texts ``&`` is written ``&amp;`` and ``<`` is written ``&lt;``, so they hold no
control string; in roles a line feed is ``&#10;``. Reading back undoes this, ``&amp;``
last.

Edge cases: null texts and roles are empty; turns of one number are ordered by role
and text, those without a number come first; a repeated row is a turn again; rows
without a conversation id form one conversation; a text of any length is formatted whole,
and a conversation must fit in a row; an empty table gives no examples;
other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
REPLY = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def examples(turns: DataFrame) -> DataFrame:
    """``conv_id, example, formatted, loss_start, loss_end`` from ``conv_id, turn, role, text``.

    ``example`` is the number of turns in it; the trainable code points of ``formatted``
    lie from ``loss_start`` (from 0) up to ``loss_end``, both null where there are none.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conversations = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    heads = F.transform("turns", lambda t: F.struct(
        (t["role"] == REPLY).alias("reply"),
        F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body")))
    formatted = conversations.select("conv_id", heads.alias("turns"))
    formatted = formatted.select("conv_id", "turns", F.transform(
        "turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))).alias("parts"))
    turns_, parts, n = F.col("turns"), F.col("parts"), F.col("example")
    numbers = F.filter(F.sequence(F.lit(1), F.size(turns_)), lambda i: F.get(turns_, i - 1)["reply"] | (i == F.size(turns_)))
    last = F.get(turns_, n - 1)
    each = formatted.select("conv_id", "turns", "parts", F.explode(numbers).alias("example")).select(
        "conv_id", "example", F.array_join(F.slice(parts, 1, n - 1), "").alias("context"), last.alias("last"))
    start = F.when(F.col("last.reply"), F.length("context") + F.length("last.head"))
    return each.select(
        "conv_id", "example", F.concat("context", "last.head", "last.body", F.lit(CLOSE)).alias("formatted"),
        start.alias("loss_start"), (start + F.length("last.body")).alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of an example as an array of ``role, text``."""
    inner = F.filter(F.split(formatted, CLOSE), lambda part: part != "")
    stripped = F.transform(inner, lambda part: F.substring(part, len(OPEN) + 1, 2**31 - 1))
    return F.transform(stripped, lambda part: F.struct(
        unescape_role(F.substring_index(part, "\n", 1)).alias("role"),
        unescape(F.substring(part, F.length(F.substring_index(part, "\n", 1)) + 2, F.length(part))).alias("text")))


def digests(found: DataFrame) -> DataFrame:
    """What the examples of each conversation say when read back."""
    loss = F.when(F.col("loss_start").isNotNull(), unescape(
        F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))))
    read = found.select("conv_id", "example", "formatted", loss.alias("loss"))
    whole = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"))
    whole = whole.select("conv_id", "formatted_chars", read_turns(F.col("formatted")).alias("turns"),
                         F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars")
