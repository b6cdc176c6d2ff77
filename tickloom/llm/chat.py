"""Chat formatting by prefix-target expansion: every assistant turn is an example of its own, with all turns before
it as context, and only its text is trained on.

A turn is written ``<|role|>text</s>``. In roles and texts ``&``, ``<`` and ``[`` become ``&amp;``, ``&lt;`` and ``&#91;``
(in roles also ``>`` becomes ``&gt;``),
so no control string of this or a similar template can come from a text, and nothing is lost. Turns after the last
assistant turn, or all of a conversation without one, are a last example that trains on nothing.

An example holds its whole conversation up to the target, so a conversation is a row on the way there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = "</s>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def escaped_role(role: Column) -> Column:
    """In a role ``>`` is escaped too, as it ends there."""
    return F.replace(escaped(role), F.lit(">"), F.lit("&gt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&#91;"), F.lit("[")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 0), text, loss_start and loss_length (code points of text that are trained on).

    conversations needs conv_id, turn, role, text. Turns go by number, null last; ties by role, then text, and repeated
    rows are repeated turns. A null role or text is empty. Rows without a conv_id are one conversation. An empty table
    gives an empty result.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").isNull(), "turn", role.alias("role"), text.alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = turns.select(
        "conv_id",
        F.col("turns.role").alias("roles"),
        F.transform("turns", lambda t: escaped(t["text"])).alias("texts"),
        F.transform(
            "turns", lambda t: F.concat(F.lit("<|"), escaped_role(t["role"]), F.lit("|>"), escaped(t["text"]), F.lit(END))
        ).alias("parts"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.size("roles")),
        lambda i: (F.get("roles", i - 1) == ASSISTANT) | (i == F.size("roles")),
    )
    rows = parts.select("*", F.posexplode(ends).alias("example", "end"))
    rows = rows.withColumn("text", F.array_join(F.slice("parts", F.lit(1), F.col("end")), ""))
    target = F.get("roles", F.col("end") - 1) == ASSISTANT
    length = F.when(target, F.char_length(F.get("texts", F.col("end") - 1))).otherwise(0)
    rows = rows.withColumn("loss_length", length)
    start = F.char_length("text") - len(END) - F.col("loss_length")
    return rows.select("conv_id", "example", "text", start.alias("loss_start"), "loss_length")


def turns_of(text: Column) -> Column:
    """The turns (role, text) of an example, read back from its text."""
    parts = F.filter(F.split(text, END), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescaped(
                F.replace(F.substring_index(F.substr(p, F.lit(3)), "|>", 1), F.lit("&gt;"), F.lit(">"))
            ).alias("role"),
            unescaped(F.substr(p, F.locate("|>", p) + 2)).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from them: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, examples."""
    loss = unescaped(F.substr("text", F.col("loss_start") + 1, F.col("loss_length")))
    rows = formatted.withColumn("loss", loss).groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
        F.count("*").alias("examples"),
    )
    turns = rows.withColumn("turns", turns_of(F.col("text"))).withColumn("loss", F.array_join("losses.loss", ""))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
        "examples",
    )
