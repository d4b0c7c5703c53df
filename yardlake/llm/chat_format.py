"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation becomes one text, turn after turn. Each assistant turn is an example of its own: the text up to and
with that reply is its prefix, and only the reply is trainable. As every example is a prefix of its conversation's text, an
example is that text, its end and the place of the reply; `texts` cuts the strings where they are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TARGET = "assistant"


def escaped(text: Column) -> Column:
    """No `<|` is left, and `&` only begins an escape."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def escaped_role(role: Column) -> Column:
    """A role is one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("&nl;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&nl;"), F.lit("\n")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def conversations(df: DataFrame) -> DataFrame:
    """conv_id, alone, formatted, replies: array of (start, end) of the text of each assistant turn, in order, from 0. alone: null, but for
    rows without a conv_id, which it tells apart.

    Rows go by turn, ties by role and text, null turns first. Null texts and roles are empty. A row without a conv_id is a
    conversation of its own, so that such rows are never gathered. Repeated rows stay. Other columns are ignored.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    rows = rows.withColumn("alone", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    turns = rows.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == TARGET).alias("target"),
            F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
        ),
    )
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + F.lit(len(CLOSE))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("replies"))

    def step(state: Column, p: Column) -> Column:
        first = state["at"] + F.length(p["head"])
        reply = F.struct(first.alias("start"), (first + F.length(p["body"])).alias("end"))
        return F.struct((state["at"] + size(p)).alias("at"), F.when(p["target"], F.concat(state["replies"], F.array(reply))).otherwise(state["replies"]).alias("replies"))

    return turns.select("conv_id", "alone", parts.alias("parts")).select(
        "conv_id",
        "alone",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("parts", start, step, lambda s: s["replies"]).alias("replies"),
    )


def expand(df: DataFrame) -> DataFrame:
    """conv_id, alone, example (from 0), formatted, end, loss_start, loss_end: one row per assistant turn; the example's text
    is the first `end` characters of formatted. Turns that no reply follows come as one last example with an empty
    mask, so that no turn is lost; a conversation without replies has only that."""
    whole = F.length("formatted")
    closed = F.transform("replies", lambda r: F.struct((r["end"] + F.lit(len(CLOSE))).alias("end"), r["start"].alias("loss_start"), r["end"].alias("loss_end")))
    done = F.coalesce(F.element_at(closed, F.when(F.size(closed) > 0, F.lit(-1)))["end"], F.lit(0))
    open_end = F.array(F.struct(whole.alias("end"), whole.alias("loss_start"), whole.alias("loss_end")))
    examples = F.when(done < whole, F.concat(closed, open_end)).otherwise(closed)
    return (
        conversations(df)
        .select("conv_id", "alone", "formatted", examples.alias("examples"))
        .select("conv_id", "alone", "formatted", F.posexplode("examples").alias("example", "e"))
        .select("conv_id", "alone", "example", "formatted", "e.end", "e.loss_start", "e.loss_end")
    )


def part(text: str | Column, start: Column | str, end: Column | str) -> Column:
    start, end = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    return F.substring(F.col(text) if isinstance(text, str) else text, start + 1, end - start)


def texts(examples: DataFrame) -> DataFrame:
    """conv_id, alone, example, text, loss_start, loss_end: the examples' own strings."""
    return examples.select("conv_id", "alone", "example", part("formatted", F.lit(0), "end").alias("text"), "loss_start", "loss_end")


def read_turns(text: Column) -> Column:
    """Array of (role, text) of a formatted text, unescaped."""
    marked = F.filter(F.split(text, OPEN.replace("|", r"\|"), -1), lambda _, i: i > 0)
    role = lambda t: F.substring_index(t, "\n", 1)
    return F.transform(
        marked,
        lambda t: F.struct(
            unescaped(role(t)).alias("role"),
            unescaped(F.substring(t, F.length(role(t)) + 2, F.length(t) - F.length(role(t)) - F.lit(1 + len(CLOSE)))).alias("text"),
        ),
    )
