"""Conversations rebuilt from a log of events, formatted for training, and read back.

Only DataFrame operations. Events of a message (its start, streamed deltas, edits,
regenerations) are folded into its final text; the messages of a conversation are sorted
and rendered with markers. Control strings inside texts are escaped, so that no text can
look like a marker, and everything can be read back.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates and tokenizers take as control.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"


def _firsts(backslashes: str) -> str:
    """A pattern of the first letter of a control string, with so many backslashes behind it."""
    rest: dict[str, list[str]] = {}
    for control in CONTROL:
        rest.setdefault(control[0], []).append(re.escape(control[1:]))
    return "|".join(f"{re.escape(first)}(?={backslashes}(?:{'|'.join(r)}))" for first, r in rest.items())


def escape(text: Column) -> Column:
    """A backslash more behind the first letter of every control string, however many it has."""
    return F.regexp_replace(text, f"({_firsts(r'\\*')})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_firsts(r'\\+')})\\", "$1")


def _role(role: Column) -> Column:
    """A role as one line."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unrole(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, at, role, text): the final messages of a log of events.

    Events have conv_id, seq, kind, message, role and text. `message` is a whole message,
    each event its own. The other kinds build the message that `message` names: `start`
    begins it, `delta` adds text to it, `edit` gives it another text, and `regenerate`
    throws away its text and every message that came after it up to then; deltas after
    that make its new text. A message stands where its first event was, under its first
    role. Null texts add nothing, and events of other kinds are ignored. Events that share
    a seq apply in the order of kind and text.
    """
    order = F.struct("seq", F.when(F.col("kind") == "delta", 1).otherwise(0), "kind", "text")
    whole = events.where("kind = 'message'").select("conv_id", F.col("seq").alias("at"), "role", F.coalesce("text", F.lit("")).alias("text"))
    parts = events.where("kind in ('start', 'delta', 'edit', 'regenerate')").withColumn("order", order)
    sets = F.col("kind") != "delta"
    folded = parts.groupBy("conv_id", "message").agg(
        F.min("seq").alias("at"),
        F.min_by("role", F.when(F.col("role").isNotNull(), F.col("order"))).alias("role"),
        F.max(F.when(sets, F.col("order"))).alias("reset"),
        F.sort_array(F.collect_list("order")).alias("all"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "regenerate", F.col("seq")))).alias("again"),
    )
    live = F.filter("all", lambda e: F.col("reset").isNull() | (e >= F.col("reset")))
    texts = F.transform(live, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(F.coalesce(e["text"], F.lit(""))))
    built = folded.select("conv_id", "at", "role", F.array_join(texts, "").alias("text"))
    # A regeneration drops what lies between its message and itself: each message looks
    # at the latest cut of the messages before it.
    cuts = folded.where(F.size("again") > 0).select("conv_id", "at", F.element_at("again", -1).alias("cut"))
    every = whole.unionByName(built).withColumn("cut", F.lit(None).cast("long"))
    marks = cuts.select("conv_id", "at", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "cut")
    before = Window.partitionBy("conv_id").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    seen = every.unionByName(marks).withColumn("latest", F.max("cut").over(before))
    return seen.where("cut is null and (latest is null or at is null or at > latest)").select("conv_id", "at", "role", "text")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one row a conversation, of rows (conv_id, at, role, text).

    Turns stand in the order of `at`, then role, then text. `loss` has, for every turn of
    the assistant, the number of its turn (from 0), where its text starts in the turn and
    in the whole, and its length, all in code points. Null roles and texts count as empty,
    a null conv_id is a conversation like others, repeated rows are turns of their own,
    and no rows give no rows. A conversation is one value of one row, so it must fit there;
    the work grows with its length.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), _role(role), F.lit("\n"))
    pieces = turns.select(
        "conv_id", "at", role.alias("role"), text.alias("text"), F.length(head).alias("start"), F.concat(head, escape(text), F.lit(END + "\n")).alias("piece")
    )
    pieces = pieces.withColumn("size", F.length("piece"))
    order = Window.partitionBy("conv_id").orderBy("at", "role", "text")
    placed = pieces.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("turn"),
        "piece",
        (F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") + F.col("start")).alias("offset"),
        "start",
        (F.col("size") - F.col("start") - len(END) - 1).alias("length"),
        (F.col("role") == LEARNED).alias("learned"),
    )
    span = F.struct("turn", "start", "offset", "length")
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "piece"))), lambda p: p["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("learned"), span))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted_chars, turns, learned): how long formatted conversations are, the
    turns (role and text) that they hold and the texts under their loss, both unescaped."""
    cut = formatted.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        "loss",
        F.split("formatted", re.escape(END) + "\n").alias("pieces"),
    )
    # What stands behind the last marker is empty.
    cut = cut.withColumn("pieces", F.slice("pieces", 1, F.size("pieces") - 1))

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        role = F.substring(piece, F.lit(len(START) + 1), line - len(START) - 1)
        text = F.substring(piece, line + 1, F.length(piece))
        return F.struct(_unrole(role).alias("role"), unescape(text).alias("text"))

    def under(span: Column) -> Column:
        return unescape(F.substring(F.element_at("pieces", span["turn"] + 1), span["start"] + 1, span["length"]))

    return cut.select("conv_id", "formatted_chars", F.transform("pieces", turn).alias("turns"), F.transform("loss", under).alias("learned"))
