"""Chat formatting with a grammar round trip, in DataFrame functions only.

A formatted conversation is a mode followed by its turns::

    conversation := mode turn*
    mode         := "<plain>" | "<escaped>"
    turn         := "<s>" role "\\n" text "</s>"

Texts go in as they are. The result is parsed again by a parser that knows the full grammar, in which a control string
is a token wherever it stands: where the turns do not come back the same, or a turn holds a control string, the
conversation is rendered once more in escaped mode, in which no control string is left in a role or text, and
which always comes back.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

PLAIN, ESCAPED = "<plain>", "<escaped>"
OPEN, CLOSE = "<s>", "</s>"

#: What a control string becomes inside a role or text. The backslash comes first when
#: escaping and last when reading back; after it, each backslash is followed by one of these letters.
ESCAPES = (("\\", "\\b"), (CLOSE, "\\e"), (OPEN, "\\s"), ("[INST]", "\\i"), ("[/INST]", "\\j"))
#: Roles end at a line break, so theirs are escaped too.
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))

TURN = "struct<role:string,text:string>"


def escape(value: Column, pairs=ESCAPES) -> Column:
    for raw, code in pairs:
        value = F.replace(value, F.lit(raw), F.lit(code))
    return value


def unescape(value: Column, pairs=ESCAPES) -> Column:
    for raw, code in reversed(pairs):
        value = F.replace(value, F.lit(code), F.lit(raw))
    return value


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def _render(turns: Column, escaped: bool) -> Column:
    def turn(t: Column) -> Column:
        role, text = (escape(t["role"], ROLE_ESCAPES), escape(t["text"])) if escaped else (t["role"], t["text"])
        return F.concat(_head(role), text, F.lit(CLOSE))

    return F.concat(F.lit(ESCAPED if escaped else PLAIN), F.array_join(F.transform(turns, turn), ""))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, by the grammar alone.

    Everything up to the first line break is the role, everything from there to the next
    closing mark the text. Text after the last closing mark is no turn.
    """
    escaped = F.startswith(formatted, F.lit(ESCAPED))
    body = F.when(escaped, F.substr(formatted, F.lit(len(ESCAPED) + 1))).otherwise(
        F.substr(formatted, F.lit(len(PLAIN) + 1))
    )
    # The closing mark has no character with a meaning in a pattern.
    parts = F.split(body, CLOSE)

    def turn(part: Column) -> Column:
        role = F.substr(F.substring_index(part, "\n", 1), F.lit(len(OPEN) + 1))
        text = F.substr(part, F.char_length(F.substring_index(part, "\n", 1)) + 2)
        return F.struct(
            F.when(escaped, unescape(role, ROLE_ESCAPES)).otherwise(role).alias("role"),
            F.when(escaped, unescape(text)).otherwise(text).alias("text"),
        )

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def _holds_control(turns: Column) -> Column:
    """Whether a role or text holds a control string; a backslash alone is none."""
    strings = [raw for raw, _ in ESCAPES[1:]]
    one = lambda t: reduce(or_, (F.contains(t[part], F.lit(raw)) for part in ("role", "text") for raw in strings))
    return F.exists(turns, one)


def format_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, escaped, turns, mask``.

    ``turns`` is what the parser reads back from ``formatted``; ``mask`` lists, for the turns of
    ``loss_role``, the number of the turn and the first character and end of its text in ``formatted``.

    Null roles and texts count as empty. Turns are ordered by number, nulls first, and equal numbers by role and
    text, so repeated rows stay, next to each other. Rows without a conversation id form one conversation.
    Other columns do not matter. A conversation is one value and must fit into memory.
    """
    own = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    plain_turns = F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    source = own.groupBy("conv_id").agg(sorted_turns.alias("all")).select("conv_id", plain_turns.alias("source"))
    first = source.withColumn("plain", _render(F.col("source"), False))
    same = F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False))
    chosen = first.withColumn("escaped", ~same | _holds_control(F.col("source"))).withColumn(
        "formatted", F.when(F.col("escaped"), _render(F.col("source"), True)).otherwise(F.col("plain"))
    )
    read = chosen.select("conv_id", "formatted", "escaped", "source", parse(F.col("formatted")).alias("turns"))
    checked = read.withColumn(
        "turns",
        F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(
            F.raise_error(F.lit("a conversation does not come back from its format"))
        ),
    )
    return checked.select("conv_id", "formatted", "escaped", "turns", _mask(loss_role).alias("mask"))


def _mask(loss_role: str) -> Column:
    """Where the texts of the loss role lie in ``formatted``."""
    mode = F.when(F.col("escaped"), len(ESCAPED)).otherwise(len(PLAIN))

    def sizes(t: Column) -> Column:
        role = F.when(F.col("escaped"), escape(t["role"], ROLE_ESCAPES)).otherwise(t["role"])
        text = F.when(F.col("escaped"), escape(t["text"])).otherwise(t["text"])
        return F.struct(
            F.char_length(_head(role)).alias("head"),
            F.char_length(text).alias("body"),
            (t["role"] == loss_role).alias("loss"),
        )

    empty = F.array().cast("array<struct<turn:int,start:int,end:int>>")
    start = F.struct(mode.alias("at"), F.lit(0).alias("turn"), empty.alias("mask"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + t["head"]
        span = F.struct(state["turn"].alias("turn"), begin.alias("start"), (begin + t["body"]).alias("end"))
        return F.struct(
            (begin + t["body"] + len(CLOSE)).alias("at"),
            (state["turn"] + 1).alias("turn"),
            F.when(t["loss"], F.concat(state["mask"], F.array(span))).otherwise(state["mask"]).alias("mask"),
        )

    return F.aggregate(F.transform("turns", sizes), start, step, lambda s: s["mask"])


def loss_text(formatted: Column, escaped: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, read from the formatted conversation."""
    piece = lambda m: F.substr(formatted, m["start"] + 1, m["end"] - m["start"])
    read = F.transform(mask, lambda m: F.when(escaped, unescape(piece(m))).otherwise(piece(m)))
    return F.array_join(read, "")


def report(formatted: DataFrame) -> DataFrame:
    """One row per conversation: counts and digests of what the formatted text holds."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = formatted.withColumn("loss", loss_text(F.col("formatted"), F.col("escaped"), F.col("mask")))
    return loss.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
