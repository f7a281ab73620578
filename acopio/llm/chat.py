"""Chat logs to training text: events folded into messages, messages rendered, and read back.

An event log tells how each message came about: it was started, streamed in pieces, edited or
generated anew. Events are folded into the final messages, a conversation is rendered as one
text with its loss mask, and the text can be read back without loss. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of events. A start, an edit and a regeneration drop what was said before them.
START, DELTA, EDIT, REGENERATE = "start", "delta", "edit", "regenerate"
#: Control strings of the template: fixed values of a public instruction format.
BOS, EOS, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
#: The role whose texts are learned.
LEARNED = "assistant"

_CONTROL = r"<(?=/?s>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Text without control strings: a backslash follows the first sign of each, and backslashes are doubled."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, "$0\\\\")


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) from events (conv_id, message, seq, kind, role, text).

    ``message`` orders the messages of a conversation and ``seq`` the events of a message; both
    may be of any orderable type. The text of a message is what came in its last start, edit or
    regeneration and after it, in order; without one of these, all that came. The role is that
    of the last event that has one. Null texts add nothing, null roles tell nothing; a message
    without any has an empty text or role. Events that tie in ``seq`` follow each other by text;
    a repeated event counts each time. Null conversations, messages and places are values like
    others (nulls first). Other columns are not looked at; an empty log gives no rows.
    """
    message = Window.partitionBy("conv_id", "message")
    resets = F.col("kind").isin(START, EDIT, REGENERATE)
    # a struct is never null, so events without a place count too
    place = F.struct(F.col("seq").isNotNull(), "seq")
    known = events.select("conv_id", "message", place.alias("place"), resets.alias("resets"), "role", "text")
    last = known.withColumn("since", F.max(F.when(F.col("resets"), F.col("place"))).over(message))
    kept = F.col("since").isNull() | (F.col("place") >= F.col("since"))
    said = F.struct("place", (~F.coalesce("resets", F.lit(False))).alias("later"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = F.collect_list(F.when(kept, said))
    role = F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("place", "role")))
    folded = last.groupBy("conv_id", "message").agg(pieces.alias("pieces"), role.alias("role"))
    text = F.array_join(F.transform(F.array_sort("pieces"), lambda p: p["text"]), "")
    return folded.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) of messages (conv_id, message, role, text), one row per conversation.

    ``formatted`` is a begin mark, then for each message in order its marked role, its text and
    an end mark; control strings inside roles and texts are escaped. ``loss`` has the spans
    (start from 0, length, in code points of ``formatted``) of the texts of the learned role.
    Null roles and texts are empty; a null conversation is a conversation; messages that tie
    follow each other by role and text. Other columns are not looked at; no messages give no rows.
    A conversation is one row, so it must fit Spark's 2 GB per row: nothing is cut to make it fit.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = messages.select(
        "conv_id", F.struct("message", role.alias("role"), text.alias("text")).alias("at"), (role == LEARNED).alias("learned"),
        F.concat(F.lit(OPEN), escape(role), F.lit(CLOSE)).alias("head"), escape(text).alias("body"),
    )
    long = lambda c: F.length(c).cast("long")
    size = long("head") + long("body") + len(EOS)
    so_far = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("at"))
    placed = turns.select("conv_id", "learned", "head", "body", number.alias("number"), (F.sum(size).over(so_far) + len(BOS) - len(EOS)).alias("end"))
    span = F.struct((F.col("end") - long("body")).alias("start"), long("body").alias("length"))
    part = F.struct("number", F.concat("head", "body", F.lit(EOS)).alias("text"), F.when(F.col("learned"), span).alias("span"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.select(
        "conv_id",
        F.concat(F.lit(BOS), F.array_join(F.transform("parts", lambda p: p["text"]), "")).alias("formatted"),
        F.transform(F.filter("parts", lambda p: p["span"].isNotNull()), lambda p: p["span"]).alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """The messages of a rendered conversation, as an array of (role, text)."""
    marked = F.split(F.substring(formatted, len(BOS) + 1, 2**31 - 1), F.lit(EOS), F.lit(-1))
    pieces = F.transform(F.slice(marked, 1, F.size(marked) - 1), lambda m: F.split(m, r"\[/INST\]", 2))
    return F.transform(
        pieces, lambda p: F.struct(unescape(F.substring(p[0], len(OPEN) + 1, 2**31 - 1)).alias("role"), unescape(p[1]).alias("text"))
    )


def learned_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask of a rendered conversation, span after span."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
