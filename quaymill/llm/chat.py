"""Chat formatting: every assistant turn becomes an example of its own.

Prefix-target expansion. An example is the conversation up to and including one assistant turn;
only that turn's text is trainable. A conversation that does not end with an assistant turn also
gives one example without a trainable part, which holds the whole conversation, so nothing is lost.

A turn is written ``<turn>role<says>text</turn>``. Within roles and texts a backslash becomes two,
and the three marks get a backslash after their ``<``; removing each backslash that precedes a
character restores them, so no text can forge a turn.

Everything is a SQL function. A conversation must fit in a row, as its examples do; examples are
made one at a time, never as an array of all prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for mark in (OPEN, SAYS, CLOSE):
        out = F.replace(out, F.lit(mark), F.lit(f"<\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order, formatted, and where assistant turns are."""
    turn = F.struct(
        F.col("turn").isNull().alias("no_turn"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    heads = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(SAYS)))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    trained = F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, i + 1))
    return grouped.select(
        "conv_id",
        heads.alias("heads"),
        bodies.alias("bodies"),
        F.filter(trained, lambda i: i.isNotNull()).alias("trained"),
        F.size("turns").alias("n"),
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, last, formatted, loss_start, loss_end.

    ``formatted`` from code point ``loss_start`` up to ``loss_end`` is trainable (both equal where
    nothing is). ``last`` marks the example with all turns. Turns are ordered by number, null
    last, ties by role and text; repeated rows are repeated turns. Null roles and texts are empty;
    a null conv_id is a conversation of its own. An empty table gives no rows. Columns other than
    conv_id, turn, role and text are not read.
    """
    turns = _turns(conversations)
    ends = F.when(
        F.try_element_at("trained", F.lit(-1)) == F.col("n"), F.col("trained")
    ).otherwise(F.concat("trained", F.array("n")))
    examples = turns.select("conv_id", "heads", "bodies", "trained", "n", F.posexplode(ends).alias("example", "end"))
    whole = F.zip_with(
        F.slice("heads", 1, F.col("end")),
        F.slice("bodies", 1, F.col("end")),
        lambda head, body: F.concat(head, body, F.lit(CLOSE)),
    )
    body = F.length(F.element_at("bodies", F.col("end")))
    formatted = examples.select(
        "conv_id",
        "example",
        (F.col("end") == F.col("n")).alias("last"),
        F.array_join(whole, "").alias("formatted"),
        F.when(F.col("example") < F.size("trained"), body).otherwise(0).alias("trainable"),
    )
    stop = F.length("formatted") - len(CLOSE)
    return formatted.select(
        "conv_id",
        "example",
        "last",
        "formatted",
        (stop - F.col("trainable")).cast("long").alias("loss_start"),
        stop.cast("long").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted text holds."""
    pieces = F.split(formatted, CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        parts = F.split(F.substr(piece, F.lit(len(OPEN) + 1)), SAYS, 2)
        return F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(pieces, turn)


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation what its formatted examples hold, read back from them."""
    read = read_turns(F.col("formatted"))
    told = F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    per_example = examples.select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("last"), F.struct(
            F.size(read).cast("long").alias("n_turns"),
            F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        )).alias("whole"),
        unescape(trained).alias("reply"),
    )
    replies = F.sort_array(F.collect_list(F.struct("example", "reply")))
    loss = F.array_join(F.col("replies.reply"), "")
    grouped = per_example.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), replies.alias("replies"), F.sum("chars").alias("formatted_chars")
    )
    return grouped.select(
        "conv_id",
        "whole.n_turns",
        "whole.turns_sha256",
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
