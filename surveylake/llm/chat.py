"""Chat formatting as relational expressions.

A conversation's turns are collected as structs and sorted; adjacent turns of
one role share a header (array expressions find where a role begins and ends),
and the pieces are concatenated.  Template of a merged turn::

    <turn>ROLE<turn:>TEXT<turn+>TEXT ...</turn>\\n

Escaping: a control string begins ``<turn`` or ``</turn``.  Where a role or text
holds such a string, with or without backslashes after the ``<``, one more
backslash is put there; reading takes one away.  All other text stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, NEXT, CLOSE = "<turn>", "<turn:>", "<turn+>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*/?turn)", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*/?turn)", "<$1")


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, segments): one row per conversation.

    ``segments`` (text, loss) concatenate to ``formatted``; loss is true for the
    escaped texts of ``loss_role`` and nothing else.  Rows go by turn, then role
    and text, so repeated turn numbers have a defined order and repeated rows
    stay; a null turn comes first.  A null text or role is empty.  Rows of a
    null conv_id are one conversation.  No rows, no conversations; other
    columns are not read.  A conversation is one training example, hence one
    output cell; nothing else is gathered.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                    F.coalesce(text_col, F.lit("")).alias("text"))
    turns = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    roles = turns.withColumn("roles", F.transform("turns", lambda t: t.role))

    def pieces(t: Column, i: Column) -> Column:
        begins = (i == 0) | (F.get("roles", i - 1) != t.role)
        ends = (i == F.size("roles") - 1) | (F.get("roles", i + 1) != t.role)
        head = F.when(begins, F.concat(F.lit(OPEN), escape(t.role), F.lit(HEAD))).otherwise(NEXT)
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(head, F.lit(False)), part(escape(t.text), t.role == loss_role),
                       part(F.when(ends, CLOSE).otherwise(""), F.lit(False)))

    segments = F.filter(F.flatten(F.transform("turns", pieces)), lambda s: s.text != "")
    return (roles.select("conv_id", segments.alias("segments"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"), "segments"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, unmerged."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, F.lit(len(OPEN) + 1), F.length(b)), HEAD, 2))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(p[1], r"<turn\+>"),
        lambda text: F.struct(unescape(p[0]).alias("role"), unescape(text).alias("text")))))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: unescape(s.text)), "")
