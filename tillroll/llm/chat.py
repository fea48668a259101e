r"""Conversations as training text, with a loss mask, proven by reading them back.

A turn is rendered as `### role: text`, a new line, `</turn>` and a new line. Those two marks
are the control strings of the grammar. A deterministic parser takes a backslash off any
control string inside a text and knows no other escape; a bare one inside a text is an error.
Each text is first rendered as it is and parsed again. Where that fails or gives another text,
one backslash goes before each of its control strings (one more, if some are there already),
and the result is identical. Roles are percent-encoded.

The formatted conversation is parsed once more as a whole, and `round_trip` says whether the
turns are those of the source. The loss mask lists the texts of assistant turns as spans of
code points in the formatted text.

Everything is built-in columns. Texts are escaped before the shuffle; one conversation is one
string, so its rows meet in one task, and nothing larger does.

Null texts and roles count as empty. Rows of one turn number are ordered by their rendered
text; equal rows all stay. Rows without a conversation id form one conversation. Turns without
a number come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CONTROL = r"### [A-Za-z0-9.*_%+-]*: |</turn>"
_END = "\n</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({_CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({_CONTROL})", "$1")


def _header(role: Column) -> Column:
    return F.concat(F.lit("### "), F.url_encode(role), F.lit(": "))


def parse_turn(turn: Column) -> Column:
    """(role, text) of one turn without its end mark; null where it breaks the grammar."""
    colon = F.locate(": ", turn)
    body = F.substr(turn, colon + F.lit(2))
    role = F.url_decode(F.substr(turn, F.lit(5), colon - F.lit(5)))
    bare = body.rlike(rf"(?<!\\)(?:{_CONTROL})")
    good = turn.startswith("### ") & (colon > 0) & ~bare
    return F.when(good, F.struct(role.alias("role"), unescape(body).alias("text")))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    pieces = F.split(formatted, _END)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), parse_turn)


def format_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", learn_role: str = "assistant",
) -> DataFrame:
    """Per conversation: conv, formatted, mask (array of start and length, from 0), n_turns
    and round_trip."""
    source = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    plain = F.split(F.concat(_header(F.col("role")), "text", F.lit(_END)), _END)
    again = F.when(F.size(plain) == 2, parse_turn(plain[0])["text"])
    fits = F.coalesce(again == F.col("text"), F.lit(False))
    turns = (
        source.withColumn("head", _header(F.col("role")))
        .withColumn("body", F.when(fits, F.col("text")).otherwise(escape(F.col("text"))))
        .withColumn("size", F.char_length("head") + F.char_length("body") + len(_END))
    )
    above = (
        Window.partitionBy("conv")
        .orderBy("turn", "head", "body")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = turns.withColumn("at", F.coalesce(F.sum("size").over(above), F.lit(0)))
    whole = placed.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("at", "head", "body", "role", "text"))).alias("its")
    )
    learned = F.transform(
        F.filter("its", lambda t: t["role"] == learn_role),
        lambda t: F.struct(
            (t["at"] + F.char_length(t["head"])).alias("start"),
            F.char_length(t["body"]).alias("length"),
        ),
    )
    formatted = F.array_join(F.transform("its", lambda t: F.concat(t["head"], t["body"], F.lit(_END))), "")
    done = whole.withColumn("formatted", formatted)
    return done.select(
        F.col("conv").alias(conv),
        "formatted",
        learned.alias("mask"),
        F.size("its").cast("long").alias("n_turns"),
        F.coalesce(
            parse(F.col("formatted"))
            == F.transform("its", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))),
            F.lit(False),
        ).alias("round_trip"),
    )


def masked_text(formatted: str = "formatted", mask: str = "mask") -> Column:
    """The texts under the loss mask, unescaped, one after the other."""
    parts = F.transform(
        mask,
        lambda m: unescape(
            F.substr(F.col(formatted), (m["start"] + 1).cast("int"), m["length"].cast("int"))
        ),
    )
    return F.array_join(parts, "")
