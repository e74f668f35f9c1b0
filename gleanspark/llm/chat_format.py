r"""Chat formatting with Spark expressions only (operator 10).

The turns of a conversation are collected as structs and sorted, adjacent turns of one
role are merged into one message by array functions, and the pieces are concatenated:

    <|im_start|>role\ntext<|im_sep|>text of the next turn<|im_end|>\n

A control string inside a text or a role gets one backslash after its first character
(``</s>`` becomes ``<\/s>``); strings that already look escaped get one more, so that
removing one backslash restores every text exactly. No escaped text can contain a
control string. Newlines of a role are escaped too, for a role ends at the first newline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of common chat templates, without their first character.
CONTROL = ("|im_start|>", "|im_sep|>", "|im_end|>", "|endoftext|>", "|startoftext|>",
           "s>", "/s>", "unk>", "INST]", "/INST]", "SYS>>", "/SYS>>")
_TAILS = "|".join("".join("\\" + c if c in "|[]/" else c for c in t) for t in CONTROL)
_ESC = rf"([<\[])(\\*+)(?={_TAILS})"
_UNESC = rf"([<\[])\\(\\*+)(?={_TAILS})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESC, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESC, "$1$2")


def _escape_role(role: Column) -> Column:
    """Also ``%`` and newline as ``%25`` and ``%0A``."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_chats(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``id_col, n_turns, n_messages, formatted, segments``.

    ``segments`` is the loss mask: an array of (text, loss) whose texts, concatenated, are
    ``formatted``; loss is true exactly on the texts of ``loss_role``, never on marks.

    Turns are sorted by ``turn_col``, nulls first; ties by role, then text; repeated rows
    are turns of their own. Null role and null text count as empty. A null conversation id
    is a conversation of its own. Other columns are ignored; an empty table gives an empty
    table. A conversation is one output row, so it has to fit into one (2 GB); the work
    per conversation is linear in its length.
    """
    turn = F.struct(F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chats = (df.select(F.col(id_col).alias("_id"), turn.alias("_t"))
             .groupBy("_id").agg(F.array_sort(F.collect_list("_t")).alias("_turns")))

    def opens(i: Column) -> Column:          # turn i starts a message
        before = F.element_at("_turns", F.greatest(i, F.lit(1)))       # turn i - 1, 1-based
        return (i == 0) | (before["role"] != F.element_at("_turns", i + 1)["role"])

    def pieces(t: Column, i: Column) -> Column:
        mark = F.when(opens(i), F.concat(F.when(i == 0, "").otherwise(F.lit(END + "\n")),
                                         F.lit(START), _escape_role(t["role"]), F.lit("\n"))
                      ).otherwise(F.lit(SEP))
        return F.array(F.struct(mark.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"),
                                (t["role"] == F.lit(loss_role)).alias("loss")))

    close = F.array(F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))
    shaped = chats.select(
        "_id", F.size("_turns").cast("long").alias("n_turns"),
        F.size(F.filter(F.transform("_turns", lambda t, i: opens(i)), lambda x: x))
        .cast("long").alias("n_messages"),
        F.concat(F.flatten(F.transform("_turns", pieces)), close).alias("segments"))
    return shaped.select(
        F.col("_id").alias(id_col), "n_turns", "n_messages",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    messages = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda m, i: i > 0)

    def turns(m: Column) -> Column:
        cut = F.locate("\n", m)
        role = _unescape_role(F.substring(m, F.lit(1), cut - 1))
        body = F.substring(m, cut + 1, F.length(m) - cut - F.lit(len(END) + 1))
        return F.transform(F.split(body, r"<\|im_sep\|>"),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
