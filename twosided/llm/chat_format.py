"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent turns of one role are merged into a run by an
array aggregation. Runs become one text:

* a user run is ``[INST]`` texts ``[/INST]``, an assistant run ``<s>`` texts ``</s>``;
* a run of another role is ``<role>`` role ``<sep>`` texts ``</role>``;
* texts of one run are joined by ``<sep>``.

A control string inside a text or role gets a backslash after its first character, and one that has backslashes there
gets one more, so every control string that is left marks a turn and :func:`read_back` gives the texts exactly.

Long conversations are formatted in two steps. Turns are first collected by conversation and slice of ``SLICE`` turn numbers,
and become pieces that are joined per conversation, so a task that collects turns holds at most a slice of them and what
meets for the last step are finished pieces, as large as the text that is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosided.llm.common import col, let

#: Turn numbers that are collected together.
SLICE = 256

# Control strings of the template: fixed values.
USER, USER_END, REPLY, REPLY_END = "[INST]", "[/INST]", "<s>", "</s>"
ROLE, ROLE_END, SEPARATOR = "<role>", "</role>", "<sep>"
_CONTROL = r"(\[)(\\*)(/?INST\])|(<)(\\*)(/?s>|/?role>|sep>)"
_ESCAPED = r"(\[)\\(\\*)(/?INST\])|(<)\\(\\*)(/?s>|/?role>|sep>)"
_CLOSING = r"\[/INST\]|</s>|</role>"


def escape(text: Column) -> Column:
    """``text`` without control strings; undone by :func:`unescape`."""
    return F.regexp_replace(text, _CONTROL, r"$1$4\\$2$5$3$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$4$2$5$3$6")


def _runs(turns: Column) -> Column:
    """Sorted turns as an array of runs ``(role, texts)``: a run ends where the next turn has another role."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    at = lambda i: F.get(turns, i)
    starts = F.filter(places, lambda i: (i == 0) | (at(i)["role"] != at(i - 1)["role"]))
    return let(starts, lambda starts: F.zip_with(
        starts, F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(turns))), lambda a, b: F.struct(
            at(a)["role"].alias("role"), F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts"))))


def _merged(left: Column, right: Column) -> Column:
    """Two arrays of runs as one; the last run of the first and the first of the second are merged if of one role."""
    last, first = F.element_at(left, -1), F.element_at(right, 1)
    joint = F.struct(last["role"].alias("role"), F.concat(last["texts"], first["texts"]).alias("texts"))
    return (
        F.when(F.size(left) == 0, right).when(last["role"] != first["role"], F.concat(left, right))
        .otherwise(F.concat(F.slice(left, 1, F.size(left) - 1), F.array(joint), F.slice(right, 2, F.size(right))))
    )


def _marked(run: Column) -> Column:
    """The pieces of a run ``(text, loss)``: marks, and escaped texts of which an assistant's are under the loss."""
    reply = run["role"] == "assistant"
    opening = F.when(run["role"] == "user", USER).when(reply, REPLY).otherwise(
        F.concat(F.lit(ROLE), escape(run["role"]), F.lit(SEPARATOR)))
    closing = F.when(run["role"] == "user", USER_END).when(reply, REPLY_END).otherwise(F.lit(ROLE_END))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    texts = F.flatten(F.transform(run["texts"], lambda text, i: F.array(
        piece(F.when(i == 0, opening).otherwise(F.lit(SEPARATOR)), F.lit(False)), piece(escape(text), reply))))
    return F.concat(texts, F.array(piece(closing, F.lit(False))))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, formatted, loss_mask)``: a row for each conversation.

    ``loss_mask`` covers ``formatted`` in order: ``(length, loss)``, lengths in code points. Each assistant text is a
    stretch of its own under the loss, marks and other texts are outside.
    Turns are ordered by turn number, role and text, null numbers first; a null text or role counts as empty and a null
    conversation as one. Repeated rows are turns of their own. No rows give no rows; other columns are not looked at.
    """
    rows = turns.select(
        col(conv).alias("conv"), F.floor(col(turn) / SLICE).alias("slice"),
        F.struct(col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                 F.coalesce(col(text), F.lit("")).alias("text")).alias("row"))
    pieces = rows.groupBy("conv", "slice").agg(let(F.array_sort(F.collect_list("row")), _runs).alias("runs"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("slice", "runs"))), lambda x: x["runs"])
    joined = lambda slices: F.when(F.size(slices) == 1, F.get(slices, F.lit(0))).otherwise(F.aggregate(slices, empty, _merged))
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")
    whole = pieces.groupBy("conv").agg(let(ordered, joined).alias("runs"))
    marked = whole.select("conv", let(F.flatten(F.transform("runs", _marked)), lambda pieces: F.struct(
        F.array_join(F.transform(pieces, lambda x: x["text"]), "").alias("formatted"),
        F.transform(pieces, lambda x: F.struct(F.char_length(x["text"]).alias("length"), x["loss"].alias("loss"))).alias("loss_mask"),
    )).alias("chat"))
    return marked.select("conv", "chat.formatted", "chat.loss_mask")


def turns_of(formatted: Column) -> Column:
    """The turns ``(role, text)`` that the marks of a formatted text tell, unescaped."""
    def turns(run: Column) -> Column:
        body = F.split(F.regexp_replace(run, r"^(?:\[INST\]|<s>|<role>)", ""), SEPARATOR)
        named = F.startswith(run, F.lit(ROLE))
        role = lambda parts: F.when(F.startswith(run, F.lit(USER)), "user").when(
            named, unescape(F.get(parts, F.lit(0)))).otherwise("assistant")
        return let(body, lambda parts: let(role(parts), lambda name: F.transform(
            F.when(named, F.slice(parts, 2, F.size(parts))).otherwise(parts),
            lambda x: F.struct(name.alias("role"), unescape(x).alias("text")))))

    return F.flatten(F.transform(F.filter(F.split(formatted, _CLOSING), lambda run: run != ""), turns))


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped and joined without anything between."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))
    read = F.aggregate(mask, start, lambda done, x: F.struct(
        (done["at"] + x["length"]).alias("at"),
        F.when(x["loss"], F.concat(done["text"], unescape(F.substr(formatted, done["at"], x["length"]))))
        .otherwise(done["text"]).alias("text")))
    return read["text"]
