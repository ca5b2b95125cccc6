"""Conversations as one training string each, with the spans that carry loss.

Rows of a conversation are collected as structs and sorted by turn (then role, then text);
adjacent turns of one role become one block by array functions: a turn opens a block where its role
differs from the one before, blocks are slices between openings, and places in the string are running
sums, so that long conversations take little more than linear time. The string is built by
array functions and `concat` only. A text keeps its own place in a block, so the output can be
read back turn by turn.

Marks: `<|turn|>` role `<|body|>` text (`<|next|>` text)* `<|end|>`. In roles and texts every
backslash is doubled and every control string (the marks and those in `ChatTemplate.controls`)
gets one backslash after its first character, so no control string is left in them and
`unescape` restores the original.

Cases: a null text or role is empty; a null turn sorts first; rows with a null conversation id
form one conversation; repeated rows are repeated turns; rows of equal turn are ordered by role
and text; an empty table gives an empty result. Other columns are ignored, whatever their names.
A conversation is one string, so it must fit into one row; nothing else is gathered.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1024  # characters
TURN, BODY, NEXT, END = "<|turn|>", "<|body|>", "<|next|>", "<|end|>"


@dataclass(frozen=True)
class ChatTemplate:
    """Strings that must not survive inside texts, besides the four marks, and the role with loss."""

    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_role: str = "assistant"

    @property
    def pattern(self) -> str:
        """The first character of any control string, by what follows it."""
        heads: dict[str, list[str]] = {}
        for text in (TURN, BODY, NEXT, END, *self.controls):
            if len(text) < 2 or "\\" in text:
                raise ValueError("a control string has two characters or more and no backslash")
            heads.setdefault(text[0], []).append(re.escape(text[1:]))
        options = [f"{re.escape(head)}(?={'|'.join(tails)})" for head, tails in heads.items()]
        return "(" + "|".join(options) + ")"

    def escape(self, text: Column) -> Column:
        doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
        return F.regexp_replace(doubled, self.pattern, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running_sums(values: Column) -> Column:
    """Sums of all prefixes of an int array, in about n^1.5 steps: chunks of sqrt(n) values."""

    def chunked(x: Column, width: Column) -> Column:
        n_chunks = F.ceil(F.size(x) / width).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda k: F.slice(x, k * width + 1, width))
        return _let(chunks, lambda c: _let(F.transform(c, _sum), lambda sums: F.flatten(
            F.transform(c, lambda chunk, k: _let(_sum(F.slice(sums, F.lit(1), k)), lambda base: F.transform(
                chunk, lambda _, i: base + _sum(F.slice(chunk, F.lit(1), i + 1))))))))

    width = lambda x: F.ceil(F.sqrt(F.size(x))).cast("int")
    return _let(values, lambda x: _let(width(x), lambda w: chunked(x, w)))


def format_conversations(df: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: conv_id, blocks, formatted, loss_spans (start, end in characters)."""
    template = template or ChatTemplate()
    turns = df.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            template.escape(F.col("role")).alias("role"),
            template.escape(F.col("text")).alias("text"),
        ).alias("_t"),
    )
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_turns"))
    # Each turn with whether it opens a block, and the characters between the text before and its own.
    before = lambda i: F.get("_turns", i - 1)
    fresh = lambda t, i: (i == 0) | ~before(i)["role"].eqNullSafe(t["role"])
    opening = lambda t, i: F.when(i > 0, len(END)).otherwise(0) + len(TURN) + F.length(t["role"]) + len(BODY)
    marked = F.transform(
        "_turns",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            t["text"].alias("text"),
            fresh(t, i).alias("opens"),
            F.when(fresh(t, i), opening(t, i)).otherwise(len(NEXT)).alias("gap"),
        ),
    )
    rows = rows.select("conv_id", marked.alias("_turns"))
    places = F.transform("_turns", lambda t, i: F.when(t["opens"], i))
    ends = running_sums(F.transform("_turns", lambda t: t["gap"] + F.length(t["text"])))
    rows = rows.select("conv_id", "_turns", F.array_compact(places).alias("_starts"), ends.alias("_ends"))

    def block(start: Column, k: Column) -> Column:
        """The turns from one opening to the next, merged."""
        upto = F.coalesce(F.get("_starts", k + 1), F.size("_turns"))
        texts = F.transform(F.slice("_turns", start + 1, upto - start), lambda t: t["text"])
        return F.struct(F.get("_turns", start)["role"].alias("role"), texts.alias("texts"))

    rows = rows.select("conv_id", "_turns", "_ends", F.transform("_starts", block).alias("blocks"))
    spans = F.transform(
        "_turns",
        lambda t, i: F.when(
            t["role"] == template.loss_role,
            F.struct(
                (F.get("_ends", i) - F.length(t["text"])).alias("start"), F.get("_ends", i).alias("end")
            ),
        ),
    )
    return rows.select(
        "conv_id",
        "blocks",
        F.array_join(
            F.transform(
                "blocks",
                lambda b: F.concat(
                    F.lit(TURN), b["role"], F.lit(BODY), F.array_join(b["texts"], NEXT), F.lit(END)
                ),
            ),
            "",
        ).alias("formatted"),
        F.array_compact(spans).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, unescaped: array of (role, text)."""
    parts = F.split(formatted, re.escape(TURN), -1)
    blocks = F.slice(parts, F.lit(2), F.size(parts))

    def turns(block: Column) -> Column:
        parts = F.split(F.substring(block, F.lit(1), F.length(block) - len(END)), re.escape(BODY), 2)
        role = unescape(parts[0])
        return F.transform(
            F.split(parts[1], re.escape(NEXT), -1),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order.

    The string is cut into pieces first, since finding a character counts from the start of a string.
    """

    def text(pieces: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / PIECE).cast("int"), F.floor(s["end"] / PIECE).cast("int")
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return unescape(F.substring(near, s["start"] - first * PIECE + 1, s["end"] - s["start"]))

    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return _let(pieces, lambda p: F.transform(spans, lambda s: text(p, s)))
