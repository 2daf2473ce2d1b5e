"""Chat formatting of typed content parts.

A conversation is a set of turns; a turn has a role and ordered parts of type text, image, audio or document. Every part
becomes its escaped text or a placeholder, the attachments behind placeholders are recorded with the number of tokens they
expand to, and a loss mask covers the text parts of the trained role. DataFrame functions only.

Turns are first joined in chunks of ``CHUNK`` turn numbers, so a long conversation is put together by many tasks; only the
finished chunks of a conversation meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 64

#: Code points of a block when spans are cut out of a conversation.
BLOCK = 1024

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

ATTACHED = ("image", "audio", "document")


@dataclass(frozen=True)
class Template:
    """Control strings, which all begin with the two characters ``<|``, and the token costs of attachments."""

    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>"
    trained_role: str = "assistant"
    patch: int = 28
    audio_rate: float = 12.5
    page_tokens: int = 256

    def __post_init__(self):
        for mark in (self.turn, self.body, self.end):
            if not (mark.startswith("<|") and len(mark) > 2 and "&" not in mark):
                raise ValueError(f"a control string begins with <| and has no &: {mark!r}")


def escape(text: Column) -> Column:
    """No control string can appear in the result; ``unescape`` restores every text."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_part(text: Column) -> Column:
    null = F.lit(None)
    return F.struct(
        F.lit("text").alias("type"),
        text.alias("text"),
        null.cast("string").alias("ref"),
        null.cast("int").alias("width"),
        null.cast("int").alias("height"),
        null.cast("double").alias("seconds"),
        null.cast("int").alias("pages"),
    )


def _tokens(part: Column, t: Template) -> Column:
    """Tokens an attachment expands to, at least one; unknown sizes count as one."""
    image = F.ceil(part["width"] / t.patch) * F.ceil(part["height"] / t.patch)
    audio = F.ceil(part["seconds"] * t.audio_rate)
    cost = (
        F.when(part["type"] == "image", image).when(part["type"] == "audio", audio).otherwise(part["pages"] * t.page_tokens)
    )
    return F.greatest(F.coalesce(cost.cast("bigint"), F.lit(1)), F.lit(1)).cast("bigint")


def _piece(part: Column) -> Column:
    marks = F.concat(F.lit("<|"), part["type"], F.lit("|>"))
    return F.when(part["type"].isin(*ATTACHED), marks).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def _visited(parts: Column) -> Column:
    """Text parts with their place inside the turn's body, in order: array of (start, length)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans"))

    def step(state, part):
        size = F.length(_piece(part)).cast("bigint")
        span = F.struct(state["at"].alias("start"), size.alias("length"))
        silent = F.coalesce(part["type"].isin(*ATTACHED), F.lit(False)) | (size == 0)
        return F.struct(
            (state["at"] + size).alias("at"),
            F.when(silent, state["spans"]).otherwise(F.concat(state["spans"], F.array(span))).alias("spans"),
        )

    return F.aggregate(parts, zero, step, lambda state: state["spans"])


def format_chat(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation from (conv_id, turn, role, parts).

    Result: conv_id, n_turns, formatted, loss (spans of code points, start from 0, and length), attachments (turn, type,
    ref, tokens; in order of their placeholders), attachment_tokens. Turns with one number are ordered by their formatted
    text; null numbers come first. Null roles and texts are empty, null parts are skipped, unknown types are text.
    Repeated rows are turns of their own; null conversation ids form one conversation; an empty table gives no rows.
    """
    t = template
    parts = F.filter(F.coalesce(F.col("parts"), F.expr(f"cast(array() as array<{PART}>)")), lambda p: p.isNotNull())
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    head = F.concat(F.lit(t.turn), escape(F.col("role")), F.lit(t.body))
    body = F.array_join(F.transform("parts", _piece), "")
    held = F.filter("parts", lambda p: p["type"].isin(*ATTACHED))
    rows = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62))).alias("chunk"),
        F.concat(head, body, F.lit(t.end)).alias("piece"),
        F.when(
            F.col("role") == t.trained_role,
            F.transform(
                _visited(F.col("parts")),
                lambda s: F.struct((s["start"] + F.length(head)).alias("start"), s["length"].alias("length")),
            ),
        ).alias("spans"),
        F.transform(
            held,
            lambda p: F.struct(
                F.col("turn").alias("turn"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p, t).alias("tokens")
            ),
        ).alias("attached"),
    )
    empty = F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")

    def placed(frame: DataFrame, order: Window) -> DataFrame:
        """Spans moved behind everything that comes before their row."""
        before = F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        moved = F.transform(
            F.coalesce("spans", empty), lambda s: F.struct((s["start"] + F.col("before")).alias("start"), s["length"].alias("length"))
        )
        return frame.withColumn("before", before).withColumn("spans", moved).withColumn("place", F.row_number().over(order))

    def joined(frame: DataFrame, *keys: str, turns_in: Column) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("place", "piece", "spans", "attached")))
        grouped = frame.groupBy(*keys).agg(ordered.alias("rows"), turns_in.alias("n_turns"))
        return grouped.select(
            *keys,
            "n_turns",
            F.array_join(F.col("rows.piece"), "").alias("piece"),
            F.flatten(F.col("rows.spans")).alias("spans"),
            F.flatten(F.col("rows.attached")).alias("attached"),
        )

    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "piece")
    chunks = joined(placed(rows, in_chunk), "conv_id", "chunk", turns_in=F.count(F.lit(1)))
    in_conversation = Window.partitionBy("conv_id").orderBy("chunk")
    whole = joined(placed(chunks, in_conversation), "conv_id", turns_in=F.sum("n_turns"))
    return whole.select(
        "conv_id",
        "n_turns",
        F.col("piece").alias("formatted"),
        F.col("spans").alias("loss"),
        F.col("attached").alias("attachments"),
        F.aggregate("attached", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def _literal(mark: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in mark)


def parsed_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation, read from the string alone: array of (role, text)."""
    t = template
    turns = F.filter(F.split(formatted, _literal(t.turn), -1), lambda x, i: i > 0)

    def turn(x):
        halves = F.split(x, _literal(t.body), -1)
        return F.struct(
            unescape(halves[0]).alias("role"), unescape(F.split(halves[1], _literal(t.end), -1)[0]).alias("text")
        )

    return F.transform(turns, turn)


def masked_text(formatted: Column, loss: Column) -> Column:
    """The text under a loss mask, unescaped, nothing between.

    The string is cut into blocks of code points once; a span only counts code points inside its own blocks.
    """

    def cut(blocks: Column) -> Column:
        def span(s: Column) -> Column:
            first, behind = F.floor(s["start"] / BLOCK), F.ceil((s["start"] + s["length"]) / BLOCK)
            near = F.array_join(F.slice(blocks, (first + 1).cast("int"), (behind - first).cast("int")), "")
            return unescape(F.substring(near, (s["start"] % BLOCK + 1).cast("int"), s["length"].cast("int")))

        return F.array_join(F.transform(loss, span), "")

    blocks = F.regexp_extract_all(formatted, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))
    return F.element_at(F.transform(F.array(blocks), cut), 1)
