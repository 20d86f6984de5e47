"""Chat formatting with the perspective rotated over the participants.

For each participant of a conversation the whole dialogue is rendered once, with that speaker as the
assistant and all others as users with their names; the mask marks what the assistant says, which is what a
model is trained on. System turns stay system turns and take no perspective.

The result has a row for each perspective and turn, with the place of the turn's text in the rendered
dialogue, so a conversation of any length is spread over many rows; ``dialogues`` joins them for those who want one
string. Everything is DataFrame expressions; no Python runs on the executors.

A turn is rendered as ``<|role|>`` or ``<|user:name|>``, a line break, the text, ``<|end|>`` and a line break.

Defined cases: a NULL or empty text is an empty turn; a NULL or blank role is the participant ``unknown``; a NULL
turn number comes first; turns that repeat are all rendered, in the order of (turn, role, text); a NULL
conv_id is a conversation like any other; a conversation with system turns only has no perspective and no rows; an
empty table gives an empty result; columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import keep, running_before

SYSTEM = "system"
UNNAMED = "unknown"
END_MARK = "<|end|>"
#: Turn numbers whose places one task works out.
TURN_BLOCK = 1024


def speaker(role: Column) -> Column:
    """The participant's name: the role, lower case and trimmed."""
    name = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    return F.when(name == "", F.lit(UNNAMED)).otherwise(name)


def header(name: Column, perspective: Column) -> Column:
    """What stands before a turn's text, for a reader with that perspective."""
    shown = F.when(name == SYSTEM, F.lit(SYSTEM)).when(name == perspective, F.lit("assistant")).otherwise(F.concat(F.lit("user:"), name))
    return F.concat(F.lit("<|"), shown, F.lit("|>\n"))


def rotate(turns: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """A row for each conversation, perspective and turn.

    Columns: conv_id, perspective, turn, position (from 0), role (as rendered), rendered, start (characters of
    the dialogue before it), mask_start and mask_end (the span of the dialogue to train on, the turn's end mark
    included; an empty span for what others say).
    """
    said = turns.select(
        F.col("conv_id"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("conv_id").isNull().alias("no_conv"),
        F.col("turn").cast("long").alias("turn"),
        speaker(F.col("role")).alias("name"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    people = said.where(F.col("name") != SYSTEM).select("conv", "no_conv", F.col("name").alias("perspective")).distinct()
    seen = keep(said.join(people, ["conv", "no_conv"]), "chat-turns")
    body = F.concat(header(F.col("name"), F.col("perspective")), F.col("text"), F.lit(END_MARK + "\n"))
    rendered = seen.select(
        "*",
        body.alias("rendered"),
        F.length(body).cast("long").alias("length"),
        F.coalesce(F.floor(F.col("turn") / block).cast("long"), F.lit(-(1 << 62))).alias("block"),
        F.lit(1).cast("long").alias("one"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("name"), F.col("text")]
    keys = ["conv", "no_conv", "perspective"]
    placed = running_before(rendered, keys, "block", order, "length", "start")
    placed = running_before(placed, keys, "block", order, "one", "position")
    own = F.col("name") == F.col("perspective")
    text_start = F.col("start") + F.length(header(F.col("name"), F.col("perspective")))
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "position",
        F.when(F.col("name") == SYSTEM, F.lit(SYSTEM)).when(own, F.lit("assistant")).otherwise(F.lit("user")).alias("role"),
        "rendered",
        "start",
        F.when(own, text_start).otherwise(F.col("start")).alias("mask_start"),
        F.when(own, text_start + F.length("text") + len(END_MARK)).otherwise(F.col("start")).cast("long").alias("mask_end"),
    )


def dialogues(rotated: DataFrame) -> DataFrame:
    """conv_id, perspective, rendered and masks: one string for each, for conversations that fit into a row."""
    part = F.struct("position", "rendered", "mask_start", "mask_end")
    joined = rotated.groupBy("conv_id", "perspective").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    spans = F.filter("parts", lambda x: x["mask_end"] > x["mask_start"])
    return joined.select(
        "conv_id",
        "perspective",
        F.concat_ws("", F.transform("parts", lambda x: x["rendered"])).alias("rendered"),
        F.transform(spans, lambda x: F.struct(x["mask_start"].alias("start"), x["mask_end"].alias("end"))).alias("masks"),
    )
