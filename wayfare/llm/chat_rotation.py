"""Dialogues from the perspective of each participant.

For every participant the dialogue is written with that speaker as the assistant and the others as users
with their names; a mask marks what the assistant says. A dialogue is written in parts of ``PART`` messages,
each with the place in the whole dialogue where it begins, so that a dialogue of any length stays in rows of
bounded size; parts in order are the dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.operators.ordered import running, running_count
from wayfare.session import written

PART = 256
SYSTEM = "system"
NO_NAME = "unknown"
END = "<|end|>\n"


def _head(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == SYSTEM, F.lit("<|system|>\n"))
        .when(role == speaker, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))
    )


def _spans(pieces: Column) -> Column:
    """(start, end) of what is learned, in characters from the start of the part."""
    zero = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    )

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["head"])
        end = start + F.length(piece["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            F.when(piece["learned"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, zero, step, lambda done: done["spans"])


def perspectives(messages: DataFrame, part_messages: int = PART) -> DataFrame:
    """(conv_id, speaker, part, start, text, spans) from ``messages`` (conv_id, turn, role, text).

    Participants are the roles of a conversation but ``system``, whose messages all perspectives keep; a
    conversation without participants has no row. Messages follow turn, then role and text, nulls first;
    repeated rows stay. A null role is a participant named ``unknown``, a null text is empty, and messages
    with a null conv_id are one conversation. start is the place of a part in the whole dialogue, and spans
    are relative to the part; both count characters. An empty table gives no rows. Other columns are not
    looked at.
    """
    known = messages.select(
        F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(NO_NAME)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    conversation = ["no_conv", "conv"]
    placed = running(known, conversation, ["turn", "role", "text"], {"place": running_count()})
    parts = written(placed.withColumn("part", F.floor((F.col("place") - 1) / part_messages)).groupBy(
        *conversation, "part"
    ).agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("messages")), "parts")
    speakers = known.filter(F.col("role") != SYSTEM).select(*conversation, F.col("role").alias("speaker")).distinct()

    def piece(message: Column) -> Column:
        return F.struct(
            _head(message["role"], F.col("speaker")).alias("head"),
            F.concat(message["text"], F.lit(END)).alias("body"),
            ((message["role"] == F.col("speaker")) & (message["role"] != SYSTEM)).alias("learned"),
        )

    # the window has lengths only, as all parts of a conversation and speaker are one task there
    said = parts.select(*conversation, "part", F.transform("messages", lambda m: F.struct(
        m["role"].alias("role"), (F.length(m["text"]) + len(END)).cast("long").alias("n")
    )).alias("said"))
    length = F.aggregate("said", F.lit(0).cast("long"), lambda n, m: (
        n + F.length(_head(m["role"], F.col("speaker"))) + m["n"]
    ))
    before = W.partitionBy(*conversation, "speaker").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = said.join(speakers, conversation).select(*conversation, "speaker", "part", length.alias("n")).select(
        *conversation, "speaker", "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("start")
    )
    return parts.join(starts, [*conversation, "part"]).select(
        *conversation, "speaker", "part", "start", F.transform("messages", piece).alias("pieces")
    ).select(
        F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), "speaker", "part", "start",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        _spans(F.col("pieces")).alias("spans"),
    )
