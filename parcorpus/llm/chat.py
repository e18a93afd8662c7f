"""Operator 4: chat formatting by perspective rotation.

Every participant of a conversation gets the whole dialogue rendered with that
participant as the assistant and the others as named users; the mask marks the
participant's own turns as the part to learn.

A dialogue is rendered in segments of ``SEGMENT_TURNS`` turns, so no task ever
holds more turns than that of one conversation; ``start_char`` is the segment's
place in the whole dialogue, and joining the segments in order gives the text.

Defined results: turns are ordered by (turn, speaker, text), nulls first, so
ties and repeated rows have a fixed place. A null conversation id is one
conversation. A null text is empty. A null speaker is shown as ``unknown`` and
is no participant; system turns stay system turns for everybody. A
conversation without a participant gives no row. Marks of the format inside a
text are broken up by a space, so a text cannot forge a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcorpus.llm.common import numbered

SEGMENT_TURNS = 128
SYSTEM = "system"
END = "<|end|>\n"


def _piece(turn: Column, perspective: Column) -> Column:
    """head (not learnt), body, and whether the body is learnt."""
    own = F.coalesce(turn["speaker"] == perspective, F.lit(False))
    name = F.coalesce(turn["speaker"], F.lit("unknown"))
    head = F.when(turn["speaker"] == SYSTEM, F.lit("<|system|>\n")).when(
        own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user|>\n"), name, F.lit(": ")))
    body = F.concat(turn["text"], F.lit(END))
    return F.struct(head.alias("head"), body.alias("body"), own.alias("own"))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role",
           text: str = "text") -> DataFrame:
    """(conv, perspective, segment, n_turns, start_char, text, mask_spans).

    ``mask_spans`` are [start, end) character spans in the segment's text."""
    t = turns.select(
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(speaker).alias("speaker"),
        F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    rows = numbered(t, ["_conv", "_turn", "speaker", "text"], "chat-turns")
    first = rows.groupBy(F.col("_conv").alias("_c")).agg(F.min("_rn").alias("_first"))
    segments = rows.join(first, F.col("_conv").eqNullSafe(F.col("_c"))).withColumn(
        "_k", F.col("_rn") - F.col("_first")).groupBy(
        "_conv", F.expr(f"_k div {SEGMENT_TURNS}").alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("_k", "speaker", "text"))).alias("_turns"))
    people = rows.where(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM)).groupBy(
        F.col("_conv").alias("_c"), F.col("speaker").alias("perspective")).agg(F.lit(1).alias("_one"))
    pieces = segments.join(people, F.col("_conv").eqNullSafe(F.col("_c"))).select(
        "_conv", "perspective", "segment",
        F.transform("_turns", lambda x: _piece(x, F.col("perspective"))).alias("_p"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a, p):
        start = a["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        here = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            p["own"], F.concat(a["spans"], F.array(here))).otherwise(a["spans"]).alias("spans"))

    out = pieces.select(
        "_conv", "perspective", "segment", F.size("_p").alias("n_turns"),
        F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        F.aggregate("_p", zero, step, lambda a: a["spans"]).alias("mask_spans"))
    # one row per segment and perspective: a conversation of n turns has n / SEGMENT_TURNS rows here
    before = Window.partitionBy("_conv", "perspective").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("long")).over(before), F.lit(0))
    return out.select(F.col("_conv").alias(conv), "perspective", "segment", "n_turns",
                      start.alias("start_char"), "text", "mask_spans")
