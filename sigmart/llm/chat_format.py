"""Chat formatting with perspective rotation for conversations of several parties.

Every participant of a conversation becomes the assistant once: that speaker's turns are the ones to learn, all other
speakers are users with their names, and system turns stay what they are. The turns of a conversation are numbered by a
range exchange and running counts, and a rendering is cut by that number, so a conversation of any length, whatever its
turn numbers say, stays in bounded rows; joining its parts in order gives the whole rendering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigmart.llm.common import materialize
from sigmart.llm.merkle import positioned

PART_TURNS = 256
SYSTEM = "system"
OPEN, CLOSE, END = "<|", "|>\n", "\n<|end|>\n"


def _header(role: Column, perspective: Column) -> Column:
    name = F.when(role == SYSTEM, F.lit("system")).when(role == perspective, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), role))
    return F.concat(F.lit(OPEN), name, F.lit(CLOSE))


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, mask: one row per conversation, participant and part.

    ``mask`` lists start:stop of the assistant's words in code points of ``text``, stop exclusive, joined by commas. Turns are in
    order of turn, role, text, and numbered in it; every part holds ``part_turns`` of them, whatever their turn says, and the last
    one the rest. A null turn comes first; a null text is empty; a null role is the participant "unknown". Repeated rows are
    repeated turns. A conversation of system turns alone has no participant and no row; a turn without a conversation
    id is a conversation of its own. Other columns are ignored.
    """
    current = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    alone = current.where("conv_id IS NULL AND role != 'system'").select(
        "conv_id", F.lit(0).cast("long").alias("part"), F.array(F.struct(F.lit(0).cast("long").alias("pos"), "role", "text")).alias("turns"),
        F.col("role").alias("perspective"))
    current = materialize(current.where("conv_id IS NOT NULL"), "turns")
    placed = positioned(current, ["turn", "role", "text", "row"], ["conv_id"])[0].withColumn("part", F.expr(f"pos div {part_turns}"))
    speakers = current.where(F.col("role") != SYSTEM).groupBy("conv_id", "role").agg(F.lit(1).alias("one")).select(
        F.col("conv_id").alias("speaker_conv"), F.col("role").alias("perspective"))
    parts = placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    rendered = parts.join(speakers, F.col("conv_id") == F.col("speaker_conv")).drop("speaker_conv").unionByName(alone)
    pieces = F.transform("turns", lambda t: F.struct(
        _header(t["role"], F.col("perspective")).alias("head"), t["text"].alias("text"),
        (t["role"] == F.col("perspective")).alias("own")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("mask"))

    def add(seen: Column, piece: Column) -> Column:
        begin = seen["at"] + F.length(piece["head"])
        stop = begin + F.length(piece["text"])
        span = F.concat_ws(":", begin.cast("string"), stop.cast("string"))
        return F.struct((stop + len(END)).alias("at"), F.when(piece["own"], F.array_append(seen["mask"], span)).otherwise(
            seen["mask"]).alias("mask"))

    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    return rendered.withColumn("pieces", pieces).select(
        "conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"),
        F.array_join(F.aggregate("pieces", start, add, lambda seen: seen["mask"]), ",").alias("mask"))
