"""Multi-party chat formatting by perspective rotation, DataFrame functions only.

For every participant the dialogue is rendered once with that speaker as the assistant and all others as
named users; the mask marks the characters on which a model would be trained: the speaker's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT, SYSTEM, USER, NAME_END, END = "<|assistant|>\n", "<|system|>\n", "<|user name=", "|>\n", "<|end|>\n"
UNKNOWN = "unknown"
#: Turn numbers in a block. Longer dialogues are rendered block by block, so that no task gathers one without bound.
BLOCK_TURNS = 2048


def _plain(c: Column) -> Column:
    """Text that cannot forge a marker: ``<|`` and ``|>`` get a space inside."""
    return F.replace(F.replace(c, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def rotate(conversations: DataFrame, block_turns: int = BLOCK_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, block, speaker, n_turns, text, spans, n_loss_chars), a row for each participant and block.

    Participants are a conversation's distinct roles but ``system``, whose turns every perspective shows as
    system text. ``spans`` holds [start, end) character ranges of the speaker's turns, end marker included.
    A block has the turns whose number divided by ``block_turns`` is equal (null turns: block null); an
    ordinary dialogue is one block. Turns are ordered by number, then role, then text.

    A null role is the participant ``unknown``, a null text an empty one, a null conv_id a conversation. Rows
    that repeat a message in full (same turn, role, text) show once. A dialogue of system turns alone has no
    participant and so no row; an empty table gives an empty table. Other columns are ignored.
    """
    said = conversations.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("said"))
    blocks = (said.withColumn("block", F.floor(F.col("turn") / block_turns).cast("long"))
              .groupBy("conv_id", "block")  # sets combine before the shuffle, so repeated rows collapse in their own task
              .agg(F.array_sort(F.collect_set(F.struct("turn", "role", "said"))).alias("turns")))
    speakers = (said.where(F.col("role") != "system").select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker"))
                .distinct())
    seen = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def head(m: Column) -> Column:
        return (F.when(m["role"] == F.col("speaker"), ASSISTANT).when(m["role"] == "system", SYSTEM)
                .otherwise(F.concat(F.lit(USER), _plain(m["role"]), F.lit(NAME_END))))

    parts = F.transform("turns", lambda m: F.struct(
        head(m).alias("head"), F.concat(_plain(m["said"]), F.lit(END)).alias("body"),
        (m["role"] == F.col("speaker")).alias("own")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return (seen.withColumn("parts", parts)
            .select("conv_id", "block", "speaker", F.size("turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
                    F.aggregate("parts", start, step)["spans"].alias("spans"))
            .withColumn("n_loss_chars", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])))
