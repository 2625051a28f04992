"""Conversations out of a table of turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text as T

# Turns joined per block, see `assemble_conversations`.
BLOCK_TURNS = 256


def _join_in_order(order: list[str], value: str) -> Column:
    items = F.sort_array(F.collect_list(F.struct(*order, value)))
    return F.array_join(F.transform(items, lambda x: x[value]), T.BLANK_LINE)


def assemble_conversations(turns: DataFrame) -> DataFrame:
    """`conv_id, chosen`: the user and assistant turns of each conversation, in order.

    `turns`: conv_id, turn, role, text. Turns of other roles, or without conversation,
    are left out: the text format would pass them off as replies. A null text drops its
    turn's line; turns of one number are ordered by role and text. Turns are first
    joined in blocks and then the blocks, so that the turns of one very long
    conversation are sorted and joined by many tasks. Both steps combine on the map side.
    """
    label = F.when(F.col("role") == "user", F.lit(T.HUMAN)).otherwise(F.lit(T.ASSISTANT))
    spoken = F.col("conv_id").isNotNull() & F.col("role").isin("user", "assistant")
    lines = turns.where(spoken).select(
        "conv_id",
        F.floor(F.col("turn") / BLOCK_TURNS).alias("block"),
        "turn",
        "role",
        F.concat(label, F.lit(" "), "text").alias("line"),
    )
    blocks = lines.groupBy("conv_id", "block").agg(
        _join_in_order(["turn", "role"], "line").alias("part")
    )
    whole = blocks.groupBy("conv_id").agg(_join_in_order(["block"], "part").alias("whole"))
    return whole.select("conv_id", F.concat(F.lit(T.BLANK_LINE), "whole").alias("chosen"))
