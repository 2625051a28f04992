"""Pairs whose two sides do not share their prompt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text as T
from pairloom.functions.binding import bind_columns
from pairloom.operators.prepare import key_columns, non_null


def prompt_mismatch(
    pairs: DataFrame, *, keep: Sequence[str] | None = None, on_null: str = "fail"
) -> DataFrame:
    """Keys, `turn` and both messages there, of each pair whose prompts differ.

    Preference pairs take the prompt of `chosen` for both sides. Here the messages
    before the last reply of each side are compared: `turn` is the number, from 1, of the first that
    differs, after turn - 1 equal ones. A side that has no such message has null role
    and content. Pairs with equal prompts are left out; each side is parsed once.
    """
    keys = key_columns(pairs, keep)
    pairs, sides = non_null(pairs, ["chosen", "rejected"], on_null)
    left, right = [T.prompt_messages(T.parse_conversation(side)) for side in sides]
    parsed = bind_columns(pairs, keys, left=left, right=right)
    # The shorter side is filled up with nulls, which equal no message.
    equal = F.zip_with("left", "right", lambda a, b: a.eqNullSafe(b))
    found = bind_columns(parsed, [*keys, "left", "right"], turn=F.array_position(equal, False))
    place = (F.col("turn") - 1).cast("int")
    at = {name: F.get(name, place) for name in ("left", "right")}
    return found.where("turn > 0").select(
        *keys,
        F.col("turn").cast("bigint").alias("turn"),
        at["left"]["role"].alias("chosen_role"),
        at["left"]["content"].alias("chosen_content"),
        at["right"]["role"].alias("rejected_role"),
        at["right"]["content"].alias("rejected_content"),
    )
