"""Preparation of a stream of pairs, in append mode.

Parsing and filtering keep no state, so the batch operators apply unchanged.
Statistics, splits and first-n need the whole table and are batch only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions.tokens import Tokenizer
from pairloom.operators.prepare import prepare_for_dpo, prepare_for_sft
from pairloom.sources.writers import json_stream

PREPARE = {"sft": prepare_for_sft, "dpo": prepare_for_dpo}


def start_preparation(
    pairs: DataFrame,
    output: str,
    path: str,
    checkpoint: str,
    *,
    tokenizer: Tokenizer | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Start writing the `sft` or `dpo` table of a stream of pairs as JSON.

    With `available_now` the query ends once the present files are done;
    otherwise it goes on with new files until it is stopped. `options` go to
    the batch operator, for example `keep=["row_id"]` or `max_length=None`.
    """
    prepared = PREPARE[output](pairs, tokenizer, **options)
    writer = json_stream(prepared, path, checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
