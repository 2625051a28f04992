"""Seeded train and validation split of exact size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators import selection
from pairloom.sources.rows import settled

TRAIN, VALIDATION = "train", "validation"


def _shuffled_key(key: str, seed: int) -> Column:
    """Seeded pseudo-random order of a unique key; the key itself breaks ties."""
    number = F.col(key).cast("bigint")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), number.cast("string")).cast("binary"))
    return F.concat(digest, selection.ordered_hex(number))


def _held_out(rows: int, val_size: float | int) -> int:
    if isinstance(val_size, int):
        held_out = val_size
    else:
        held_out = math.ceil(rows * val_size) if 0 < val_size < 1 else 0
    if not 0 < held_out < rows:
        raise ValueError(f"cannot hold out {val_size} of {rows} rows")
    return held_out


def with_split(
    df: DataFrame,
    val_size: float | int = 0.05,
    seed: int = 42,
    *,
    key: str = "row_id",
    direct: int = selection.DIRECT,
) -> DataFrame:
    """Add `split`; validation gets `ceil(rows * val_size)` rows.

    `key` must be unique. It alone is hashed, so the assignment does not depend
    on partitioning or file layout. Only a table of keys is read to find the
    border; the rows are labelled by a comparison and are never moved. `df` is
    evaluated once for its keys and once for the result, so split a written
    table where preparation is dear. Ids that a text scan numbers at each read are
    written once with their rows, and that table is split.
    """
    df = settled(df, key)
    order = _shuffled_key(key, seed)
    keys = selection.written_keys(df.select(order.alias("k")))
    border = selection.nth_smallest(keys, _held_out(keys.count(), val_size), direct)
    return df.withColumn(
        "split", F.when(order <= F.lit(border), F.lit(VALIDATION)).otherwise(F.lit(TRAIN))
    )


def create_train_val_split(
    df: DataFrame,
    val_size: float | int = 0.05,
    seed: int = 42,
    *,
    key: str = "row_id",
    direct: int = selection.DIRECT,
) -> dict[str, DataFrame]:
    """The two sides as separate tables, keyed `train` and `validation`."""
    labelled = with_split(df, val_size, seed, key=key, direct=direct)
    return {
        name: labelled.where(F.col("split") == name).drop("split") for name in (TRAIN, VALIDATION)
    }


def with_hash_split(
    df: DataFrame, val_size: float = 0.05, seed: int = 42, *, key: str = "row_id"
) -> DataFrame:
    """Add `split` by a threshold on a seeded hash of `key`, row by row.

    About `val_size` of all keys go to validation. A row's side depends on its key and
    the seed alone: rows that are added later move none, and streams can be split. Equal
    keys share a side; a null key is for training.
    """
    if not 0 < val_size < 1:
        raise ValueError(f"val_size must lie between 0 and 1, not {val_size}")
    # The first eight digits of the hash, as a number below 2 ** 32, in text order.
    border = f"{math.floor(val_size * 2**32):08x}"
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    held_out = F.substring(digest, 1, 8) < F.lit(border)
    return df.withColumn("split", F.when(held_out, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)))
