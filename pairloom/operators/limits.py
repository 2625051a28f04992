"""The first rows of a table, in row order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators import selection
from pairloom.sources.rows import settled

# Raw rows tried first when looking for the first few prepared rows.
PREVIEW_START = 1_000


def _up_to(df: DataFrame, n: int, key: str, direct: int) -> Column:
    if n < 0:
        raise ValueError("the number of rows cannot be negative")
    if n == 0:
        return F.lit(False)
    keys = df.select(selection.ordered_hex(F.col(key)).alias("k"))
    if n > direct:
        keys = selection.written_keys(keys)
    last = selection.nth_smallest(keys, n, direct)
    return F.lit(False) if last is None else F.col(key) <= selection.from_ordered_hex(last)


def first_rows(
    df: DataFrame,
    n: int,
    *,
    key: str = "row_id",
    splits: Sequence[str] | None = None,
    direct: int = selection.DIRECT,
) -> DataFrame:
    """The `min(n, size)` rows of smallest `key`, or as many of each split.

    `key` must be unique (within a split). The result is a plain filter on
    `key`: rows are not moved, and a columnar scan skips what is beyond it. Ids that a
    text scan numbers at each read are written once with their rows first.
    """
    df = settled(df, key)
    if splits is None:
        return df.where(_up_to(df, n, key, direct))
    kept = F.lit(False)
    for name in splits:
        of_split = F.col("split") == name
        kept |= of_split & _up_to(df.where(of_split), n, key, direct)
    return df.where(kept)


def first_prepared(
    first: Callable[[int], DataFrame],
    prepare: Callable[[DataFrame], DataFrame],
    n: int,
    *,
    key: str = "row_id",
    most: int | None = None,
    start: int = PREVIEW_START,
) -> DataFrame:
    """The first n prepared rows, looking at ever longer starts of the raw table.

    `first(k)` gives the first k raw rows, as `first_rows` does. Preparation works row by
    row, so the first n rows of a prepared start are the first n of the whole unless
    the start yields fewer; then one a thousand times as long is tried. Only raw keys
    are ranked, so no row beyond the start is parsed. n is for looking at: the rows come to
    the driver. `most` limits the raw table.
    """
    size = max(n, start)
    while True:
        if most is not None:
            size = min(size, most)
        raw = first(size)
        rows = prepare(raw).orderBy(key).limit(n)
        found = rows.collect() if n > 0 else []
        if len(found) >= n or size == most or raw.count() < size:
            return rows.sparkSession.createDataFrame(found, rows.schema)
        size *= 1_000
