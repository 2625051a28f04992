"""Evaluate-once helpers.

Spark inlines a projected expression into every filter and projection above
it, so a parser that feeds a filter is evaluated several times per row. The two
helpers here keep each parse to a single evaluation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name `value` inside `body`, so that `body` may use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind_columns(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """Project `keep` plus `columns`, with `columns` behind a generator.

    Filters on generated columns stay above the generator, so the expressions
    run once per row. Filters on the kept columns still reach the scan.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
