"""Filter rows by the token counts of their text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.binding import bind_columns
from pairloom.functions.tokens import Tokenizer


def _together(values: Mapping[str, Column], names: Sequence[str]) -> Column:
    return reduce(add, [values[name] for name in names])


def within_limits(
    df: DataFrame, tokenizer: Tokenizer, limits: Sequence[tuple[Sequence[str], int]]
) -> DataFrame:
    """Rows where each named group of columns has at most so many tokens together.

    Each column is counted once, on its own. Where the tokenizer knows a bound,
    a group that fits by it is not counted: its columns go to the counter as
    NULL, unless another group needs them, and the group passes.
    """
    columns = df.columns
    texts = {name: F.col(name) for group, _ in limits for name in group}
    if tokenizer.most is not None:
        most = {name: tokenizer.most(text) for name, text in texts.items()}
        open_ = [(group, _together(most, group) > limit) for group, limit in limits]
        needed = {n: reduce(or_, [is_open for group, is_open in open_ if n in group]) for n in texts}
        df = df.withColumns({f"__count_{name}": flag for name, flag in needed.items()})
        texts = {name: F.when(F.col(f"__count_{name}"), text) for name, text in texts.items()}
    counted = bind_columns(df, columns, __tokens=tokenizer.count_all(texts))
    tokens = {name: F.col("__tokens")[name] for name in texts}
    fits = [F.coalesce(_together(tokens, group) <= limit, F.lit(True)) for group, limit in limits]
    return counted.where(reduce(and_, fits)).select(*columns)
