"""Shortened text for display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ELLIPSIS = "..."


def shorten(text: Column, size: int) -> Column:
    """Cut to `size` characters and mark the cut; shorter text is unchanged."""
    return F.when(F.length(text) > size, excerpt(text, size)).otherwise(text)


def excerpt(text: Column, size: int) -> Column:
    """The first `size` characters, always followed by the mark."""
    return F.concat(F.left(text, F.lit(size)), F.lit(ELLIPSIS))
