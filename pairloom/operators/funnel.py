"""Where rows go during preparation, counted while the prepared table is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Funnel:
    """Row counts at each step of one preparation.

    Every step observes the rows that pass it, so the counts ride on the action that
    reads the prepared table: nothing is read or parsed a second time. One funnel
    serves one preparation; its counts are those of the first action on it.
    """

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}

    def count(self, df: DataFrame, step: str, **metrics: Column) -> DataFrame:
        """`df` with its rows counted as `step`, and further counts beside."""
        if step in self._steps:
            raise ValueError(f"this funnel has counted {step!r} already; take a new one")
        self._steps[step] = Observation()
        counts = [value.alias(name) for name, value in metrics.items()]
        return df.observe(self._steps[step], F.count(F.lit(1)).alias("rows"), *counts)

    def _rows(self, step: str) -> int:
        return self._steps[step].get["rows"]

    @property
    def get(self) -> dict[str, int]:
        """`rows_in, nulls, unparsed, empty, over_length, kept`; waits for the action.

        Preference pairs: the five last add up to the first. A row without any marked
        turn is unparsed, one that lacks a response otherwise is empty. Supervised text
        drops neither, so unparsed rows count among the kept ones and empty is 0.
        """
        rows_in, read, kept = self._rows("in"), self._rows("read"), self._rows("kept")
        unparsed = self._steps["parsed"].get["unparsed"]
        filled = self._rows("filled") if "filled" in self._steps else read
        return {
            "rows_in": rows_in,
            "nulls": rows_in - read,
            "unparsed": unparsed,
            "empty": read - filled - unparsed if "filled" in self._steps else 0,
            "over_length": filled - kept,
            "kept": kept,
        }
