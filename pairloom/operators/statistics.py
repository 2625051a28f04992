"""Length statistics of a prepared table, in one pass.

The aggregate is partial per task and final in one row, so it moves one row per
task however large the table is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.operators.prepare import BOTH_TYPES, FORMATS, KEY_COLUMNS


def measured_columns(df: DataFrame) -> list[str]:
    """Text columns to measure; decided by the columns that are present."""
    names = []
    if "text" in df.columns:
        names.append("text")
    if "prompt" in df.columns:
        names += ["prompt", "chosen", "rejected"]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"a table with a prompt column needs {missing} as well")
    return names


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEY_COLUMNS]


def _metrics(df: DataFrame) -> list[Column]:
    return _measures(measured_columns(df), F.count(F.lit(1)))


def _measures(names: Sequence[str], rows: Column) -> list[Column]:
    metrics = [rows.alias("num_examples")]
    for name in names:
        size = F.length(name).cast("bigint")
        metrics += [
            # Exact bigint sum, one division at the end; NULL on an empty table.
            F.try_divide(F.sum(size).cast("double"), rows.cast("double")).alias(f"{name}_mean"),
            F.min(size).alias(f"{name}_min"),
            F.max(size).alias(f"{name}_max"),
        ]
    return metrics


def dataset_statistics(df: DataFrame) -> DataFrame:
    """One row: `num_examples`, `columns`, and mean, min, max per text column."""
    return df.agg(*_metrics(df)).withColumn("columns", F.lit(",".join(data_columns(df))))


def observe_statistics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Collect the same numbers while another action (a write) reads `df`."""
    observation = Observation(name)
    return df.observe(observation, *_metrics(df)), observation


def observe_formats(both: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
    """The same numbers for each format of `prepare_both`, while one action reads it.

    The columns of a format are null in rows of the other, so they are not measured there.
    """
    found = {}
    for kind, columns in FORMATS.items():
        found[kind] = Observation()
        names = [c for c in columns if BOTH_TYPES[c] == "string"]
        both = both.observe(found[kind], *_measures(names, F.count(names[0])))
    return both, found


def as_report(df: DataFrame, row: Mapping[str, Any]) -> dict[str, Any]:
    """The nested form: counts, columns and `{mean, min, max}` per text column."""
    report: dict[str, Any] = {"num_examples": row["num_examples"], "columns": data_columns(df)}
    for name in measured_columns(df):
        report[f"{name}_length"] = {k: row[f"{name}_{k}"] for k in ("mean", "min", "max")}
    return report


def get_dataset_statistics(df: DataFrame) -> dict[str, Any]:
    return as_report(df, dataset_statistics(df).first().asDict())
