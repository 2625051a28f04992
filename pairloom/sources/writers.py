"""JSON-lines output."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pairloom.session import delete_folder, folder_exists, move_folder

# The column in which readers of prepared tables keep all further fields.
EXTRA, EXTRA_TYPE = "extra", "map<string,variant>"


def write_json(
    df: DataFrame, path: str, *, keep_row_id: bool = True, compression: str | None = None
) -> None:
    """Write one table as a folder of JSON-lines parts; parents are created.

    Nothing is shuffled: each scan task writes its own part. `row_id` is kept
    by default, as it alone carries the row order. Null fields are written out. A map of
    further fields, as the reader of prepared tables makes it, is written as fields
    of the line.
    """
    out = df if keep_row_id else df.drop("row_id")
    mapped = dict(out.dtypes).get(EXTRA) == EXTRA_TYPE
    writer = (_lines(out) if mapped else out).write.mode("errorifexists")
    if compression is not None:
        writer = writer.option("compression", compression)
    if mapped:
        writer.text(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def _lines(df: DataFrame) -> DataFrame:
    """Rows as JSON lines, the entries of their map of further fields after the columns."""
    options = {"ignoreNullFields": "false"}
    own = F.to_json(F.struct(*[c for c in df.columns if c != EXTRA]), options)
    more = F.to_json(F.col(EXTRA), options)
    both = F.concat(F.expr("left(own, length(own) - 1)"), F.lit(","), F.expr("substr(more, 2)"))
    lines = df.select(own.alias("own"), more.alias("more"))
    return lines.select(F.when(F.length("more") > 2, both).otherwise(F.col("own")).alias("value"))


def write_keyed(
    df: DataFrame,
    path: str,
    key: str,
    *,
    mode: str = "errorifexists",
    null_fields: bool = True,
    compression: str | None = None,
) -> None:
    """Write one table as a folder of JSON-lines parts for each value of `key`, in one pass.

    The table is read and computed once whatever the number of values, and nothing is
    shuffled: each task sorts its own rows by key and writes a part per value.
    `null_fields=False` leaves null fields out, for rows of several kinds.
    """
    writer = df.write.mode(mode).partitionBy(key).option("ignoreNullFields", str(not null_fields).lower())
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.json(path)


def read_keyed(spark: SparkSession, path: str, key: str, value: str, schema: str) -> DataFrame:
    """The rows of one value of a table written by key; other folders are not read."""
    table = spark.read.schema(f"{schema}, {key} string").json(path)
    return table.where(F.col(key) == value).drop(key)


def write_formats(both: DataFrame, paths: dict[str, str], *, keep_row_id: bool = True) -> None:
    """Write each format of `prepare_both` to a path of its own, from one pass over the input.

    One keyed write goes to a folder beside the first path; its parts are then renamed.
    A format without rows gives an empty folder.
    """
    spark = both.sparkSession
    folder, slash, _ = next(iter(paths.values())).rpartition("/")
    working = f"{folder}{slash}.formats-{uuid.uuid4().hex}"
    out = both if keep_row_id else both.drop("row_id")
    try:
        write_keyed(out, working, "format", null_fields=False)
        for kind, path in paths.items():
            part = f"{working}/format={kind}"
            if not folder_exists(spark, part):
                spark.range(0).write.json(part)
            move_folder(spark, part, path)
    finally:
        delete_folder(spark, working)


def json_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        df.writeStream.format("json")
        .outputMode("append")
        .option("ignoreNullFields", "false")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def save_paths(path: str, output: str) -> dict[str, str]:
    """Where each table of an `sft`, `dpo` or `both` run goes."""
    if output != "both":
        return {output: path}
    folder, slash, name = path.rpartition("/")
    return {
        kind: folder + slash + str(PurePosixPath(name).with_suffix(f".{kind}.json"))
        for kind in ("sft", "dpo")
    }
