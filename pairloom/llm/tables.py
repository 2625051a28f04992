"""Written intermediate tables and lossless narrowing by id."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import scratch_dir

_MARK_BITS = 1 << 22  # bits of the id marks: at most 65,536 broadcast rows of 64 bits


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_TEXTS, _NARROW = 1000, 10_000  # rows that go to a Python worker at once


def text_batches(spark: SparkSession) -> None:
    """Hand workers at most so many whole texts at once from now on, in this session."""
    if not 0 < int(spark.conf.get(_BATCH)) <= _TEXTS:
        spark.conf.set(_BATCH, str(_TEXTS))


class Scratch:
    """One new folder in the shared storage; tables written there cut lineage."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, scratch_dir(spark)
        text_batches(spark)

    def put(self, df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
        """Write a table and read it back, so that it is computed once.

        narrow: rows are a few numbers, so workers may get more of them at once.
        """
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(_BATCH)
        if narrow:
            self.spark.conf.set(_BATCH, str(_NARROW))
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_BATCH, before)
        return self.spark.read.schema(df.schema).parquet(path)


def mark_table(values: DataFrame, column: str, hashed: bool) -> DataFrame:
    """(__word, __marks): a bit set for each value, of a fixed number of bits.

    At most 65,536 rows whatever the input, so the table may be broadcast.
    """
    value = F.xxhash64(column) if hashed else F.col(column)
    return (
        values.select(value.bitwiseAND(F.lit(_MARK_BITS - 1)).alias("__bit"))
        .groupBy(F.shiftright("__bit", 6).alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(__bit & 63 AS INT))")).alias("__marks"))
    )


def with_mark(df: DataFrame, marks: DataFrame, value: Column) -> DataFrame:
    """df with __hit: whether the value of a row may be among the marked ones."""
    return (
        df.withColumn("__bit", value.bitwiseAND(F.lit(_MARK_BITS - 1)))
        .join(F.broadcast(marks), F.shiftright("__bit", 6) == F.col("__word"), "left")
        .withColumn("__hit", F.expr("coalesce((shiftright(__marks, CAST(__bit & 63 AS INT)) & 1L) = 1L, false)"))
        .drop("__bit", "__word", "__marks")
    )


def mark_bytes(values: DataFrame, column: str) -> tuple[bytes, int]:
    """Marks of values that are hashes already, as bytes, and how many bits they are."""
    words = bytearray(_MARK_BITS // 8)
    for row in mark_table(values, column, hashed=False).toLocalIterator():
        words[8 * row["__word"] : 8 * row["__word"] + 8] = row["__marks"].to_bytes(8, "little", signed=True)
    return bytes(words), _MARK_BITS


def narrowed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key occurs in ids (one column `id`), wide columns moved little.

    Marks of all ids are broadcast and drop most other rows at the scan; an exact
    semi join follows, which moves only what the marks let through.
    """
    hit = with_mark(df, mark_table(ids, "id", hashed=True), F.xxhash64(F.col(key))).where("__hit").drop("__hit")
    return hit.join(ids.select(F.col("id").alias("__id")), F.col(key) == F.col("__id"), "left_semi")
