"""The preparation job over a stream: both training tables from one read of each batch.

Every micro-batch is read and parsed once and written once, keyed by format, to the
folder of its number. A batch that is run again after a failure replaces that folder,
so a restart neither repeats rows nor loses any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions.tokens import Tokenizer
from pairloom.operators.prepare import BOTH_TYPES, FORMATS, prepare_both
from pairloom.sources.writers import write_keyed

# Counts of each batch, in a folder that readers of the tables do not see.
COUNTS = "_counts"
COUNTS_SCHEMA = "batch bigint, pairs bigint, sft bigint, dpo bigint"


def _write_batch(path: str, tokenizer: Tokenizer | None, options: dict) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        read, out = Observation(), Observation()
        pairs = batch.observe(read, F.count(F.lit(1)).alias("pairs"))
        both = prepare_both(pairs, tokenizer, **options)
        kinds = [F.count_if(F.col("format") == kind).alias(kind) for kind in FORMATS]
        both = both.observe(out, *kinds)
        write_keyed(both, f"{path}/batch={number}", "format", mode="overwrite", null_fields=False)
        counts = (number, read.get["pairs"], *(out.get[kind] for kind in FORMATS))
        row = batch.sparkSession.createDataFrame([counts], COUNTS_SCHEMA)
        row.coalesce(1).write.mode("overwrite").json(f"{path}/{COUNTS}/{number}")

    return write


def start_job(
    pairs: DataFrame,
    path: str,
    checkpoint: str,
    *,
    tokenizer: Tokenizer | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Start writing both tables of a stream of pairs under `path`.

    With `available_now` the query ends once the present files are done; otherwise it
    goes on with new files. A query started again with the same path and checkpoint
    goes on where the last one ended. `options` go to `prepare_both`; keep=["subset"], for
    example, carries a column along.
    """
    writer = pairs.writeStream.foreachBatch(_write_batch(path, tokenizer, options))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def job_output(spark: SparkSession, path: str, kind: str, keep: str = "") -> DataFrame:
    """One format of what `start_job` wrote: the rows of all batches.

    keep: schema of the kept columns, such as "subset string".
    """
    columns = ", ".join(f"{c} {BOTH_TYPES[c]}" for c in FORMATS[kind])
    schema = f"{keep}, {columns}" if keep else columns
    table = spark.read.schema(f"{schema}, batch bigint, format string").json(path)
    return table.where(F.col("format") == kind).drop("batch", "format")


def job_counts(spark: SparkSession, path: str) -> DataFrame:
    """`batch, pairs, sft, dpo`: rows read and written by each batch."""
    return spark.read.schema(COUNTS_SCHEMA).option("recursiveFileLookup", "true").json(f"{path}/{COUNTS}")
