"""Row numbers that follow file order."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.session import delete_folder, scratch_dir

# row_id = file rank, then position in the file: 21 and 42 bits.
POSITION_BITS = 42
MAX_FILES = 2 ** (63 - POSITION_BITS)

# Blocks whose first ids are broadcast at once, 40 bytes each, and groups of part files.
BLOCKS = 1 << 18
_PART_GROUPS = 1 << 12

# Marks ids that a text scan of this application makes anew at each read.
_TAG = "pairloom.scan"

# The two ways Spark names a file differ in the slashes after the scheme.
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"


def _position(columnar: bool) -> Column:
    """A number that grows along the rows of one file."""
    if columnar:
        return F.col("_metadata.row_index")
    # Text files are read in blocks. A row takes at least two bytes, so the
    # start of its block plus its number in the task stays below the start of
    # the next block: unique and ascending, without counting any rows.
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return F.col("_metadata.file_block_start") + in_task


def _file_hash() -> Column:
    """The file of a row, as a hash of its name."""
    return F.xxhash64(F.regexp_replace("_metadata.file_path", _SCHEME, "/")).alias("file_hash")


def file_ranks(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """`file_hash, file_rank`: 16 bytes a file, in order of the list."""
    named = [(rank, re.sub(_SCHEME, "/", name)) for rank, name in enumerate(files)]
    ranks = spark.createDataFrame(named, "file_rank bigint, file_name string").select(
        F.xxhash64("file_name").alias("file_hash"), "file_rank"
    )
    if ranks.select("file_hash").distinct().count() < len(files):
        raise ValueError("two file names share a hash; rename one of them")
    return ranks


def with_row_id(
    df: DataFrame,
    *columns: str | Column,
    files: Sequence[str] | None = None,
    columnar: bool = False,
) -> DataFrame:
    """Put a unique `row_id`, ascending in (file name, position), before `columns`.

    `df` must be a plain file scan, of `files` or of some of them. Ids of text
    files depend on how the scan is cut into tasks; operators that read them twice
    write them down first (`settled`), and `staged_rows` gives ids 0, 1, 2, ... The
    ranks of at most MAX_FILES files are broadcast, 32 MB; stage longer lists.
    """
    files = sorted(df.inputFiles() if files is None else files)
    if len(files) > MAX_FILES:
        raise ValueError(f"{len(files)} files; stage them by ingest_pairs, which has no limit")
    wanted = columns or tuple(df.columns)
    position = _position(columnar)
    tag = {} if columnar else {_TAG: df.sparkSession.sparkContext.applicationId}
    if len(files) <= 1:
        return df.select(position.alias("row_id", metadata=tag), *wanted)
    ranks = file_ranks(df.sparkSession, files)
    placed = df.select(_file_hash(), position.alias("position"), *wanted).join(
        F.broadcast(ranks), "file_hash", "left"
    )
    rank = F.coalesce(
        F.col("file_rank"), F.raise_error(F.lit("a file of the scan is not in the list"))
    ).cast("bigint")
    names = [c for c in placed.columns if c not in ("file_hash", "position", "file_rank")]
    return placed.select(
        (F.shiftleft(rank, POSITION_BITS) + F.col("position")).alias("row_id", metadata=tag), *names
    )


def settled(df: DataFrame, key: str) -> DataFrame:
    """`df` with keys that hold over several reads.

    Keys that were numbered by the cut of a text scan are written once, with all
    columns, and the table is read back; any other table is returned as it is.
    """
    spark = df.sparkSession
    if df.schema[key].metadata.get(_TAG) != spark.sparkContext.applicationId:
        return df
    path = f"{scratch_dir(spark)}/rows"
    df.withMetadata(key, {}).write.parquet(path)
    return spark.read.parquet(path)


def staged_parts(
    df: DataFrame, *columns: str | Column, target: str, counts: Mapping[str, Column] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """A scan of text files, written once as it is cut, and counts made while it is written.

    Each row keeps the hash of its file, the start of its block and its number in the
    task; together they are unique and ascend within a file.
    """
    spark = df.sparkSession
    metrics = Observation()
    start = F.col("_metadata.file_block_start").alias("block_start")
    rows = df.select(
        _file_hash(), start, F.monotonically_increasing_id().alias("in_task"), *(columns or df.columns)
    )
    schema = rows.schema
    if counts:
        rows = rows.observe(metrics, *[value.alias(name) for name, value in counts.items()])
    rows.write.parquet(target)
    found = metrics.get if counts else {}
    return spark.read.schema(schema).parquet(target), found


def _block_bases(blocks: DataFrame) -> DataFrame:
    """`base` of each block: the rows before it. Windows run over one file, over 4096 files,
    and over the totals of these groups, never over all blocks."""
    group = F.shiftright("file_rank", 12).alias("group")
    files = blocks.groupBy("file_rank", group).agg(F.sum("n").alias("n"))

    def running(*within: str, by: str) -> Column:
        over = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(over), F.lit(0))

    groups = files.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", running(by="group").alias("of_group"))
    files = files.select("file_rank", "group", running("group", by="file_rank").alias("of_file"))
    bases = files.join(groups, "group").select("file_rank", (F.col("of_group") + F.col("of_file")).alias("before"))
    own = blocks.withColumn("of_block", running("file_rank", by="block_start"))
    return own.join(bases, "file_rank").withColumn("base", F.col("before") + F.col("of_block"))


def numbered_parts(parts: DataFrame, files: Sequence[str], target: str) -> DataFrame:
    """Staged parts written anew with `row_id` 0, 1, 2, ... in file order.

    Rows per block, a table of one row per block of the scan, give every block its
    first id by prefix sums in two levels. The ids are written into the rows: no row is
    shuffled, and a read of the result joins nothing. Blocks are looked up in a
    broadcast table of at most BLOCKS rows; of more blocks, the part files are taken in
    several rounds, each read once.
    """
    spark = parts.sparkSession
    names = parts.columns[3:]
    part = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(_PART_GROUPS))
    block = ["file_hash", "block_start"]
    counted = parts.groupBy(*block, part.alias("part")).agg(
        F.count("*").alias("n"), F.min("in_task").alias("first")
    )
    blocks = _block_bases(counted.join(file_ranks(spark, sorted(files)), "file_hash"))
    blocks = blocks.select(*block, "part", "first", "base")
    blocks.write.parquet(f"{target}/blocks")
    blocks = spark.read.schema(blocks.schema).parquet(f"{target}/blocks")
    rounds = min(_PART_GROUPS, max(1, -(-blocks.count() // BLOCKS)))
    row_id = (F.col("base") + F.col("in_task") - F.col("first")).alias("row_id")
    for k in range(rounds):
        own = blocks.where(F.col("part") % rounds == k).drop("part")
        # The filter is on the file name only, so files of other rounds are not opened.
        rows = parts.where(part % rounds == k) if rounds > 1 else parts
        done = rows.join(F.broadcast(own), block).select(row_id, *names)
        done.write.mode("append").parquet(f"{target}/rows")
    return spark.read.schema(done.schema).parquet(f"{target}/rows")


def staged_rows(df: DataFrame, *columns: str | Column, files: Sequence[str], target: str) -> DataFrame:
    """A scan of text files, written under `target` with ids 0, 1, 2, ... in file order.

    The text is read once and written twice, since ids need the counts of all blocks;
    reads of the result give the same ids however they are cut.
    """
    parts, _ = staged_parts(df, *columns, target=f"{target}/parts")
    rows = numbered_parts(parts, files, target)
    for name in ("parts", "blocks"):
        delete_folder(df.sparkSession, f"{target}/{name}")
    return rows
