"""Raw preference pairs from files, in batch or as a stream.

Layout: `<root>/<subset>/<split>*`, where the last part is a JSON-lines file
(gzip accepted), a parquet file, or a folder of such files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.limits import first_rows
from pairloom.session import scratch_dir
from pairloom.sources.rows import staged_rows, with_row_id

PAIR_SCHEMA = "chosen string, rejected string"
STAGED_SCHEMA = "row_id bigint, chosen string, rejected string, subset string, split string"
# The file that makes a staged table complete, beside the folder of its rows.
MANIFEST, VERSION = "manifest", 1
MANIFEST_COLUMNS = ("version", "table", "rows", "files", "bytes", "source")
MANIFEST_SCHEMA = "version int, table string, rows bigint, files bigint, bytes bigint, source string"
# The split names of the pair files.
SPLITS = ("train", "test")

# Endings of files that one task must read whole.
PACKED = (".gz", ".zst", ".snappy", ".lz4", ".deflate")

_PLACE = r"/([^/]+)/(train|test)[^/]*(?:/[^/]+)?$"


def _pattern(root: str, subset: str | None, split: str | None) -> str:
    if split is not None and split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS} or None, not {split!r}")
    names = split or "{" + ",".join(SPLITS) + "}"
    return f"{root.rstrip('/')}/{subset or '*'}/{names}*"


def _place() -> list[Column]:
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    path = F.url_decode(escaped)
    return [
        F.regexp_extract(path, _PLACE, 1).alias("subset"),
        F.regexp_extract(path, _PLACE, 2).alias("split"),
    ]


def _as_path(name: str) -> str:
    """A listed file name as a path to load: not URL-encoded, no wildcards."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(name))


def _spread(df: DataFrame, files: Sequence[str]) -> DataFrame:
    """Even out rows that come from packed files, before they are parsed.

    A packed file is read by one task however large it is. Where there are any, the
    rows are shuffled once into parts of even size; otherwise nothing is moved.
    """
    return df.hint("rebalance") if any(name.endswith(PACKED) for name in files) else df


def _first_files(
    load: Callable[[Sequence[str]], DataFrame], files: Sequence[str], rows: int
) -> list[str]:
    """A start of `files` that holds `rows` rows, if all of them do."""
    size = 1
    while size < len(files):
        # A filter that reads a column, so that only true rows are counted.
        read = load(files[:size]).where("chosen IS NULL OR length(chosen) >= 0")
        if read.count() >= rows:
            break
        size *= 4
    return list(files[:size])


def load_pairs(
    spark: SparkSession,
    root: str,
    split: str | None = None,
    subset: str | None = None,
    max_samples: int | None = None,
    *,
    file_format: str = "json",
) -> DataFrame:
    """`row_id, chosen, rejected, subset, split` of the chosen files.

    None stands for all subsets and for all splits. `max_samples` keeps the
    first rows of the table, or of each split when all splits are loaded; files
    beyond those rows are not read. As that takes ids which hold over two reads,
    text files are then staged in the scratch folder; see `ingest_pairs`.
    """

    def load(paths: Sequence[str]) -> DataFrame:
        reader = spark.read.schema(PAIR_SCHEMA).format(file_format)
        return reader.load([_as_path(p) for p in paths])

    found = spark.read.schema(PAIR_SCHEMA).format(file_format).load(_pattern(root, subset, split))
    files = sorted(found.inputFiles())
    if not files:
        return found.select(F.lit(0).cast("bigint").alias("row_id"), "chosen", "rejected", *_place())
    wanted = files
    if max_samples is not None:
        wanted = []
        for name in SPLITS if split is None else (split,):
            of_split = [f for f in files if re.search(_PLACE, f)[2] == name]
            wanted += _first_files(load, of_split, max_samples)
    df = found if wanted == files else load(wanted)
    if max_samples is not None and file_format != "parquet":
        pairs = staged_rows(df, "chosen", "rejected", *_place(), files=files, target=scratch_dir(spark))
        return first_rows(pairs, max_samples, splits=SPLITS if split is None else None)
    pairs = with_row_id(
        df, "chosen", "rejected", *_place(), files=files, columnar=file_format == "parquet"
    )
    pairs = _spread(pairs, wanted)
    if max_samples is None:
        return pairs
    return first_rows(pairs, max_samples, splits=SPLITS if split is None else None)


def _source_mark(spark: SparkSession, pattern: str) -> dict[str, int | str]:
    """Names, sizes and times of the files, as one number; reads no content."""
    found = spark.read.format("binaryFile").load(pattern)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = found.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.sum(each).alias("mark")).first()
    return {"files": row["files"], "bytes": row["bytes"] or 0, "source": str(row["mark"])}


def _manifest(spark: SparkSession, target: str) -> dict[str, int | str] | None:
    """What was staged under `target`, or None if nothing was completed there."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).json(f"{target}/{MANIFEST}").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if len(rows) != 1:
        raise ValueError(f"the manifest of {target} has {len(rows)} rows")
    if rows[0]["version"] != VERSION:
        raise ValueError(f"{target} has layout {rows[0]['version']}; this package reads {VERSION}")
    return rows[0].asDict()


def open_pairs(spark: SparkSession, target: str) -> DataFrame:
    """`row_id, chosen, rejected, subset, split` of the table staged under `target`.

    A plain columnar scan: ids are stored in the rows, in any session they are the same.
    """
    manifest = _manifest(spark, target)
    if manifest is None:
        raise ValueError(f"no complete table under {target}; run ingest_pairs first")
    return spark.read.schema(STAGED_SCHEMA).parquet(f"{target}/{manifest['table']}/rows")


def ingest_pairs(
    spark: SparkSession,
    root: str,
    target: str,
    split: str | None = None,
    subset: str | None = None,
    *,
    file_format: str = "json",
) -> DataFrame:
    """The pairs of files, staged as parquet under `target`, with lasting `row_id`.

    Ids are 0, 1, 2, ... in file order and stored in the rows. The rows go to a new
    folder, and a manifest of one row, written last, makes them the table: a run that
    broke off leaves nothing that `open_pairs` would read, and can be repeated. A run on
    a target that holds the table of the same files, by name, size and time, opens it;
    one of other files is refused.
    """
    pattern = _pattern(root, subset, split)
    scan = spark.read.schema(PAIR_SCHEMA).format(file_format).load(pattern)
    files = sorted(scan.inputFiles())
    if not files:
        raise ValueError(f"no files under {root}")
    source = _source_mark(spark, pattern)
    before = _manifest(spark, target)
    if before is not None:
        if any(before[name] != value for name, value in source.items()):
            raise ValueError(f"{target} holds the table of other files")
        return open_pairs(spark, target)
    table = f"table-{uuid.uuid4().hex}"
    rows = staged_rows(scan, "chosen", "rejected", *_place(), files=files, target=f"{target}/{table}")
    manifest = {"version": VERSION, "table": table, "rows": rows.count(), **source}
    entry = spark.createDataFrame([tuple(manifest[n] for n in MANIFEST_COLUMNS)], MANIFEST_SCHEMA)
    entry.coalesce(1).write.mode("errorifexists").json(f"{target}/{MANIFEST}")
    return open_pairs(spark, target)


def stream_pairs(
    spark: SparkSession,
    root: str,
    split: str | None = None,
    subset: str | None = None,
    *,
    file_format: str = "json",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same files as a stream. There is no first-n and no row order here."""
    reader = spark.readStream.schema(PAIR_SCHEMA).format(file_format)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.load(_pattern(root, subset, split))
    return df.select("chosen", "rejected", *_place())
