"""Prepared tables, read back for training."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import MESSAGES_TYPE
from pairloom.operators.prepare import sft_text_from_pairs
from pairloom.session import delete_folder, scratch_dir
from pairloom.sources.rows import numbered_parts, staged_parts, staged_rows, with_row_id
from pairloom.sources.writers import EXTRA, EXTRA_TYPE

# The columns each reader needs.
DPO_COLUMNS = ("prompt", "chosen", "rejected")
SFT_COLUMNS = ("prompt", "chosen")

MAX_FIELDS = 10_000  # that may become columns of their own

_TYPES = {"row_id": "bigint", "messages": MESSAGES_TYPE}


def require_columns(present: Iterable[str], required: Iterable[str]) -> None:
    missing = [c for c in required if c not in set(present)]
    if missing:
        raise ValueError(f"missing columns {missing}; needed are {list(required)}")


def json_fields(spark: SparkSession, path: str) -> list[str]:
    """All field names of a JSON table; a declared schema would hide undeclared ones."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    fields = lines.select(F.explode(F.json_object_keys("value")).alias("field")).distinct()
    found = sorted(row["field"] for row in fields.limit(MAX_FIELDS + 1).collect())
    if len(found) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields; keep them in one column by extra='variant'")
    return found


def _json_rows(spark: SparkSession, path: str, columns: Sequence[str], variant: bool) -> DataFrame:
    """Typed columns and row_id of JSON lines; the other fields of a line as one map on request."""
    schema = ", ".join(f"`{c}` {_TYPES.get(c, 'string')}" for c in ["row_id", *columns])
    if not variant:
        return spark.read.schema(schema).json(path)
    lines = spark.read.text(path).where("trim(value) <> ''")
    fields = F.from_json("value", EXTRA_TYPE)
    others = F.map_filter(fields, lambda name, _: ~name.isin("row_id", *columns))
    return lines.withColumns({"__row": F.from_json("value", schema), EXTRA: others}).select(
        "__row.*", EXTRA
    )


def _staged_json(
    spark: SparkSession, path: str, required: Sequence[str], extra: Sequence[str], variant: bool
) -> DataFrame:
    """A JSON table with `row_id`, staged in one pass over its lines.

    Whether columns and ids are there is counted while the lines are staged, and judged before
    the table is handed out.
    """
    columns = [*required, *extra]
    df = _json_rows(spark, path, columns, variant)
    names = [*columns, EXTRA] if variant else columns
    files = df.inputFiles()
    if not files:
        return spark.createDataFrame([], df.schema).select("row_id", *names)
    whole = F.lit(True)
    for c in required:
        whole &= F.col(c).isNotNull()
    counts = {"rows": F.count(F.lit(1)), "ids": F.count("row_id")}
    counts["unnumbered"] = F.count_if(whole & F.col("row_id").isNull())
    counts |= {f"of_{c}": F.count(c) for c in required}
    target = scratch_dir(spark)
    parts, found = staged_parts(df, "row_id", *names, target=f"{target}/parts", counts=counts)
    try:
        require_columns([c for c in required if found[f"of_{c}"] or not found["rows"]], required)
        if found["ids"] and found["unnumbered"]:
            raise ValueError(
                f"row_id is null in {found['unnumbered']} of {found['rows']} rows; "
                "number all rows, or leave row_id out of the file"
            )
    except ValueError:
        delete_folder(spark, target)
        raise
    if found["ids"]:
        return parts.select("row_id", *names)
    numbered = numbered_parts(parts.drop("row_id"), files, target)
    for name in ("parts", "blocks"):
        delete_folder(spark, f"{target}/{name}")
    return numbered


def _columnar(
    spark: SparkSession, path: str, required: Sequence[str], extra: Sequence[str] | str, file_format: str
) -> DataFrame:
    """A table whose files say what columns they have."""
    df = spark.read.format(file_format).load(path)
    require_columns(df.columns, required)
    if extra == "all":
        extra = [c for c in df.columns if c not in ("row_id", *required)]
    columns = [*required, *extra]
    if "row_id" in df.columns:
        # File statistics answer this where no id is null.
        if not df.where("row_id IS NULL").isEmpty():
            raise ValueError("row_id is null in some rows; number all rows, or drop the column")
        return df.select("row_id", *columns)
    if file_format == "parquet" or not (files := df.inputFiles()):
        return with_row_id(df, *columns, columnar=file_format == "parquet")
    return staged_rows(df, *columns, files=files, target=scratch_dir(spark))


def read_prepared(
    spark: SparkSession,
    path: str,
    required: Sequence[str],
    extra: Sequence[str] | str = (),
    *,
    file_format: str = "json",
    on_null: str = "fail",
) -> DataFrame:
    """A prepared table with `row_id`.

    JSON lines are read once and staged as parquet in the scratch folder, where further
    reads start, so that ids hold; without ids rows get 0, 1, 2, ... in file order. Ids
    that some rows lack are refused. Parquet rows are numbered by their place.

    `extra` names further columns to keep. "variant" keeps all other fields of JSON in one
    column `extra`, a map from name to VARIANT, whatever they are; "all" makes a text column
    of each (`messages` as messages), for which a pass over the lines learns their
    names, MAX_FIELDS at most. A required column without any value is missing, which is
    an error at once. A null among the values of one, as of an absent field or a
    malformed line, fails the job (`on_null="fail"`) or drops the row (`"drop"`).
    """
    if on_null not in ("fail", "drop"):
        raise ValueError(f"on_null must be fail or drop, not {on_null!r}")
    if file_format != "json":
        if extra == "variant":
            raise ValueError("extra='variant' is for JSON; other files name their columns")
        df = _columnar(spark, path, required, extra, file_format)
    else:
        variant = extra == "variant"
        if extra == "all":
            fields = json_fields(spark, path)
            require_columns(fields, required)
            extra = [c for c in fields if c not in ("row_id", *required)]
        df = _staged_json(spark, path, required, () if variant else extra, variant)
    absent = reduce(or_, [F.col(c).isNull() for c in required])
    if on_null == "drop":
        return df.where(~absent)
    fail = F.raise_error(F.lit(f"null in a needed column of {list(required)}")).cast("string")
    return df.withColumns({c: F.when(absent, fail).otherwise(F.col(c)) for c in required})


def load_training_text(
    spark: SparkSession, path: str, *, file_format: str = "json", on_null: str = "fail"
) -> DataFrame:
    """`row_id, text` for supervised tuning, out of a table of prepared pairs."""
    pairs = read_prepared(spark, path, SFT_COLUMNS, file_format=file_format, on_null=on_null)
    return sft_text_from_pairs(pairs)


def load_preference_data(
    spark: SparkSession,
    path: str,
    extra: Sequence[str] | str = (),
    *,
    file_format: str = "json",
    on_null: str = "fail",
) -> DataFrame:
    """`row_id` and the prepared pairs, with any extra columns (see `read_prepared`)."""
    return read_prepared(
        spark, path, DPO_COLUMNS, extra, file_format=file_format, on_null=on_null
    )
