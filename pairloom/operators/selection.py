"""Find the n-th smallest key of a distributed table without sorting it.

First-n and the exact split both need "the n smallest keys", where n can be a
fixed share of a huge table. A global sort, a window over the whole table or a
`limit` through one task would not hold. Instead the keys are counted by their
leading digits, at most 65,536 groups, and only the group that holds the n-th
key is looked at further. Each pass reads a key column only and brings one row
to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import scratch_dir

# Up to this many keys are ranked directly: each task sends its smallest ones,
# never more than this, to one small task.
DIRECT = 1_000
# Hex digits per counting pass: at most 16 ** 4 groups.
DIGITS = 4

_SIGN_BIT = -(2**63)


def ordered_hex(row_id: Column) -> Column:
    """A bigint as 16 hex digits whose text order is the number order."""
    return F.lower(F.lpad(F.hex(row_id.cast("bigint").bitwiseXOR(F.lit(_SIGN_BIT))), 16, "0"))


def from_ordered_hex(text: str) -> int:
    return int(text, 16) - 2**63


def written_keys(keys: DataFrame) -> DataFrame:
    """Store a key table once in the shared folder, so later passes read only it."""
    spark = keys.sparkSession
    path = f"{scratch_dir(spark)}/keys-{uuid.uuid4().hex}"
    keys.write.parquet(path)
    return spark.read.schema(keys.schema).parquet(path)


def nth_smallest(keys: DataFrame, n: int, direct: int = DIRECT) -> str | None:
    """The n-th smallest of the unique, fixed-width hex texts in column `k`.

    The largest key if there are fewer than n; None if there are no keys. A key
    at the border that occurs more than once is an error: "up to the n-th" would
    then be more than n rows.
    """
    found = _nth_smallest(keys, n, direct)
    if found is not None and keys.where(F.col("k") == F.lit(found)).limit(2).count() > 1:
        raise ValueError("the key is not unique; number the rows anew, as by ingest_pairs")
    return found


def _nth_smallest(keys: DataFrame, n: int, direct: int) -> str | None:
    prefix, left = "", n
    group = keys
    while left > direct:
        digits = F.substring("k", len(prefix) + 1, DIGITS).alias("digits")
        counts = group.groupBy(digits).agg(F.count(F.lit(1)).alias("size"))
        # The window runs over at most 65,536 counts, never over the keys.
        counts = counts.withColumn("upto", F.sum("size").over(Window.orderBy("digits")))
        found = counts.agg(
            F.min(F.when(F.col("upto") >= left, F.struct("digits", "size", "upto"))).alias("at")
        ).first()["at"]
        if found is None:
            return group.agg(F.max("k")).first()[0]
        if not found["digits"]:  # all digits are used up: this is one repeated key
            return prefix
        prefix += found["digits"]
        left -= found["upto"] - found["size"]
        group = keys.where(F.startswith("k", F.lit(prefix)))
        if found["size"] <= direct:
            break
    return group.orderBy("k").limit(left).agg(F.max("k")).first()[0]
