"""Best-fit packing of token sequences, planned on the histogram of lengths.

Documents are cut into pieces of at most `most` ids. How many pieces there are of
each length, at most `most` numbers, is all the plan needs: best fit takes lengths
from long to short and works on counts, so a step places any number of equal
pieces into equal free spaces at once. The plan lists slots by length and rank;
each piece takes the slot of its rank within its length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch
from .tokens import encoder
from .workers import lean

_PIECE = pa.schema(
    [
        ("task", pa.int64()),
        ("nth", pa.int64()),
        ("id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_FLUSH = 16 << 20  # bytes of ids in a batch of pieces


def _cut(path: str, most: int):
    """Pieces of each text, numbered in their task and within their length there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(most + 1, np.int64)
        end = b"\0\0\0\0"
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    n = len(part) // 4
                    rows.append((task, int(seen[n]), i, k, at // 4, n, part))
                    seen[n] += 1
                    held += len(part)
                if held > _FLUSH:
                    yield _rows(rows)
                    rows, held = [], 0
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_PIECE)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECE, strict=True)], schema=_PIECE)


def plan_best_fit(counts: dict[int, int], most: int) -> np.ndarray:
    """Slots for counts of pieces by length: rows of (length, first rank, sequence, offset, n).

    Such a row places n pieces of that length, of consecutive ranks, at that offset
    of n consecutive sequences. Lengths go from long to short; each piece goes where
    the least space is left over. Pieces longer than `most` are refused. The work
    depends on the number of different lengths, not on the number of pieces.
    """
    spaces: dict[int, list[tuple[int, int]]] = {}  # free length: [(first sequence, how many)]
    free: list[int] = []  # its keys, ascending
    slots: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def keep(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in spaces:
                bisect.insort(free, space)
            spaces.setdefault(space, []).append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= most:
            raise ValueError(f"a piece of {length} does not fit into {most}")
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, n = spaces[space].pop()
                if not spaces[space]:
                    del spaces[space], free[at]
            else:
                space, first, n = most, sequences, -(-left // (most // length))
                sequences += n
            each = space // length
            full = min(n, left // each)
            for k in range(each if full else 0):
                slots.append((length, rank, first, most - space + k * length, full))
                rank += full
            keep(space - each * length, first, full)
            left -= full * each
            if full < n and left:  # the last pieces fill one more space in part
                some = min(left, each)
                for k in range(some):
                    slots.append((length, rank, first + full, most - space + k * length, 1))
                    rank += 1
                keep(space - some * length, first + full, 1)
                left -= some
                full += 1
            keep(space, first + full, n - full)
    return np.array(slots, np.int64).reshape(-1, 5)


def _take(slots: np.ndarray):
    """Sequence and offset of each (length, rank), by search in the plan."""
    base = np.int64(1) << 48
    starts = slots[:, 0] * base + slots[:, 1]
    order = np.argsort(starts)
    starts, own = starts[order], slots[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(starts, batch.column("length").to_numpy() * base + rank, side="right") - 1
            columns = [batch.column(c) for c in ("task", "nth", "length")]
            columns += [pa.array(own[at, 2] + rank - own[at, 1]), pa.array(own[at, 3])]
            yield pa.record_batch(columns, names=["task", "nth", "length", "sequence_id", "offset"])

    return run


@dataclass
class Packed:
    """pieces: task, nth, length (together a key), id, piece, start, ids (packed unsigned
    32-bit little-endian). slots: the same key, sequence_id, offset."""

    pieces: DataFrame
    slots: DataFrame

    def placed(self, *columns: F.Column | str) -> DataFrame:
        """Columns of the pieces, with sequence_id and offset; name only what is needed."""
        key = ["task", "nth", "length"]
        return self.pieces.select(*key, *columns).join(self.slots, key).drop("task", "nth")

    def sequences(self) -> DataFrame:
        """sequence_id, ids: the ids of each whole sequence, in order of offset."""
        parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
        joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
        return self.placed("ids").groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", most: int = 2048
) -> Packed:
    """Pack whole documents into as few sequences of at most `most` ids as best fit gives.

    A document is its token ids and an id 0 at the end; longer ones are cut into
    pieces of `most`, the last one shorter. A null or empty text is the single id 0.
    Null keys and repeated rows are packed like others; other columns are not looked
    at. An empty table gives no pieces. Ranks within a length are counted per task
    of the staged table, so no length, however common, meets in one task.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    pieces = scratch.put(
        base.mapInArrow(
            lean(_cut(tokenizer, most), "tokens"),
            "task long, nth long, id long, piece int, start long, length long, ids binary",
        ),
        "pieces",
    )
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    by_task = scratch.put(by_task, "lengths")
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_best_fit(histogram, most)
    earlier = Window.partitionBy("length").orderBy("task")  # one row per length and task
    before = F.sum("n").over(earlier) - F.col("n")
    ranked = (
        pieces.select("task", "nth", "length")
        .join(by_task.withColumn("before", before).drop("n"), ["length", "task"])
        .select("task", "nth", "length", (F.col("before") + F.col("nth")).alias("rank"))
    )
    taken = ranked.mapInArrow(
        lean(_take(slots), "tokens"), "task long, nth long, length long, sequence_id long, offset long"
    )
    return Packed(pieces, taken)
