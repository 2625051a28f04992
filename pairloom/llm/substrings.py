"""Removal of repeated byte strings, by a Burrows-Wheeler table over anchors.

A byte string of the given length holds anchors: the places where the hash of a
short gram is least in a sliding window, which depend on the string alone. A text
becomes a sequence of symbols, one per anchor: gram and distance to the next. The
Burrows-Wheeler rows of all shards are one table: a suffix of symbols with the
symbol before it. A round of interleave refinement maps every row to the suffix one
symbol longer and joins shards on (symbol before, interval), so after h rounds rows
share an interval if their first h symbols agree: common prefixes are known without
sorting suffixes, and a row alone in its interval is done with. The order of the
intervals is not needed and not kept. Intervals with company give the candidates;
exact hashes settle what is repeated: first of all strings of an anchor at once,
then, only where runs of one gram differ, of fewer, and at last of single strings.
Of those only runs stay in question whose strings share the bytes that all of them cover.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lines import _hashes, _prefix_sums
from .tables import Scratch, mark_bytes, mark_table, with_mark
from .words import mix, slices, text_bytes

_ROUNDS = 2  # symbols that are compared before strings are; a third drops few rows more
_ROW = "r1 long, r2 long, nth long, gram long, gap long, first long, last long, anchor long, depth long, span long"
_GRAINS = (16, 1)  # places of the parts in which runs are looked at closer


def grams_for(length: int) -> tuple[int, int]:
    """Bytes of a gram, and places of a window, for strings of this length."""
    return max(4, length // 6), max(2, length // 3)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of places that share an anchor, over all texts.

    Yields arrays: text, first and last place of the run, the anchor, and prefix sums
    for hashes. A place is where a window starts that lies within its text.
    """
    gram, window = grams_for(length)
    n = len(data)
    sums = _prefix_sums(data)
    count = n - gram + 1
    if count < window:
        return np.zeros((4, 0), np.int64), sums
    at = np.arange(count)
    value = _hashes(sums, at, at + gram)
    value = (value & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    pad = -count % window
    table = np.concatenate([value, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, window)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    places = count - window + 1
    least = np.minimum(behind[:places], ahead[window - 1 : window - 1 + places])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # The last place of each text whose window still lies within it.
    ends = offsets[1:] - (window + gram - 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:places]
    valid = np.arange(places) <= ends[owner]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.r_[new[1:] | ~valid[1:], True])
    return np.stack([owner[first], first, stop, anchor[first]]), sums


def _slices(batch: pa.RecordBatch, length: int):
    data, offsets = text_bytes(batch.column("text"))
    for top, bottom in slices(offsets):
        part = offsets[top : bottom + 1] - offsets[top]
        own = data[offsets[top] : offsets[bottom]]
        yield top, own, part, *anchors(own, part, length)


def _grams(length: int) -> Callable:
    gram, _ = grams_for(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, (_, _, _, anchor), sums in _slices(batch, length):
                yield pa.record_batch([pa.array(_hashes(sums, anchor, anchor + gram).view(np.int64))], names=["gram"])

    return run


def _rows(length: int, repeated, bits: int) -> Callable:
    """Burrows-Wheeler rows of anchors whose gram may be repeated."""
    gram, window = grams_for(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(repeated.value, np.uint8)
        for batch in batches:
            for top, _, part, (owner, first, last, anchor), sums in _slices(batch, length):
                print_ = _hashes(sums, anchor, anchor + gram)
                nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
                gap = np.r_[anchor[1:] - anchor[:-1], 0] if len(anchor) else anchor
                # Symbols that every string starting in the run holds whole.
                reach = np.searchsorted(first, first + length - (window + gram - 1), side="right")
                stop = np.searchsorted(owner, owner, side="right")
                depth = np.minimum(reach, stop) - np.arange(len(owner))
                end = np.minimum(last, part[owner + 1] - length)  # last string that starts here
                some = end >= first
                span = np.zeros(len(owner), np.uint64)
                span[some] = _hashes(sums, first[some], end[some] + length)
                span = mix(span + (anchor - first).astype(np.uint64))
                bit = (print_ & np.uint64(bits - 1)).astype(np.int64)
                hit = np.flatnonzero((marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                start = part[owner]
                columns = [nth, print_.view(np.int64), gap, first - start, end - start, anchor - start, depth, span.view(np.int64)]
                rows = pa.array(top + owner[hit])
                yield pa.record_batch(
                    [batch.column("r1").take(rows), batch.column("r2").take(rows), *[pa.array(c[hit]) for c in columns]],
                    names=[f.split()[0] for f in _ROW.split(", ")],
                )

    return run


def _parts(length: int, grain: int) -> Callable:
    """Runs cut at fixed distances from their anchor, each part with the hash of its span.

    Every string of a part covers the same bytes around the anchor. They join the group
    of a part, so that one that stands alone with them is done with: no string of it
    is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], []
            for k, (text, runs) in enumerate(zip(batch.column("text"), batch.column("runs"), strict=True)):
                sums = _prefix_sums(np.frombuffer(text.as_buffer(), np.uint8))
                runs = runs.as_py()
                first, last, anchor, gram, copies = (
                    np.array([r[c] for r in runs], np.int64) for c in ("first", "last", "anchor", "gram", "copies")
                )
                far, near = (anchor - first) // grain, (anchor - last) // grain
                size = far - near + 1
                ends = np.cumsum(size)
                own = np.repeat(np.arange(len(runs)), size)
                part = far[own] - (np.arange(ends[-1]) - (ends - size)[own])
                begin = np.maximum(first[own], anchor[own] - part * grain - grain + 1)
                end = np.minimum(last[own], anchor[own] - part * grain)
                nearest = anchor[own] - part * grain  # the last place a part may have
                start = np.minimum(nearest, len(sums) - 1)
                core = _hashes(sums, start, np.maximum(start, nearest - grain + 1 + length))
                group = mix(mix(gram.view(np.uint64)[own] + mix(part.astype(np.uint64))) + core)
                span = mix(_hashes(sums, begin, end + length) + (anchor[own] - begin).astype(np.uint64))
                columns.append((group.view(np.int64), begin, end, anchor[own], span.view(np.int64), copies[own]))
                rows.append(np.full(len(own), k))
            if rows:
                row = pa.array(np.concatenate(rows))
                own = [pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)]
                yield pa.record_batch(
                    [batch.column("r1").take(row), batch.column("r2").take(row), *own],
                    names=["r1", "r2", "gram", "first", "last", "anchor", "span", "copies"],
                )

    return run


def _settled(found: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Runs whose whole span occurs again, and one of each kind where a gram has several.

    Only grams with a run that has no equal, but other runs beside it, stay open.
    """
    whole = found.groupBy("gram", "span").agg(
        F.sum("copies").alias("times"), F.min(F.struct("r1", "r2", "first", "last", "anchor")).alias("one")
    )
    whole = scratch.put(whole, "whole")
    sure = found.join(whole.where("times > 1").select("gram", "span"), ["gram", "span"], "left_semi")
    mixed = whole.groupBy("gram").agg(F.min("times").alias("least"), F.count("*").alias("kinds"))
    mixed = mixed.where("least = 1 AND kinds > 1").select("gram")
    ones = whole.join(mixed, "gram", "left_semi").select("gram", "one.*", F.least("times", F.lit(2)).alias("copies"))
    return sure.select("r1", "r2", "first", "last"), ones


def _removed(length: int) -> Callable:
    """Bytes left and spans removed, from the places where repeated strings start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for text, runs in zip(batch.column("__text"), batch.column("__runs"), strict=True):
                data = (text.as_py() or "").encode()
                merged: list[list[int]] = []
                for first, last in sorted((r["first"], r["last"]) for r in runs.as_py() or []):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last + length)
                    else:
                        merged.append([first, last + length])
                edges = [0, *[x for span in merged for x in span], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "stop": b} for a, b in merged])
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in ("__text", "__runs")]
            names = [n for n in batch.schema.names if n not in ("__text", "__runs")]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()), pa.array(spans, kind)], names=[*names, "kept", "spans"])

    return run


def repeated_runs(base: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """(r1, r2, first, last): runs of places of repeated strings, by row of base (r1, r2, text)."""
    grams = base.select("text").mapInArrow(_grams(length), "gram long")
    grams = scratch.put(grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "grams")
    marks, bits = mark_bytes(grams, "gram")
    marks = base.sparkSession.sparkContext.broadcast(marks)
    columns = [c.split()[0] for c in _ROW.split(", ")]
    table = base.mapInArrow(_rows(length, marks, bits), _ROW).groupBy(*columns).agg(F.count("*").alias("copies"))
    table = scratch.put(table.join(grams, "gram", "left_semi"), "rows")
    marks.unpersist()
    # Round 1: the interval of a row is its gram.
    interval = table.select("r1", "r2", "nth", "copies", F.col("gram").alias("interval"))
    found = None
    for h in range(1, _ROUNDS + 1):
        company = interval.groupBy("interval").agg(F.sum("copies").alias("c")).where("c > 1").select("interval")
        interval = scratch.put(interval.join(company, "interval", "left_semi"), f"round{h}")
        due = table.where(f"depth {'>=' if h == _ROUNDS else '='} {h} AND last >= first")
        here = due.join(interval.select("r1", "r2", "nth"), ["r1", "r2", "nth"], "left_semi")
        found = here if found is None else found.unionByName(here)
        if h < _ROUNDS:
            # The row before, by its symbol: gram and distance to the anchor after it.
            longer = interval.withColumn("nth", F.col("nth") - 1).join(
                table.select("r1", "r2", "nth", "gram", "gap"), ["r1", "r2", "nth"]
            )
            interval = longer.select("r1", "r2", "nth", "copies", F.xxhash64("gram", "gap", "interval").alias("interval"))
    found = scratch.put(found, "found")
    sure, ones = _settled(found, scratch)
    for grain in _GRAINS:
        per_text = ones.groupBy("r1", "r2").agg(
            F.collect_list(F.struct("gram", "first", "last", "anchor", "copies")).alias("runs")
        )
        per_text = scratch.put(per_text, "open")
        texts = with_mark(base, mark_table(per_text, "r1", hashed=False), F.col("r1")).where("__hit").drop("__hit")
        parts = texts.dropDuplicates(["r1", "r2"]).join(per_text, ["r1", "r2"]).mapInArrow(
            _parts(length, grain),
            "r1 long, r2 long, gram long, first long, last long, anchor long, span long, copies long",
        )
        more, ones = _settled(scratch.put(parts, "parts"), scratch)
        sure = sure.unionByName(more)
    return sure


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400
) -> DataFrame:
    """docs with kept (bytes left) and spans (removed: start, stop in bytes, maximal, ascending).

    Removed is every byte covered by a string of `length` bytes that starts anywhere
    else too, in the same text or another; overlaps count, strings do not cross texts
    and are judged on the input. Bytes are those of UTF-8; a null text is empty. Rows
    equal in key and text are two texts and repeat each other. Columns of docs with
    the names of the result are replaced; others stay.
    """
    scratch = Scratch(docs.sparkSession)
    own = docs.drop(*[c for c in ("kept", "spans") if c not in (key, text)])
    r1, r2 = F.xxhash64(F.col(key), F.col(text)), F.xxhash64(F.lit(1), F.col(text), F.col(key))
    base = own.select(r1.alias("r1"), r2.alias("r2"), F.col(text).alias("text")).where(F.octet_length("text") >= length)
    runs = repeated_runs(base, scratch, length)
    lists = runs.groupBy(F.col("r1").alias("__g1"), F.col("r2").alias("__g2")).agg(
        F.collect_list(F.struct("first", "last")).alias("__runs")
    )
    lists = scratch.put(lists, "lists")
    names = own.columns
    keyed = with_mark(
        own.withColumn("__r1", r1).withColumn("__r2", r2), mark_table(lists, "__g1", hashed=False), F.col("__r1")
    )
    still = keyed.where("NOT __hit").select(
        *names,
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("kept"),
        F.expr("CAST(array() AS array<struct<start: bigint, stop: bigint>>)").alias("spans"),
    )
    moved = keyed.where("__hit").join(lists, F.expr("__r1 = __g1 AND __r2 = __g2"), "left")
    moved = moved.select(*names, F.col(text).alias("__text"), "__runs")
    return still.unionByName(moved.mapInArrow(_removed(length), still.schema))
