"""Ranked lexical search, reversed: the queries are indexed and the documents stream by.

The items (the query set) make an inverted index from term to items, which is broadcast
in blocks of bounded size. A first pass counts the terms of every whole document and
keeps those of the index; sums over it give the weights. A second pass streams these
counts through the index and updates one heap of bounded size per item and task. The
heaps are merged by two rounds of ranks. Nothing of a document but its id, length and
counts of indexed terms is written, and no text is moved.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cuts import as_strings, word_chunks
from .tables import Scratch
from .words import text_bytes

MOST = 10  # documents of an item
BLOCK_BYTES = 32 << 20  # text of the items of a block
_CELLS = 1 << 22  # scores, and contributions to them, held at once
_EXACT = 1 << 53

# Bytes that separate terms, all ASCII but letters and digits.
_APART = np.zeros(256, bool)
_APART[:0x80] = True
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def _terms(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """The terms of texts in order, with the place of their text, chunk by chunk."""
    data, offsets = text_bytes(column)
    for chunk in word_chunks(data, offsets, _APART, hashed=False):
        packed, places = chunk.packed()
        row = np.searchsorted(offsets, chunk.at + chunk.starts, side="right") - 1
        yield row, as_strings(packed, places[:-1], places[1:] - 1)


@dataclass
class ItemIndex:
    """Distinct terms of a block of items; items of term t: items[ends[t] : ends[t + 1]]."""

    ids: list[int | None]
    terms: pa.Array
    ends: np.ndarray
    items: np.ndarray


def index_items(rows: pa.Table) -> ItemIndex:
    """The index of a block (id, text); rows of one id are one item, null texts have no terms."""
    ids = list(dict.fromkeys(rows["id"].to_pylist()))
    place = {id_: k for k, id_ in enumerate(ids)}
    owner = np.array([place[i] for i in rows["id"].to_pylist()], np.int64)
    found, owners = [], []
    for row, terms in _terms(rows["text"].combine_chunks()):
        found.append(terms)
        owners.append(owner[row])
    if not found:
        return ItemIndex(ids, pa.array([], pa.large_string()), np.zeros(1, np.int64), np.zeros(0, np.int64))
    coded = pa.chunked_array(found).combine_chunks().dictionary_encode()
    pairs = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + np.concatenate(owners))
    ends = np.searchsorted(pairs, np.arange(len(coded.dictionary) + 1) * len(ids))
    return ItemIndex(ids, coded.dictionary, ends, pairs % len(ids))


def _count_terms(terms) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """id, n, terms, times: length of each text and how often it has the indexed terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexed = terms.value
        width = max(len(indexed), 1)
        for batch in batches:
            rows = batch.num_rows
            sizes = np.zeros(rows, np.int64)
            keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, found in _terms(batch.column("text")):
                sizes += np.bincount(row, minlength=rows)
                place = pc.index_in(found, value_set=indexed).fill_null(-1).to_numpy()
                key = row[place >= 0] * width + place[place >= 0]
                if not len(key):
                    continue
                low, cells = int(row[0]) * width, (int(row[-1] - row[0]) + 1) * width
                if cells <= 8 * len(key):
                    all_ = np.bincount(key - low, minlength=cells)
                    own = np.flatnonzero(all_)
                    keys.append(own + low)
                    counts.append(all_[own])
                else:
                    own, times = np.unique(key, return_counts=True)
                    keys.append(own)
                    counts.append(times)
            key, times = np.concatenate(keys), np.concatenate(counts)
            # A text that was cut into chunks has a term once per chunk.
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
            times = np.add.reduceat(times, first) if len(first) else times
            key = key[first]
            ends = np.searchsorted(key, np.arange(rows + 1) * width).astype(np.int32)
            columns = [
                batch.column("id"),
                pa.array(sizes),
                pa.ListArray.from_arrays(ends, pa.array((key % width).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "times"])

    return run


def _saturation(sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """m of each document, without overflow."""
    if len(sizes) and 90 * int(sizes.max()) * documents >= 1 << 63:
        return np.array([10 + 90 * int(n) * documents // words for n in sizes], np.int64)
    return 10 + 90 * sizes * documents // max(words, 1)


class _Heaps:
    """The best `most` rows (score, id) of every item so far."""

    def __init__(self, items: int, most: int) -> None:
        self.items, self.most = items, most
        self.item = self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)  # what a score must reach to matter

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """scores: a row per document, a column per item."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        score = np.r_[self.score, scores[row, item]]
        item = np.r_[self.item, item]
        id_, none = np.r_[self.id, ids[row]], np.r_[self.null, null[row]]
        order = np.lexsort((id_, none, -score, item))
        item, score, id_, none = item[order], score[order], id_[order], none[order]
        rank = np.arange(len(item)) - np.searchsorted(item, np.arange(self.items))[item]
        full = rank == self.most - 1
        self.least[item[full]] = score[full]
        kept = rank < self.most
        self.item, self.score, self.id, self.null = item[kept], score[kept], id_[kept], none[kept]


def _best_documents(
    index, weights, documents: int, words: int, most: int
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """item, id, score: the best documents of each item among those of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = index.value, weights.value
        width = len(own.ids)
        heaps, step = _Heaps(width, most), 64
        listed = np.diff(own.ends)
        longest = int(np.bincount(own.items, minlength=1).max()) if len(own.items) else 0
        exact = longest * 1_000_000 * int(weight.max(initial=0)) < _EXACT

        def scored(row: np.ndarray, term: np.ndarray, part: np.ndarray, rows: int) -> np.ndarray:
            reps = listed[term]
            from_ = np.repeat(own.ends[term] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
            cell = np.repeat(row * width, reps) + own.items[from_]
            if exact:  # sums of doubles below 2**53 lose nothing
                sums = np.bincount(cell, np.repeat(part, reps), minlength=rows * width).astype(np.int64)
            else:
                sums = np.zeros(rows * width, np.int64)
                np.add.at(sums, cell, np.repeat(part, reps))
            return sums.reshape(rows, width)

        for batch in batches:
            sizes = batch.column("n").to_numpy()
            m = _saturation(sizes, documents, words)
            lengths = pc.list_value_length(batch.column("terms")).to_numpy()
            term = pc.list_flatten(batch.column("terms")).to_numpy()
            times = pc.list_flatten(batch.column("times")).to_numpy()
            row = np.repeat(np.arange(len(sizes)), lengths)
            part = weight[term] * (1_000_000_000 * times // (1000 * times + 8 * m[row]))
            ends = np.r_[0, np.cumsum(lengths)]
            work = np.r_[0, np.cumsum(listed[term])][ends]
            null = batch.column("id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("id").fill_null(0).to_numpy()
            first = 0
            while first < len(sizes) and width:
                last = int(np.searchsorted(work, work[first] + _CELLS, side="right")) - 1
                last = max(first + 1, min(last, first + step, first + _CELLS // width, len(sizes)))
                part_ = slice(ends[first], ends[last])
                heaps.add(scored(row[part_] - first, term[part_], part[part_], last - first), ids[first:last], null[first:last])
                first, step = last, min(2 * step, _CELLS)
        names = pa.array(own.ids, pa.int64())
        columns = [names.take(pa.array(heaps.item)), pa.array(heaps.id, mask=heaps.null), pa.array(heaps.score)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "id", "score"])

    return run


def _weights(counts: DataFrame, width: int, documents: int) -> np.ndarray:
    """The weight of each indexed term, by the number of documents that hold it."""
    held = np.zeros(width, np.int64)
    found = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    held[found["term"].to_numpy()] = found["count"].to_numpy()
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def _block(docs: DataFrame, items: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """The best documents of one block of items, per task."""
    context = docs.sparkSession.sparkContext
    built = index_items(items.toArrow())
    terms, index = context.broadcast(built.terms), context.broadcast(built)
    counted = docs.mapInArrow(_count_terms(terms), "id long, n long, terms array<int>, times array<long>")
    counts = scratch.put(counted, "counts")
    size = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("words")).first()
    documents, words = size["documents"], size["words"] or 0
    weights = context.broadcast(_weights(counts, len(built.terms), documents))
    found = counts.mapInArrow(
        _best_documents(index, weights, documents, words, most), "item long, id long, score long"
    )
    found = scratch.put(found, "heaps", narrow=True)
    for broadcast in (terms, index, weights):
        broadcast.unpersist()
    return found


def search(docs: DataFrame, items: DataFrame, most: int = MOST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`item, rank, id, score`: the `most` documents (id, text) of highest score for each item (id, text).

    Ids are integers. A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))) over all
    documents with terms; a document of n terms, tf of them this one, adds
    w * (1000000000 * tf div (1000 * tf + 8m)) with m = 10 + 90 * n * N div L. Only
    scores above 0 count, equal ones in order of id, a null id last. A null text has no
    terms. Rows of one item id are one item, null among them; each row of docs is a
    document of its own, also if it repeats. Items beyond block_bytes of text are taken
    in blocks, each with passes of its own over docs.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select(F.col("id").cast("long").alias("id"), "text")
    items = items.select(F.col("id").cast("long").alias("id"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    found = reduce(
        DataFrame.unionByName,
        [_block(docs, items.where(block == k), scratch, most) for k in range(blocks)],
    )
    order = [F.desc("score"), F.asc_nulls_last("id")]
    for keys in (["item", F.pmod(F.xxhash64("id", "score"), F.lit(64))], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).where(F.col("rank") <= most)
    return found.select("item", "rank", "id", "score")


def _search_sql() -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    cut = f"unnest(regexp_extract_all(translate(text, {letters}), '{pattern}')) AS term"
    return f"""
WITH t AS (SELECT doc_id, {cut} FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
items AS (SELECT DISTINCT item_id, {cut} FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM items) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, s GROUP BY term),
parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS part
  FROM tf JOIN w USING (term) JOIN d USING (doc_id), s),
scores AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM parts JOIN items USING (term) GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, CAST(row_number() OVER i AS INTEGER) AS rank, doc_id, score
FROM scores WINDOW i AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER i <= 10"""


SEARCH_SQL = _search_sql()
