"""Quality grades by ordinal cumulative-link regression on hashed words.

P(grade <= k) = 1 / (1 + exp(score - threshold_k)), with one score for all grades:
the sum of the weights of the distinct words of a text, by 64-bit hash, and of
steps of simple shares (capitals, symbols, digits, repeated words). The weights
are fitted on a bounded sample of rated documents by proximal gradient steps, which
leave most at zero; scoring reads every document whole and moves no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import narrowed, text_batches
from .words import slices, text_bytes, words_of
from .workers import lean

GRADES = 3
KEEP_FROM = 0.4  # least probability of the highest grade with which a document stays

_APART = np.ones(256, bool)  # bytes that separate words: all but letters, digits, non-ASCII
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_STEPS = np.array([0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8])
_CLASSES = 5


def _byte_classes() -> np.ndarray:
    """0 letters and blanks, 1 capitals, 2 digits, 3 bars, 4 marks rare in prose."""
    classes = np.zeros(256, np.uint8)
    classes[0x41:0x5B] = 1
    classes[0x30:0x3A] = 2
    classes[ord("|")] = 3
    classes[[ord(c) for c in "!#$%&*+<=>@[]^_`{}~\\"]] = 4
    return classes


_CLASS = _byte_classes()
SHAPES = _CLASSES * len(_STEPS)


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct word hashes, ascending, and which share steps it reaches."""
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        own = data[part[0] : part[-1]]
        part = part - part[0]
        words, at = words_of(own, part, lower=True, blank=_APART)
        classes = _CLASS[own]
        shares = np.zeros((_CLASSES, len(part) - 1))
        for k in range(1, _CLASSES):
            run = np.r_[0, np.cumsum(classes == k)]
            shares[k - 1] = (run[part[1:]] - run[part[:-1]]) / np.maximum(np.diff(part), 1)
        for i in range(len(part) - 1):
            distinct = np.unique(words[at[i] : at[i + 1]])
            shares[-1, i] = 1 - len(distinct) / max(at[i + 1] - at[i], 1)
            yield distinct, (shares[:, i, None] >= _STEPS).ravel()


@dataclass
class GradeModel:
    """words: hashes with a weight, ascending; weights: theirs, then those of the share
    steps; thresholds: ascending, one less than there are grades."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, column: pa.Array) -> np.ndarray:
        """P(grade >= k) for k from 1, a row per text."""
        scores = np.zeros(len(column))
        shapes = self.weights[len(self.words) :]
        for i, (words, steps) in enumerate(features(column)):
            if len(self.words):
                place = np.searchsorted(self.words, words).clip(max=len(self.words) - 1)
                scores[i] = self.weights[place[self.words[place] == words]].sum()
            scores[i] += shapes[steps].sum()
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - scores[:, None], -50, 50)))

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """docs with expected_grade and at_least (array of P(grade >= k), k from 1).

        Columns of docs with these names are replaced. A null text scores like an
        empty one. No rows are dropped or moved.
        """
        text_batches(docs.sparkSession)
        model = docs.sparkSession.sparkContext.broadcast(self)
        own = docs.drop("expected_grade", "at_least")
        schema = T.StructType(list(own.schema.fields))
        schema.add("expected_grade", "double").add("at_least", T.ArrayType(T.DoubleType()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tail = model.value.at_least(batch.column(text))
                columns = [*batch.columns, pa.array(tail.sum(1)), pa.array(list(tail), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "expected_grade", "at_least"])

        return own.mapInArrow(lean(run), schema)


def fit_thresholds(grades: np.ndarray, levels: int) -> np.ndarray:
    """Thresholds without any feature, from the shares of the grades."""
    share = np.array([(grades <= k).mean() for k in range(levels - 1)]).clip(1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def ordinal_slopes(
    scores: np.ndarray, thresholds: np.ndarray, grades: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean of -log P(grade), and its slopes by each score and by each threshold.

    P(grade = k) is the rise of the cumulative probability from threshold k - 1 to k.
    """
    n, cuts = len(grades), len(thresholds)
    below = 1 / (1 + np.exp(-np.clip(thresholds - scores[:, None], -50, 50)))
    edges = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
    row = np.arange(n)
    low, high = edges[row, grades], edges[row, grades + 1]
    share = np.maximum(high - low, 1e-12)
    by_score = (1 - high - low) / n
    steep = np.concatenate([np.zeros((n, 1)), below * (1 - below), np.zeros((n, 1))], axis=1)
    by_cut = np.bincount(grades + 1, -steep[row, grades + 1] / share, cuts + 2)
    by_cut += np.bincount(grades, steep[row, grades] / share, cuts + 2)
    return float(-np.log(share).mean()), by_score, by_cut[1:-1] / n


def _fit(rows: np.ndarray, columns: np.ndarray, width: int, grades: np.ndarray, levels: int, steps: int, sparse: float):
    """Proximal Adam steps on the cumulative-link likelihood; rows ascending."""
    heads = np.searchsorted(rows, np.arange(len(grades)))
    ends = np.searchsorted(rows, np.arange(len(grades)), side="right")
    weights, thresholds = np.zeros(width), fit_thresholds(grades, levels)
    moments = [np.zeros(width), np.zeros(width), np.zeros(levels - 1), np.zeros(levels - 1)]
    for step in range(1, steps + 1):
        run = np.r_[0, np.cumsum(weights[columns])]
        scores = run[ends] - run[heads]
        _, pull, lift = ordinal_slopes(scores, thresholds, grades)
        slopes = (np.bincount(columns, np.repeat(pull, ends - heads), width), lift)
        rate = 0.1 * (1 - step / (steps + 1)) + 0.002
        for slope, k in zip(slopes, (0, 2), strict=True):
            moments[k] = 0.9 * moments[k] + 0.1 * slope
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * slope**2
            size = np.sqrt(moments[k + 1] / (1 - 0.99**step)) + 1e-6
            move = moments[k] / (1 - 0.9**step) / size
            if k:
                thresholds = np.sort(thresholds - rate * move)
            else:
                weights = weights - rate * move
                weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparse / size, 0)
    return weights, thresholds


def fit_grades(
    docs: DataFrame,
    ratings: DataFrame,
    levels: int,
    key: str = "doc_id",
    text: str = "text",
    most: int = 6000,
    most_words: int = 2048,
    least_documents: int = 8,
    steps: int = 150,
    sparse: float = 2e-4,
) -> GradeModel:
    """Fit on at most `most` rated documents, those of the smallest hash of their key.

    Of each, the `most_words` distinct words of smallest hash count, so at most 8 bytes
    times both bounds come to the driver. ratings: (id, grade), grades from 0 to levels - 1; a key rated more than once
    counts with its lowest grade, null keys or grades not at all. Words of fewer
    than `least_documents` sample documents get no weight. Without any rated
    document the model gives every text the highest grade.
    """
    rated = (
        ratings.where(f"id IS NOT NULL AND grade BETWEEN 0 AND {levels - 1}")
        .groupBy("id")
        .agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
        .withColumn("grade", F.col("grade").cast("int"))
    )
    texts = narrowed(docs.select(F.col(key).alias("__key"), F.col(text).alias("text")), rated.select("id"), "__key")
    texts = texts.dropDuplicates(["__key"]).join(rated, F.col("__key") == F.col("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(features(batch.column("text")))
            yield pa.record_batch(
                [
                    batch.column("id").cast(pa.string()),
                    batch.column("grade"),
                    pa.array([w[:most_words].tobytes() for w, _ in made], pa.binary()),
                    pa.array([s.tobytes() for _, s in made], pa.binary()),
                ],
                names=["id", "grade", "words", "steps"],
            )

    schema = "id string, grade int, words binary, steps binary"
    sample = sorted(texts.select("id", "grade", "text").mapInArrow(lean(run), schema).toLocalIterator(), key=lambda r: r["id"])
    if not sample:
        return GradeModel(np.zeros(0, np.uint64), np.zeros(SHAPES), np.full(levels - 1, -np.inf))
    grades = np.array([r["grade"] for r in sample])
    words = [np.frombuffer(r["words"], np.uint64) for r in sample]
    steps_reached = np.array([np.frombuffer(r["steps"], bool) for r in sample])
    known, count = np.unique(np.concatenate(words), return_counts=True)
    known = known[count >= least_documents]
    rows, columns = [], []
    for i, own in enumerate(words):
        place = np.searchsorted(known, own).clip(max=max(len(known) - 1, 0))
        hits = place[known[place] == own] if len(known) else place[:0]
        shape = len(known) + np.flatnonzero(steps_reached[i])
        rows.append(np.full(len(hits) + len(shape), i))
        columns.append(np.r_[hits, shape])
    weights, thresholds = _fit(
        np.concatenate(rows), np.concatenate(columns).astype(np.int64), len(known) + SHAPES, grades, levels, steps, sparse
    )
    used = np.flatnonzero(weights[: len(known)])
    return GradeModel(known[used], np.r_[weights[used], weights[len(known) :]], thresholds)


def document_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded ratings from the labels: 0 poor, 1 sound but toxic, 2 good."""
    grade = F.expr("CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IS NOT NULL")
    return labels.select(F.col("doc_id").alias("id"), grade.alias("grade"))


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with expected_grade, at_least and keep; the model is fitted on rated documents."""
    rated = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_grades(rated, document_grades(spark, sf_dir), GRADES)
    keep = F.element_at("at_least", GRADES - 1) >= KEEP_FROM
    return model.score(docs).withColumn("keep", keep)
