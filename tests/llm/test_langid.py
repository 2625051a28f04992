"""Language field: probabilities by enumeration, gradients by differences, held-out accuracy."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import langid
from pairloom.llm.langid import crf_gradient, fit_languages, forward_backward, training_sample
from pairloom.llm.queries import op13_language_id

SF = "/root/testdata/sf0.1"
SCHEMA = "id long, text string, lang string, score string, rank string"


def enumerated(scores, start, moves):
    """P(label) of each word over all label sequences."""
    n, labels = scores.shape
    total, mass = 0.0, np.zeros((n, labels))
    for path in itertools.product(range(labels), repeat=n):
        weight = start[path[0]] + sum(scores[t, y] for t, y in enumerate(path))
        weight = np.exp(weight + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        total += weight
        for t, y in enumerate(path):
            mass[t, y] += weight
    return mass / total, np.log(total)


def test_probabilities_by_enumeration(monkeypatch):
    monkeypatch.setattr(langid, "_BLOCK", 3)
    rng = np.random.default_rng(1)
    sizes = [1, 2, 3, 4, 6, 7, 9, 1]
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    scores, start, moves = rng.normal(size=(sum(sizes), 3)) * 2, rng.normal(size=3), rng.normal(size=(3, 3))
    got = forward_backward(scores, first, start, moves)
    want = [enumerated(scores[a : a + n], start, moves)[0] for a, n in zip(first, sizes, strict=True)]
    assert np.allclose(got, np.concatenate(want))


def test_long_sequences_as_by_single_steps():
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(5000, 4)) * 30  # far beyond what exp can hold in products
    start, moves = rng.normal(size=4), 3 * np.eye(4)
    alpha = [start + scores[0]]
    for row in scores[1:]:
        alpha.append(np.logaddexp.reduce(alpha[-1][:, None] + moves, axis=0) + row)
    beta = [np.zeros(4)]
    for row in scores[:0:-1]:
        beta.append(np.logaddexp.reduce(moves + row + beta[-1], axis=1))
    want = np.array(alpha) + np.array(beta[::-1])
    want = np.exp(want - np.logaddexp.reduce(want, axis=1, keepdims=True))
    assert np.allclose(forward_backward(scores, np.array([0]), start, moves), want, atol=1e-9)


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    scores, start, moves = rng.normal(size=(2, 4, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    gold = rng.integers(0, 3, size=(2, 4))
    loss, *slopes = crf_gradient(scores, gold, start, moves)
    want = sum(
        enumerated(scores[k], start, moves)[1]
        - start[y[0]] - scores[k][np.arange(4), y].sum() - moves[y[:-1], y[1:]].sum()
        for k, y in enumerate(gold)
    )
    assert np.isclose(loss, want)
    for value, slope in zip((scores, start, moves), slopes, strict=True):
        for at in np.ndindex(value.shape):
            value[at] += 1e-5
            up = crf_gradient(scores, gold, start, moves)[0]
            value[at] -= 2e-5
            down = crf_gradient(scores, gold, start, moves)[0]
            value[at] += 1e-5
            assert np.isclose((up - down) / 2e-5, slope[at], atol=1e-4)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("id"), "text", "lang")


@pytest.fixture(scope="module")
def model(docs):
    return fit_languages(docs.where("crc32(CAST(CAST(id AS STRING) AS BINARY)) % 3 <> 1"))


def test_held_out_accuracy(spark):
    got = op13_language_id(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(langs, "doc_id").toPandas()
    assert len(rows) == langs.count()
    fold = spark.range(len(rows)).selectExpr("id", "crc32(CAST(CAST(id AS STRING) AS BINARY)) % 3 = 1 AS held")
    assert dict(zip(rows.doc_id, rows.held_out, strict=True)) == {r.id: r.held for r in fold.collect()}
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.995
    assert rows.score.between(0, 1).all()


def test_code_switched_text(spark, docs, model):
    """Runs follow the switches of a text made of parts in several languages."""
    parts = {r.lang: r.text for r in docs.where("length(text) BETWEEN 400 AND 800").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    order = ["de", "en", "fr", "de", "es"]
    words = {k: [w for w in v.split() if w.isalpha()][:40] for k, v in parts.items()}
    mixed = " ".join(" ".join(words[k]) for k in order)
    row = model.predict(spark.createDataFrame([(1, mixed)], "id long, text string"), runs=True).first()
    sizes = [len(words[k]) for k in order]
    assert row.lang_pred == "de" and sum(r.words for r in row.runs) == sum(sizes)
    labels = [r.lang for r in row.runs for _ in range(r.words)]
    want = [k for k, n in zip(order, sizes, strict=True) for _ in range(n)]
    assert np.mean([a == b for a, b in zip(labels, want, strict=True)]) > 0.95
    assert len(row.runs) <= 2 * len(order)


def test_edge_texts(spark, model):
    long_ = "the and of with " * 60_000  # several sequences and chunks
    rows = [(1, None), (2, ""), (3, "12 .. -- 34"), (4, "—¿·"), (None, "the and of with"), (5, long_), (5, long_), (6, "x" * 70_000)]
    docs = spark.createDataFrame([(*r, "zz", "s", "r") for r in rows], SCHEMA)
    got = model.predict(docs, runs=True)
    assert got.columns == ["id", "text", "lang", "rank", "lang_pred", "score", "runs"]
    found = got.collect()
    assert [(r.lang_pred, r.score, r.runs) for r in found[:4]] == [("und", 0.0, [])] * 4
    assert found[4].lang_pred == "en" and found[5].lang_pred == "en" and found[5][4:] == found[6][4:]
    assert [(r.lang, r.words) for r in found[5].runs] == [("en", 240_000)]
    assert found[7].lang_pred in model.labels and sum(r.words for r in found[7].runs) == 1


def test_scores_do_not_depend_on_neighbours(monkeypatch, model):
    monkeypatch.setattr(langid, "_SEQUENCE", 50)
    texts = ["the and der die les une " * k for k in (0, 1, 7, 30, 2)] + [None, "und the"]
    whole = model.masses(pa.array(texts), True)
    for k, text in enumerate(texts):
        mass, runs = model.masses(pa.array([text], pa.string()), True)
        assert np.allclose(mass[0], whole[0][k]) and runs[0] == whole[1][k]


def test_sample_and_small_tables(spark, docs):
    rows = [(1, "the and of", "en", "s", "r"), (1, "the and of", "en", "s", "r"), (None, "der die", "de", "s", "r"), (2, "der die", None, "s", "r"), (3, None, "fr", "s", "r")]
    few = spark.createDataFrame(rows, SCHEMA)
    assert [(r.id, r.lang) for r in training_sample(few).orderBy("id").collect()] == [(1, "en"), (3, "fr")]
    one = fit_languages(few)
    assert one.labels == ["en"]
    got = {r.id: (r.lang_pred, r.score) for r in one.predict(few.where("id IS NOT NULL")).collect()}
    assert got == {1: ("en", 1.0), 2: ("en", 1.0), 3: ("und", 0.0)}
    none = fit_languages(few.limit(0))
    assert {r.lang_pred for r in none.predict(few).collect()} == {"und"}
    assert one.predict(few.limit(0)).collect() == []
    sample = training_sample(docs, 40, 200)
    counts = sample.groupBy("lang").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("size")).collect()
    assert {r.n for r in counts} == {10} and max(r.size for r in counts) <= 200
    again = training_sample(docs.repartition(9), 40, 200)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))
