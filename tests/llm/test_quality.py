"""Quality grades: held-out accuracy, and the cumulative-link form."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pairloom.llm.quality import SHAPES, GradeModel, document_grades, fit_grades, ordinal_slopes
from pairloom.llm.queries import op4_quality_grades

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rated = document_grades(spark, SF)
    held = F.expr("pmod(xxhash64(id, 'fold'), 4) = 0")
    model = fit_grades(docs, rated.where(~held), 3)
    got = model.score(docs).join(rated.where(held), F.col("doc_id") == F.col("id")).toPandas()
    tail = np.array(got.at_least.tolist())
    assert (np.diff(tail, axis=1) <= 1e-12).all()
    assert np.allclose(got.expected_grade, tail.sum(1))
    keep = tail[:, 1] >= 0.4
    assert keep[got.grade == 2].mean() > 0.98
    assert keep[got.grade == 0].mean() < 0.1
    means = got.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2]


def test_score_is_the_sum_of_weights():
    model = GradeModel(np.zeros(0, np.uint64), np.zeros(SHAPES), np.array([-1.0, 0.5]))
    tail = model.at_least(pa.array([None, "", "a b"]))
    assert np.allclose(tail, 1 / (1 + np.exp([[-1.0, 0.5]] * 3)))


def test_slopes_of_the_cumulative_link_likelihood():
    rng = np.random.default_rng(4)
    scores, thresholds = rng.normal(size=9), np.array([-0.7, 0.2, 1.5])
    grades = np.array([0, 1, 2, 3, 0, 1, 2, 3, 3])
    loss, by_score, by_cut = ordinal_slopes(scores, thresholds, grades)
    edges = np.array([[0, *(1 / (1 + np.exp(s - thresholds))), 1] for s in scores])
    assert np.isclose(loss, -np.log(edges[range(9), grades + 1] - edges[range(9), grades]).mean())
    for value, slope in ((scores, by_score), (thresholds, by_cut)):
        for k in range(len(value)):
            value[k] += 1e-6
            up = ordinal_slopes(scores, thresholds, grades)[0]
            value[k] -= 2e-6
            down = ordinal_slopes(scores, thresholds, grades)[0]
            value[k] += 1e-6
            assert np.isclose((up - down) / 2e-6, slope[k], atol=1e-7)


def test_edge_tables(spark):
    schema = "doc_id long, text string, at_least int, other string"
    rows = [(1, None, 1, "a"), (1, None, 1, "a"), (None, "", 1, None), (2, "word " * 60_000, 1, "b")]
    docs = spark.createDataFrame(rows, schema)
    ratings = spark.createDataFrame([(1, None), (None, 2), (9, 1), (2, 7)], "id long, grade int")
    none = fit_grades(docs, ratings, 3).score(docs).collect()
    assert len(none) == 4 and {tuple(r.at_least) for r in none} == {(1.0, 1.0)}
    some = spark.createDataFrame([(2, 0), (2, 1), (1, 2)], "id long, grade int")
    model = fit_grades(docs, some, 3)
    assert model.score(docs).columns == ["doc_id", "text", "other", "expected_grade", "at_least"]
    assert model.score(docs.where("false")).collect() == []


def test_query_grades_every_document(spark):
    got = op4_quality_grades(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in got) == list(range(200))
