"""Near-duplicate join on word shingles against all pairs of plain Python sets."""

import random
import re

import pytest

from pairloom.llm import jaccard
from pairloom.llm.jaccard import similar_documents

SCHEMA = "doc_id long, text string, key string, n long"


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t, *_ in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(x), find(i)) for i, x in sets)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three four")]
    common = rng.choices(vocabulary, k=12)
    for base in range(30):
        words = rng.choices(vocabulary, k=rng.choice([5, 12, 40, 150, 400]))
        for _ in range(rng.choice([1, 2, 3, 6])):
            edited = list(words)
            for _ in range(rng.choice([0, 1, 2, 5])):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            if base % 3 == 0:
                edited += common
            rows.append((len(rows) + 1, " ".join(edited)))
    star = rng.choices(vocabulary, k=120)
    for _ in range(90):
        edited = list(star)
        for _ in range(rng.choice([0, 1, 2, 3, 8])):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        rows.append((len(rows) + 1, " ".join(edited)))
    rows += [(len(rows) + 1, rows[20][1]), rows[21], (len(rows) + 3, "x " * 30_000)]
    rng.shuffle(rows)
    return [(i, t, "k", 1) for i, t in rows]


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("light", [jaccard._LIGHT, -1])
def test_components_match_all_pairs(spark, monkeypatch, size, percent, light):
    """Also with every repeated token taken as frequent, and combinations cut in blocks."""
    if light < 0:
        monkeypatch.setattr(jaccard, "_LIGHT", 1)
        monkeypatch.setattr(jaccard, "_BLOCK", 16)
    rows = corpus()
    got = similar_documents(spark.createDataFrame(rows, SCHEMA), size=size, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == brute(rows, size, percent)


def test_null_key_and_empty_table(spark):
    rows = [(None, "a b c d e f g h", "k", 1), (7, "a b c d e f g h", "k", 1), (7, "z", "k", 1)]
    got = similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == [(7, 1, 7), (7, 4, 7), (None, 4, None)]
    assert similar_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tables_of_the_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = similar_documents(docs, size=3, percent=90).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 90)
