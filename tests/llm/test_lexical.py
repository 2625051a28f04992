"""Reversed search against a plain-Python score of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pairloom.llm import cuts, lexical
from pairloom.llm.lexical import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "id long, text string, score string, item string", "id long, text string, rank string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, most):
    counts = [(id_, Counter(terms(text))) for id_, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_words = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for id_, text in items:
        wanted.setdefault(id_, set()).update(terms(text))
    got = []
    for item, own in wanted.items():
        scores = []
        for (id_, c), n in zip(counts, sizes, strict=True):
            score = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_words)))
            if score > 0:
                scores.append((-score, id_ is None, id_ or 0))
        for rank, (score, none, id_) in enumerate(sorted(scores)[:most], 1):
            got.append((item, rank, None if none else id_, -score))
    return sorted(got, key=str)


def tables(seed, rows):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünder", "ÉÉ", "naïve", "日本", "A1", "x" * 50]
    odd = [" ", "\n", "-", "  ", "\x00", "_"]

    def text(most):
        return "".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))])[0] + rng.choice(odd) for _ in range(rng.randint(0, most)))

    docs = [(k, text(80)) for k in range(rows)]
    docs += [(None, docs[3][1]), (3, docs[3][1]), (7, None), (8, ""), (9, "w1 " * 40_000), (10, "...")]
    items = [(k, text(20)) for k in range(25)] + [(3, "w59 w58"), (None, "w5 w6"), (98, None), (99, "absent")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 25, 400])
def test_against_brute_force(spark, block_bytes):
    docs, items = tables(1, 400)
    got = search(
        spark.createDataFrame([(*d, "s", "i") for d in docs], DOCS).repartition(7),
        spark.createDataFrame([(*i, "r") for i in items], ITEMS),
        block_bytes=block_bytes,
    )
    assert got.columns == ["item", "rank", "id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 10)


def test_small_slices_and_ties(monkeypatch):
    """Heaps of one worker: chunks of 64 bytes, slices of few cells, many equal scores."""
    monkeypatch.setattr(cuts, "_CHUNK", 64)
    monkeypatch.setattr(lexical, "_CELLS", 50)
    docs, items = tables(2, 120)
    docs = [(1000 - i if i is not None else None, t) for i, t in docs] * 2

    class Held:
        def __init__(self, value):
            self.value = value

    index = lexical.index_items(pa.table({"id": pa.array([i for i, _ in items], pa.int64()), "text": [t for _, t in items]}))
    table = pa.table({"id": pa.array([i for i, _ in docs], pa.int64()), "text": [t for _, t in docs]})
    counted = list(lexical._count_terms(Held(index.terms))(table.to_batches(max_chunksize=9)))
    sizes = np.concatenate([b.column("n").to_numpy() for b in counted])
    assert sizes.tolist() == [len(terms(t)) for _, t in docs]
    df = Counter(t for b in counted for row in b.column("terms").to_pylist() for t in row)
    n = int((sizes > 0).sum())
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[k] + 1))) for k in range(len(index.terms))])
    want = sorted(brute(docs, items, 10), key=lambda r: (str(r[0]), r[1]))
    for exact in (1 << 53, 0):  # sums of doubles, and of integers
        monkeypatch.setattr(lexical, "_EXACT", exact)
        out = lexical._best_documents(Held(index), Held(weights), n, int(sizes.sum()), 10)
        best = [r for b in out(counted) for r in b.to_pylist()]
        best.sort(key=lambda r: (str(r["item"]), -r["score"], r["id"] is None, r["id"] or 0))
        assert [(r["item"], r["id"], r["score"]) for r in best] == [(a, c, d) for a, _, c, d in want]


def test_lengths_beyond_64_bits():
    sizes = np.array([1, 10**9], np.int64)
    got = lexical._saturation(sizes, 10**12, 10**16)
    assert got.tolist() == [10 + 90 * n * 10**12 // 10**16 for n in (1, 10**9)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "i")], DOCS)
    items = spark.createDataFrame([(1, "a", "r")], ITEMS)
    assert search(docs.limit(0), items).collect() == []
    assert search(docs, items.limit(0)).collect() == []
    assert [tuple(r) for r in search(docs, items).collect()] == brute([(1, "a b")], [(1, "a")], 10)
