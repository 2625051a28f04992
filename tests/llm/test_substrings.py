"""Repeated strings against a count of all strings."""

import hashlib
import random
from collections import Counter

import pytest

from pairloom.llm.queries import op6_suffix_dedup
from pairloom.llm.substrings import remove_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        spans = []
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        edges = [0, *[x for s in spans for x in s], len(d)]
        out.append((b"".join(d[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), spans))
    return out


def corpus(seed):
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("abcdé ", k=rng.choice([10, 39, 40, 41, 60, 150, 400]))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = ["".join(rng.choices("abcdé ", k=rng.choice([0, 1, 5, 30, 200]))) for _ in range(4)]
        texts.append("".join(x for p in parts for x in (p, rng.choice(pieces) if rng.random() < 0.4 else "")))
    texts += ["ab" * 300, "a" * 500, "x" * 40, "x" * 39, "", None, texts[3], texts[4] + "z", "y" + texts[4]]
    once = "".join(rng.choices("abcd", k=300))
    texts += [once[:200] + once[150:], "".join(rng.choices("ab", k=30_000))]
    return texts


@pytest.mark.parametrize("seed", range(2))
def test_removal_matches_a_count_of_all_strings(spark, seed):
    texts = corpus(seed)
    rows = [(i if i % 9 else None, t, "k", 1) for i, t in enumerate(texts)] + [(7, texts[7], "k", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, r1 int")
    got = remove_repeats(docs, length=40)
    assert got.columns == ["doc_id", "text", "r1", "kept", "spans"]
    want = sorted(((r[0], r[1], k, s) for r, (k, s) in zip(rows, brute([r[1] for r in rows], 40), strict=True)), key=str)
    have = sorted(((r.doc_id, r.text, bytes(r.kept), [list(s) for s in r.spans]) for r in got.collect()), key=str)
    assert have == want
    assert remove_repeats(docs.where("false")).collect() == []


def test_query_matches_a_count_of_all_strings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = brute([d.text for d in docs], 400)
    got = {r.doc_id: r for r in op6_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    for d, (kept, spans) in zip(docs, want, strict=True):
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(d.text.encode()), sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
