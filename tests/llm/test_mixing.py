"""Mixing against a plain model in Python."""

import hashlib
import math
import random
import re

import pytest

from pairloom.llm.mixing import mix_sources

SCHEMA = "doc_id long, text string, source string, size string, copies long"


def model(rows, quality, weights=(3, 1, 2), share=1.5, passes=2):
    docs = []
    for i, text, source, *_ in rows:
        name = "" if i is None else str(i)
        u = (int(hashlib.md5(f"mix:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        w = max(quality.get(i, 1.0) or 0, 1e-6)
        docs.append((source, -math.log(u) / w, name, len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))))
    names = sorted({d[0] for d in docs}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(d[3] for d in docs if d[0] == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, room = {}, set(names), share * sum(size.values())
    while left:
        level = room / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] >= passes * size[s]}
        for s in over or left:
            target[s] = passes * size[s] if over else level * weight[s]
        room -= sum(target[s] for s in over)
        left -= over or left
    copies = {}
    for s in names:
        whole = int(target[s] // size[s]) if size[s] else 0
        rest, run = target[s] - whole * size[s], 0
        blocks = {}
        for d in docs:
            if d[0] == s:
                blocks[d[1:3]] = blocks.get(d[1:3], 0) + d[3]
        for block in sorted(blocks):
            run += blocks[block]
            copies[s, block] = whole + (run - blocks[block] / 2 <= rest)
    return [(d[0], d[3], size[d[0]], target[d[0]], copies[d[0], d[1:3]]) for d in docs]


@pytest.mark.parametrize("seed", range(3))
def test_mix_matches_the_model(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 5, 80]), rng.choice("aaaaabc") + "é" * rng.randint(0, 1), "x", 1) for i in range(200)]
    rows += [(300, None, None, "x", 1), (301, "long " * 30_000, None, "x", 1), (301, "again", None, "x", 1)]
    rows += [(None, "no key", "a", "x", 1), rows[5], (400, " ", "empty", "x", 1), (401, "q", "", "x", 1)]
    quality = {i: rng.choice([0.5, 2.0, None, -1.0]) for i in range(0, 200, 3)}
    weights = spark.createDataFrame(list(quality.items()), "id long, weight double")
    got = mix_sources(spark.createDataFrame(rows, SCHEMA), quality=weights).collect()
    assert {len(r) for r in got} == {8}
    key = lambda r: (r[0] or "", r[0] is None, *r[1:])
    want = sorted(model(rows, quality), key=key)
    have = sorted(((r.source, r.size, r.source_size, r.target, r.copies) for r in got), key=key)
    assert [w[:3] + w[4:] for w in want] == [h[:3] + h[4:] for h in have]
    assert [w[3] for w in want] == pytest.approx([h[3] for h in have])
    assert all(r.taken == r.copies * r.size for r in got)


def test_empty_tables(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    only = mix_sources(spark.createDataFrame([(1, " ", "a", "x", 1)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)]
