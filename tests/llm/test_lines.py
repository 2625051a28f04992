"""Line dedup against all pairs of lines and the plain edit distance."""

import random
from collections import Counter

import numpy as np
import pytest

from pairloom.llm import lines
from pairloom.llm.lines import dedup_lines, line_table, probes, segments, within_edits
from pairloom.llm.queries import op8_line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, times):
    line = list(line)
    for _ in range(times):
        at = rng.randrange(len(line) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            line.insert(at, rng.choice("abé "))
        elif kind == 1 and line:
            del line[min(at, len(line) - 1)]
        elif line:
            line[min(at, len(line) - 1)] = rng.choice("abc ")
    return "".join(line)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_banded_distance(edits):
    rng = random.Random(edits)
    left, right = [], []
    for _ in range(1500):
        a = "".join(rng.choices("ab", k=rng.randrange(0, 25)))
        b = edited(rng, a, rng.randrange(5)) if rng.random() < 0.9 else "".join(rng.choices("ab", k=9))
        left.append(a.encode())
        right.append(b.encode())
    want = [distance(a, b) <= edits for a, b in zip(left, right, strict=True)]
    assert within_edits(left, right, edits).tolist() == want


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_probes_find_every_near_pair(edits):
    rng = random.Random(edits)
    for _ in range(400):
        a = "".join(rng.choices("ab", k=rng.randrange(8, 20)))
        b = edited(rng, a, edits).replace("é", "x")
        if len(a) < len(b):
            a, b = b, a
        if distance(a, b) > edits or len(b) <= edits:
            continue
        index = {(k, b[int(p[0]) : int(p[0] + n[0])]) for k, (p, n) in enumerate(segments(np.array([len(b)]), edits))}
        hits = [
            (k, a[int(p[0]) : int(p[0] + n[0])])
            for shift, k, p, n, fits in probes(np.array([len(a)]), edits)
            if fits[0] and shift == len(a) - len(b)
        ]
        assert index & set(hits), (a, b)


def test_line_table():
    texts = ["", "a\n", "b", "\n\n", "x\ny"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    starts, ends, owner = line_table(data, offsets)
    got = [(int(o), data[a:b].tobytes().decode()) for a, b, o in zip(starts, ends, owner, strict=True)]
    assert got == [(i, line) for i, t in enumerate(texts) for line in t.split("\n")]


def brute(rows, edits, least):
    """Rows of (key, kept text, removed)."""
    docs = sorted({r[:2] for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    lines = [(line.encode(), d, n) for d in docs for n, line in enumerate(d[1].split("\n")) if len(line.encode()) >= least]
    different = sorted({line for line, *_ in lines})
    root = {x: x for x in different}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    counts = {x: Counter(x) for x in different}
    for i, x in enumerate(different):
        for y in different[:i]:
            if abs(len(x) - len(y)) > edits or (counts[x] - counts[y]).total() > edits:
                continue  # an edit adds one byte value at most
            if distance(x, y) <= edits:
                root[find(x)] = find(y)
    seen, gone = set(), {}
    for line, d, n in lines:
        if find(line) in seen:
            gone.setdefault(d, set()).add(n)
        seen.add(find(line))
    out = []
    for key, text, *_ in rows:
        away = gone.get((key, text), ())
        kept = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in away)
        out.append((key, kept, len(away)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdé ", k=rng.choice([3, 19, 20, 30, 60]))) for _ in range(40)]
    pool += [edited(rng, rng.choice(pool), rng.choice([1, 1, 2, 3, 5])) for _ in range(120)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.choice([1, 2, 5])))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "\n\n"), (None, pool[3]), (93, "long line " * 20_000), rows[4], rows[4]]
    rows += [(94, "long line " * 30 + "x\nshort"), (95, "long line " * 30)]
    rng.shuffle(rows)
    return [(i, t, "k", i) for i, t in rows]


@pytest.mark.parametrize("seed, edits", [(1, 2), (2, 1)])
def test_dedup_matches_all_pairs(spark, seed, edits):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, line string, r1 long")
    got = dedup_lines(docs, edits=edits)
    assert got.columns == ["doc_id", "text", "line", "r1", "n_lines_removed"]
    assert sorted(((r[0], r[1], r[4]) for r in got.collect()), key=str) == brute(rows, edits, 20)
    assert dedup_lines(docs.where("false")).collect() == []


@pytest.mark.parametrize("few, turns", [(1, 0), (1, 6), (2, 1)])
def test_common_segments_meet_in_rounds(spark, monkeypatch, few, turns):
    """Nearly every key counts as common, and what the rounds leave meets on finer keys."""
    monkeypatch.setattr(lines, "_FEW", few)
    monkeypatch.setattr(lines, "_TURNS", turns)
    rng = random.Random(few + turns)
    stem = "a common stem of lines that "
    pool = [stem + "".join(rng.choices("abcd", k=6)) for _ in range(60)]  # share segments, seldom near
    pool += [edited(rng, "one line of which there are many near copies", rng.choice([1, 1, 2])) for _ in range(60)]
    pool += [edited(rng, rng.choice(pool), 1) for _ in range(30)]
    rows = [(i, "\n".join(rng.choices(pool, k=4)), "k", i) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line string, r1 long")
    got = [(r[0], r[1], r[4]) for r in dedup_lines(docs).collect()]
    assert sorted(got, key=str) == brute(rows, 2, 20)


@pytest.mark.parametrize("lines_of_key", [40, 160])
def test_rows_of_open_keys_are_dealt_once(spark, lines_of_key):
    """Lines that share one segment and nothing else: rows grow with them, not with their pairs."""
    from pyspark.sql import functions as F

    from pairloom.llm.tables import Scratch

    made = {}

    class Counted(Scratch):
        def put(self, df, name, narrow=False):
            made[name] = super().put(df, name, narrow)
            return made[name]

    rng = random.Random(lines_of_key)
    indexed = [(7, k, rng.getrandbits(63), k) for k in range(lines_of_key)]
    members = [*indexed, *((7, k, rng.getrandbits(63), k) for k in range(lines_of_key, 2 * lines_of_key))]
    near = (7, 10**6, indexed[3][2] ^ 0b101, 10**6)  # two bits from an indexed line
    shape = "key long, line long, sketch long, component long"
    x, y = spark.createDataFrame(indexed, shape), spark.createDataFrame([*members, near], shape)
    met = lines._apart(x, y, 2, Counted(spark)).collect()
    assert [(r.a, r.b) for r in met if r.b == 10**6] == [(3, 10**6)]
    assert made["dealt"].count() == 5 * (len(members) + 1)
    assert made["dealt"].where("indexed").agg(F.countDistinct("line")).first()[0] == len(indexed)


def test_query_covers_all_documents(spark):
    got = op8_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in got) == list(range(200))
    assert sum(r.n_lines_removed for r in got) > 0
