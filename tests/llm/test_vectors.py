"""Vector dedup and search against all pairs."""

import threading

import numpy as np
import pytest

from pairloom.llm import vectors as V
from pairloom.llm.queries import op7_embedding_near_dedup, op10_nearest_neighbours

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, kept string, id int"


def brute_links(ids, rows, cosine):
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    link = (units @ units.T >= cosine) & (ids[:, None] != ids[None])
    comp = ids.copy()
    while True:
        low = np.minimum(comp, np.where(link, comp[None], np.iinfo(np.int64).max).min(1))
        if (low == comp).all():
            return link.sum(1), comp
        comp = low


def cloud(n, groups, rng):
    rows = rng.standard_normal((n, 16))
    centres = rng.integers(0, n, groups)
    for k in range(n // 2):
        rows[k] = rows[centres[k % groups]] + rng.standard_normal(16) * rng.choice([0, 0.03, 0.15, 0.25])
    return rows.astype(np.float32)


@pytest.mark.parametrize("block", [V._BLOCK, 64])
def test_links_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(V, "_BLOCK", block)
    rows = cloud(500, 9, np.random.default_rng(block))
    rows[:150] = rows[0] * np.linspace(1, 1e-20, 150)[:, None]  # one direction, a third of all
    ids = np.random.default_rng(1).permutation(500).astype(np.int64)
    table = [(int(i), r.tolist(), "x", 1) for i, r in zip(ids, rows, strict=True)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] * 8), (904, []), (905, [1.0]), (None, rows[0].tolist())]
    table += [(i, v, "x", 1) for i, v in odd] + [table[3], table[3]]
    got = V.similar_vectors(spark.createDataFrame(table, SCHEMA)).collect()
    degree, comp = brute_links(ids, rows.astype(np.float64), 0.95)
    want = {int(i): (int(d), int(c), bool(i == c)) for i, d, c in zip(ids, degree, comp, strict=True)}
    want |= {i: (0, i, True) for i in range(900, 906)} | {None: (0, None, False)}
    assert len(got) == len(table)
    have = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    close = np.abs(np.triu(unit_products(rows), 1) - 0.95).min()
    assert close > 1e-9
    assert have == want


def unit_products(rows):
    units = rows.astype(np.float64) / np.linalg.norm(rows.astype(np.float64), axis=1, keepdims=True)
    return units @ units.T


def check_links(spark, rows):
    ids = np.random.default_rng(2).permutation(len(rows)).astype(np.int64)
    table = [(int(i), r.tolist(), "x", 1) for i, r in zip(ids, rows, strict=True)]
    degree, comp = brute_links(ids, rows.astype(np.float64), 0.95)
    got = V.similar_vectors(spark.createDataFrame(table, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {int(i): (int(d), int(c)) for i, d, c in zip(ids, degree, comp, strict=True)}
    return degree


@pytest.mark.parametrize("shape", [(32,), (8, 64), (4, 8, 64)])
def test_hashed_cells_lose_no_link(spark, monkeypatch, shape):
    from math import ceil, log

    tables = ceil(log(V._MISSED_CELL) / log(1 - V.shared_cell(shape, 0.95)))
    monkeypatch.setattr(V, "hashing", lambda sample, total, cosine: (shape, tables))
    monkeypatch.setattr(V, "_BLOCK", 64)
    monkeypatch.setattr(V, "_LED", 32)
    monkeypatch.setattr(V, "_NUMBERS", 16 * 16)
    rows = cloud(700, 11, np.random.default_rng(5))
    rows[:200] = rows[0] + np.random.default_rng(6).standard_normal((200, 16)) * 0.1  # a group of several blocks
    rows[600:640] = rows[300]  # equal vectors
    degree = check_links(spark, rows)
    assert degree.max() >= 100 and (degree[600:640] >= 40).all()


def test_leaders_give_the_groups_of_all_pairs(monkeypatch):
    rng = np.random.default_rng(4)
    rows = cloud(900, 6, rng)
    for bits, limits in ((V._SKETCH, [30]), (V._SHARP, [30, 90])):
        signs = rows @ rng.standard_normal((16, bits)) >= 0
        apart = (signs[:, None] != signs[None]).reshape(900, 900, bits)
        close = (apart[:, :, : V._SKETCH].sum(2) <= limits[0]) & (apart.sum(2) <= limits[-1])
        want = np.arange(900)
        while True:
            low = np.where(close, want[None], 900).min(1)
            if (low == want).all():
                break
            want = low
        sketches = np.packbits(signs, axis=1).view(np.uint64)
        for led in (4096, 50):
            monkeypatch.setattr(V, "_LED", led)
            assert V.near_groups(sketches, limits).tolist() == want.tolist()


def test_disk_stays_near_the_size_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(V, "_BLOCK", 64)
    monkeypatch.setattr(V, "_ALL_PAIRS", 1.0, raising=False)
    rows = np.random.default_rng(8).standard_normal((4000, 16)).astype(np.float32)
    table = spark.createDataFrame([(i, r.tolist(), "x", 1) for i, r in enumerate(rows)], SCHEMA)
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def on_disk():
        held = files.getAllFiles().iterator()
        total = 0
        while held.hasNext():
            total += held.next().length()
        return total

    before, most, over = on_disk(), [0], threading.Event()

    def watch():  # Spark removes the files of a query at its end
        while not over.wait(0.1):
            try:
                most.append(on_disk() - before)
            except Exception:  # a file may go meanwhile
                continue

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert len(V.similar_vectors(table).collect()) == 4000
    finally:
        over.set()
        watcher.join()
    assert max(most) < 20 * rows.nbytes  # each block once went to every one it met


def test_needed_collisions_hold_the_recall():
    needed = V.collisions_needed(24, 3.0, 0.9999)
    rng = np.random.default_rng(0)
    hits = (np.abs(rng.standard_normal((200_000, 24))) <= 3.0).sum(1)
    assert 0 < needed < 24 and (hits >= needed).mean() >= 0.9998


def test_index_holds_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, (3000, 8)).astype(np.uint8)
    index = V.SubstringIndex(codes)
    for radius in (0, 5, 7, 16, 20, 27, 64):
        query = codes[5] ^ np.uint8(radius)
        apart = np.bitwise_count(codes ^ query).sum(1)
        assert index.within(query, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def true_nearest(ids, rows, asks, k):
    out = {}
    for q in asks:
        score = V.exact_products(rows, rows[ids == q][0])
        order = np.lexsort((ids, -score))
        out[int(q)] = [(int(ids[o]), score[o]) for o in order if ids[o] != q][:k]
    return out


def test_recall_of_the_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, rows = table.vec_id.to_numpy(), np.stack(table.embedding).astype(np.float64)
    want = true_nearest(ids, rows, ids[ids % 20 == 0], 20)
    got = {}
    for r in op10_nearest_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    shared = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert shared >= 0.95 * 20 * len(want)


def test_few_and_odd_candidates(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 2.0]), (3, [0.5, 2.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = V.nearest_vectors(table, table.where("vec_id IN (1, 4, 5)"), k=5).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 1.0), (1, 2, 3, 0.5)]
    assert V.nearest_vectors(table.where("false"), table.where("false")).collect() == []
    assert V.similar_vectors(table.where("false")).collect() == []


def test_query_links_match_all_pairs(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    ids, rows = table.vec_id.to_numpy(), np.stack(table.embedding).astype(np.float64)
    degree, comp = brute_links(ids, rows, 0.95)
    got = op7_embedding_near_dedup(spark, "/root/testdata/sf0.1").orderBy("vec_id").collect()
    order = np.argsort(ids)
    assert [(r.vec_id, r.n_links, r.component_id) for r in got] == list(zip(ids[order].tolist(), degree[order].tolist(), comp[order].tolist(), strict=True))
