"""Near-duplicate vectors by hashed cells and collision counting, and nearest neighbours by multi-index hashing.

Both prepare vectors alike: a vector takes part if it is not null, has the usual
number of components, all of them finite, and is not zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import acos, ceil, comb, erf, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .components import components
from .tables import Scratch, mark_table, narrowed, with_mark
from .workers import hand_back, lean, turn_to

_SAMPLE = 4096  # vectors, those of the smallest hash of their id, on which models are fitted
_BLOCK = 4096  # vectors of a block, about, unless its group has more than 8 blocks; two blocks meet in one task
_NUMBERS = 1 << 21  # components of the vectors of a larger block, at most
_STRIP = 1 << 17  # pairs of rows of two blocks whose counts are held at a time
_PROJECTIONS = 24
_DENSE = 12  # projections counted for all pairs, before those out of reach are left out
_WIDTH = 3.0  # half a window, in standard deviations of the difference of a pair at the limit
_MISSED_CELL, _MISSED_SKETCH = 4e-5, 1e-5  # of pairs at the limit, by all tables and by the sketches of a length
_RECALL = 0.99996  # of pairs at the limit, by the collisions a pair needs: 0.9999 in all
_SKETCH, _SHARP = 128, 512  # bits, of all vectors and of those in large groups
_SHAPES = [(8,), (32,), (128,), (512,), (32, 128), (128, 128), (8, 64, 128), (32, 128, 128), (128, 128, 128)]
# Microseconds of an entry (its place on disk counted in), a cell, a pair of sketches, a pair of vectors.
_COPY, _CELL, _MEETING, _ALL_PAIRS = 24.0, 60.0, 0.008, 0.015
_PART = 1 << 24  # bytes of entries that one task takes, about
_LED, _LEADERS = 4096, 32  # rows of a cell beyond which leaders form groups first, and how many at once
_AT_ONCE = 1 << 17  # pairs of sketches held at a time
_CODE = 64


def usable(vectors: DataFrame, key: str, vector: str, kind: str = "array<double>") -> DataFrame:
    """(id, v) of the vectors that take part; v is in double precision, or as told."""
    v = F.col("v")
    own = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"))
    low, high, inf = F.array_min(v), F.array_max(v), float("inf")  # NaN counts as the largest
    fine = ~F.isnan(high) & (high < inf) & (low > -inf) & ((high > 0) | (low < 0))
    return own.where(F.col("id").isNotNull() & fine).where(~F.exists(v, lambda x: x.isNull()))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def sample_of(staged: DataFrame) -> np.ndarray:
    """At most _SAMPLE vectors, on which directions or codes are fitted."""
    rows = staged.orderBy(F.xxhash64("id"), "id").limit(_SAMPLE).select("v").toLocalIterator()
    return np.array([r["v"] for r in rows])


# --- near-duplicate vectors


def collisions_needed(count: int, half_width: float, recall: float) -> int:
    """Collisions of `count` windows that a pair at the limit reaches with that probability."""
    p = erf(half_width / sqrt(2))
    missed, needed = 0.0, 0
    while needed < count:
        missed += comb(count, needed) * p**needed * (1 - p) ** (count - needed)
        if missed > 1 - recall:
            break
        needed += 1
    return needed


def bits_apart(bits: int, cosine: float, missed: float) -> int:
    """Bits by which sketches of a pair at the limit differ at most, but for that probability."""
    p = acos(max(-1.0, min(1.0, cosine))) / pi
    within, limit = (1 - p) ** bits, 0
    while 1 - within > missed and limit < bits:
        limit += 1
        within += comb(bits, limit) * p**limit * (1 - p) ** (bits - limit)
    return limit


def _lean_group(run: Callable) -> Callable:
    """run, whose worker holds no more after a group than before."""

    def own(table: pa.Table) -> pa.Table:
        turn_to("")
        try:
            return run(table)
        finally:
            hand_back()

    return own


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def two_cells(levels: list[np.ndarray]) -> np.ndarray:
    """The two cells of each row: at each level the direction it leans to most, or against.

    Columns of a level are projections on random directions. In the second cell the
    level at which the choice was closest has the second direction.
    """
    n = np.arange(len(levels[0]))
    cells, gaps, steps = np.zeros(len(n), np.int64), [], []
    for projected in levels:
        size = np.abs(projected)
        first = size.argmax(1)
        most = size[n, first]
        size[n, first] = -1
        second = size.argmax(1)
        a, b = (2 * which + (projected[n, which] < 0) for which in (first, second))
        cells = cells * (2 * projected.shape[1]) + a
        steps = [step * (2 * projected.shape[1]) for step in steps] + [b - a]
        gaps.append(most - size[n, second])
    closest = np.argmin(gaps, axis=0)
    return np.stack([cells, cells + np.array(steps)[closest, n]], 1)


def shared_cell(shape: tuple[int, ...], cosine: float) -> float:
    """How likely a pair at the limit shares a cell: three deviations below what trials show.

    Projections on random directions have this law for every such pair, so it holds
    whatever the data.
    """
    trials, rng = 10_000, np.random.default_rng(sum(shape))
    one = [rng.standard_normal((trials, m), np.float32) for m in shape]
    other = [cosine * x + sqrt(max(0.0, 1 - cosine**2)) * rng.standard_normal(x.shape, np.float32) for x in one]
    a, b = two_cells(one), two_cells(other)
    p = float((a[:, :, None] == b[:, None]).any((1, 2)).mean())
    return p - 3 * sqrt(max(p * (1 - p), 1 / trials) / trials)


def hashing(sample: np.ndarray, total: int, cosine: float) -> tuple[tuple[int, ...], int]:
    """Directions of each level, and the number of tables; no tables: all pairs are dearer to avoid.

    The number of tables follows from the recall, whatever the data; the sample only
    tells which shape costs least.
    """
    best, cost = ((), 0), total * _ALL_PAIRS / 2
    units = _unit(np.unique(sample, axis=0)).astype(np.float32)
    rng = np.random.default_rng(7)
    for shape in _SHAPES:
        p = shared_cell(shape, cosine)
        if p <= 0.01:
            continue
        tables = max(1, ceil(log(_MISSED_CELL) / log(1 - p)))
        levels = [units @ rng.standard_normal((units.shape[1], m), np.float32) for m in shape]
        count = np.unique(two_cells(levels), return_counts=True)[1]
        room = int(np.prod([2 * m for m in shape]))
        chance = max((count * (count - 1.0)).sum() / max(1, len(units) * (len(units) - 1)), 4 / room)
        spent = tables * (2 * _COPY + total * chance / 2 * _MEETING + min(2.0, room / total) * _CELL)
        if spent < cost:
            best, cost = (shape, tables), spent
    return best


def _entries(directions, shape: tuple[int, ...], tables: int, bits: int, parts: int) -> Callable:
    """From vectors to packed rows (part, keys, ids, sketches): two cells a table and vector."""

    def packed(ids: np.ndarray, units: np.ndarray) -> pa.RecordBatch:
        own = directions.value
        sketches = np.packbits(units @ own[:bits].T >= 0, axis=1).view(np.uint64)
        keys = np.empty((len(ids), tables, 2), np.uint64)
        at = bits
        for table in range(tables):
            levels = []
            for m in shape:
                levels.append(units @ own[at : at + m].T)
                at += m
            keys[:, table] = two_cells(levels).astype(np.uint64) * np.uint64(tables) + np.uint64(table)
        keys = keys.reshape(-1)
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        keys = (keys >> np.uint64(32)).astype(np.uint32)  # cells that share a key only mean more candidates
        part = keys % np.uint32(parts)
        order = np.lexsort((keys, part))
        keys, part, row = keys[order], part[order], order // (2 * tables)
        heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        tails = np.r_[heads[1:], len(part)]
        columns = [[x[a:b].tobytes() for a, b in zip(heads, tails, strict=True)] for x in (keys, ids[row], sketches[row])]
        arrays = [pa.array(part[heads].astype(np.int32)), *[pa.array(c, pa.binary()) for c in columns]]
        return pa.record_batch(arrays, names=["part", "keys", "ids", "sketches"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if len(batch):
                rows = matrix(batch.column("v")).astype(np.float64)
                held.append((batch.column("id").to_numpy(), _unit(rows).astype(np.float32)))
            if sum(len(x) for x, _ in held) >= _BLOCK:
                yield packed(*map(np.concatenate, zip(*held, strict=True)))
                held = []
        if held:
            yield packed(*map(np.concatenate, zip(*held, strict=True)))

    return lean(run)


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of the links (a, b); root holds the smallest row of each tree."""
    a, b = root[a], root[b]
    while (apart := a != b).any():
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]
        a, b = root[a], root[b]


def _true_cells(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a table, faster where few are."""
    return np.divmod(np.flatnonzero(table), max(1, table.shape[1]))


def near_groups(sketches: np.ndarray, limits: list[int]) -> np.ndarray:
    """The smallest row that each row reaches over pairs of sketches so few bits apart.

    The first limit holds for the first _SKETCH bits, the last one for all bits. Of a large cell, rows around a few leaders form groups first; after that only members of
    different groups are compared, until the groups are one.
    """
    root, loose, groups = np.arange(len(sketches)), np.arange(len(sketches)), []

    def close(some: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = np.zeros((len(some), len(others)), np.uint8)
        for word in sketches.T[: _SKETCH // 64]:
            apart += np.bitwise_count(word[some, None] ^ word[None, others])
        a, b = _true_cells(apart <= limits[0])
        if len(limits) > 1:
            keep = np.bitwise_count(sketches[some[a]] ^ sketches[others[b]]).sum(1) <= limits[-1]
            a, b = a[keep], b[keep]
        return a, b

    free = np.ones(len(sketches), bool)
    while len(loose) > _LED:
        before = len(loose)
        for leader in loose[:: -(-before // _LEADERS)]:
            near = loose[close(np.array([leader]), loose)[1]] if free[leader] else loose[:0]
            if len(near) > 1:
                groups.append(near)
                _join_roots(root, near, np.full(len(near), leader))
                free[near] = False
                loose = loose[free[loose]]
        if len(loose) > 0.9 * before:
            break
    order = np.concatenate([loose, *groups])
    step = max(1, _AT_ONCE // max(1, len(order)))
    for top in range(0, len(loose), step):
        a, b = close(loose[top : top + step], order[top:])
        _join_roots(root, loose[top : top + step][a], order[top:][b])
    past = len(loose)
    for group in groups:
        past += len(group)
        step = max(1, _AT_ONCE // max(1, len(order) - past))
        for top in range(0, len(group), step):
            others = order[past:]
            others = others[root[others] != root[group[0]]]
            if not len(others):
                break
            a, b = close(group[top : top + step], others)
            _join_roots(root, group[top : top + step][a], others[b])
    return root


def _cell_links(bits: int, limits: list[int]) -> Callable:
    """Of the entries of a part: each vector with the first it reaches in a cell."""

    def run(table: pa.Table) -> pa.Table:
        keys, ids, sketches = (
            np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])
            for name, kind in (("keys", np.uint32), ("ids", np.int64), ("sketches", np.uint64))
        )
        order = np.lexsort((ids, keys))
        keys, ids, sketches = keys[order], ids[order], sketches.reshape(-1, bits // 64)[order]
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        found = [(ids[:0], ids[:0])]
        for head, tail in zip(heads, np.r_[heads[1:], len(keys)], strict=True):
            if tail - head > 1:
                root = near_groups(sketches[head:tail], limits)
                moved = np.flatnonzero(root != np.arange(len(root)))
                found.append((ids[head + moved], ids[head + root[moved]]))
        a, b = map(np.concatenate, zip(*found, strict=True))
        pairs = np.unique(np.stack([a, b], 1)[a != b], axis=0)
        return pa.table({"a": np.ascontiguousarray(pairs[:, 0]), "b": np.ascontiguousarray(pairs[:, 1])})

    return _lean_group(run)


def _windows(x: np.ndarray, y: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted y: the rank of each, and per x the first rank in its window and how many there are."""
    order = np.argsort(y, kind="stable")
    rank = np.empty(len(y), np.int32)
    rank[order] = np.arange(len(y))
    first = np.searchsorted(y[order], x - half, side="left").astype(np.int32)
    return rank, first, np.searchsorted(y[order], x + half, side="right").astype(np.int32) - first


def colliding(
    x: np.ndarray, y: np.ndarray, half: float, needed: int, whole: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of x and y (projections by column) that meet in enough windows, by strips of x.

    whole: x is y, and a pair counts once, with the later row second.
    """
    windows = [_windows(x[:, j], y[:, j], half) for j in range(x.shape[1])]
    spare = x.shape[1] - needed  # windows a pair may miss
    step = max(1, _STRIP // max(1, len(y)))
    for top in range(0, len(x), step):
        rows, past = slice(top, top + step), top if whole else 0
        missed = np.zeros((len(x[rows]), len(y) - past), np.uint8)
        for rank, first, many in windows[:_DENSE]:
            away = (rank[None, past:] - first[rows, None]).view(np.uint32)  # below 0 is far above
            missed += away >= many[rows, None].view(np.uint32)
        a, b = _true_cells(missed <= spare)
        left = missed[a, b]
        a, b = a + top, b + past
        if whole:
            a, b, left = a[b > a], b[b > a], left[b > a]
        for rank, first, many in windows[_DENSE:]:
            away = (rank[b] - first[a]).view(np.uint32)
            left = left + (away >= many[a].view(np.uint32))
            keep = left <= spare
            a, b, left = a[keep], b[keep], left[keep]
        yield a, b


def linked(units: np.ndarray, theirs: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs (a, b) reach the limit; a is a run of rows or few of them."""

    def each(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        for k in range(0, len(a), 1 << 15):
            part = slice(k, k + (1 << 15))
            out[part] = (units[a[part]] * theirs[b[part]]).sum(1) >= cosine
        return out

    rows = (int(a.min()), int(a.max()) + 1) if len(a) else (0, 0)
    if len(a) <= (rows[1] - rows[0]) * len(theirs) / 8:
        return each(a, b)
    # Products of whole strips differ from those of pairs in the last bits, so close ones are taken again.
    product = (units[rows[0] : rows[1]] @ theirs.T)[a - rows[0], b]
    out = product >= cosine
    close = np.flatnonzero(np.abs(product - cosine) < 1e-9)
    out[close] = each(a[close], b[close])
    return out


def _block_links(directions, half: float, needed: int, cosine: float) -> Callable:
    """Of a pair of blocks: links per vector, and each vector with the first it reaches."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, ids, weight = (table.column(c).to_numpy() for c in ("side", "id", "weight"))
        units = _unit(matrix(table.column("v").combine_chunks()).astype(np.float64))
        whole = bool((side == 2).any())
        own, other = (np.flatnonzero(side == k) for k in ((2, 2) if whole else (0, 1)))
        x, y = units[own] @ directions.value.T, units[other] @ directions.value.T
        degree, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        ours, theirs = units[own], units[other]
        for a, b in colliding(x, y, half, needed, whole):
            link = linked(ours, theirs, a, b, cosine)
            a, b = own[a[link]], other[b[link]]
            if len(a):
                for one, two in ((a, b), (b, a)):
                    degree += np.bincount(one, weights=weight[two], minlength=len(ids)).astype(np.int64)
                _join_roots(root, a, b)
        has, moved = degree > 0, root != np.arange(len(root))
        zeros = np.zeros(moved.sum(), np.int64)
        columns = ((ids[has], ids[moved]), (ids[has], ids[root[moved]]), (degree[has], zeros))
        return pa.table({name: np.concatenate(c) for name, c in zip("abn", columns, strict=True)})

    return _lean_group(run)


def similar_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95
) -> DataFrame:
    """One row per row of vectors: key, n_links, component_id, kept.

    Vectors link when their cosine, in double precision, reaches the limit. Vectors
    on the unit sphere are sorted by many one-dimensional projections; around each
    vector a window covers a link at the limit with a known probability, so the
    number of windows in which a linked pair must meet is set for a recall, whatever
    the data. Pairs with so many collisions are verified.

    So that far vectors never meet, each first lies in the two cells of every one of
    several tables that random directions give it. Within a cell vectors whose
    sketches are few bits apart form groups, groups are joined over all tables, and
    only vectors of one group meet in windows. Cells, sketches and windows together
    miss at most one of 10,000 links at the limit, and fewer of closer ones. Small
    groups share a block. A large one is cut into blocks by the main axis of the
    vectors; a window there that no link can leave says which of its blocks meet.
    Groups larger than a block are formed again by longer sketches. Only ids and
    sketches are moved to the cells; a vector is moved if it is in a group, once for
    each block that its own one meets. Equal vectors are compared once.

    Vectors that are null, zero or hold null or non-finite components have no links
    and are their own component. Rows of one key are one vector, the first by value:
    it is compared by each, and links to itself do not count; a null key has a null
    component. Vectors of another length than most link with nothing. Other columns
    are not looked at. The table is read several times rather than copied.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    held = vectors.schema[vector].dataType
    single = isinstance(getattr(held, "elementType", None), FloatType)
    own = usable(vectors, key, vector, "array<float>" if single else "array<double>")
    # Of the same values, 128 bits are the same.
    names = [F.col("id"), F.size("v").alias("n"), F.xxhash64("v").alias("h"), F.xxhash64("v", F.lit(1)).alias("g")]
    known = scratch.put(own.select(*names), "known", narrow=True)
    again = scratch.put(known.groupBy("id").count().where("count > 1").select("id"), "again")
    if not again.isEmpty():
        marked = with_mark(own, mark_table(again, "id", hashed=True), F.xxhash64("id"))
        few = marked.where("__hit").groupBy("id").agg(F.min("v").alias("v"))
        own = scratch.put(marked.where("NOT __hit").select("id", "v").unionByName(few), "vectors")
        known = scratch.put(own.select(*names), "known", narrow=True)
    lengths = known.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    width, total = (lengths["n"], lengths["count"]) if lengths else (1, 0)
    own, known = own.where(F.size("v") == width), known.where(F.col("n") == width).drop("n")
    equal = known.groupBy("h", "g").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    if cosine > 1 - 1e-9:
        equal = equal.where("false")  # the product of a vector with itself may fall short
    equal = scratch.put(known.join(equal, ["h", "g"]).select("id", "first", "copies"), "equal", narrow=True)
    rest = equal.where("id <> first").select("id")
    distinct, ids = own, known.select("id")
    if not rest.isEmpty():
        marked = with_mark(own, mark_table(rest, "id", hashed=True), F.xxhash64("id"))
        unsure = marked.where("__hit").select("id", "v").join(rest, "id", "left_anti")
        distinct = marked.where("NOT __hit").select("id", "v").unionByName(unsure)
        ids = ids.join(rest, "id", "left_anti")
        total -= rest.count()

    some = known.select("id").orderBy(F.xxhash64("id"), "id").limit(_SAMPLE)
    sample = sample_of(own.join(F.broadcast(some), "id", "left_semi"))
    shape, tables = hashing(sample, total, cosine) if total > _BLOCK else ((), 0)
    if tables:
        groups = _groups(distinct, total, width, cosine, shape, tables, [_SKETCH], scratch)
        large = groups.groupBy("component").count().where(F.col("count") > _BLOCK).select("component", "count")
        large = scratch.put(large, "large")
        again = large.agg(F.sum("count")).first()[0]
        if again:  # longer sketches tell apart what is only akin
            members = groups.join(F.broadcast(large), "component", "left_semi").select("id")
            sharp = _groups(narrowed(distinct, members, "id"), again, width, cosine, shape, tables, [_SKETCH, _SHARP], scratch)
            groups = groups.join(F.broadcast(large), "component", "left_anti").unionByName(sharp)
    else:
        groups = ids.withColumn("component", F.lit(0).cast("long"))
    groups = scratch.put(groups, "groups", narrow=True)

    rng = np.random.default_rng(20)
    directions = spark.sparkContext.broadcast(rng.standard_normal((_PROJECTIONS, width)))
    reach = sqrt(2 - 2 * cosine)
    needed = collisions_needed(_PROJECTIONS, _WIDTH, _RECALL)
    met = _meetings(own, groups, equal, sample, reach, scratch)
    found = met.groupBy("i", "j").applyInArrow(_block_links(directions, _WIDTH * reach, needed, cosine), "a long, b long, n long")
    found = scratch.put(found, "found")
    degrees = found.where("a = b").groupBy(F.col("a").alias("first")).agg(F.sum("n").alias("n"))
    parts = components(found.where("a <> b").select("a", "b"), scratch).withColumnRenamed("id", "first")
    every = vectors.select(F.col(key).cast("long").alias("id"))
    return (
        every.join(equal, "id", "left")
        .withColumn("first", F.coalesce("first", "id"))
        .join(degrees, "first", "left")
        .join(parts, "first", "left")
        .withColumn("component", F.coalesce("component", "first"))
        .select(
            F.col("id").alias(key),
            (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
            F.col("component").alias("component_id"),
            F.coalesce(F.col("component") == F.col("id"), F.lit(False)).alias("kept"),
        )
    )


def _groups(
    rows: DataFrame, count: int, width: int, cosine: float, shape: tuple[int, ...], tables: int, bits: list[int], scratch: Scratch
) -> DataFrame:
    """(id, component) of rows that share a cell with another one whose sketch is close."""
    spark = rows.sparkSession
    turns = [np.random.default_rng(31).standard_normal((bits[-1], width), np.float32)]
    turns.append(np.random.default_rng(30).standard_normal((tables * sum(shape), width), np.float32))
    size = count * tables * 2 * (12 + bits[-1] // 8)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(size / _PART))
    entries = rows.select("id", "v").mapInArrow(
        _entries(spark.sparkContext.broadcast(np.concatenate(turns)), shape, tables, bits[-1], parts),
        "part int, keys binary, ids binary, sketches binary",
    )
    links = _cell_links(bits[-1], [bits_apart(b, cosine, _MISSED_SKETCH) for b in bits])
    linked = entries.groupBy("part").applyInArrow(links, "a long, b long")
    return scratch.put(components(linked, scratch).select("id", "component"), "groups", narrow=True)


def _meetings(
    own: DataFrame, groups: DataFrame, equal: DataFrame, sample: np.ndarray, reach: float, scratch: Scratch
) -> DataFrame:
    """(i, j, side, id, weight, v): the vectors of two blocks that meet, or of one (side 2).

    Groups of up to a quarter of a block share blocks, by hash. One that is larger than a
    block is cut along the main axis of the vectors into runs, up to eight and then as many
    as memory asks for; a longer run, as many vectors lie at one place, is dealt out by id.
    """
    width = sample.shape[1] if len(sample) else 1
    most = max(_BLOCK, min(8 * _BLOCK, _NUMBERS // width))
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    large = scratch.put(sizes.where(F.col("n") > _BLOCK // 4), "large")
    small = groups.count() - (large.agg(F.sum("n")).first()[0] or 0)
    bins = max(1, -(-small // max(1, _BLOCK // 4)))
    dealt = groups.join(F.broadcast(large), "component", "left").join(
        equal.where("id = first").select("id", F.col("copies").alias("weight")), "id", "left"
    )
    bin_of = F.when(F.col("n").isNull(), F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(F.xxhash64("component"))
    dealt = dealt.withColumn("weight", F.coalesce("weight", F.lit(1).cast("long"))).withColumn("block", bin_of)

    def whole(some: DataFrame) -> DataFrame:
        hit = with_mark(own, mark_table(some, "id", hashed=True), F.xxhash64("id"))
        return hit.where("__hit").select("id", "v").join(some, "id")

    alike = [F.col("block").alias("i"), F.col("block").alias("j"), F.lit(2).alias("side"), "id", "weight", "v"]
    met = whole(dealt.where(f"n IS NULL OR n <= {_BLOCK}")).select(*alike)
    if large.where(F.col("n") > _BLOCK).isEmpty():
        return met

    if len(sample) > 1:
        centred = _unit(sample) - _unit(sample).mean(0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
    else:
        axis = np.eye(width)[0]
    main, v = F.array(*[F.lit(float(x)) for x in axis]), F.col("v").cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    place = F.aggregate(F.zip_with(v, main, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) / norm
    placed = scratch.put(whole(dealt.where(f"n > {_BLOCK}")).drop("block").withColumn("place", place), "placed")
    runs = f"greatest(least(ceil(n / {_BLOCK}), 8), ceil(n / {most}))"
    spans = placed.groupBy("component").agg(F.min("place").alias("from"), F.max("place").alias("to"))
    run = F.expr(f"coalesce(least({runs} - 1, floor((place - from) / nullif(to - from, 0) * {runs})), 0)")
    cut = placed.join(F.broadcast(spans), "component").withColumn("run", run).drop("from", "to")
    long = cut.groupBy("component", "run").agg(F.expr(f"ceil(count(*) / greatest({_BLOCK}, max(n) / max({runs})))").alias("cuts"))
    long = scratch.put(long, "runs")
    block = F.expr("xxhash64(component, run, pmod(xxhash64(id), cuts))")
    cut = cut.join(F.broadcast(long), ["component", "run"]).withColumn("block", block)
    # Blocks i <= j of a group meet if a link can reach from the one into the other.
    slack = reach * (1 + 1e-9) + 1e-9
    blocks = scratch.put(cut.groupBy("component", "block").agg(F.min("place").alias("low"), F.max("place").alias("high")), "blocks")
    strips = "explode(sequence(CAST(floor(low / {0!r}) AS INT), CAST(floor((high + {1!r}) / {0!r}) AS INT))) AS strip"
    i, j = (
        blocks.selectExpr("component", *[f"{c} AS {c}_{n}" for c in ("block", "low", "high")], strips.format(slack, more))
        for n, more in (("i", slack), ("j", 0.0))
    )
    near = f"low_j <= high_i + {slack!r} AND low_i <= high_j + {slack!r}"
    pairs = i.join(j, ["component", "strip"]).where(near)
    meets = scratch.put(
        pairs.select(F.least("block_i", "block_j").alias("i"), F.greatest("block_i", "block_j").alias("j")).distinct(), "meets"
    )
    sides = meets.select("i", "j", F.col("i").alias("block"), F.expr("IF(i = j, 2, 0)").alias("side")).unionByName(
        meets.where("i < j").select("i", "j", F.col("j").alias("block"), F.lit(1).alias("side"))
    )
    return met.unionByName(cut.join(sides, "block").select("i", "j", "side", "id", "weight", "v"))


# --- nearest neighbours


def fit_codes(sample: np.ndarray, bits: int = _CODE, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection of binary codes: main axes, turned until signs fit best.

    With fewer axes than bits further random turns of the same axes follow.
    """
    centre = sample.mean(0)
    centred = sample - centre
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    low = centred @ axes
    rng = np.random.default_rng(10)
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        turn = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
        for _ in range(rounds):
            signs = np.where(low @ turn >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(signs.T @ low)
            turn = (u @ w).T
        parts.append(axes @ turn)
    return centre, np.concatenate(parts, axis=1)[:, :bits]


def codes_of(rows: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes; each byte is a substring with an index of its own."""
    return np.packbits((rows - centre) @ projection >= 0, axis=1)


def fit_radius(sample: np.ndarray, codes: np.ndarray, k: int, recall: float) -> int:
    """Hamming radius that holds so many of the k nearest of sample queries.

    In the sample the k nearest are farther away than in the whole table, so the
    radius errs on the side of a higher recall.
    """
    queries = np.arange(0, len(sample), max(1, len(sample) // 256))
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    nearest = np.argsort(-scores, axis=1)[:, : min(k, len(sample) - 1)]
    apart = np.bitwise_count(codes[queries][:, None] ^ codes[nearest]).sum(2)
    return int(np.quantile(apart, recall, method="higher")) if apart.size else codes.shape[1] * 8


class SubstringIndex:
    """Multi-index over codes: for every byte of the code, rows by its value."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.heads = [np.searchsorted(codes[o, s], np.arange(257)) for s, o in enumerate(self.order)]
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))
        self.near = [[np.flatnonzero(apart[x] == r) for r in range(9)] for x in range(256)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row within the radius: a substring of it is within radius // substrings.

        By the pigeonhole principle; of the substrings only the first few, as many as
        the remainder plus one, are probed to the full quotient, the rest to one less.
        """
        each, full = divmod(radius, len(code))
        hit = np.zeros(len(self.codes), bool)
        for s, value in enumerate(code):
            for r in range(min(8, each if s <= full else each - 1) + 1):
                for x in self.near[value][r]:
                    hit[self.order[s][self.heads[s][x] : self.heads[s][x + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1) <= radius]


def _search(model, k: int) -> Callable:
    """The k best rows of a block for each query of a block of queries."""

    def run(frame):
        import pandas as pd

        centre, projection, radius = model.value
        rows = frame[~frame["asks"]].sort_values("id")
        asks = frame[frame["asks"]]
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(asks):
            ids, v = rows["id"].to_numpy(), np.stack(rows["v"].to_numpy())
            index = SubstringIndex(codes_of(v, centre, projection))
            queries = np.stack(asks["v"].to_numpy())
            for q, vector, code in zip(asks["id"], queries, codes_of(queries, centre, projection), strict=True):
                reach = radius
                near = index.within(code, reach)
                while (ids[near] != q).sum() < min(k, (ids != q).sum()):  # too few: look farther
                    reach += 2
                    near = index.within(code, reach)
                near = near[ids[near] != q]
                score = exact_products(v[near], vector)
                best = np.lexsort((ids[near], -score))[:k]
                out["query_id"] += [q] * len(best)
                out["vec_id"] += ids[near][best].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def exact_products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products, each summed on its own, so they do not depend on other rows."""
    return (rows * vector).sum(axis=1)


def nearest_vectors(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    recall: float = 0.98,
    block: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id, score: of each query its k nearest rows by inner product.

    Rotated binary codes are learned on at most 4096 vectors; every row gets a code,
    and its bytes are substrings with an index each. Probing them around the bytes of
    a query gives every code within a Hamming radius, set so that on the sample it
    holds `recall` of the k nearest; where a block has fewer than k, the radius
    grows. Rows and queries meet in blocks; the k best of each block are ranked over
    all blocks by the exact product on the vectors, ties to the smaller id, a query's
    own key left out. Null, zero or non-finite vectors and null keys take no part;
    of rows with one key the first by value counts; other lengths than most are left
    out. Fewer than k candidates are all returned.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)

    def once(table: DataFrame) -> DataFrame:
        return usable(table, key, vector).groupBy("id").agg(F.min("v").alias("v"))

    rows = scratch.put(once(vectors), "rows")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").collect()
    width, total = (lengths[0]["n"], lengths[0]["count"]) if lengths else (1, 0)
    rows = rows.where(F.size("v") == width)
    asks = scratch.put(once(queries).where(F.size("v") == width), "asks")
    sample = sample_of(rows)
    if len(sample) > 1:
        centre, projection = fit_codes(sample)
        radius = fit_radius(sample, codes_of(sample, centre, projection), k, recall)
    else:
        centre, projection, radius = np.zeros(width), np.zeros((width, _CODE)), _CODE
    model = spark.sparkContext.broadcast((centre, projection, radius))
    row_blocks = max(1, -(-total // block))
    ask_blocks = max(1, -(-asks.count() // block))

    def dealt(table: DataFrame, name: str, blocks: int, other: str, others: int, asking: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias(name)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other)
        return table.select("id", "v", F.lit(asking).alias("asks"), own, every)

    cells = dealt(rows, "r", row_blocks, "q", ask_blocks, False).unionByName(
        dealt(asks, "q", ask_blocks, "r", row_blocks, True)
    )
    found = cells.groupBy("r", "q").applyInPandas(_search(model, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
