"""Near-duplicate join on word shingles by token-combination prefixes.

Sets are hashes of distinct word shingles. All sets share one order of tokens:
light ones (rare by a count over all documents, low hash) by hash, then the
others by hash. Two sets of similarity t or more differ in at most
slack(x) = |x| - ceil(t|x|) tokens of either, so whichever prefix ends first
keeps a token, or a k-combination of tokens, that the other prefix holds too:

* a set with more than slack + 1 light tokens indexes its first slack + 2 of them, of
  which a linked set holds two, so that sets which share but one never meet further;
* any other set indexes all its light tokens, extends its prefix into the frequent
  ones and indexes pairs of those within small hash classes: n tokens of a class give
  n - 1 cover, and the prefix goes on until light tokens and cover exceed the slack.
  Two such sets meet in one token or one pair.

Sets of equal content are one from the start. Candidates pass a lossless parity
sketch and are then verified on the sets. Groups of frequent combinations are first
linked to their best member, each set in its largest group; where there are more rounds, one
member of each component goes on. Only members still apart meet as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import Scratch, mark_table, narrowed, with_mark
from .words import mix, shingle_sets
from .workers import lean

_COUNTERS = 1 << 21  # of the token counts, whatever the input
_CHUNK = 1 << 16
_LOW = np.uint64(1 << 62)  # light tokens lie below: a quarter of all, prefixes need a tenth
_LIGHT = 32  # documents a light token may have beyond the usual load of a counter
_BLOCK = 2048  # members of a combination that are compared in one task
_FIRST = 8  # combinations of a set by which pairs are told that meet in several
_STARS = 1  # rounds that link a group to its best member; each costs many small stages


def slack(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Tokens of a set of n that a set linked with it may lack."""
    return n - -(-n * percent // 100)


def _counter(low: np.ndarray) -> np.ndarray:
    """The counter of each low token: its leading bits."""
    return (low >> np.uint64(62 - _COUNTERS.bit_length() + 1)).astype(np.int64)


def _classes(level: int, percent: int) -> int:
    return max(1, -(-(slack(1 << level, percent) + 1) // 3))


def _levels(n: int, percent: int) -> list[int]:
    """Size levels of n and of all sizes that a linked set can have."""
    low, high = -(-n * percent // 100), n * 100 // percent
    return sorted({x.bit_length() - 1 for x in (low, n, high)})


def _parity_bits(n: int) -> int:
    return min(8192, max(64, 1 << (n // 2).bit_length()))


def _parity(tokens: np.ndarray) -> bytes:
    bits = _parity_bits(len(tokens))
    at = (tokens >> np.uint64(3)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _fold(parity: np.ndarray, to: int) -> np.ndarray:
    """Rows of parities made shorter: position modulo the new length."""
    while parity.shape[1] > to:
        half = parity.shape[1] // 2
        parity = parity[:, :half] ^ parity[:, half:]
    return parity


def _may_differ(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens in which linked sets of n and m may differ in all."""
    both = n + m
    return both - 2 * -(-percent * both // (100 + percent))


def _batch(schema: pa.Schema, columns: dict[str, list | np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _describe(size: int, percent: int) -> Callable:
    """Per document its size, fingerprint, first low tokens and parity; per task its counts."""
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("n", pa.int64()),
            ("print", pa.binary()),
            ("low", pa.binary()),
            ("parity", pa.binary()),
            ("chunk", pa.int32()),
            ("counts", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_COUNTERS, np.int32)
        for batch in batches:
            out: dict = {name: [] for name in schema.names}
            for tokens in shingle_sets(batch.column("text"), size):
                n = len(tokens)
                low = tokens[: np.searchsorted(tokens, _LOW)]
                np.add.at(counts, _counter(low), 1)
                first = 3 * (slack(n, percent) + 2) // 2 + 8
                out["n"].append(n)
                sums = np.array([mix(tokens).sum(), mix(~tokens).sum()], np.uint64)
                out["print"].append(sums.tobytes() + n.to_bytes(4, "little") if n else None)
                out["low"].append(low[:first].tobytes())
                out["parity"].append(_parity(tokens) if n else None)
            out["id"] = batch.column("id")
            out["chunk"] = out["counts"] = [None] * len(batch)
            yield pa.record_batch(
                [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in schema],
                schema=schema,
            )
        chunks = np.minimum(counts, 65535).astype(np.uint16).reshape(-1, _CHUNK)  # more is frequent anyway
        full = np.flatnonzero(chunks.any(1))
        empty = [None] * len(full)
        yield _batch(
            schema,
            {f: empty for f in schema.names}
            | {"chunk": full, "counts": [chunks[i].tobytes() for i in full]},
        )

    return run


def _sum_chunks(frame):
    total = sum(np.frombuffer(x, np.uint16).astype(np.uint32) for x in frame["counts"])
    return frame.head(1).assign(counts=[total.tobytes()])[["chunk", "counts"]]


def _token_counts(described: DataFrame) -> np.ndarray:
    """Counts over all documents; the counters have a fixed size, so this may be collected."""
    parts = (
        described.where("chunk IS NOT NULL")
        .select("chunk", (F.rand(7) * 16).cast("int").alias("salt"), "counts")
        .groupBy("chunk", "salt")
    )
    some = parts.applyInPandas(_sum_chunks, "chunk int, counts binary")
    counts = np.zeros(_COUNTERS, np.int64)
    for row in some.toLocalIterator():
        at = row["chunk"] * _CHUNK
        counts[at : at + _CHUNK] += np.frombuffer(row["counts"], np.uint32)
    return counts


_KEYS = "key long, id long, n long"


def _light_keys(counts, limit: float, percent: int) -> Callable:
    """Keys of the first light tokens; a row without key for a set that has too few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            keys, ids, sizes = [], [], []
            for i, n, low in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "low")), strict=True):
                tokens = np.frombuffer(low, np.uint64)
                need = slack(n, percent) + 2
                light = tokens[table[_counter(tokens)] < limit][:need]
                short = len(light) < need
                keys.append(np.zeros(1, np.int64) if short else light.astype(np.int64))
                ids.append(np.full(len(keys[-1]), i))
                sizes.append(np.full(len(keys[-1]), -n if short else n))
            if keys:
                yield pa.record_batch(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (keys, ids, sizes)],
                    names=["key", "id", "n"],
                )

    return run


def _extended_keys(counts, limit: float, size: int, percent: int) -> Callable:
    """Of sets short of light tokens: all their light keys, and pairs of frequent tokens.

    n of a light key is negative where the set has no more than the slack plus one.
    """
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("parity", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            for i, tokens in zip(batch.column("id").to_pylist(), shingle_sets(batch.column("text"), size), strict=True):
                n = len(tokens)
                low = tokens < _LOW
                light = np.zeros(n, bool)
                light[low] = table[_counter(tokens[low])] < limit
                need = slack(n, percent) + 1
                singles, rest = tokens[light][: need + 1], tokens[~light]
                keys = [singles.astype(np.int64)]
                for level in _levels(n, percent):
                    classes = _classes(level, percent)
                    some = rest[: max(need - len(singles), 0) + classes]
                    which = (mix(some) % np.uint64(classes)).astype(np.int64)
                    for c in np.unique(which):
                        own = mix(some[which == c] + np.uint64(level))
                        a, b = np.triu_indices(len(own), 1)
                        keys.append((mix(own[a] * np.uint64(3) + own[b]) | np.uint64(1 << 63)).astype(np.int64))
                key = np.concatenate(keys)
                parity = [None] * len(singles) + [_parity(tokens)] * (len(key) - len(singles))
                sizes = np.full(len(key), n)
                if len(singles) <= need:
                    sizes[: len(singles)] = -n
                yield _batch(schema, {"key": key, "id": np.full(len(key), i), "n": sizes, "parity": parity})

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of whole groups of a partition sorted by keys; a group may span batches."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        same = np.ones(len(table), bool)
        for key in keys:
            column = table.column(key).to_numpy()
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and len(rest):
        yield rest


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _light_pairs(percent: int) -> Callable:
    """a, b, weight: pairs within a light key, whose group is small by the count.

    A meeting of two sets short of light tokens (negative n) weighs 2, any other 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["key"]):
            key, ids, n = (table.column(c).to_numpy() for c in ("key", "id", "n"))
            short, n = n < 0, np.abs(n)
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            length = np.diff(np.r_[heads, len(key)])
            found, weights = [], []
            for m in np.unique(length[length > 1]):
                at = heads[length == m][:, None]
                x, y = np.triu_indices(int(m), 1)
                a, b = (at + x).ravel(), (at + y).ravel()
                close = np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent
                close &= ids[a] != ids[b]
                a, b = a[close], b[close]
                weights.append(1 + (short[a] & short[b]))
                found.append(np.stack([np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])], 1))
            if found:
                pairs, which = np.unique(np.concatenate(found), axis=0, return_inverse=True)
                weight = np.bincount(which.ravel(), np.concatenate(weights), len(pairs)).astype(np.int64)
                yield pa.record_batch(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(weight)], names=["a", "b", "weight"]
                )

    return run


def _parity_rows(parities: list[bytes], bits: int) -> np.ndarray:
    """Parities of one stored length each, folded to so many bits, as rows of bytes."""
    out = np.zeros((len(parities), bits // 8), np.uint8)
    lengths = np.array([len(p) for p in parities])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        rows = np.frombuffer(b"".join(parities[i] for i in at), np.uint8).reshape(len(at), -1)
        out[at] = _fold(rows, bits // 8)
    return out


def _passes(percent: int) -> Callable:
    """Pairs whose parities do not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            p, q = batch.column("p").to_pylist(), batch.column("q").to_pylist()
            bits = 8 * np.minimum([len(x) for x in p], [len(x) for x in q])
            apart = np.zeros(len(n), np.int64)
            for b in np.unique(bits):
                at = np.flatnonzero(bits == b)
                x = _parity_rows([p[i] for i in at], b) ^ _parity_rows([q[i] for i in at], b)
                apart[at] = np.bitwise_count(x).sum(1)
            keep = pa.array(apart <= _may_differ(n, m, percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], schema=_PAIR
            )

    return run


def _group_pairs(percent: int, stars: bool) -> Callable:
    """Of each block pair of a combination: pairs of different components that parities allow.

    With stars, only those of the member that has most. Without, a pair is left to the
    least of the first combinations that its members share, if they share any of these.
    """

    def elsewhere(key: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether pairs of members with these first combinations are found in a lesser one."""
        shared = np.where((x[:, :, None] == y[:, None, :]).any(2), x, np.iinfo(np.int64).max)
        return shared.min(1) < key

    def one(key, ids, n, comp, side, parities, firsts) -> np.ndarray:
        bits = 8 * min(map(len, parities))
        rows = _parity_rows(parities, bits)
        rows = np.ascontiguousarray(rows).view(np.uint64)
        found = []
        for first in range(0, len(ids), 256):
            x = slice(first, first + 256)
            apart = np.bitwise_count(rows[x, None] ^ rows[None]).sum(2, dtype=np.int64)
            fits = apart <= _may_differ(n[x, None], n[None], percent)
            fits &= np.minimum(n[x, None], n[None]) * 100 >= np.maximum(n[x, None], n[None]) * percent
            fits &= (comp[x, None] != comp[None]) & (ids[x, None] < ids[None])
            fits &= (side[x, None] != side[None]) | (side[x, None] == 2)
            own = np.argwhere(fits) + [first, 0]
            for k in range(0, len(own), 1 << 16):
                some = own[k : k + (1 << 16)]
                if not stars:
                    some = some[~elsewhere(key, firsts[some[:, 0]], firsts[some[:, 1]])]
                found.append(some)
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *found])
        if stars and len(pairs):
            hub = np.bincount(pairs.ravel(), minlength=len(ids)).argmax()
            pairs = pairs[(pairs == hub).any(1)]
        return ids[pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((0, 2), np.int64)
        for table in _groups(batches, ["key", "block"]):
            key, block = table.column("key").to_numpy(), table.column("block").to_numpy()
            heads = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
            for a, b in zip(heads, [*heads[1:], len(key)], strict=True):
                part = table.slice(a, b - a)
                ids, n, comp, side = (part.column(c).to_numpy() for c in ("id", "n", "comp", "side"))
                firsts = np.zeros((0, _FIRST), np.int64)
                if not stars:
                    firsts = np.frombuffer(b"".join(part.column("firsts").to_pylist()), ">i8").reshape(-1, _FIRST)
                parities = part.column("parity").to_pylist()
                seen = np.concatenate([seen, one(int(key[a]), ids, n, comp, side, parities, firsts)])
            if len(seen) > 1 << 16:
                seen = np.unique(seen, axis=0)
                yield pa.record_batch([pa.array(seen[:, 0]), pa.array(seen[:, 1])], schema=_PAIR)
                seen = seen[:0]
        seen = np.unique(seen, axis=0)
        yield pa.record_batch([pa.array(seen[:, 0]), pa.array(seen[:, 1])], schema=_PAIR)

    return run


def _sets_of(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [x.tobytes() for x in shingle_sets(batch.column("text"), size)]
            yield pa.record_batch([batch.column("id"), pa.array(sets, pa.binary())], names=["id", "tokens"])

    return run


def _verify(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], schema=_PAIR
            )

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that the sets confirm."""
    x = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(x, "a").join(y, "b").mapInArrow(lean(_verify(percent)), "a long, b long")


def _apart(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of combinations that still hold more than one component, in block pairs."""
    own = groups.join(parts, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    open_keys = (
        own.groupBy("key")
        .agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("members"))
        .where("x <> y")
        .select("key", F.expr(f"CAST(ceil(members / {_BLOCK}) AS INT)").alias("blocks"))
    )
    dealt = own.join(open_keys, "key").withColumn("mine", F.expr("CAST(pmod(xxhash64(id), blocks) AS INT)"))
    # Blocks i <= j meet in cell (i, j): a member joins every cell of its row and column.
    cells = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return cells.select(
        "key",
        F.expr("CAST(least(mine, other) AS LONG) * 1000000 + greatest(mine, other)").alias("block"),
        "id",
        "n",
        "comp",
        F.expr("CASE WHEN mine = other THEN 2 WHEN mine < other THEN 0 ELSE 1 END").alias("side"),
        "sid",
    )


def _first_keys(groups: DataFrame) -> DataFrame:
    """firsts: the least combinations of each set (sid), as bytes of one length.

    A set has a bounded number of combinations, so few that they are sorted by row.
    """
    least = F.slice(F.array_sort(F.collect_set("key")), 1, _FIRST)
    padded = F.concat(least, F.array_repeat(F.element_at(least, -1), _FIRST))
    parts = [F.unhex(F.lpad(F.hex(F.get(padded, F.lit(k))), 16, "0")) for k in range(_FIRST)]
    return groups.groupBy("sid").agg(F.concat(*parts).alias("firsts"))


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key reachable).

    Words are runs of bytes other than space and 09-0D of the text with A-Z
    lower-cased; a set holds the distinct shingles of `size` words, or the whole
    sequence if there are fewer. Documents link when 100 |x & y| >= percent |x | y|.
    A null text, or one without words, has 0 shingles and is linked with nothing.
    Rows with a null key get a null component. Rows of one key are one document:
    each links for it. Repeated rows stay repeated. Other columns are not looked at.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = scratch.put(
        base.mapInArrow(
            lean(_describe(size, percent)),
            "id long, n long, print binary, low binary, parity binary, chunk int, counts binary",
        ),
        "described",
    )
    rows = described.where("chunk IS NULL")
    prints = rows.where("n > 0 AND id IS NOT NULL").select("id", "print")
    same = prints.groupBy("print").agg(F.min("id").alias("first"), F.count("*").alias("times"))
    copies = prints.join(same.where("times > 1"), "print").where("id <> first")
    copies = scratch.put(copies.select(F.col("id").alias("a"), F.col("first").alias("b"), "print"), "copies")
    counts = _token_counts(described)
    load = counts.mean()
    limit = load + 2 * load**0.5 + _LIGHT
    counts = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))

    # A set this small is linked with equal sets only.
    least = next(n for n in range(1, 1000) if slack(n, percent) or n * 100 // percent > n)
    marked = with_mark(rows.where(f"n >= {least}"), mark_table(copies, "a", hashed=True), F.xxhash64("id"))
    wide = ["id", "n", "low", "parity"]
    firsts = marked.where("NOT __hit").select(wide).unionByName(
        marked.where("__hit").join(copies.withColumnRenamed("a", "id"), ["id", "print"], "left_anti").select(wide)
    )
    firsts = scratch.put(firsts.where("id IS NOT NULL"), "firsts")
    keys = scratch.put(
        firsts.select("id", "n", "low").mapInArrow(lean(_light_keys(counts, limit, percent)), _KEYS), "keys"
    )
    short = keys.where("n < 0").select("id").distinct()
    extended = scratch.put(
        narrowed(base.where("id IS NOT NULL"), short, "id").mapInArrow(
            lean(_extended_keys(counts, limit, size, percent)), f"{_KEYS}, parity binary"
        ),
        "extended",
    )
    counts.unpersist()
    light = keys.where("n > 0").unionByName(extended.where("parity IS NULL").select("key", "id", "n"))
    pairs = (
        light.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lean(_light_pairs(percent)), "a long, b long, weight long")
        .groupBy("a", "b")
        .agg(F.sum("weight").alias("weight"))
        .where("weight > 1")
        .select("a", "b")
    )
    pairs = scratch.put(pairs, "met", narrow=True)
    ends = scratch.put(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    near = scratch.put(narrowed(firsts.select("id", "n", "parity"), ends, "id"), "near")
    p = near.select(F.col("id").alias("a"), "n", F.col("parity").alias("p"))
    q = near.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("parity").alias("q"))
    pairs = pairs.join(p, "a").join(q, "b").mapInArrow(lean(_passes(percent)), "a long, b long")
    pairs = scratch.put(pairs, "pairs")

    # Groups are worked on without parities, which join where they are compared.
    whole = extended.where("parity IS NOT NULL").withColumn("sid", F.xxhash64("id", "n", "parity"))
    narrow = whole.select("key", "id", "n", "sid")
    many = narrow.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    groups = scratch.put(narrow.join(many, "key"), "groups", narrow=True)
    parities = whole.select("sid", "parity").join(groups.select("sid"), "sid", "left_semi")
    parities = scratch.put(parities.groupBy("sid").agg(F.min("parity").alias("parity")), "parities")

    wanted = (
        pairs.select(F.col("a").alias("id"))
        .unionByName(pairs.select(F.col("b").alias("id")))
        .unionByName(groups.select("id"))
        .distinct()
    )
    wanted = scratch.put(wanted, "wanted")
    sets = scratch.put(
        narrowed(base.where("id IS NOT NULL"), wanted, "id").mapInArrow(
            lean(_sets_of(size)), "id long, tokens binary"
        ),
        "sets",
    )
    links = scratch.put(_linked(pairs, sets, percent), "links")
    parts = components(links, scratch)

    def met_in(members: DataFrame, stars: bool) -> DataFrame:
        """Links between members of a group that lie in different components."""
        cells = _apart(members, parts).join(parities, "sid")
        if not stars:
            cells = cells.join(_first_keys(members), "sid")
        found = (
            cells.drop("sid")
            .repartition("key", "block")
            .sortWithinPartitions("key", "block")
            .mapInArrow(lean(_group_pairs(percent, stars)), "a long, b long")
            .distinct()
        )
        found = scratch.put(found, "found")
        ends = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        return scratch.put(_linked(found, narrowed(sets, ends, "id"), percent), "links")

    one = groups.groupBy("id").agg(F.max(F.struct("members", "key")).alias("at")).select("id", "at.key")
    groups = groups.drop("members")
    for turn in range(_STARS):
        if turn:  # one member of each component and group
            own = groups.join(parts, "id", "left").withColumn("comp", F.coalesce("component", "id"))
            drawn = F.min_by(F.struct("id", "n", "sid"), F.xxhash64("id", F.lit(turn)))
            some = own.groupBy("key", "comp").agg(drawn.alias("member")).select("key", "member.*")
        else:  # the largest group of each set
            some = groups.join(one, ["id", "key"])
        found = met_in(some, stars=True)
        if turn and found.isEmpty():
            break
        links = links.unionByName(found)
        parts = components(links, scratch)
    found = met_in(groups, stars=False)
    if not found.isEmpty():
        links = links.unionByName(found)
    parts = components(links.unionByName(copies.drop("print")), scratch)
    return (
        rows.select("id", "n")
        .join(parts, "id", "left")
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
