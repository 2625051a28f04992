"""Line dedup: exact and within a small edit distance, by a segment-partition join.

Two lines within `edits` byte edits, cut into edits + 1 even segments, share one
segment whole, at nearly the same place. Every line indexes its own segments and
probes, for each length not above its own, the substrings at which a shared
segment can lie (the multi-match-aware windows). Index and probes meet in a plain
join on a hash of substring, segment and length, with a bit sketch that no pair
within reach fails; banded bit-parallel edit distance then decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import Scratch, mark_bytes, mark_table, with_mark
from .words import mix, powers, slices, text_bytes
from .workers import lean

_NEWLINE = 0x0A
_LEAST = 20  # bytes; a shorter line is left alone
_FEW = 8  # lines of a key that all meet at once
_TURNS = 1  # most rounds that link lines of a common key to one drawn from them
_PAIR_BYTES = 1 << 21  # of padded lines whose distances are worked out together


def line_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line of the texts, and the text each belongs to.

    Lines are what stands between line feeds; a text without bytes is one empty line.
    """
    breaks = np.flatnonzero(data == _NEWLINE)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    # A line feed at the end of a text gives it an empty last line, which starts where
    # the next text does: count lines by text instead of searching for their starts.
    owner = np.repeat(
        np.arange(len(offsets) - 1), np.diff(np.searchsorted(breaks, offsets)) + 1
    )
    return starts, ends, owner


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = powers(max(len(data), 1))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of substrings."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _sketches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Parity of how often each byte value, modulo 64, occurs: an edit flips two bits at most."""
    bit = np.uint64(1) << (data & np.uint8(63)).astype(np.uint64)
    run = np.zeros(len(data) + 1, np.uint64)
    np.bitwise_xor.accumulate(bit, out=run[1:])
    return run[ends] ^ run[starts]


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Place and size of each of the edits + 1 segments of lines of these lengths."""
    parts = edits + 1
    size, longer = length // parts, length % parts  # the last ones are longer by one
    out, at = [], np.zeros_like(length)
    for k in range(parts):
        own = size + (k >= parts - longer)
        out.append((at, own))
        at = at + own
    return out


def probes(length: np.ndarray, edits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per shift and segment: shift, segment, places, sizes, and which lines probe there.

    A line of length n looks for lines of length n - shift. The window of segment k
    is the meet of the ones from the left and from the right side.
    """
    for shift in range(edits + 1):
        for k, (at, size) in enumerate(segments(length - shift, edits)):
            left, right = k, edits - k
            low = np.maximum(at - left, at + shift - right)
            high = np.minimum(at + left, at + shift + right)
            for step in range(2 * edits + 1):
                place = low + step
                fits = (place <= high) & (place >= 0) & (place + size <= length) & (length - shift > edits)
                if fits.any():
                    yield shift, k, place, size, fits


def _keys(role: str, edits: int, least: int) -> Callable:
    """Rows of (key, line, sketch): of lines as indexed, or as probing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in slices(offsets):
                part = offsets[first : last + 1]
                own = data[part[0] : part[-1]]
                starts, ends, _ = line_table(own, part - part[0])
                long = ends - starts >= least
                starts, ends = starts[long], ends[long]
                sums = _prefix_sums(own)
                line, once = np.unique(_hashes(sums, starts, ends), return_index=True)
                starts, ends = starts[once], ends[once]
                sketch, length = _sketches(own, starts, ends), ends - starts
                rows = []
                if role == "index":
                    for k, (at, size) in enumerate(segments(length, edits)):
                        key = _hashes(sums, starts + at, starts + at + size)
                        rows.append((mix(key + mix(length * 64 + k)), line, sketch))
                else:
                    for shift, k, place, size, fits in probes(length, edits):
                        begin = starts[fits] + place[fits]
                        key = _hashes(sums, begin, begin + size[fits])
                        key = mix(key + mix((length[fits] - shift) * 64 + k))
                        rows.append((key, line[fits], sketch[fits]))
                if rows:
                    columns = [np.concatenate(c).view(np.int64) for c in zip(*rows, strict=True)]
                    yield pa.record_batch([pa.array(c) for c in columns], names=["key", "line", "sketch"])

    return run


def _occurrences(least: int) -> Callable:
    """(r1, r2, order, nth, line) of every line that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in slices(offsets):
                part = offsets[first : last + 1]
                own = data[part[0] : part[-1]]
                starts, ends, owner = line_table(own, part - part[0])
                nth = np.arange(len(starts)) - np.searchsorted(owner, owner)
                long = np.flatnonzero(ends - starts >= least)
                line = _hashes(_prefix_sums(own), starts[long], ends[long]).view(np.int64)
                row = pa.array(first + owner[long])
                columns = [batch.column(c).take(row) for c in ("r1", "r2", "id")]
                yield pa.record_batch(
                    [*columns, pa.array(nth[long]), pa.array(line)], names=["r1", "r2", "order", "nth", "line"]
                )

    return run


def _texts_of(wanted, bits: int, least: int) -> Callable:
    """(line, bytes) of lines whose mark is set; once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in slices(offsets):
                part = offsets[first : last + 1]
                own = data[part[0] : part[-1]]
                starts, ends, _ = line_table(own, part - part[0])
                long = ends - starts >= least
                starts, ends = starts[long], ends[long]
                line, once = np.unique(_hashes(_prefix_sums(own), starts, ends), return_index=True)
                at = (line & np.uint64(bits - 1)).astype(np.int64)
                hit = np.flatnonzero((marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                texts = [own[starts[i] : ends[i]].tobytes() for i in once[hit]]
                yield pa.record_batch(
                    [pa.array(line[hit].view(np.int64)), pa.array(texts, pa.binary())], names=["line", "bytes"]
                )

    return run


def within_edits(left: list[bytes], right: list[bytes], edits: int) -> np.ndarray:
    """Whether each pair of byte strings is within so many insertions, deletions, changes.

    Bit-parallel in the band of 2 edits + 1 diagonals, for all pairs at once: bit k
    of a word stands for row column - edits + k of the usual table. Differences that
    leave the band count as one more, so a distance is never taken for less.
    """
    out = np.zeros(len(left), bool)
    pairs = [(b, a) if len(a) < len(b) else (a, b) for a, b in zip(left, right, strict=True)]
    near = [i for i, (a, b) in enumerate(pairs) if len(a) - len(b) <= edits]
    near.sort(key=lambda i: len(pairs[i][1]))
    while near:
        width = len(pairs[near[-1]][0]) + 2 * edits + 2
        some = max(1, _PAIR_BYTES // width)
        out[near[-some:]] = _banded([pairs[i] for i in near[-some:]], edits)
        near = near[:-some]
    return out


def _banded(pairs: list[tuple[bytes, bytes]], edits: int) -> np.ndarray:
    word, full = np.uint64, np.uint64((1 << (2 * edits + 1)) - 1)
    rows = np.array([len(a) for a, _ in pairs])
    columns = np.array([len(b) for _, b in pairs])  # ascending, and never above rows
    # Rows are the longer string, with other bytes around it, so that none matches outside.
    longer = np.full((len(pairs), rows.max() + 2 * edits + 2), 256, np.int16)
    shorter = np.full((len(pairs), max(columns.max(), 1)), 257, np.int16)
    for i, (a, b) in enumerate(pairs):
        longer[i, edits : edits + len(a)] = np.frombuffer(a, np.uint8)
        shorter[i, : len(b)] = np.frombuffer(b, np.uint8)
    up = np.full(len(pairs), int(full) & ~((1 << (edits + 1)) - 1), word)  # rows 1 and on of column 0
    down = np.zeros(len(pairs), word)
    middle = np.zeros(len(pairs), np.int64)  # the distance on the main diagonal
    one, top = word(1), word(1 << (2 * edits))
    for j in range(int(columns.max())):
        live = slice(int(np.searchsorted(columns, j, side="right")), None)
        vp, vn = (up[live] >> one) | top, down[live] >> one
        match = np.zeros(len(vp), word)
        for k in range(2 * edits + 1):
            match |= (longer[live, j + k] == shorter[live, j]).astype(word) << word(k)
        # Bit k is row j + 1 - edits + k, which stands at j + k of the padded string.
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        middle[live] += 1 - ((d0 >> word(edits)) & one).astype(np.int64)
        hp = ((hp << one) | one) & full
        up[live] = ((hn << one) | ~(d0 | hp)) & full
        down[live] = d0 & hp
    for k in range(1, edits + 1):  # from the diagonal down to the last row
        deeper = rows - columns >= k
        bit = word(edits + k)
        middle += deeper * (((up >> bit) & one).astype(np.int64) - ((down >> bit) & one).astype(np.int64))
    return middle <= edits


def _verify(edits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = within_edits(batch.column("x").to_pylist(), batch.column("y").to_pylist(), edits)
            keep = pa.array(near)
            yield pa.record_batch([batch.column(c).filter(keep) for c in "ab"], names=["a", "b"])

    return run


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose numbers are in `gone`."""
    for batch in batches:
        kept = []
        for text, gone in zip(batch.column("__text"), batch.column("__gone"), strict=True):
            text, gone = text.as_py(), gone.as_py()
            if gone:
                away = set(gone)
                lines = text.split("\n")
                text = "\n".join(x for k, x in enumerate(lines) if k not in away)
            kept.append(text)
        at = batch.schema.get_field_index("__text")
        yield batch.set_column(at, "__text", pa.array(kept, pa.string())).drop_columns(["__gone"])


_SHAPE = "key long, line long, sketch long"


def _meet(index: DataFrame, probing: DataFrame, edits: int, further: str = "true") -> DataFrame:
    """Pairs (a, b) of different lines that meet in a key and whose sketches allow a link."""
    a = index.withColumnsRenamed({c: f"{c}_a" for c in index.columns})
    b = probing.withColumnsRenamed({c: f"{c}_b" for c in probing.columns})
    near = f"line_a <> line_b AND bit_count(sketch_a ^ sketch_b) <= {2 * edits} AND {further}"
    met = a.join(b, (F.col("key_a") == F.col("key_b")) & F.expr(near))
    return met.select(F.least("line_a", "line_b").alias("a"), F.greatest("line_a", "line_b").alias("b")).distinct()


class _Lines:
    """Bytes of the lines that occur in pairs, looked up once."""

    def __init__(self, text: DataFrame, lines: DataFrame, scratch: Scratch, edits: int, least: int) -> None:
        self.edits, self.scratch = edits, scratch
        wanted, bits = mark_bytes(lines, "line")
        context = text.sparkSession.sparkContext
        wanted = context.broadcast(wanted)
        found = text.mapInArrow(lean(_texts_of(wanted, bits, least)), "line long, bytes binary")
        found = found.join(lines, "line", "left_semi").dropDuplicates(["line"])
        self.bytes = scratch.put(found, "texts")
        wanted.unpersist()

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are within reach."""
        x = self.bytes.select(F.col("line").alias("a"), F.col("bytes").alias("x"))
        y = self.bytes.select(F.col("line").alias("b"), F.col("bytes").alias("y"))
        near = pairs.join(x, "a").join(y, "b").mapInArrow(lean(_verify(self.edits)), "a long, b long")
        return self.scratch.put(near, "links")


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with the component of their line so far."""
    own = parts.select(F.col("id").alias("line"), "component")
    return rows.join(own, "line", "left").withColumn("component", F.coalesce("component", "line"))


def _still_open(members: DataFrame) -> DataFrame:
    """Keys whose lines are of several components, with the component of most lines."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    return (
        sizes.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("giant"), F.count("*").alias("kinds"))
        .where("kinds > 1")
        .select("key", "giant")
    )


def _apart(indexed: DataFrame, members: DataFrame, edits: int, scratch: Scratch) -> DataFrame:
    """All pairs of common keys that lie in different components.

    Sketches within reach agree in one of 2 * edits + 1 parts of their bits, which
    joins the key, so that lines which share little more than a segment do not meet. Lines
    of the component that holds most of a key never meet each other. Rows are dealt to
    their parts once, (2 * edits + 1) times the rows of open keys, whatever a key holds.
    """
    parts = 2 * edits + 1
    width = -(-64 // parts)
    part = F.expr(f"transform(sequence(0, {parts - 1}), p -> shiftrightunsigned(shiftleft(sketch, p * {width}), {64 - width}))")
    # A line finds itself, so an indexed row is a member's too, if its line is long enough to be found.
    rows = members.withColumn("indexed", F.lit(False)).unionByName(indexed.withColumn("indexed", F.lit(True)))
    rows = rows.groupBy("key", "line", "sketch", "component").agg(F.max("indexed").alias("indexed"))
    own = rows.join(_still_open(members), "key").withColumn("largest", F.col("component") == F.col("giant"))
    own = own.select("line", "sketch", "component", "largest", "indexed", "key", F.posexplode(part).alias("p", "bits"))
    own = own.select(F.xxhash64("key", "p", "bits").alias("key"), "line", "sketch", "component", "largest", "indexed")
    y = scratch.put(own, "dealt", narrow=True)
    x = y.where("indexed").drop("indexed")
    y = y.drop("indexed")
    differ = "component_a <> component_b"
    few = _meet(x.where("NOT largest"), y, edits, differ)
    return few.unionByName(_meet(x.where("largest"), y.where("NOT largest"), edits, differ)).distinct()


def similar_lines(base: DataFrame, scratch: Scratch, edits: int, least: int) -> DataFrame:
    """(id, component) of hashes of different lines that are within `edits` of each other.

    Where few lines share a key, all of them meet. In a key of more than _FEW lines they
    first meet one of them, then others drawn from those that still lie apart, as long as
    that links any; what lies apart in the end meets in full, on finer keys.
    """
    text = base.select("text")
    index = text.mapInArrow(lean(_keys("index", edits, least)), _SHAPE).distinct()
    index = scratch.put(index, "index", narrow=True)
    hub = F.min(F.struct("line", "sketch")).alias("hub")
    common = index.groupBy("key").agg(F.count("*").alias("n"), hub).where(F.col("n") > _FEW)
    common = scratch.put(common.select("key", "hub.line", "hub.sketch"), "common", narrow=True)
    probing = text.mapInArrow(lean(_keys("probe", edits, least)), _SHAPE)
    any_common = not common.isEmpty()
    few = index.join(common.select("key"), "key", "left_anti").unionByName(common) if any_common else index
    pairs = scratch.put(_meet(few, probing, edits), "pairs", narrow=True)
    lines = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    if not any_common:
        links = _Lines(text, lines, scratch, edits, least).links(pairs)
        return components(links, scratch)

    marked = with_mark(probing, mark_table(common, "key", hashed=False), F.col("key")).where("__hit").drop("__hit")
    members = scratch.put(marked.join(common.select("key"), "key", "left_semi").distinct(), "members", narrow=True)
    indexed = scratch.put(index.join(common.select("key"), "key", "left_semi"), "indexed", narrow=True)
    lines = lines.unionByName(members.select("line")).distinct()
    table = _Lines(text, scratch.put(lines, "lines", narrow=True), scratch, edits, least)
    links = table.links(pairs)
    parts = components(links, scratch)
    for turn in range(_TURNS):
        own = _placed(members, parts)
        apart = _placed(indexed, parts).join(_still_open(own), "key").where("component <> giant").drop("giant")
        order = F.xxhash64("line", F.lit(turn))
        hubs = apart.groupBy("key").agg(F.min_by(F.struct("line", "sketch", "component"), order).alias("hub"))
        met = _meet(hubs.select("key", "hub.*"), own, edits, "component_a <> component_b")
        found = table.links(scratch.put(met, "pairs", narrow=True))
        if found.isEmpty():
            break
        links = links.unionByName(found)
        parts = components(links, scratch)
    met = _apart(_placed(indexed, parts), _placed(members, parts), edits, scratch)
    found = table.links(scratch.put(met, "pairs", narrow=True))
    return parts if found.isEmpty() else components(links.unionByName(found), scratch)


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    edits: int = 2,
    least: int = _LEAST,
) -> DataFrame:
    """docs, each text without the lines that came before, with n_lines_removed.

    Lines of at least `least` bytes are alike if equal or within `edits` byte edits
    of each other, and so are chains of such lines. Of alike lines the first by key
    (null last) and place stays, wherever it is; the others go, in the same document
    too. Shorter lines stay. A null text stays null, a text of removed lines only is
    left empty, no row is dropped. Rows equal in key and text are one document: what
    stays in one stays in all. A column named n_lines_removed is replaced.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    own = docs.drop("n_lines_removed")
    r1, r2 = F.xxhash64(F.col(key), F.col(text)), F.xxhash64(F.lit(1), F.col(text), F.col(key))
    kind = own.select(key).schema[0].dataType.simpleString()
    base = own.select(r1.alias("r1"), r2.alias("r2"), F.col(key).alias("id"), F.col(text).alias("text"))
    base = base.where("text IS NOT NULL")
    alike = similar_lines(base, scratch, edits, least)
    found = base.mapInArrow(lean(_occurrences(least)), f"r1 long, r2 long, order {kind}, nth long, line long")
    found = scratch.put(found.distinct(), "found")
    found = found.join(alike, found["line"] == alike["id"], "left").select(
        "r1", "r2", "nth", "order", F.coalesce("component", "line").alias("line")
    )
    place = F.struct(F.col("order").isNull().alias("none"), "order", "r1", "r2", "nth")
    first = found.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    first = first.where("times > 1").select("line", "first.r1", "first.r2", "first.nth")
    repeated = found.join(first.select("line"), "line", "left_semi")
    gone = repeated.join(first.drop("line"), ["r1", "r2", "nth"], "left_anti")
    gone = gone.groupBy(F.col("r1").alias("__g1"), F.col("r2").alias("__g2")).agg(
        F.collect_list(F.col("nth").cast("int")).alias("__gone")
    )
    gone = scratch.put(gone, "gone")
    # Only documents that marks say may lose lines are moved.
    names = own.columns
    keyed = own.withColumn("__r1", r1).withColumn("__r2", r2)
    keyed = with_mark(keyed, mark_table(gone, "__g1", hashed=False), F.col("__r1"))
    still = keyed.where("NOT __hit").select(*names, F.lit(0).alias("n_lines_removed"))
    moved = (
        keyed.where("__hit")
        .join(gone, F.expr("__r1 = __g1 AND __r2 = __g2"), "left")
        .withColumn("n_lines_removed", F.expr("CASE WHEN __gone IS NULL THEN 0 ELSE size(__gone) END"))
        .select(*names, "n_lines_removed", F.col(text).alias("__text"), "__gone")
    )
    moved = moved.drop(text)
    rebuilt = moved.mapInArrow(lean(_rebuilt), moved.drop("__gone").schema)
    rebuilt = rebuilt.withColumnRenamed("__text", text).select(*names, "n_lines_removed")
    return still.unionByName(rebuilt)
