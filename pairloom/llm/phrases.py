"""Phrase collocations: depth-truncated suffix subtrees, built group by group.

Texts are strings of words cut into pieces, and every place in a piece starts a suffix
of at most `longest` words. Prefixes are partitioned first, by counts over all
documents: a suffix is cut before its first rare word and its first rare pair, as no
phrase with a rare part is frequent, and places whose first pair is rare start none.
What is left is dealt by its two-word prefix to groups of a memory budget; prefixes
above the budget are extended, that is dealt by the whole suffix. Each group sorts
its suffixes (Spark's sort, which spills) and reads the subtree off neighbours in
order: the count of a node is the total of its leaves. Only filters of bounded size
are broadcast; they tell what is rare by hashes, so a chance hit costs work and never
changes a count. All counts are of the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cuts import as_strings, word_chunks
from .tables import Scratch
from .words import mix, text_bytes

LONGEST = 4  # words of a phrase
GROUP = 1 << 20  # suffixes of a group
_HEAVY = 1 << 18  # most prefixes that may be extended: with more suffixes groups grow instead
_MARKS = 1 << 28  # most bits of a filter; at 16 bits an entry it then lets more rare ones pass
_KEPT = 1 << 19  # rows that a worker adds up before it hands them on

# Bytes that end a piece, and those that separate words within it.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _ENDS.copy()
_APART[[0x20, 0x09]] = True


@dataclass
class _Words:
    """Consecutive words: hash with language, piece, language code, packed bytes."""

    hashes: np.ndarray
    pieces: np.ndarray
    langs: np.ndarray
    data: np.ndarray
    places: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)

    def after(self, n: int) -> _Words:
        cut = self.places[n]
        return _Words(self.hashes[n:], self.pieces[n:], self.langs[n:], self.data[cut:], self.places[n:] - cut)

    def then(self, other: _Words) -> _Words:
        places = np.r_[self.places[:-1], other.places + self.places[-1]]
        own = [np.concatenate([a, b]) for a, b in ((self.hashes, other.hashes), (self.pieces, other.pieces), (self.langs, other.langs), (self.data, other.data))]
        return _Words(*own, places)


def _lang_codes(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """The language of each row as a place in names, which grows."""
    known = {name: k for k, name in enumerate(names)}
    for lang in pc.unique(batch.column("lang")).to_pylist():
        if lang not in known:
            known[lang] = len(names)
            names.append(lang)
    column = pa.array(names, batch.column("lang").type)
    return pc.index_in(batch.column("lang"), column).to_numpy(zero_copy_only=False)


def _worded(batch: pa.RecordBatch, names: list[str]) -> Iterator[_Words]:
    """The words of a batch of (lang, text), in chunks."""
    codes = _lang_codes(batch, names)
    salts = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names], np.uint64)
    data, offsets = text_bytes(batch.column("text"))
    ends = 0
    for chunk in word_chunks(data, offsets, _APART):
        passed = np.cumsum(_ENDS[chunk.data])
        doc = np.searchsorted(offsets, chunk.at + chunk.starts, side="right") - 1
        # Both numbers only grow, so the sum tells pieces and documents apart.
        pieces = ends + passed[chunk.starts] + doc
        ends += int(passed[-1])
        langs = codes[doc]
        yield _Words(mix(chunk.hashes ^ salts[langs]), pieces, langs, *chunk.packed())


def _with_next(batch: pa.RecordBatch, names: list[str], ahead: int) -> Iterator[tuple[_Words, int]]:
    """Words and how many of them start suffixes here: all have `ahead` words after them or no more."""
    left: _Words | None = None
    for words in _worded(batch, names):
        left = words if left is None else left.then(words)
        ready = max(len(left) - ahead, 0)
        yield left, ready
        left = left.after(ready)
    if left is not None:
        yield left, len(left)


class _Sums:
    """Rows added up by key in a worker, handed on when many."""

    def __init__(self, keys: list[str]) -> None:
        self.keys, self.parts, self.rows, self.limit = keys, [], 0, _KEPT

    def add(self, table: pa.Table) -> None:
        if table.num_rows:
            self.parts.append(table)
            self.rows += table.num_rows

    def _merge(self) -> pa.Table:
        table = pa.concat_tables(self.parts, promote_options="none")
        table = table.group_by(self.keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*self.keys, "n"])
        self.parts, self.rows = [table], table.num_rows
        return table

    def ready(self, done: bool = False) -> Iterator[pa.RecordBatch]:
        if self.parts and (done or self.rows > 2 * self.limit):
            table = self._merge()
            if done or self.rows > self.limit:
                self.parts, self.rows = [], 0
                yield from table.to_batches()


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n of texts."""
    sums, names = _Sums(["lang", "word"]), []
    for batch in batches:
        for words in _worded(batch, names):
            text = as_strings(words.data, words.places[:-1], words.places[1:] - 1)
            table = pa.table({"lang": words.langs, "word": text})
            table = table.group_by(["lang", "word"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["lang", "word", "n"])
            sums.add(table.set_column(0, "lang", pa.array(names, pa.string()).take(table["lang"])))
        for out in sums.ready():
            yield _plain(out)
    for out in sums.ready(done=True):
        yield _plain(out)


def _plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Large strings as plain ones."""
    return batch.cast(pa.schema([(f.name, pa.string() if pa.types.is_large_string(f.type) else f.type) for f in batch.schema]))


def _hash_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each (lang, word), as `_worded` has it."""
    names: list[str] = []
    for batch in batches:
        whole = pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("word")], names=["lang", "text"])
        for words in _worded(whole, names):
            yield pa.RecordBatch.from_arrays([pa.array(words.hashes.view(np.int64))], names=["h"])


@dataclass
class _Marks:
    """A bit for each hash: those without a mark are not among the hashes."""

    words: np.ndarray

    def hit(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes & np.uint64(64 * len(self.words) - 1)
        return (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _marks(hashes: DataFrame) -> _Marks:
    """Marks of column h; their size follows the number of hashes up to _MARKS bits."""
    bits = 1 << 16
    count = hashes.count()
    while bits < min(16 * count, _MARKS):
        bits *= 2
    bit = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = (
        hashes.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("marks"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["marks"].to_numpy().view(np.uint64)
    return _Marks(words)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _pairs(words: _Words, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word the hash of it with the next, and whether both are frequent and of one piece."""
    n = len(words)
    hashes, joined = np.zeros(n, np.uint64), np.zeros(n, bool)
    hashes[:-1] = _pair(words.hashes[:-1], words.hashes[1:])
    joined[:-1] = (words.pieces[:-1] == words.pieces[1:]) & frequent[:-1] & frequent[1:]
    return hashes, joined


def _counter_of_pairs(marks) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """h, n: places of each pair of frequent words, by hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            hashes = np.concatenate([h for h, _ in found])
            counts = np.concatenate([n for _, n in found])
            order = np.argsort(hashes)
            hashes, counts = hashes[order], counts[order]
            first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            return hashes[first], np.add.reduceat(counts, first)

        def out(done: bool) -> Iterator[pa.RecordBatch]:
            nonlocal found, rows
            if found and (done or rows > 4 * _KEPT):
                found = [merged()]
                rows = len(found[0][0])
                if done or rows > 2 * _KEPT:
                    hashes, counts = found[0]
                    for k in range(0, rows, 1 << 16):
                        columns = [pa.array(hashes[k : k + (1 << 16)].view(np.int64)), pa.array(counts[k : k + (1 << 16)])]
                        yield pa.RecordBatch.from_arrays(columns, names=["h", "n"])
                    found, rows = [], 0

        for batch in batches:
            for words, ready in _with_next(batch, names, 1):
                hashes, joined = _pairs(words, marks.value.hit(words.hashes))
                hashes, counts = np.unique(hashes[:ready][joined[:ready]], return_counts=True)
                if len(hashes):
                    found.append((hashes, counts.astype(np.int64)))
                    rows += len(hashes)
            yield from out(done=False)
        yield from out(done=True)

    return run


def _suffixes(marks, pair_marks, heavy, longest: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, suffix, prefix, split, n: truncated suffixes that start with a frequent pair.

    prefix: a hash by which the suffix is dealt; split: whether its first pair is over
    the budget, so that its suffixes are dealt apart.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, names = _Sums(["lang", "suffix", "prefix", "split"]), []
        for batch in batches:
            for words, ready in _with_next(batch, names, longest):
                hashes, joined = _pairs(words, marks.value.hit(words.hashes))
                joined &= pair_marks.value.hit(hashes)
                first = np.flatnonzero(joined[:ready])
                if not len(first):
                    continue
                depth = np.full(len(first), 2)
                prefix = hashes[first]
                split = np.zeros(len(first), bool)
                if len(heavy.value):
                    place = np.searchsorted(heavy.value, prefix).clip(max=len(heavy.value) - 1)
                    split = heavy.value[place] == prefix
                going = np.ones(len(first), bool)
                for k in range(1, longest - 1):
                    next_ = (first + k).clip(max=len(words) - 1)
                    going &= joined[next_] & (first + k < len(words))
                    depth[going] += 1
                    more = going & split
                    prefix[more] = _pair(prefix[more], words.hashes[(first + k + 1).clip(max=len(words) - 1)][more])
                text = as_strings(words.data, words.places[first], words.places[first + depth])
                columns = {"lang": words.langs[first], "suffix": text, "prefix": prefix.view(np.int64), "split": split}
                keys = list(columns)
                table = pa.table(columns).group_by(keys, use_threads=False).aggregate([([], "count_all")]).rename_columns([*keys, "n"])
                sums.add(table.set_column(0, "lang", pa.array(names, pa.string()).take(table["lang"])))
            for out in sums.ready():
                yield _plain(out)
        for out in sums.ready(done=True):
            yield _plain(out)

    return run


def _subtrees(least: int, longest: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, phrase, words, total of the nodes of the subtrees of suffixes in order.

    Suffixes come sorted by (lang, suffix) and end with a space each, so those below a
    node are neighbours. At most one node of each depth is open at the end of a batch;
    its total goes on into the next. Nodes of fewer than `least` go, unless
    their suffixes are split over groups.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[str, str, int, bool]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = batch.column("lang").dictionary_encode().indices.to_numpy()
            cut = pc.split_pattern(pc.utf8_rtrim(batch.column("suffix"), " "), " ")
            sizes = pc.list_value_length(cut).to_numpy()
            codes = np.full((len(sizes), longest), -1)
            flat = pc.list_flatten(cut).dictionary_encode().indices.to_numpy()
            codes[np.arange(longest) < sizes[:, None]] = flat
            n, split = batch.column("n").to_numpy(), batch.column("split").to_numpy(zero_copy_only=False)
            changed = np.ones(len(sizes), bool)
            changed[1:] = lang[1:] != lang[:-1]
            changed[1:] |= codes[1:, 0] != codes[:-1, 0]
            out: list[tuple[str, str, int, int]] = []

            def phrase(row: int, depth: int, batch: pa.RecordBatch = batch) -> tuple[str, str]:
                words = batch.column("suffix")[row].as_py().split(" ", depth)[:depth]
                return batch.column("lang")[row].as_py(), " ".join(words)

            for depth in range(2, longest + 1):
                changed[1:] |= codes[1:, depth - 1] != codes[:-1, depth - 1]
                first = np.flatnonzero(changed)
                totals = np.add.reduceat(n, first)
                there = sizes[first] >= depth
                before = open_.pop(depth, None)
                if before is not None:
                    if there[0] and phrase(0, depth) == before[:2]:
                        totals[0] += before[2]
                    elif before[2] >= least or before[3]:
                        out.append((*before[:2], depth, before[2]))
                if there[-1]:
                    open_[depth] = (*phrase(int(first[-1]), depth), int(totals[-1]), bool(split[-1]))
                    there[-1] = False
                for k in np.flatnonzero(there & ((totals >= least) | split[first])):
                    out.append((*phrase(int(first[k]), depth), depth, int(totals[k])))
            if out:
                yield _node_batch(out)
        last = [(lang, phrase, depth, total) for depth, (lang, phrase, total, split) in open_.items() if total >= least or split]
        if last:
            yield _node_batch(last)

    return run


def _node_batch(nodes: list[tuple[str, str, int, int]]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
    columns = [pa.array(c, t) for c, t in zip(zip(*nodes, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "total"])


@dataclass
class PhraseCounts:
    """words (lang, word, f): every word; phrases (lang, phrase, words, a): those of 2 to
    `longest` words with a >= least."""

    words: DataFrame
    phrases: DataFrame
    least: int


def count_phrases(docs: DataFrame, least: int, longest: int = LONGEST, group: int = GROUP) -> PhraseCounts:
    """How often every word and every frequent phrase occurs, by lang.

    docs: text and lang, further columns are ignored. A null text is empty, a null lang
    is `und`; rows without words add nothing and rows that repeat count each time. The
    texts are read three times and never moved. group: suffixes aimed at per group.
    """
    if longest < 2 or least < 1 or group < 1:
        raise ValueError("phrases have two words and occur once, at least")
    spark = docs.sparkSession
    scratch, context = Scratch(spark), spark.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, word string, n long")
    words = scratch.put(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words", narrow=True)

    frequent = words.where(F.col("f") >= least).select("lang", "word")
    marks = context.broadcast(_marks(scratch.put(frequent.mapInArrow(_hash_words, "h long"), "hashes", narrow=True)))
    pairs = texts.mapInArrow(_counter_of_pairs(marks), "h long, n long").groupBy("h").agg(F.sum("n").alias("f"))
    pairs = scratch.put(pairs.where(F.col("f") >= least), "pairs", narrow=True)
    pair_marks = context.broadcast(_marks(pairs))
    total = pairs.agg(F.sum("f")).first()[0] or 0
    over = pairs.where(F.col("f") > max(group, total // _HEAVY)).select("h").toArrow()["h"].to_numpy()
    heavy = context.broadcast(np.sort(over.view(np.uint64)))

    cut = "lang string, suffix string, prefix long, split boolean, n long"
    suffixes = texts.mapInArrow(_suffixes(marks, pair_marks, heavy, longest), cut)
    groups = suffixes.repartition(max(1, -(-total // group)), "prefix").sortWithinPartitions("lang", "suffix")
    nodes = groups.select("lang", "suffix", "split", "n").mapInArrow(
        _subtrees(least, longest), "lang string, phrase string, words int, total long"
    )
    whole = nodes.groupBy("lang", "phrase", "words").agg(F.sum("total").alias("a")).where(F.col("a") >= least)
    whole = scratch.put(whole, "phrases", narrow=True)
    for broadcast in (marks, pair_marks, heavy):
        broadcast.unpersist()
    return PhraseCounts(words, whole, least)


def _wide(name: str) -> str:
    return f"CAST({name} AS DECIMAL(20,0))"


def collocations(
    counts: PhraseCounts, scale: int = 2_000_000, covered: tuple[int, int] = (80, 100), most: int | None = 2000
) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score`: phrases by how much their parts belong together.

    Of all cuts of a phrase in two, the one with the lowest floor(scale * a / (l + r))
    counts, the first of equal ones; l and r are the counts of its parts. A phrase goes
    if a longer frequent one holds it and occurs covered[0] / covered[1] as often, at least. The
    first `most` of each lang are ranked by score and a, descending, then phrase by
    UTF-8 bytes; None ranks all. n counts the words of the lang.
    """
    phrases = counts.phrases
    facts = phrases.select("lang", "phrase", F.col("a").alias("f")).unionByName(
        counts.words.where(F.col("f") >= counts.least).select("lang", F.col("word").alias("phrase"), "f")
    )

    def known(part: str, count: str) -> DataFrame:
        return facts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', k)"),
            "right": F.expr("substring_index(phrase, ' ', k - words)"),
        }
    )
    halves = cuts.join(known("left", "l"), ["lang", "left"]).join(known("right", "r"), ["lang", "right"])
    score = F.expr(f"({_wide('a')} * {scale}) DIV ({_wide('l')} + {_wide('r')})").alias("score")
    best = halves.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("best"))

    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, s), ' '))))"
    )
    longer = (
        phrases.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("within"))
    )
    share, of = covered
    goes = F.expr(f"within IS NOT NULL AND {of} * {_wide('within')} >= {share} * {_wide('a')}")
    kept = best.join(longer, ["lang", "phrase"], "left").where(~goes).select("lang", "phrase", "a", "best.*")
    order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if most is not None:
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
        kept = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    sizes = counts.words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _phrase_sql() -> str:
    """The same for DuckDB: each word with those after it, and all cuts."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    pieces = f"regexp_split_to_array(translate(coalesce(text, ''), {letters}), '[.,;:!?\\x0A-\\x0D]')"
    runs = " UNION ALL ".join(
        f"SELECT lang, {s} AS words, concat_ws(' ', {', '.join(f'w{i}' for i in range(1, s + 1))}) AS phrase "
        f"FROM runs WHERE w{s} IS NOT NULL"
        for s in range(1, 5)
    )

    def part(first: int, last: int) -> str:
        return f"array_to_string(string_split(phrase, ' ')[{first}:{last}], ' ')"

    inner = " UNION ALL ".join(
        f"SELECT lang, {part(i, i + s - 1)} AS phrase, a FROM cand WHERE words >= {i + s - 1} AND words > {s}"
        for s in (2, 3)
        for i in range(1, 6 - s)
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, {part(1, k)} AS x, {part(k + 1, 4)} AS y FROM cand WHERE words > {k}"
        for k in range(1, 4)
    )
    return f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest({pieces}) AS piece FROM documents))),
places AS (SELECT lang, piece, unnest(words) AS w1, unnest(range(len(words))) AS i FROM pieces),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
  FROM places WINDOW p AS (PARTITION BY piece ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, phrase, words, lang || chr(30) || phrase AS key, count(*) AS f FROM ({runs}) GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, words, f AS a FROM f WHERE words > 1 AND f >= 30),
cuts AS ({cuts}),
best AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, (2000000 * c.a::HUGEINT) // (x.f + y.f) AS score
  FROM cuts AS c JOIN f AS x ON x.key = c.lang || chr(30) || c.x JOIN f AS y ON y.key = c.lang || chr(30) || c.y
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM ({inner}) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase)
  WHERE longer.a IS NULL OR 100 * longer.a::HUGEINT < 80 * best.a::HUGEINT),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""


PHRASE_SQL = _phrase_sql()
