"""Language of words and texts by a linear-chain conditional random field.

Every word is scored for every language by hashed byte n-grams, anchored at its ends as
affixes too, and by a lexicon of how much each language uses the word; learned
transitions join the words of a text, and forward-backward gives each word its
probabilities. The language of a text is that of most expected words. Training text is
labelled by document only, so code-switched sequences for the transitions are
spliced from parts of several documents. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cuts import word_chunks
from .tables import Scratch, narrowed, text_batches
from .words import text_bytes

UNKNOWN = "und"
SAMPLE = 2400  # training documents, shared evenly by the languages
SAMPLE_BYTES = 3000  # of each training document

_BUCKETS = 1 << 16
_ORDERS = (1, 2, 3, 4, 5)  # of n-grams; the longest only at the ends of a word
_SEQUENCE = 1 << 16  # words; a longer text is several sequences
_BLOCK = 32  # words of a sequence that are multiplied up together
_OPEN, _CLOSE = 0x02, 0x03  # around a word

# Bytes that separate words: ASCII but letters.
_APART = np.zeros(256, bool)
_APART[:0x80] = True
_APART[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


@dataclass
class Sheet:
    """Words of texts in order: text, and which distinct word; features of the distinct
    ones are buckets[ends[w] : ends[w + 1]]."""

    rows: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    buckets: np.ndarray
    ends: np.ndarray


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words, and where those of each word start."""
    sizes = ends - starts + 2
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    place = np.arange(at[-1]) - np.repeat(at[:-1], sizes)
    left = np.repeat(sizes, sizes) - place  # bytes from here to the end of the word
    inner = (place > 0) & (left > 1)
    letters = np.full(at[-1], _OPEN, np.uint64)
    letters[left == 1] = _CLOSE
    letters[inner] = data[(np.repeat(starts, sizes) + place - 1)[inner]]
    found, owners = [], []
    owner = np.repeat(np.arange(len(sizes)), sizes)
    gram = np.zeros(len(letters), np.uint64)
    for order in range(1, max(_ORDERS) + 1):
        gram = gram * np.uint64(256)
        gram[: len(letters) - order + 1] += letters[order - 1 :]
        whole = left >= order
        if order == 1:
            whole &= inner
        if order == max(_ORDERS):
            whole &= (place == 0) | (left == order)
        hashed = (gram[whole] * np.uint64(16) + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C55)
        found.append((hashed >> np.uint64(48)).astype(np.int64) & (_BUCKETS - 1))
        owners.append(owner[whole])
    owner = np.concatenate(owners)
    order_ = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order_], np.searchsorted(owner[order_], np.arange(len(sizes) + 1))


def sheets(column: pa.Array) -> Iterator[Sheet]:
    """The words of a column of texts, chunk by chunk; null is empty."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    for chunk in word_chunks(data, offsets, _APART):
        if not len(chunk.starts):
            continue
        hashes, first, words = np.unique(chunk.hashes, return_index=True, return_inverse=True)
        buckets, ends = _features(chunk.data, chunk.starts[first], chunk.ends[first])
        rows = np.searchsorted(offsets, chunk.at + chunk.starts, side="right") - 1
        yield Sheet(rows, words, hashes, buckets, ends)


def forward_backward(scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(label) of every word of several sequences, joined.

    scores: log weights, a row per word; first: where each sequence starts (none is
    empty); start, moves: log weights of first labels and of transitions. Blocks of words
    are multiplied up side by side, then linked, so that a long sequence is as cheap.
    """
    n, labels = scores.shape
    sizes = np.diff(np.r_[first, n])
    blocks = -(-sizes // _BLOCK)
    heads = np.cumsum(blocks) - blocks  # first block of each sequence
    total = int(blocks.sum())
    in_sequence = np.arange(n) - np.repeat(first, sizes)
    block, step = np.repeat(heads, sizes) + in_sequence // _BLOCK, in_sequence % _BLOCK
    weight = np.ones((_BLOCK, total, labels))
    weight[step, block] = np.exp(scores - scores.max(1, keepdims=True))
    there = np.zeros((_BLOCK, total), bool)
    there[step, block] = True
    opens = np.zeros(total, bool)
    opens[heads] = True
    move = np.exp(moves - moves.max())
    begin = np.exp(start - start.max())

    def scaled(x: np.ndarray, axis: int | tuple[int, ...] = -1) -> np.ndarray:
        return x / x.sum(axis, keepdims=True)

    # What a block makes of the labels before it.
    through = np.where(opens[:, None, None], begin, move) * weight[0][:, None, :]
    for t in range(1, _BLOCK):
        after = (through.reshape(-1, labels) @ move).reshape(through.shape) * weight[t][:, None, :]
        through = scaled(np.where(there[t][:, None, None], after, through), (1, 2))
    enter = np.full((total, labels), 1 / labels)
    leave = np.full((total, labels), 1 / labels)
    order = np.argsort(-blocks, kind="stable")
    longest = int(blocks.max(initial=0))
    many = np.searchsorted(-blocks[order], -np.arange(longest + 1), side="left")  # sequences of more than k blocks
    for k in range(1, longest):
        now = heads[order[: many[k]]] + k
        enter[now] = scaled(np.einsum("bi,bij->bj", enter[now - 1], through[now - 1]))
    for k in range(longest - 1, 0, -1):
        now = heads[order[: many[k]]] + k
        leave[now - 1] = scaled(np.einsum("bij,bj->bi", through[now], leave[now]))

    forward = np.empty((_BLOCK, total, labels))
    at = enter
    for t in range(_BLOCK):
        into = at @ move
        if t == 0:
            into = np.where(opens[:, None], begin, into)
        at = np.where(there[t][:, None], scaled(into * weight[t]), at)
        forward[t] = at
    out = np.empty((_BLOCK, total, labels))
    at = leave
    for t in range(_BLOCK - 1, -1, -1):
        out[t] = forward[t] * at
        at = np.where(there[t][:, None], scaled((weight[t] * at) @ move.T), at)
    return scaled(out[step, block])


@dataclass
class LanguageCrf:
    """labels: learned languages; weights: of each bucket; lexicon: hashes of words,
    ascending, with the usage of each language; usage_weights: from usage to labels."""

    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray
    lexicon: np.ndarray
    usage: np.ndarray
    usage_weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def used(self, hashes: np.ndarray) -> np.ndarray:
        """The usage of words by language; zero for a word the lexicon lacks."""
        if not len(self.lexicon):
            return np.zeros((len(hashes), len(self.labels)))
        place = np.searchsorted(self.lexicon, hashes).clip(max=len(self.lexicon) - 1)
        return np.where((self.lexicon[place] == hashes)[:, None], self.usage[place], 0)

    def word_scores(self, sheet: Sheet) -> np.ndarray:
        """Log weights of the distinct words of a sheet, a column per language."""
        sums = np.add.reduceat(self.weights[sheet.buckets], sheet.ends[:-1], axis=0)
        return sums + self.bias + self.used(sheet.hashes) @ self.usage_weights

    def marginals(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text of every word and its probabilities, in whole sequences, in order."""
        rows = np.zeros(0, np.int64)
        scores = np.zeros((0, len(self.labels)))
        before = 0  # words of the first text here that were handed out already

        def out(rows: np.ndarray, scores: np.ndarray, before: int, done: bool):
            heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            rank = np.arange(len(rows)) - np.repeat(heads, np.diff(np.r_[heads, len(rows)]))
            rank[rows == rows[0]] += before
            first = np.flatnonzero((rank % _SEQUENCE == 0) | np.r_[True, rows[1:] != rows[:-1]])
            end = len(rows) if done else int(first[-1])
            if end:
                own = first if done else first[:-1]
                found = rows[:end], forward_backward(scores[:end], own, self.start, self.moves)
            else:
                found = None
            kept = int(rank[end]) if end < len(rows) else 0
            return found, rows[end:], scores[end:], kept

        for sheet in sheets(column):
            rows = np.r_[rows, sheet.rows]
            scores = np.concatenate([scores, self.word_scores(sheet)[sheet.words]])
            found, rows, scores, before = out(rows, scores, before, done=False)
            if found is not None:
                yield found
        if len(rows):
            yield out(rows, scores, before, done=True)[0]

    def predict(
        self, docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, runs: bool = False
    ) -> DataFrame:
        """Columns `keep` of docs (all of them), lang_pred and score, and runs if asked for.

        lang_pred is the language of most expected words, the first of equal ones in
        order of labels, and score the share of its words. It is `und` with score 0 where
        the text is null or has no letter, or nothing was learned. runs: array of
        (lang, words) by the likeliest label of each word. Columns of docs with these
        names are replaced; no row is dropped or moved.
        """
        text_batches(docs.sparkSession)
        model = docs.sparkSession.sparkContext.broadcast(self)
        names = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", "runs"[: 4 * runs])]
        own = docs.select(*names, F.col(text).alias("__text"))
        schema = T.StructType(list(own.schema.fields)[:-1]).add("lang_pred", "string").add("score", "double")
        run_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
        if runs:
            part = T.StructType().add("lang", "string").add("words", "long")
            schema.add("runs", T.ArrayType(part))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mass, found = model.value.masses(batch.column("__text"), runs)
                total = mass.sum(1)
                best = mass.argmax(1) if mass.shape[1] else np.zeros(len(mass), np.int64)
                labels = pa.array([*model.value.labels, UNKNOWN])
                place = np.where(total > 0, best, len(labels) - 1)
                score = np.divide(mass.max(1, initial=0), total, out=np.zeros(len(mass)), where=total > 0)
                columns = [*batch.columns[:-1], labels.take(pa.array(place)), pa.array(score.clip(0, 1))]
                if runs:
                    columns.append(pa.array(found, run_type))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return own.mapInArrow(run, schema)

    def masses(self, column: pa.Array, runs: bool) -> tuple[np.ndarray, list[list[dict]]]:
        """Expected words by language of every text (none without letters), and runs."""
        mass = np.zeros((len(column), len(self.labels)))
        found: list[list[dict]] = [[] for _ in range(len(column))]
        if not self.labels:
            return mass, found
        for rows, shares in self.marginals(column):
            for k in range(len(self.labels)):
                mass[:, k] += np.bincount(rows, shares[:, k], minlength=len(column))
            if runs:
                label = shares.argmax(1)
                heads = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (label[1:] != label[:-1])])
                for a, b in zip(heads, np.r_[heads[1:], len(rows)], strict=True):
                    own, lang = found[rows[a]], self.labels[label[a]]
                    if own and own[-1]["lang"] == lang:  # goes on from the sequence before
                        own[-1]["words"] += int(b - a)
                    else:
                        own.append({"lang": lang, "words": int(b - a)})
        letterless = np.flatnonzero(~pc.match_substring_regex(column.fill_null(""), "[A-Za-z]").to_numpy(zero_copy_only=False))
        for k in letterless:
            if not any(c.isalpha() for c in column[int(k)].as_py() or ""):
                mass[k], found[k] = 0, []
        return mass, found


def _part(text: str | None, size: int, seed: int) -> str:
    """At most `size` bytes of a text, from a place given by the seed on, whole words."""
    raw = (text or "").encode()
    if len(raw) <= size:
        return text or ""
    start = seed % (len(raw) - size)
    return raw[start : start + size].decode(errors="ignore").partition(" ")[2].rpartition(" ")[0]


def training_sample(docs: DataFrame, sample: int = SAMPLE, size: int = SAMPLE_BYTES) -> DataFrame:
    """lang, text: parts of at most `size` bytes of at most `sample` documents (id, text, lang).

    The documents are those of the smallest hashes of ids, as many of each language; a
    null id or lang is left out, and of an id that repeats one row stays. Only ids are
    ranked; texts are looked up for the chosen ones and cut where they lie.
    """
    labelled = docs.where("id IS NOT NULL AND lang IS NOT NULL")
    scratch = Scratch(docs.sparkSession)
    languages = labelled.select("lang").distinct().count()
    each = max(1, sample // max(languages, 1))

    def ranked(df: DataFrame, by: list[Column], *within: str) -> DataFrame:
        return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*within).orderBy(*by)))

    order = F.xxhash64("id", F.lit("sample")).alias("order")
    salted = ranked(labelled.select("id", "lang", order, F.pmod("id", F.lit(64)).alias("salt")), [F.col("order"), F.col("id")], "lang", "salt")
    salted = salted.where(F.col("__rank") <= each).select("id", "lang", "order")
    chosen = ranked(salted, [F.col("order"), F.col("id")], "lang").where(F.col("__rank") <= each)
    chosen = scratch.put(chosen.select("id").distinct(), "chosen")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            parts = [_part(batch.column("text")[k].as_py(), size, hash(id_)) for k, id_ in enumerate(ids)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(parts, pa.string())], names=["id", "lang", "text"])

    rows = narrowed(labelled.select("id", "lang", "text"), chosen, "id").mapInArrow(cut, "id long, lang string, text string")
    return ranked(rows, [F.col("lang"), F.col("text")], "id").where("__rank = 1").select("id", "lang", "text")


def _spliced(bounds: list[tuple[int, int, int]], length: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of word places with their labels: half of them change language once.

    bounds: label, first place and end of the words of each document.
    """
    long_ = [b for b in bounds if b[2] - b[1] >= length]
    short = [b for b in bounds if 0 < b[2] - b[1] < length]
    places, labels = [], []

    def piece(size: int) -> tuple[np.ndarray, int]:
        """Words of one language: of one document, or of it over and over if it is short."""
        pool = long_ if long_ and (not short or rng.random() < 0.8) else short
        label, a, b = pool[rng.integers(len(pool))]
        at = a + (rng.integers(max(b - a, 1)) + np.arange(size)) % (b - a)
        return at, label

    for _ in range(sum(b - a for _, a, b in bounds) // length + 1):
        cut = int(rng.integers(1, length)) if rng.random() < 0.5 else length
        own = [piece(cut)] + ([piece(length - cut)] if cut < length else [])
        places.append(np.concatenate([at for at, _ in own]))
        labels.append(np.concatenate([np.full(len(at), label) for at, label in own]))
    return np.array(places), np.array(labels)


def crf_gradient(scores: np.ndarray, gold: np.ndarray, start: np.ndarray, moves: np.ndarray):
    """Loss, and gradients by scores, start and moves, of sequences (rows) of equal length."""
    count, length, labels = scores.shape
    top = scores.max(2, keepdims=True)
    weight = np.exp(scores - top)
    move, begin = np.exp(moves), np.exp(start)
    forward, scale = np.empty_like(weight), np.empty((count, length))
    for t in range(length):
        at = (begin if t == 0 else forward[:, t - 1] @ move) * weight[:, t]
        scale[:, t] = at.sum(1)
        forward[:, t] = at / scale[:, t, None]
    backward = np.ones((count, labels))
    slope, move_slope = np.empty_like(weight), np.zeros_like(moves)
    for t in range(length - 1, -1, -1):
        slope[:, t] = forward[:, t] * backward
        if t:
            later = weight[:, t] * backward / scale[:, t, None]
            move_slope += move * (forward[:, t - 1].T @ later)
            backward = later @ move.T
    row, step = np.arange(count)[:, None], np.arange(length)[None]
    loss = np.log(scale).sum() + top.sum() - scores[row, step, gold].sum()
    loss -= start[gold[:, 0]].sum() + moves[gold[:, :-1], gold[:, 1:]].sum()
    start_slope = slope[:, 0].sum(0) - np.bincount(gold[:, 0], minlength=labels)
    slope[row, step, gold] -= 1
    np.add.at(move_slope, (gold[:, :-1], gold[:, 1:]), -1)
    return loss, slope, start_slope, move_slope


def fit_languages(
    docs: DataFrame, sample: int = SAMPLE, size: int = SAMPLE_BYTES, epochs: int = 4, length: int = 24
) -> LanguageCrf:
    """The field learned from documents (id, text, lang); see `training_sample` for the bounds.

    At most sample * size bytes come to the driver. Rows without id, lang or words teach
    nothing. The same rows give the same model, however they are laid out.
    """
    rows = training_sample(docs, sample, size).toArrow().sort_by("id")
    return fit_sample(rows, epochs, length)


def fit_sample(rows: pa.Table, epochs: int, length: int) -> LanguageCrf:
    """Adam steps on the negative log likelihood of spliced sequences; rows: lang, text."""
    words: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    vocabulary: dict[int, int] = {}
    buckets: list[np.ndarray] = []
    for sheet in sheets(rows["text"].combine_chunks()):
        place = np.empty(len(sheet.hashes), np.int64)
        for k, value in enumerate(sheet.hashes.tolist()):
            place[k] = vocabulary.setdefault(value, len(vocabulary))
            if place[k] == len(buckets):
                buckets.append(sheet.buckets[sheet.ends[k] : sheet.ends[k + 1]])
        words.append(place[sheet.words])
        owners.append(sheet.rows)
    word = np.concatenate(words) if words else np.zeros(0, np.int64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    langs = rows["lang"].to_pylist()
    labels = sorted({langs[k] for k in np.unique(owner)})
    n = len(labels)
    model = LanguageCrf(
        labels, np.zeros((_BUCKETS, n)), np.zeros(n), np.zeros(0, np.uint64), np.zeros((0, n)), np.eye(n), np.zeros(n), np.zeros((n, n))
    )
    if n < 2:
        return model
    code = np.array([labels.index(lang) if lang in labels else 0 for lang in langs])

    # Usage: centred log frequencies of words that several documents of the sample share.
    pairs = np.unique(word * len(langs) + owner)
    shared = np.bincount(pairs // len(langs), minlength=len(vocabulary)) > 2
    usage = np.bincount(word * n + code[owner], minlength=len(vocabulary) * n).reshape(-1, n).astype(float)
    usage = np.log((usage + 0.5) / (usage.sum(0) + 1))
    usage -= usage.mean(1, keepdims=True)
    hashes = np.array(list(vocabulary), np.uint64)
    order = np.argsort(hashes)
    order = order[shared[order]]
    model.lexicon, model.usage = hashes[order], usage[order]
    known = np.where(shared[:, None], usage, 0)

    ends = np.r_[0, np.cumsum([len(b) for b in buckets])]
    flat = np.concatenate(buckets)
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    tails = np.r_[heads[1:], len(owner)]
    bounds = [(int(code[owner[a]]), int(a), int(b)) for a, b in zip(heads, tails, strict=True)]
    rng = np.random.default_rng(13)
    model.usage_weights = 0.1 * np.eye(n)
    params = [model.weights, model.bias, model.usage_weights, model.start, model.moves]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step, batch = 0, 256
    for epoch in range(epochs):
        places, gold = _spliced(bounds, length, rng)
        for k in range(0, len(places), batch):
            own, target = word[places[k : k + batch]], gold[k : k + batch]
            used, inverse = np.unique(own, return_inverse=True)
            inverse = inverse.reshape(own.shape)
            counts = ends[used + 1] - ends[used]
            from_ = np.repeat(ends[used] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            feature = flat[from_]
            sums = np.add.reduceat(model.weights[feature], np.cumsum(counts) - counts, axis=0)
            sums += model.bias + known[used] @ model.usage_weights
            _, slope, start_slope, move_slope = crf_gradient(sums[inverse], target, model.start, model.moves)
            by_word = np.zeros_like(sums)
            np.add.at(by_word, inverse.ravel(), slope.reshape(-1, n))
            spread = np.repeat(by_word, counts, axis=0)
            weight_slope = np.stack([np.bincount(feature, spread[:, j], minlength=_BUCKETS) for j in range(n)], 1)
            size = own.size
            slopes = [weight_slope, by_word.sum(0), known[used].T @ by_word, start_slope, move_slope]
            step += 1
            rate = 0.03 * (1 - epoch / epochs)
            for p, (m, v), s in zip(params, moments, slopes, strict=True):
                s = s / size + 1e-6 * p
                m += 0.1 * (s - m)
                v += 0.01 * (s * s - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model
