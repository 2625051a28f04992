"""Phrase counts and collocations against a plain-Python count of all phrases."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import pyarrow as pa
import pytest

from pairloom.llm import cuts, phrases
from pairloom.llm.phrases import collocations, count_phrases
from pairloom.llm.words import text_bytes

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, f string"


def brute_counts(rows):
    counts = Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + size])] += 1
    return counts


def brute(rows, least, most=2000):
    counts = brute_counts(rows)
    frequent = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    n = Counter()
    for (lang, words), f in counts.items():
        n[lang] += f if len(words) == 1 else 0
    out = {}
    for (lang, words), a in frequent.items():
        covered = any(
            100 * b >= 80 * a
            for (other, longer), b in frequent.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
        )
        parts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        scores = [floor(Fraction(2_000_000 * a, l + r)) for l, r in parts]
        best = scores.index(min(scores))
        if not covered:
            out.setdefault(lang, []).append((scores[best], a, " ".join(words), *parts[best]))
    got = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        for rank, (score, a, phrase, l, r) in enumerate(found[:most], 1):
            got.append((lang, rank, phrase, a, l, r, n[lang], score))
    return sorted(got)


def texts(seed, size):
    rng = random.Random(seed)
    words = ["the", "of", "Ünder", "a", "\x01b", "b", "ZZ", "q\x00", "naïve", "日本", "x" * 40]
    rows = []
    for _ in range(size):
        parts = rng.choices([*words, "the of a b", "the of"], [1 / (k + 1) for k in range(13)], k=rng.randint(0, 60))
        rows.append(("".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\r\n"]) for p in parts), rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("group", [1 << 20, 20])
def test_against_brute_force(spark, group):
    """A small budget extends many prefixes and makes many groups."""
    rows = texts(3, 300) + [(None, "en"), ("", None), ("Solo", "fr"), ("the of " * 3000, "en")]
    rows += [rows[5]] * 3
    docs = spark.createDataFrame([(1, t, lang, "p", "n", "f") for t, lang in rows], SCHEMA).repartition(5)
    for least in (2, 30):
        counts = count_phrases(docs, least, group=group)
        want = brute_counts(rows)
        got = {(r.lang, tuple(r.phrase.split(" "))): r.a for r in counts.phrases.collect()}
        assert got == {k: a for k, a in want.items() if len(k[1]) > 1 and a >= least}
        assert {(r.lang, (r.word,)): r.f for r in counts.words.collect()} == {k: a for k, a in want.items() if len(k[1]) == 1}
        assert sorted(map(tuple, collocations(counts).collect())) == brute(rows, least)
        assert sorted(map(tuple, collocations(counts, most=4).collect())) == brute(rows, least, 4)


def test_sums_handed_on_early_and_small_chunks(monkeypatch):
    monkeypatch.setattr(cuts, "_CHUNK", 64)
    monkeypatch.setattr(phrases, "_KEPT", 5)
    rows = texts(5, 60)
    langs = pa.array([lang or "und" for _, lang in rows])
    table = pa.table({"lang": langs, "text": [t for t, _ in rows]})
    got = Counter()
    parts = list(phrases._count_words(table.to_batches(max_chunksize=7)))
    for part in parts:
        for row in part.to_pylist():
            got[row["lang"], (row["word"],)] += row["n"]
    assert len(parts) > 1
    assert got == Counter({k: f for k, f in brute_counts(rows).items() if len(k[1]) == 1})


def test_small_chunks_give_the_same_words(monkeypatch):
    monkeypatch.setattr(cuts, "_CHUNK", 64)
    rows = texts(4, 40) + [("y" * 300 + " the of", "en"), ("y" * 300, "en")]
    data, offsets = text_bytes(pa.array([t for t, _ in rows]))
    got, seen = Counter(), {}
    for chunk in cuts.word_chunks(data, offsets, phrases._APART):
        packed, places = chunk.packed()
        for k, value in enumerate(chunk.hashes.tolist()):
            word = packed[places[k] : places[k + 1] - 1].tobytes().decode()
            got[word] += 1
            assert seen.setdefault(word, value) == value
    want = Counter()
    for (_, words), f in brute_counts(rows).items():
        if len(words) == 1:
            want[words[0]] += f
    assert got == want and len(set(seen.values())) == len(seen)


def test_empty_tables_and_wrong_parameters(spark):
    docs = spark.createDataFrame([], SCHEMA)
    counts = count_phrases(docs, 30)
    assert collocations(counts).collect() == [] and counts.words.count() == 0
    none = spark.createDataFrame([(1, None, None, "p", "n", "f"), (2, " .\n", "en", "p", "n", "f")], SCHEMA)
    assert collocations(count_phrases(none, 1)).collect() == []
    with pytest.raises(ValueError):
        count_phrases(docs, 0)
