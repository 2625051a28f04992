"""Packing: exact cuts, gapless sequences, and as few of them as best fit gives."""

import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm.packing import pack_documents, plan_best_fit
from pairloom.llm.queries import op1_best_fit_packing
from pairloom.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths, most):
    """Best fit, one piece at a time; the number of sequences."""
    spaces = []
    for n in sorted(lengths, reverse=True):
        fits = [s for s in spaces if s >= n]
        space = min(fits) if fits else most
        if fits:
            spaces.remove(space)
        spaces.append(space - n)
    return len(spaces)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_over_counts(seed):
    rng = random.Random(seed)
    most = rng.choice([5, 16, 100])
    counts = {rng.randint(1, most): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
    slots = plan_best_fit(counts, most)
    used, ranks = {}, {}
    for length, rank, first, offset, n in slots.tolist():
        ranks.setdefault(length, []).extend(range(rank, rank + n))
        for k in range(n):
            used.setdefault(first + k, []).append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    assert len(used) == best_fit([k for k, v in counts.items() for _ in range(v)], most)
    with pytest.raises(ValueError):
        plan_best_fit({most + 1: 1}, most)


def test_ids_are_those_of_the_tokenizer(spark):
    encode, whole = encoder(PATH), Tokenizer.from_file(PATH)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(5)
    odd = "".join(map(chr, range(1, 256))) + "''sstt  \n\nΣσς ẞ字́"
    texts += ["".join(rng.choices(odd, k=rng.randint(1, 30))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "a\x1cb", "don't we'll I'm", "x" * 50_000]
    for text in texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert encode(text) == struct.pack(f"<{len(ids)}I", *ids), text[:80]
    assert encode(None) == b""


def test_pieces_and_sequences(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "the cat sat on the mat " * 40, 3), (3, "a b", 3), (None, "a b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    packed = pack_documents(docs, PATH, most=64)
    got = packed.placed("id", "piece", "start", "ids").collect()
    encode = encoder(PATH)
    want = []
    for i, text, _ in rows:
        ids = encode(text) + b"\0\0\0\0"
        want += [(i, k, 64 * k, ids[256 * k : 256 * k + 256]) for k in range(-(-len(ids) // 256))]
    key = lambda x: (x[0] or 0, *x[1:])
    assert sorted(((r.id, r.piece, r.start, bytes(r.ids)) for r in got), key=key) == sorted(want, key=key)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    whole = {r.sequence_id: bytes(r.ids) for r in packed.sequences().collect()}
    for sequence, parts in by_sequence.items():
        assert b"".join(p[2] for p in sorted(parts)) == whole[sequence]
        assert len(whole[sequence]) == 4 * sum(p[1] for p in parts) <= 256
    empty = pack_documents(docs.where("false"), PATH)
    assert empty.placed("id").collect() == []


def test_query_packs_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = op1_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    encode = encoder(PATH)
    want, lengths = set(), []
    for d in docs:
        ids = encode(d.text) + b"\0\0\0\0"
        for k, at in enumerate(range(0, len(ids), 8192)):
            part = ids[at : at + 8192]
            want.add((d.doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            lengths.append(len(part) // 4)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    assert len(got) == len(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    assert len(places) == best_fit(lengths, 2048)
