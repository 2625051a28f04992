"""The pipeline stage by stage against the plain models of the operators."""

import test_jaccard
import test_lines
import test_mixing

import corpus_pipeline
from pairloom.llm.quality import graded
from pairloom.llm.tables import Scratch
from pairloom.llm.tokens import encoder, tokenizer_file

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_match_their_models(spark):
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, quality), (_, lines), (_, jaccard), (_, mixing), (_, packing) = corpus_pipeline.STAGES

    good = scratch.put(quality(spark, docs, SF), "good")
    assert good.columns == docs.columns
    kept = {r.doc_id for r in graded(spark, docs, SF).where("keep").collect()}
    assert set(ids(good)) == kept and 0 < len(kept) < docs.count()

    fresh = scratch.put(lines(spark, good, SF), "fresh")
    assert fresh.columns == docs.columns
    want = test_lines.brute([(r.doc_id, r.text) for r in good.collect()], 2, 20)
    want = {i: t for i, t, gone in want if not gone or t.strip()}
    assert {r.doc_id: r.text for r in fresh.collect()} == want
    assert all(r.n_chars == len(r.text) for r in fresh.collect())

    single = scratch.put(jaccard(spark, fresh, SF), "single")
    assert single.columns == docs.columns
    want = test_jaccard.brute([(r.doc_id, r.text) for r in fresh.collect()], 5, 80)
    assert ids(single) == sorted(i for i, _, c in want if i == c)

    mixed = scratch.put(mixing(spark, single, SF), "mixed")
    assert mixed.columns == docs.columns
    rows = [(r.doc_id, r.text, r.source) for r in single.collect()]
    weights = {i: 2.0 if 200 <= len(t) <= 50_000 else 1.0 for i, t, _ in rows}
    copies = [m[-1] for m in test_mixing.model(rows, weights)]
    assert ids(mixed) == sorted(r[0] for r, n in zip(rows, copies, strict=True) for _ in range(int(n)))

    packed = packing(spark, mixed, SF).collect()
    encode = encoder(tokenizer_file())
    lengths = sorted((r.doc_id, len(encode(r.text)) // 4 + 1) for r in mixed.collect())
    assert sum(r.length for r in packed) == sum(n for _, n in lengths)
    assert sum(r.piece == 0 for r in packed) == len(lengths)
    used = {}
    for r in packed:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in parts) <= 2048 for parts in used.values())


def test_rows_without_key_text_or_source(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (7, "x", None, None, 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() > 0, name
        empty = stage(spark, docs.where("false"), SF)
        assert empty.columns == out.columns and empty.count() == 0, name
