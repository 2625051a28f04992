"""Licence scan: known notices in plain documents, and what must stay unknown."""

import textwrap

import pytest
from pyspark.sql import functions as F

from pairloom.llm.licences import SIBLINGS, TEMPLATES, _templates, document_licences, fit_licences, plain_lines, scan_licences

SF = "/root/testdata/sf0.01"
NOTICES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
}


@pytest.fixture(scope="module")
def model(spark):
    return fit_licences(spark.read.parquet(f"{SF}/documents.parquet"))


def test_documents_of_the_test_data(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in document_licences(docs, model).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        named = {f for notice, f in NOTICES.items() if notice in r.text}
        if len(named) == 1:
            assert got[r.doc_id].family in named, r.text[-200:]
        elif not named:
            assert got[r.doc_id].family == "unknown", (got[r.doc_id], r.text[:300])


def test_odd_rows(spark, model):
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "plain text " * 20_000, "a"), (None, "released under the MIT license!", "a"),
        (4, "x\n\nReleased under the MIT License. And more text\nReleased under the MIT License.", "a"),
        (4, "x\n\nReleased under the MIT License. And more text\nReleased under the MIT License.", "a"),
        (5, "The ferry is licensed to carry the public under general rules of version control.", "a"),
        (6, "Distributed under the BSD 3-Clause License", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = document_licences(docs, model).collect()
    assert len(got) == len(rows)
    have = sorted(((r.doc_id, r.family, r.n_paragraphs, r.paragraph) for r in got), key=str)
    want = [(1, "unknown", 0, None), (2, "unknown", 0, None), (3, "unknown", 0, None), (None, "MIT", 1, 0)]
    want += [(4, "MIT", 2, 2)] * 0 + [(5, "unknown", 0, None), (6, "BSD-3-Clause", 1, 0)]
    assert [h for h in have if h[0] != 4] == sorted(want, key=str)
    assert [h[:3] for h in have if h[0] == 4] == [(4, "MIT", 2)] * 2
    assert scan_licences(docs.where("false"), model).collect() == []
    assert document_licences(docs.where("false"), model).collect() == []


def test_wrapped_notices(spark, model):
    rows, want = [], {}
    for n, (family, notice) in enumerate(TEMPLATES):
        for width in (40, 60, 72, 80):
            for lead, mark in (("", ""), ("Copyright by the authors. ", " * ")):
                lines = textwrap.wrap(lead + notice, width)
                body = "\n".join(mark + line for line in lines)
                rows.append((f"{n} {width} {mark}", f"The ferry left.\n\n{body}\n\nIt came back."))
                want[rows[-1][0]] = family
    got = document_licences(spark.createDataFrame(rows, "doc_id string, text string"), model).collect()
    assert {r.doc_id: r.family for r in got} == want
    assert {r.n_paragraphs for r in got} == {1}
    cut = "Redistribution and use in source and binary forms, with or without\n\nmodification, are"
    got = document_licences(spark.createDataFrame([("a", cut)], "doc_id string, text string"), model).first()
    assert got.family == "unknown"


def test_sibling_licences(spark, model):
    other = SIBLINGS + [
        "Licensed under the Apache License, Version 1.0.",
        "Licensed under CC BY 2.5.",
        "You may copy it under the GNU Lesser General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 1.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    ]
    rows = [(f"{n} {width}", textwrap.fill(t, width)) for n, t in enumerate(other) for width in (60, 400)]
    got = document_licences(spark.createDataFrame(rows, "doc_id string, text string"), model).collect()
    assert {(r.doc_id, r.family) for r in got} == {(n, "unknown") for n, _ in rows}
    both = "Licensed under the Apache License, Version 2.0. Released under the MIT License."
    found = scan_licences(spark.createDataFrame([("a", both)], "doc_id string, text string"), model).collect()
    assert {r.family for r in found} == {"Apache-2.0", "MIT"}


def test_lines_near_a_template_are_kept(spark):
    near = "The museum was licensed under the MIT board of the time."
    docs = spark.createDataFrame([(1, near), (2, "Released under the MIT License.")], "doc_id long, text string")
    lines = plain_lines(docs.select(F.col("text").alias("t")), _templates(spark))
    assert [r.text for r in lines.collect()] == [near]


def test_same_plain_lines_in_any_order(spark):
    texts = ["\n".join(f"line {n} of the report" for n in range(k, 60, 7)) for k in range(7)]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    templates = _templates(spark).cache()
    taken = [
        {r.text for r in plain_lines(docs.repartition(parts).orderBy(order), templates, 10).collect()}
        for parts, order in ((1, F.asc("t")), (5, F.desc("t")))
    ]
    assert len(taken[0]) == 10 and taken[0] == taken[1]
    lines = [line for t in texts for line in t.split("\n")]
    by_hash = spark.createDataFrame([(t,) for t in lines], "text string").orderBy(F.xxhash64("text")).limit(10)
    assert taken[0] == {r.text for r in by_hash.collect()}
