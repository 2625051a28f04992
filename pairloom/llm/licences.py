"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

A template is looked for in the words of a text, wherever its lines break: the word
pairs of all texts meet the short list of those of the templates, and spans of words
that are like a whole template are taken. Only a line without characters ends a span.
A multinomial logistic regression with a lasso penalty, fitted on varied licence
templates against plain text, gives weights to few word pairs and triples; the span
and a few words on either side are scored with them, all in native columns. A family
is reported only where its probability passes a threshold set on held-out plain text
and where a template of the family is there in words, else the text is unknown.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import Scratch

UNKNOWN = "unknown"
_CONFIRM = 0.6  # least likeness of a span and a template
_AROUND = 3  # words on either side of a span that are scored with it

# Notices by which public licences are usually named.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Distributed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
# What a notice of each family must name, in lower-cased words; one of these.
NAMES = {
    "Apache-2.0": ["apache (software )?licen[cs]e (version |v )?2 0"],
    "BSD-3-Clause": ["bsd 3 clause", "redistribution and use in source and binary forms .*modification"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution (international |public |licen[cs]e |version |v )*4 0"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "attribution non( )?commercial (international |public |licen[cs]e |version |v )*4 0"],
    "CC0-1.0": ["cc0", "waived all copyright"],
    "GPL-3.0": ["gnu general public licen[cs]e (version |v( )?)3", "gnu general public licen[cs]e .*version 3"],
    "MIT": ["mit (x11 |expat |software |open source )?licen[cs]e", "any person obtaining a copy"],
    "MPL-2.0": ["mozilla public licen[cs]e (version |v )?2 0"],
}
#: Notices like the templates of licences that have none; to be unknown.
SIBLINGS = [
    "Licensed under the Apache License, Version 1.1.",
    "Licensed under the Apache Software License, Version 1.0; you may not use this file except in compliance with the License.",
    "Distributed under the BSD 2-Clause License.",
    "Distributed under the BSD 4-Clause License.",
    "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY-ND 4.0.",
    "Licensed under CC BY 3.0.",
    "Licensed under CC BY-NC-SA 4.0.",
    "Licensed under CC BY-NC-ND 4.0.",
    "Licensed under CC BY-NC 3.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
    "Released under the MIT-0 License.",
    "Released under the ISC License.",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0.",
]
#: Plain sentences that speak of licences without naming one.
PLAIN = [
    "A driver must carry a licence and the papers of the car at all times.",
    "Licensed under terms agreed with the publisher. All rights reserved.",
    "This software is proprietary and may not be copied without permission.",
    "The pub lost its license after the new version of the law was released.",
    "Released under embargo until the work is published by the foundation.",
    "You may not use this file. It is subject to the terms of the contract.",
    "This work is licensed to the museum under a private agreement.",
]


def ngrams(text: Column) -> Column:
    """Distinct word pairs and triples of a text, lower-cased ASCII words; [] for none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", -1), lambda w: w != "")

    def runs(w: Column, n: int) -> Column:
        first = F.slice(w, 1, F.greatest(F.size(w) - (n - 1), F.lit(0)))
        joined = first
        for k in range(1, n):
            joined = F.zip_with(
                joined, F.slice(w, k + 1, F.greatest(F.size(w) - (n - 1), F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)
            )
        return joined

    # One evaluation of the words for both lengths.
    return F.flatten(F.transform(F.array(words), lambda w: F.array_distinct(F.concat(runs(w, 2), runs(w, 3)))))


def _words(text: Column) -> Column:
    """(w, line) of the lower-cased ASCII words of a text; a blank line is an empty word."""

    def of_line(line: Column, i: Column) -> Column:
        words = F.filter(F.split(line, "[^a-z0-9]+", -1), lambda w: w != "")
        blank = F.trim(F.translate(line, "\t\r", "  ")) == ""
        return F.transform(F.when(blank, F.array(F.lit(""))).otherwise(words), lambda w: F.struct(w.alias("w"), i.alias("line")))

    return F.flatten(F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n", -1), of_line))


def _templates(spark: SparkSession) -> DataFrame:
    """(pair, thirds, family, template, size): the word pairs of every template, the words
    that follow a pair there, and how many different pairs and triples the template has."""
    made = spark.createDataFrame([(f, t) for f, t in TEMPLATES], "family string, template string")
    grams = made.withColumn("size", F.size(ngrams(F.col("template")))).withColumn("words", _words(F.col("template"))["w"])
    at = F.explode(F.sequence(F.lit(0), F.size("words") - 2)).alias("at")
    pairs = grams.select("family", "template", "size", "words", at)
    pair = F.concat_ws(" ", F.get("words", F.col("at")), F.get("words", F.col("at") + 1)).alias("pair")
    return pairs.select(pair, F.get("words", F.col("at") + 2).alias("third"), "family", "template", "size").groupBy(
        "pair", "family", "template", "size"
    ).agg(F.collect_set("third").alias("thirds"))


def template_matches(docs: DataFrame, templates: DataFrame, key: str, text: str, confirm: float = _CONFIRM) -> DataFrame:
    """(key, row, family, likeness, first, last, paragraph, bottom, near) of spans like a template.

    first and last are the places of the words, paragraph and bottom the lines that hold
    them, near the span and _AROUND words on either side. The likeness is the number of
    different pairs and triples that span and template share over the larger of their
    numbers, so words that are missing count as well as words in between. A span and the
    words beside it must give the name of the family, see NAMES: a licence that differs in
    a word or a number is no notice of it. Of spans of one family that overlap the most
    alike is taken, then the first.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(text).alias("text"))
    # A text without any name has no notice and need not be cut into words.
    named = "|".join(name.replace(" ", "[^a-z0-9]+") for names in NAMES.values() for name in names)
    rows = rows.where(F.lower("text").rlike(f"(?s){named}"))

    def pairs_of(words: Column) -> Column:
        return F.transform(
            words,
            lambda x, i: F.struct(
                F.concat_ws(" ", x["w"], F.get(words, i + 1)["w"]).alias("pair"), F.get(words, i + 2)["w"].alias("third"),
                i.alias("at"), x["line"].alias("line"), F.get(words, i + 1)["line"].alias("line2"),
            ),
        )

    # One evaluation of the words.
    placed = F.explode(F.flatten(F.transform(F.array(_words(F.col("text"))), pairs_of))).alias("p")
    hits = rows.select("key", "row", placed).select("key", "row", "p.*").join(F.broadcast(templates), "pair")
    hit = F.struct("at", "pair", F.when(F.array_contains("thirds", F.col("third")), F.col("third")).alias("third"), "line2")
    own = ["key", "row", "family", "template", "size"]
    hits = hits.select(*own, "at", "line", hit.alias("hit")).distinct()
    # A longer span is below the limit whatever it shares.
    reach = max(2 * len(t.split()) for _, t in TEMPLATES)
    ahead = Window.partitionBy(*own).orderBy("at").rangeBetween(0, int(reach / confirm) + 2)
    spans = hits.withColumn("hits", F.collect_list("hit").over(ahead)).where(2 * F.size("hits") >= confirm * F.col("size"))

    def until(hits: Column, last: Column, j: Column) -> Column:
        some = F.slice(hits, F.lit(1), j + 1)
        triples = F.filter(some, lambda h: h["third"].isNotNull() & (h["at"] < last["at"]))
        shared = F.size(F.array_distinct(F.transform(some, lambda h: h["pair"]))) + F.size(
            F.array_distinct(F.transform(triples, lambda h: F.concat_ws(" ", h["pair"], h["third"])))
        )
        grams = 2 * (last["at"] - F.col("at")) + 1
        return F.struct(
            (shared / F.greatest("size", grams)).alias("likeness"), (-last["at"] - 1).alias("end"), last["line2"].alias("bottom")
        )

    best = F.array_max(F.transform("hits", lambda h, j: until(F.col("hits"), h, j)))
    spans = spans.select("key", "row", "family", "at", "line", best.alias("best")).where(F.col("best.likeness") >= confirm)
    span = F.struct("best.likeness", (-F.col("at")).alias("start"), (-F.col("best.end")).alias("last"))
    spans = spans.groupBy("key", "row", "family", "at", "line").agg(F.max(F.struct(span.alias("span"), "best.bottom")).alias("b"))
    spans = spans.select("key", "row", "family", "at", "line", "b.span", "b.bottom")
    beside = Window.partitionBy("key", "row", "family").orderBy("at").rangeBetween(-int(reach / confirm) - 2, int(reach / confirm) + 2)
    better = F.exists(
        F.collect_list("span").over(beside),
        lambda s: (s > F.col("span")) & (-s["start"] <= F.col("span.last")) & (s["last"] >= F.col("at")),
    )
    spans = spans.withColumn("lost", better).where("NOT lost").select(
        F.col("key").alias("key2"), F.col("row").alias("row2"), "family", "span.likeness",
        F.col("at").alias("first"), "span.last", F.col("line").alias("paragraph"), "bottom",
    )
    start = F.greatest(F.col("first") - _AROUND, F.lit(0))
    near = F.slice(_words(F.col("text"))["w"], start + 1, F.col("last") + _AROUND + 1 - start)
    whole = rows.dropDuplicates(["key", "row"]).join(spans, (F.col("row") == F.col("row2")) & F.col("key").eqNullSafe(F.col("key2")))
    whole = whole.select("key", "row", "family", "likeness", "first", "last", "paragraph", "bottom", F.array_join(near, " ").alias("near"))
    named = [(F.col("family") == f) & F.col("near").rlike(r"\b(" + "|".join(names) + r")\b") for f, names in NAMES.items()]
    return whole.where(reduce(or_, named))


@dataclass
class LicenceModel:
    """grams: (gram, weights by class); classes: unknown first; bases: intercepts;
    threshold: least probability of a family; templates: see _templates."""

    grams: DataFrame
    classes: list[str]
    bases: list[float]
    threshold: float
    templates: DataFrame


def _examples(spark: SparkSession, plain: DataFrame, variants: int) -> DataFrame:
    """(label, text, held): templates with words left out and plain text around, and plain text."""
    made = spark.createDataFrame(TEMPLATES, "label string, text string")
    plain = plain.withColumn("nth", F.pmod(F.xxhash64("text"), F.lit(variants)).cast("int"))
    around = plain.groupBy("nth").agg(F.min("text").alias("around"))
    dropped = F.array_join(
        F.filter(
            F.split("text", " "),
            lambda w, i: F.pmod(F.xxhash64(w, i, F.col("nth"), F.col("text")), F.lit(10)) > 0,
        ),
        " ",
    )
    varied = (
        made.withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
        .join(around, "nth", "left")
        .select("label", F.when(F.col("nth") % 4 == 0, F.col("text")).otherwise(dropped).alias("text"), "nth", "around")
        .select("label", F.when(F.col("nth") % 2 == 0, F.concat_ws(" ", "text", F.substring("around", 1, 300))).otherwise(F.col("text")).alias("text"), "nth")
    )
    hard = spark.createDataFrame([(t,) for t in PLAIN + SIBLINGS], "text string").withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    hard = hard.join(around, "nth", "left").select(
        F.when(F.col("nth") % 2 == 0, F.concat_ws(" ", "text", F.substring("around", 1, 300))).otherwise(F.col("text")).alias("text"), "nth"
    )
    others = plain.select("text", "nth").unionByName(hard).select(F.lit(UNKNOWN).alias("label"), "text", "nth")
    return varied.unionByName(others).select("label", "text", (F.col("nth") % 5 == 4).alias("held"))


def plain_lines(texts: DataFrame, templates: DataFrame, most: int = 4000) -> DataFrame:
    """(text) of the different lines of texts (t) that hold no part of a notice.

    Of more than `most` lines those of the smallest hash are taken.
    """
    notices = template_matches(texts, templates, "t", "t").select(
        F.col("key").alias("t"), F.explode(F.sequence("paragraph", "bottom")).alias("nth")
    )
    lines = texts.select("t", F.posexplode(F.split("t", "\n", -1)).alias("nth", "text")).join(notices, ["t", "nth"], "left_anti")
    lines = lines.where("length(text) > 0").select("text").distinct()
    return lines.orderBy(F.xxhash64("text"), "text").limit(most)


def fit_licences(docs: DataFrame, text: str = "text", most: int = 400, variants: int = 40, most_lines: int = 4000) -> LicenceModel:
    """Fit on the templates and on at most `most_lines` plain lines of `most` documents.

    The documents are those of the smallest hash of their text, and so are the lines.
    Their lines are plain, also those that share words with a template, unless a notice is found in them. So
    are PLAIN and SIBLINGS, in training as for the threshold. The candidates for weights
    are the n-grams of the templates and of these sentences.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    pairs = scratch.put(_templates(spark), "pairs")
    some = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("t")).orderBy(F.xxhash64("t"), "t").limit(most)
    some = scratch.put(some.distinct(), "some")
    lines = plain_lines(some, pairs, most_lines)
    examples = _examples(spark, scratch.put(lines, "plain"), variants)
    # Written, so that n-grams are made once and not once for each word of the vocabulary.
    examples = scratch.put(examples.withColumn("grams", ngrams(F.col("text"))), "examples")
    known = spark.createDataFrame([(t,) for t in [t for _, t in TEMPLATES] + PLAIN + SIBLINGS], "text string")
    vocabulary = sorted({r["gram"] for r in known.select(F.explode(ngrams(F.col("text"))).alias("gram")).distinct().collect()})
    classes = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    has = F.transform(F.array(*[F.lit(g) for g in vocabulary]), lambda g: F.array_contains(F.col("grams"), g).cast("double"))
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1
    rows = examples.select(
        "held", label.cast("double").alias("label"), array_to_vector(has).alias("features")
    )
    rows = scratch.put(rows, "features")
    learner = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.7, standardization=False, maxIter=60
    )
    model = learner.fit(rows.where("NOT held"))
    weights = model.coefficientMatrix.toArray().T.tolist()
    used = [(g, w) for g, w in zip(vocabulary, weights, strict=True) if any(w)]
    table = scratch.put(spark.createDataFrame(used, "gram string, weights array<double>").coalesce(1), "weights")
    # Held-out plain text sets how sure a family must be.
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(classes) - 1))
    plain = model.transform(rows.where("held AND label = 0")).agg(F.percentile_approx(best, 0.999, 10_000).alias("p"))
    threshold = min(0.9, max(0.5, (plain.first()["p"] or 0.0) + 0.05))
    return LicenceModel(table, classes, model.interceptVector.toArray().tolist(), threshold, pairs)


def scan_licences(
    docs: DataFrame, model: LicenceModel, key: str = "doc_id", text: str = "text", confirm: float = _CONFIRM
) -> DataFrame:
    """(key, paragraph, family, probability, likeness) of notices of a licence.

    paragraph is the line in which the notice begins, counted from 0. likeness is that of
    the notice and a template of the family, see template_matches; below `confirm` the
    prediction is not taken. Rows equal in key and text give one set of findings; a null
    or empty text gives none. The short tables of weights and of template pairs are as
    long as the vocabulary of the templates, whatever the input.
    """
    spans = template_matches(docs, model.templates, key, text, confirm)
    own = ["key", "row", "family", "likeness", "first", "paragraph"]
    grams = spans.select(*own, F.explode(ngrams(F.col("near"))).alias("gram"))
    hits = grams.join(F.broadcast(model.grams), "gram")
    sums = [F.sum(F.element_at("weights", k + 1)).alias(f"s{k}") for k in range(len(model.classes))]
    scores = hits.groupBy(*own).agg(*sums)
    total = F.array(*[F.col(f"s{k}") + b for k, b in enumerate(model.bases)])
    odds = F.transform(total, lambda s: F.exp(s - F.array_max(total)))
    share = F.array_max(odds) / F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    place = F.array_position(total, F.array_max(total)).cast("int")
    best = scores.select(*own, F.element_at(F.array(*[F.lit(c) for c in model.classes]), place).alias("best"), share.alias("probability"))
    sure = best.where((F.col("family") == F.col("best")) & (F.col("probability") >= model.threshold))
    found = sure.groupBy("key", "row", "paragraph", "family").agg(F.max("probability").alias("probability"), F.max("likeness").alias("likeness"))
    return found.select(F.col("key").alias(key), F.col("row").alias("__row"), "paragraph", "family", "probability", "likeness")


def document_licences(docs: DataFrame, model: LicenceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of docs: key, family (of its surest paragraph, else unknown), n_paragraphs,
    paragraph (the first of that sureness) and probability, both null for unknown."""
    found = scan_licences(docs, model, key, text)
    sure = F.struct(F.round("probability", 6).alias("p"), (-F.col("paragraph")).alias("at"), "family", "probability")
    per_row = found.groupBy(F.col(key).alias("__key"), "__row").agg(F.max(sure).alias("best"), F.count_distinct("paragraph").alias("n"))
    rows = docs.select(F.col(key), F.xxhash64(F.col(key), F.col(text)).alias("__own"))
    return rows.join(per_row, (F.col("__own") == F.col("__row")) & F.col(key).eqNullSafe(F.col("__key")), "left").select(
        key,
        F.coalesce("best.family", F.lit(UNKNOWN)).alias("family"),
        F.coalesce("n", F.lit(0)).alias("n_paragraphs"),
        (-F.col("best.at")).alias("paragraph"),
        F.col("best.probability").alias("probability"),
    )
