"""Licence scans with a trained paragraph classifier, in DataFrame and ML-pipeline operations only.

Paragraphs are lines. A multinomial logistic regression over word uni- and bigrams, made
sparse by an elastic net, tells licence families apart, with a class ``unknown`` for all
else. It is fitted on notices of each family with words left out, and on at most
``MAX_NEGATIVES`` paragraphs of the corpus, taken by hash. Probabilities are calibrated on
held-out rows by a temperature, and a family needs at least the probability that keeps
held-out unknowns out. A prediction counts as confirmed if enough of a template's words,
and of the paragraph's own, are shared.

Scoring is a join with the table of weights (at most ``VOCABULARY`` n-grams, broadcast).
Paragraphs without any word of the vocabulary's n-grams have no weight to add; they are
``unknown`` by the intercepts, and are left out before the join. Cutting a line into words
costs most, so one pattern over whole texts and then lines passes those that may have such
a word, and only these are cut and looked at.
"""

from __future__ import annotations

import math
import re
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MAX_NEGATIVES = 4_000
VOCABULARY = 2_000
UNKNOWN = "unknown"
CONFIRMED = 0.6
#: A word in more than this share of the sample of paragraphs tells nothing.
USUAL = 0.005

# Fixed notices of licence families: what projects commonly write.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Distributed under the Apache 2.0 license.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GPL, version 2 or later.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Distributed under the terms of the LGPL version 3.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL version 3 or later.",
    ),
    "BSD": (
        "Distributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "proprietary": (
        "Copyright the author. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited.",
    ),
}
FAMILIES = (UNKNOWN, *TEMPLATES)


def words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^a-z0-9.]+|\.(?![0-9])"), lambda w: w != "")


def ngrams(w: Column) -> Column:
    """Distinct words and pairs of neighbours, of an array of words."""
    pairs = F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(w, F.filter(pairs, lambda p: p.isNotNull())))


def _templates(spark) -> DataFrame:
    rows = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    return spark.createDataFrame(rows, "family string, template string").select("family", words(F.col("template")).alias("template"))


def may_have(text: Column, vocabulary: list[str]) -> Column:
    """Whether a text or line may have one of these words: all that have one pass, and few others. A word is never
    next to a letter or digit that isn't its own."""
    first = groupby(sorted({w for w in vocabulary if w}), key=lambda w: w[0])
    choices = [f"{re.escape(c)}(?:{'|'.join(re.escape(w[1:]) for w in own)})" for c, own in first]
    return F.concat(F.lit(" "), F.lower(text)).rlike(f"[^a-z0-9](?:{'|'.join(choices) or '(?!)'})(?![a-z0-9])")


def paragraphs(docs: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """k, paragraph (from 0), w (words) of every line of every text; with a ``vocabulary``, of those that may have a
    word of it."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    if vocabulary is not None:
        docs = docs.where(may_have(F.col("text"), vocabulary))
    found = docs.select("k", F.posexplode(lines).alias("paragraph", "line"))
    if vocabulary is not None:
        found = found.where(may_have(F.col("line"), vocabulary))
    return found.select("k", "paragraph", words(F.col("line")).alias("w"))


class Model:
    """Weights (gram, class, weight) as rows, intercepts by class, temperature and least probability."""

    def __init__(self, weights, usual: set[str], intercepts, temperature: float, least: float) -> None:
        self.weights, self.usual, self.intercepts = weights, usual, intercepts
        self.temperature, self.least = temperature, least

    def vocabulary(self) -> list[str]:
        """Words of which every n-gram with a weight has one."""
        return sorted({w for gram, _ in self.weights for w in gram.split(" ")} - self.usual)


def fit(paras: DataFrame, n_paragraphs: int, copies: int = 40, seed: int = 1) -> Model:
    """``paras`` (k, paragraph, w): the corpus, of about ``n_paragraphs`` lines with words. Training rows are a
    sample of whole lines and, for each template, ``copies`` versions with about a quarter of the words left out."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    spark = paras.sparkSession
    known = _templates(spark)
    # a paragraph that shares most of its words with a template is no example of unknown
    alike = F.exists("all", lambda t: F.size(F.array_intersect("w", t)) >= 0.75 * F.size(F.array_distinct(t)))
    every = F.broadcast(known.agg(F.collect_list("template").alias("all")))  # one row
    order = F.xxhash64("k", "paragraph")
    negatives = (
        common.least_hashes(paras, n_paragraphs, order, MAX_NEGATIVES, F.size("w") > 0)
        .join(every)
        .where(~alike)
        .select(F.lit(0.0).alias("label"), "w", order.alias("h"))
    )
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    chance = lambda w, i: F.pmod(F.xxhash64(w, i, F.col("copy"), F.lit(seed)), F.lit(100)) >= 25
    positives = known.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        label.cast("double").alias("label"),
        F.when(F.col("copy") == 0, F.col("template")).otherwise(F.filter("template", chance)).alias("w"),
        F.xxhash64("template", "copy").alias("h"),
    )
    rows = negatives.unionByName(positives).where(F.size("w") > 0).select("label", "h", "w", ngrams(F.col("w")).alias("grams"))
    rows = common.written(rows, "licence-train")
    # words that the corpus uses anyway tell nothing: n-grams need another one
    usual = rows.where("label = 0").select(F.explode(F.array_distinct("w")).alias("word")).groupBy("word").count()
    usual = {r[0] for r in usual.where(F.col("count") > USUAL * MAX_NEGATIVES).collect()}
    told = lambda g: ~F.array_contains(F.array(F.lit(""), *map(F.lit, sorted(usual))), g)
    rows = rows.withColumn("grams", F.filter("grams", lambda g: F.exists(F.split(g, " "), told)))
    train, held = rows.where("pmod(h, 5) <> 0"), rows.where("pmod(h, 5) = 0")
    grams = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=3.0, binary=True).fit(train)
    weight = F.when(F.col("label") == 0, 1.0).otherwise(2.0)
    regression = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, weightCol="weight", standardization=False
    )
    fitted = regression.fit(grams.transform(train).withColumn("weight", weight))
    # classes are those up to the last label; the families' order makes that all of them
    matrix, base = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = {
        (g, c): float(matrix[c, i])
        for i, g in enumerate(grams.vocabulary)
        for c in range(matrix.shape[0])
        if abs(matrix[c, i]) > 1e-6
    }
    scored = fitted.transform(grams.transform(held)).select("label", "rawPrediction").collect()  # a fifth of the bounded sample
    raws = [(int(r[0]), r[1].toArray().tolist()) for r in scored]

    def probabilities(raw, temperature):
        z = [x / temperature for x in raw]
        top = max(z)
        e = [math.exp(x - top) for x in z]
        return [x / sum(e) for x in e]

    def loss(temperature):
        return -sum(math.log(max(probabilities(r, temperature)[y], 1e-12)) for y, r in raws)

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    above = [max(probabilities(r, temperature)[1:]) for y, r in raws if y == 0]
    least = min(0.95, max([0.5, *sorted(above)[: math.ceil(0.995 * len(above))][-1:]]))
    return Model(weights, usual, base.tolist(), temperature, least)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, paragraph (line number from 0), family, probability, similarity, confirmed: every paragraph
    that the classifier gives a licence family.

    ``similarity``: the largest, over the family's templates and the paragraph's stretches of a template's
    length, of the mean of the shares of shared words; so a notice inside a long line is confirmed. Null and empty texts have no findings; rows that repeat id and text have them each.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", common.row_key().alias("k"))
    texts = docs.select("k", "text").where("text is not null")
    if model is None:  # lines are counted whole; only the sampled ones are cut into words
        with_words = F.filter(F.split("text", "\n", -1), lambda line: line.rlike("[A-Za-z0-9]"))
        count = docs.where("text is not null").agg(F.sum(F.size(with_words))).first()[0]
        model = fit(paragraphs(texts), count or 0)
    if not model.weights:
        return spark.createDataFrame([], FOUND)
    n = len(model.intercepts)
    by_gram: dict[str, list[float]] = {}
    for (g, c), x in model.weights.items():
        by_gram.setdefault(g, [0.0] * n)[c] = x
    table = spark.createDataFrame(list(by_gram.items()), "gram string, weights array<double>")  # at most VOCABULARY rows
    vocabulary = model.vocabulary()
    own = F.array(*map(F.lit, vocabulary))
    near = paragraphs(texts, vocabulary).where(F.arrays_overlap("w", own)).dropDuplicates(["k", "paragraph"])
    sums = [F.sum(F.col("weights")[c]).alias(f"s{c}") for c in range(n)]
    scores = (
        near.select("k", "paragraph", F.explode(ngrams(F.col("w"))).alias("gram"))
        .join(F.broadcast(table), "gram")
        .groupBy("k", "paragraph")
        .agg(*sums)
    )
    z = [F.exp((F.col(f"s{c}") + model.intercepts[c]) / model.temperature) for c in range(n)]
    total = sum(z[1:], z[0])
    best = F.array_max(F.array(*(F.struct((z[c] / total).alias("p"), F.lit(FAMILIES[c]).alias("family")) for c in range(n))))
    named = scores.select("k", "paragraph", best.alias("best")).where(
        (F.col("best.family") != UNKNOWN) & (F.col("best.p") >= model.least)
    )
    named = named.select("k", "paragraph", "best.family", F.col("best.p").alias("probability"))
    templates = _templates(spark).groupBy("family").agg(F.collect_list("template").alias("templates"))
    # the stretch of the paragraph, as long as the template, that shares most with it
    starts = lambda t: F.sequence(
        F.lit(0), F.greatest(F.size("w") - F.size(t), F.lit(0)), F.greatest(F.floor(F.size(t) / 4), F.lit(1)).cast("int")
    )
    stretches = lambda t: F.array_append(
        F.transform(starts(t), lambda at: F.slice("w", at + 1, F.size(t))),
        F.slice("w", F.greatest(F.size("w") - F.size(t), F.lit(0)) + 1, F.size(t)),
    )
    alike = lambda t, own: 0.5 * F.size(F.array_intersect(own, t)) * (
        1 / F.size(F.array_distinct(t)) + 1 / F.size(F.array_distinct(own))
    )
    similar = F.array_max(
        F.transform("templates", lambda t: F.array_max(F.transform(stretches(t), lambda own: alike(t, own))))
    )
    found = (
        named.join(near, ["k", "paragraph"])
        .join(F.broadcast(templates), "family")  # one row for each family
        .withColumn("similarity", similar)
        .select("k", "paragraph", "family", "probability", "similarity")
    )
    return docs.select("doc_id", "k").join(found, "k").select(
        "doc_id", "paragraph", "family", "probability", "similarity", (F.col("similarity") >= CONFIRMED).alias("confirmed")
    )


FOUND = "doc_id long, paragraph int, family string, probability double, similarity double, confirmed boolean"


def op10_license_scan(spark, sf_dir) -> DataFrame:
    """Findings of every document, with no row for documents without one."""
    found = scan(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "paragraph", "family", F.round("probability", 4).alias("probability"), F.round("similarity", 4).alias("similarity"), "confirmed"
    )
