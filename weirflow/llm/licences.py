"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Notices of known licence families, varied by dropping words and by standing inside other text, are told apart from each
other, from unknown licences and from ordinary paragraphs by a sparse multinomial logistic regression on hashed word 1-grams and
2-grams. Unknown licences are made from the notices of the families: every word that few families use becomes an invented one.
The probability from which a paragraph counts as a licence is calibrated on ordinary paragraphs that the model was not trained on.

All ordinary paragraphs of the table train or calibrate, each different one once. A 1-gram or 2-gram of words that no template
holds says nothing about a licence, so such words only count by how many they are. Paragraphs then have few features, and those
with the same ones are one row with its number of paragraphs.

A predicted family is confirmed by comparison with its templates: by the share of what they have in common, and by that share
weighed by how few families use a word or pair, so that "licensed under the ... license, version" alone confirms none. The least
weighed share is calibrated on the varied and the unknown notices. A licence that is not confirmed is ``unknown``.

Only built-in functions and Spark's own learners are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence families and what their notices say.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License, see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Distributed under the 3-clause BSD license.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Distributed under the terms of the GNU GPL, version 2 or later.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "Public domain": (
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "Proprietary": (
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
        "All rights reserved. Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.",
    ),
}
NONE, UNKNOWN = "none", "unknown"
FEATURES = 1 << 13
#: Steps of the calibrated probability.
STEPS = 10_000
#: Ordinary paragraphs that notices stand beside, one of each range of hashes, and how many of their words.
PLACES, BESIDE = 1000, 8
TASK_ROWS = 200_000
#: A word of more families than this belongs to the wording that all notices share.
FEW = 3


def words_of(text: Column) -> Column:
    """Lower-case words: letters and digits, with the marks inside a version or a name."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|\.(?!\p{N})"), "")


def grams_of(words: Column) -> Column:
    """Words and pairs of neighbours; a blank paragraph has none."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, pairs)


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, template string").withColumn("words", words_of(F.col("template")))


@dataclass(frozen=True)
class Model:
    learned: LogisticRegressionModel
    families: tuple[str, ...]
    least: float
    least_own: float


def known_templates(spark: SparkSession) -> DataFrame:
    """(predicted, known, weights): the 1-grams and 2-grams of each family's templates (all templates for ``unknown``), and what each counts."""
    told = templates(spark).select("family", grams_of(F.col("words")).alias("grams"))
    of = told.select("family", F.explode("grams").alias("gram")).groupBy("gram").agg((1 / F.pow(F.countDistinct("family"), 2)).alias("weight"))
    weights = of.agg(F.map_from_entries(F.collect_list(F.struct("gram", "weight"))).alias("weights"))
    both = told.unionByName(told.withColumn("family", F.lit(UNKNOWN))).groupBy(F.col("family").alias("predicted")).agg(F.collect_list("grams").alias("known"))
    return both.withColumn("weights", weights.scalar())


def _weight(grams: Column) -> Column:
    return F.aggregate(F.array_distinct(grams), F.lit(0.0), lambda total, g: total + F.coalesce(F.try_element_at("weights", g), F.lit(1.0)))


def similarity(template: Column, grams: Column) -> Column:
    """Share of the 1-grams and 2-grams in common, of the shorter of the two."""
    return F.size(F.array_intersect(template, grams)) / F.least(F.size(F.array_distinct(template)), F.size(F.array_distinct(grams)))


def own_similarity(template: Column, grams: Column) -> Column:
    """The same share, weighed by how few families use a gram (``weights``); one of no family counts in full."""
    return _weight(F.array_intersect(template, grams)) / F.least(_weight(template), _weight(grams))


def _largest(share) -> Column:
    """The largest share of the grams with a known template."""
    return F.array_max(F.transform("known", lambda t: share(t, F.col("grams"))))


def words_of_templates(spark: SparkSession) -> list[str]:
    return sorted({w for r in templates(spark).select("words").collect() for w in r.words})


def codes_of(spark: SparkSession, words: Column) -> Column:
    """The words as numbers: 0 for one that no template holds."""
    said = words_of_templates(spark)
    return F.transform(words, lambda w: F.when(w.isin(said), F.hash(w)).otherwise(F.lit(0)))


def known_codes(codes: Column) -> Column:
    return F.array_distinct(F.array_remove(codes, 0))


def may_be_alike(spark: SparkSession, words: Column, least: float, codes: Column | None = None) -> Column:
    """False only if no template reaches a similarity of ``least``, so that nothing is lost.

    A paragraph without a word of the templates has no gram in common with them. With one such word it has that word alone in
    common, since no template says a word twice in a row, and at least as many grams as it has different words. ``codes`` are
    those of the words, if they are there.
    """
    if least <= 0:
        return F.lit(True)
    fewest = min(len(set(r.words)) for r in templates(spark).select("words").collect())
    common = F.size(known_codes(codes_of(spark, words) if codes is None else codes))
    shorter = F.least(F.size(F.array_distinct(words)), F.lit(fewest))
    return (common >= 2) | ((common == 1) & (shorter * least <= 1))


def features_of(codes: Column) -> Column:
    """Sorted numbers of the templates' words, of pairs of them side by side, and of how many other words there are (0, 1, 3, 7 or more)."""
    pairs = F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))), lambda a, b: F.when((a != 0) & (b != 0), F.hash(a, b)).otherwise(F.lit(0)))
    others = F.size(codes) - F.size(F.array_remove(codes, 0))
    many = F.least(F.floor(F.log2(others + 1)), F.lit(3)).cast("int") + 1
    return F.array_sort(F.array_distinct(F.array_remove(F.concat(codes, pairs, F.array(many)), 0)))


def _hashing() -> HashingTF:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")


def paragraphs_of(docs: DataFrame, doc_id: str, text: str, split: str) -> DataFrame:
    """(doc_id, paragraph, text) of each paragraph with a word; paragraphs are numbered from 0 in their document."""
    parts = F.posexplode(F.split(F.col(text), split)).alias("paragraph", "text")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), parts).where(F.trim("text") != "")


def _probabilities(frame: DataFrame, learned: LogisticRegressionModel) -> DataFrame:
    """``p``: the probabilities of the classes, for ``grams``."""
    return learned.transform(_hashing().transform(frame)).withColumn("p", vector_to_array("probability"))


def ordinary(docs: DataFrame, doc_id: str, text: str, split: str) -> DataFrame:
    """(grams, beside, learn, held): the features of all ordinary paragraphs, their first words, and how many train and calibrate.

    A paragraph is ordinary if less than half of its different words are in templates. Paragraphs of the same words count once,
    wherever they stand; their hash says whether they train or calibrate.
    """
    spark = docs.sparkSession
    # generators make words and codes once for all that asks for them
    parts = paragraphs_of(docs, doc_id, text, split).select(F.explode(F.array(words_of(F.col("text")))).alias("words")).where(F.size("words") > 0)
    parts = parts.select("words", F.explode(F.array(codes_of(spark, F.col("words")))).alias("codes"))
    parts = parts.where(F.size(known_codes(F.col("codes"))) * 2 < F.size(F.array_distinct("words")))
    beside = F.slice("codes", 1, BESIDE).alias("beside")
    each = parts.select(F.xxhash64("words").alias("h"), F.hash("words").alias("h2"), features_of(F.col("codes")).alias("grams"), beside).distinct()
    learn = F.pmod("h", F.lit(2)) == 0
    return each.groupBy("grams", "beside").agg(F.count_if(learn).alias("learn"), F.count_if(~learn).alias("held"))


def varied_notices(spark: SparkSession, variants: int) -> DataFrame:
    """(family, words, variant): the templates as they are, with an eighth of their words dropped, and as notices of unknown licences.

    In an ``unknown`` notice every word of at most ``FEW`` families is an invented one; templates that keep less than half of their
    words have no shared wording and give none.
    """
    known = templates(spark)
    few = known.select("family", F.explode("words").alias("word")).groupBy("word").agg(F.countDistinct("family").alias("n")).where(F.col("n") <= FEW)
    few = few.agg(F.collect_set("word").alias("few"))
    known = known.withColumn("few", few.scalar()).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    kept = F.filter("words", lambda w, i: (F.col("variant") == 0) | (F.pmod(F.xxhash64(i, F.col("variant"), F.lit("drop")), F.lit(8)) > 0))
    invented = F.transform("words", lambda w: F.when(F.array_contains("few", w), F.concat(F.lit("x"), F.hex(F.xxhash64(w, "variant", "family")))).otherwise(w))
    shared = F.size(F.filter("words", lambda w: ~F.array_contains("few", w))) >= F.size("words") / 2
    own = known.select("family", kept.alias("words"), "variant")
    return own.unionByName(known.where(shared).select(F.lit(UNKNOWN).alias("family"), invented.alias("words"), "variant"))


def _least_own(spark: SparkSession, variants: int) -> float:
    """Half way between the weighed shares of unknown notices (99 of 100 are below) and of the families' own (99 of 100 above)."""
    notices = varied_notices(spark, variants).select(F.col("family").alias("predicted"), grams_of(F.col("words")).alias("grams"))
    told = notices.join(F.broadcast(known_templates(spark)), "predicted")
    shares = told.select((F.col("predicted") == UNKNOWN).alias("unknown"), _largest(own_similarity).alias("own"))
    ends = shares.agg(F.expr("percentile(own, 0.99) FILTER (WHERE unknown)").alias("a"), F.expr("percentile(own, 0.01) FILTER (WHERE NOT unknown)").alias("b")).first()
    return ((ends.a or 0.0) + ends.b) / 2


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", split: str = "\n", variants: int = 40, least: float = 0.8) -> Model:
    """A model from the templates and all ordinary paragraphs.

    Paragraphs of which half of the words are in templates are left out. Every second one calibrates: the
    probability to be reached is ``least``, or what 995 of 1000 of these stay below, if that is more (0.99 at most). The others train;
    if they are more than the notices, they weigh as much as these together. Tasks add up in any order, so probabilities of
    two runs may differ by rounding.
    """
    spark = docs.sparkSession
    families = tuple([NONE, *TEMPLATES, UNKNOWN])
    plain = ordinary(docs, doc_id, text, split).cache()
    n, learns = plain.agg(F.count(F.lit(1)), F.coalesce(F.sum("learn"), F.lit(0))).first()
    # each iteration of the learner is a job over them, of few tasks as long as the rows are few
    dealt = plain.coalesce(max(spark.sparkContext.defaultParallelism, n // TASK_ROWS))

    place = F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(i))])
    varied = varied_notices(spark, variants).withColumn("h", F.xxhash64("family", "words", "variant"))
    # half of the notices stand beside an ordinary paragraph's words
    places = max(1, min(PLACES, n // 8))
    picked = F.xxhash64("grams", "beside")
    beside = plain.groupBy(F.pmod(picked, F.lit(places)).alias("n")).agg(F.min(F.struct(picked.alias("h"), "beside"))["beside"].alias("more"))
    varied = varied.withColumn("n", F.pmod("h", F.lit(places))).join(F.broadcast(beside), "n", "left")
    more = F.when(F.col("variant") % 2 == 1, F.coalesce("more", F.array().cast("array<int>"))).otherwise(F.array().cast("array<int>"))
    codes = F.concat(codes_of(spark, F.col("words")), more)
    varied = varied.select(features_of(codes).alias("grams"), place[F.col("family")].alias("label"), F.lit(1.0).alias("weight")).coalesce(1).cache()
    weight = F.col("learn") * min(1.0, varied.count() / max(learns, 1))
    training = varied.unionByName(dealt.where("learn > 0").select("grams", F.lit(0).alias("label"), weight.alias("weight")))
    training = _hashing().transform(training.withColumn("label", F.col("label").cast("double"))).select("features", "label", "weight")
    learner = LogisticRegression(family="multinomial", regParam=2e-3, elasticNetParam=0.5, maxIter=60, standardization=False, weightCol="weight")
    learned = learner.fit(training)
    varied.unpersist()

    step = F.greatest(F.ceil((1 - F.col("p")[0]) * STEPS), F.lit(0))
    held = _probabilities(plain.where("held > 0"), learned).groupBy(step.alias("step")).agg(F.sum("held").alias("n")).orderBy("step").collect()
    plain.unpersist()
    below, total, reached = 0, sum(r.n for r in held), 0.0
    for r in held:
        if below < 0.995 * total:
            below, reached = below + r.n, r.step / STEPS
    return Model(learned, families, min(max(least, reached), 0.99), _least_own(spark, variants))


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", split: str = "\n", alike: float = 0.5) -> DataFrame:
    """One row for each paragraph that is a licence: doc_id, paragraph, family, predicted, probability, similarity, own_similarity, notice.

    ``predicted`` is the family with the largest probability, or ``unknown``; ``similarity`` is the largest share of words and
    pairs that the paragraph and a template of this family have in common, of the shorter of the two, and ``own_similarity`` the
    largest one weighed by how few families use them. The family is ``unknown`` if ``similarity`` is below ``alike`` or
    ``own_similarity`` below the calibrated share; with a similarity below half of ``alike`` the paragraph is no licence.

    Null, empty and blank texts and paragraphs give no rows. A paragraph of one word is compared by that word. Rows are
    scanned each for itself, so repeated rows give repeated results; a null doc_id stays null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    # generators make words and codes once for all that asks for them
    parts = paragraphs_of(docs, doc_id, text, split).select("doc_id", "paragraph", "text", F.explode(F.array(words_of(F.col("text")))).alias("words"))
    parts = parts.select("doc_id", "paragraph", "text", "words", F.explode(F.array(codes_of(spark, F.col("words")))).alias("codes"))
    parts = parts.where(may_be_alike(spark, F.col("words"), alike / 2, F.col("codes")))
    parts = parts.select("doc_id", "paragraph", "text", features_of(F.col("codes")).alias("grams"))
    scored = _probabilities(parts, model.learned).where(1 - F.col("p")[0] >= model.least)
    each = F.slice("p", 2, len(model.families) - 1)
    predicted = F.element_at(F.array(*map(F.lit, model.families[1:])), F.array_position(each, F.array_max(each)).cast("int"))
    scored = scored.select("doc_id", "paragraph", F.col("text").alias("notice"), grams_of(words_of(F.col("text"))).alias("grams"), predicted.alias("predicted"), (1 - F.col("p")[0]).alias("probability"))
    compared = scored.join(F.broadcast(known_templates(spark)), "predicted")
    compared = compared.withColumns({"similarity": _largest(similarity), "own_similarity": _largest(own_similarity)})
    confirmed = (F.col("similarity") >= alike) & (F.col("own_similarity") >= model.least_own)
    return compared.where(F.col("similarity") >= alike / 2).select(
        "doc_id",
        "paragraph",
        F.when(confirmed, F.col("predicted")).otherwise(F.lit(UNKNOWN)).alias("family"),
        "predicted",
        "probability",
        "similarity",
        "own_similarity",
        "notice",
    )
