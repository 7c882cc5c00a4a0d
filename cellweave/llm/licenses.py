"""Licence scan of every paragraph of every text, with DataFrame functions and Spark ML only.

Lines without words (blank ones, or bare comment marks) end a paragraph. What is scored are all runs of lines inside a paragraph that have up to LINES lines, or up to WORDS words in any
number of lines, so a notice is found on one line, wrapped at any width, behind comment marks, and between other lines of its paragraph; of confirmed runs of one family the shortest count, and of those that overlap one.

A multinomial logistic regression with an L1 penalty over words, pairs and triples of words tells licence families from `unknown`. It learns from
the templates below, from variants of them with a word left out, from sentences that only speak of licences, and from the lines and longest runs of a
bounded sample of documents (`sample`) that share no triple of words with a template. Its scores are divided by a temperature fitted on rows held
out of training, so that they are calibrated, the unknown class included. A family is accepted where it is the likeliest class, its probability is at
least `least_probability`, and a template of that family confirms it: at least `least_similarity` of the template's word pairs stand in the run.

The weights that aren't zero form a small table (at most the templates' word groups), which is broadcast. Words whose groups, even all
together, cannot outweigh the intercept of `unknown` are weak, frequent ones first; a run with weak words alone is unknown without being
taken apart into word groups. Partial sums are by run, so frequent lines and large documents are no load; texts are read whole, however long.

Null and empty texts have no licence. Every row gets a result, rows without doc_id too; equal rows get equal ones, and rows that share a doc_id but not their
text each get their own. Of equally likely families the first by order of TEMPLATES is taken. An empty table gives an empty result, and training on
one leaves the templates and sentences alone to learn from. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import written

UNKNOWN = "unknown"
#: Notices as licences and their authors state them (fixed values).
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 2 or later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
}
#: Sentences with words of licences that grant nothing.
OTHERS = (
    "He lost his driving licence and had to renew it",
    "The licence plate of the car was version 2 of the design",
    "The general public is under the impression that terms are free",
    "A license fee is due for use of the software",
    "The foundation published a free copy of the source",
    "All rights reserved, no license is granted",
    "This file is under review and may not be released",
    "Her work was released under a new version of the name",
    "Public software is free to use in general terms",
    "The commons were open to the public, with attribution to the library",
)
SAMPLE, LEAST_PROBABILITY, LEAST_SIMILARITY = 1000, 0.5, 0.8
#: A run has so many lines at most, or so many words: over twice those of the longest template.
LINES, WORDS = 5, 80
#: What tells a run apart.
RUN = ("doc_id", "t", "line", "n_lines")
TEMPERATURES = tuple(0.5 * 1.25**i for i in range(12))


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}0-9]+"), "")


def groups_of(words: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Distinct runs of 1, 2 and 3 words."""

    def runs(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))

    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.when(F.size(words) >= n, runs(n)).otherwise(empty) for n in sizes]))


def rows(spark: SparkSession, values: list[dict], schema: str) -> DataFrame:
    """A small table from the driver."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))


def contains(words: Column, some: list[str]) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, some)).cast("array<string>"))


def runs(docs: DataFrame, telling: list[str] | None = None) -> DataFrame:
    """doc_id, t (a hash of the text), line (from 0), n_lines and words of every run of lines; with `telling`, of those that hold one of these words."""
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.transform(F.split("text", "\n"), words_of).alias("lines"))
    if telling is not None:
        each = each.where(F.exists("lines", lambda x: contains(x, telling)))
    each = each.withColumn("sizes", F.transform("lines", F.size))

    def reach(i: Column) -> Column:
        """How many lines from line i on are in its longest run."""
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(True).alias("open"))

        def further(a: Column, size: Column) -> Column:
            more = a.open & (size > 0) & ((a.n < LINES) | (a.words + size <= WORDS))
            return F.struct(F.when(more, a.n + 1).otherwise(a.n).alias("n"), F.when(more, a.words + size).otherwise(a.words).alias("words"), more.alias("open"))

        return F.aggregate(F.slice("sizes", i + 1, WORDS), start, further, lambda a: a.n)

    from_each = F.transform("lines", lambda x, i: F.struct(i.alias("line"), F.slice("lines", i + 1, reach(i)).alias("near")))
    lines = each.select("doc_id", "t", F.inline(F.filter(from_each, lambda x: F.size(x.near) > 0)))
    lines = lines.withColumn("n_lines", F.explode(F.sequence(F.lit(1), F.size("near"))))
    found = lines.select("doc_id", "t", "line", "n_lines", F.flatten(F.slice("near", F.lit(1), F.col("n_lines"))).alias("words"))
    return found if telling is None else found.where(contains(F.col("words"), telling))


def examples(docs: DataFrame, sample: int) -> DataFrame:
    """family, words and held_out of all training rows; bounded by the templates and the sample."""
    spark = docs.sparkSession
    given = rows(spark, [{"family": f, "line": t} for f, texts in [*TEMPLATES.items(), (UNKNOWN, OTHERS)] for t in texts], "family:string,line:string")
    given = given.select("family", words_of(F.col("line")).alias("words"))
    n = F.size("words")
    less = given.select("family", "words", F.explode(F.sequence(F.lit(0), n)).alias("i"))  # 0: the whole
    less = less.select("family", "i", F.filter("words", lambda x, k: k + 1 != F.col("i")).alias("words")).where(F.size("words") > 2)
    # without its telling word a notice may be another family's, or anyone's
    less = less.groupBy("words").agg(F.min_by("family", "i").alias("family"), F.min("i").alias("i"), F.count_distinct("family").alias("n"))
    less = less.where("i = 0 or n = 1").select("family", "words")
    triples = given.where(F.col("family") != UNKNOWN).select(F.explode(groups_of(F.col("words"), (3,))).alias("group")).distinct()
    known = [r.group for r in triples.collect()]  # as many as the templates have
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    others = runs(chosen).where(F.col("n_lines").isin(1, LINES)).where(~contains(groups_of(F.col("words"), (3,)), known))
    return less.unionAll(others.select(F.lit(UNKNOWN).alias("family"), "words")).dropDuplicates(["family", "words"]).withColumn("held_out", F.pmod(F.xxhash64("words"), F.lit(4)) == 3)


@dataclass
class Model:
    families: list[str]  # the last one is UNKNOWN
    intercepts: list[float]
    weights: list[dict]  # group, w: one weight a family
    temperature: float
    telling: list[str]  # without one of these words no paragraph gets a known family

    def logits(self, table: DataFrame) -> DataFrame:
        """The runs, with logits (one a family) for their words; equal runs are one row."""
        spark = table.sparkSession
        last = len(self.families) - 1
        # the empty group stands once in each run: it counts how many equal rows of the input have it
        weights = F.broadcast(rows(spark, [*self.weights, {"group": "", "w": [0.0] * (last + 1)}], "group:string,w:array<double>"))
        groups = F.concat(F.array(F.lit("")), groups_of(F.col("words")))
        held = table.select(*RUN, "words", F.explode(groups).alias("group")).join(weights, "group")
        copies = F.count_if(F.col("group") == "")
        sums = held.groupBy(*RUN, "words").agg(*[(F.sum(F.col("w")[k]) / copies).alias(f"w{k}") for k in range(last + 1)])
        return sums.select(*RUN, "words", F.array(*[F.col(f"w{k}") + self.intercepts[k] for k in range(last + 1)]).alias("logits"))


def telling_words(weights: list[dict], intercepts: list[float], frequency: dict[str, int]) -> list[str]:
    """The rarest word of each word group, without those whose groups are too weak even all together; the most frequent are tried first as weak ones."""
    last, gains = len(intercepts) - 1, {}
    for x in weights:
        rarest = min(x["group"].split(" "), key=lambda w: (frequency.get(w, 0), w))
        gain = gains.setdefault(rarest, [0.0] * last)
        for k in range(last):
            gain[k] += max(0.0, x["w"][k] - x["w"][last])
    total, telling = [0.0] * last, []
    for word in sorted(gains, key=lambda w: (-frequency.get(w, 0), w)):
        both = [a + b for a, b in zip(total, gains[word], strict=True)]
        if all(x < intercepts[last] - intercepts[k] for k, x in enumerate(both)):
            total = both
        else:
            telling.append(word)
    return telling


def train(docs: DataFrame, sample: int = SAMPLE, penalty: float = 3e-4) -> Model:
    """Fits the model; the driver gets the weights only."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer
    from pyspark.ml.functions import vector_to_array

    families = [*TEMPLATES, UNKNOWN]
    number = F.coalesce(*[F.when(F.col("family") == f, F.lit(float(i))) for i, f in enumerate(families)])
    data = written(examples(docs, sample).select(number.alias("label"), "held_out", "words", groups_of(F.col("words")).alias("groups")), "license-examples")
    # every known family weighs the same, and all of them as much as what is unknown
    count = data.groupBy("label").count()
    part = F.when(F.col("label") == len(TEMPLATES), 1.0).otherwise(1.0 / len(TEMPLATES)) / F.col("count")
    data = data.join(F.broadcast(count.select("label", (part * 1000).alias("weight"))), "label")
    groups = data.where("label != " + str(len(TEMPLATES))).select("groups")
    vectors = CountVectorizer(inputCol="groups", outputCol="features", binary=True, minDF=1, vocabSize=20000).fit(groups)
    fitted = LogisticRegression(family="multinomial", regParam=penalty, elasticNetParam=1.0, maxIter=60, weightCol="weight", standardization=False).fit(vectors.transform(data.where("not held_out")))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = [{"group": g, "w": matrix[:, i].tolist()} for i, g in enumerate(vectors.vocabulary) if matrix[:, i].any()]
    scored = fitted.transform(vectors.transform(data.where("held_out"))).select("label", "weight", vector_to_array("rawPrediction").alias("x"))
    top = F.array_max("x")

    def loss(t: float) -> Column:
        rest = F.aggregate("x", F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))
        return F.sum(F.col("weight") * (F.log(rest) + (top - F.element_at("x", F.col("label").cast("int") + 1)) / t))

    losses = scored.agg(*[loss(t).alias(f"loss_{k}") for k, t in enumerate(TEMPERATURES)]).first()
    temperature = 1.0 if losses[0] is None else min(zip(losses, TEMPERATURES, strict=True))[1]
    held = sorted({w for x in weights for w in x["group"].split(" ")})
    words = data.where(f"label = {len(TEMPLATES)}").select(F.explode("words").alias("word")).where(F.col("word").isin(held))
    frequency = dict(words.groupBy("word").count().collect())
    return Model(families, intercepts.tolist(), weights, temperature, telling_words(weights, intercepts.tolist(), frequency))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """RUN, words, family and probability of each run whose likeliest class is a family."""
    scores = model.logits(runs(docs, model.telling))
    t = F.transform("logits", lambda x: x / model.temperature)
    scores = scores.withColumn("scaled", t).withColumn("top", F.array_max("scaled"))
    scores = scores.withColumn("probability", 1 / F.aggregate("scaled", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    family = F.element_at(F.array(*map(F.lit, model.families)), F.array_position("scaled", F.col("top")).cast("int"))
    return scores.select(*RUN, "words", family.alias("family"), "probability").where(F.col("family") != UNKNOWN)


def classify(docs: DataFrame, model: Model, least_probability: float = LEAST_PROBABILITY, least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """RUN, family, probability, similarity and confirmed: of the confirmed runs of a family those that hold no other one, and all single lines that aren't confirmed."""
    templates = rows(docs.sparkSession, [{"family": f, "line": x} for f, texts in TEMPLATES.items() for x in texts], "family:string,line:string")
    templates = templates.select("family", groups_of(words_of(F.col("line")), (2,)).alias("pairs")).groupBy("family").agg(F.collect_list("pairs").alias("templates"))  # a few for each family
    both = scored(docs, model).withColumn("pairs", groups_of(F.col("words"), (2,))).join(F.broadcast(templates), "family")
    similarity = F.array_max(F.transform("templates", lambda x: F.size(F.array_intersect(x, F.col("pairs"))) / F.size(x)))
    both = both.withColumn("similarity", similarity)
    confirmed = (F.col("similarity") >= least_similarity) & (F.col("probability") >= least_probability)
    both = both.select(*RUN, "family", "probability", "similarity", confirmed.alias("confirmed"), (F.col("line") + F.col("n_lines")).alias("end"))
    of_family = Window.partitionBy("doc_id", "t", "family").orderBy("line")
    end = F.min(F.when(F.col("confirmed"), F.col("end")))
    both = both.withColumns({"first_end": end.over(of_family.rangeBetween(0, WORDS - 1)), "later_end": end.over(of_family.rangeBetween(1, WORDS - 1))})
    shortest = (F.col("end") == F.col("first_end")) & (F.col("later_end").isNull() | (F.col("later_end") > F.col("end")))
    return both.where(F.when(F.col("confirmed"), shortest).otherwise(F.col("n_lines") == 1)).select(*RUN, "family", "probability", "similarity", "confirmed")


def apart(runs: Column) -> Column:
    """How many runs (end, line), in ascending order, there are of which no two overlap: the one that ends first, then the next one after it, and so on."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(runs, none, lambda a, x: F.when(x.line >= a.end, F.struct((a.n + 1).alias("n"), x.end.alias("end"))).otherwise(a), lambda a: a.n)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """For every document: the confirmed families (sorted, distinct), how many runs apart from each other state one, how many lines were not confirmed, and the largest probability."""
    run = F.struct((F.col("line") + F.col("n_lines")).alias("end"), "line")
    of_family = classify(docs, model).groupBy("doc_id", "t", "family").agg(
        apart(F.array_sort(F.collect_list(F.when(F.col("confirmed"), run)))).alias("n"),  # as many as a text's lines
        F.count_if(~F.col("confirmed")).alias("unconfirmed"),
        F.max("probability").alias("probability"),
    )
    found = of_family.groupBy("doc_id", "t").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.col("family")))), ",").alias("families"),
        F.sum("n").alias("n_licenses"),
        F.sum("unconfirmed").alias("n_unconfirmed"),
        F.max("probability").alias("probability"),
    ).withColumnsRenamed({"doc_id": "found_id", "t": "found_t"})
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"))
    mine = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("t") == F.col("found_t"))
    zero = {"n_licenses": F.lit(0), "n_unconfirmed": F.lit(0), "probability": F.lit(0.0)}
    return ids.join(found, mine, "left").select("doc_id", F.coalesce("families", F.lit("")).alias("families"), *[F.coalesce(F.col(c), z.cast("double" if c == "probability" else "long")).alias(c) for c, z in zero.items()])
