"""Licence scans: a sparse word n-gram classifier of lines, confirmed against templates.

Everything runs on DataFrame functions and Spark's own logistic regression.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.session import store

# Public licence notices, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See the LICENSE file in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "MPL-2.0": (
        "Released under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
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
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright holder. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    ),
}
COMMON = "a all an and any are as at be by can for from in is it may not of on or that the this to under use with you".split()
UNKNOWN = "unknown"

UNKNOWN_WEIGHT = 10  # of the unknown lines together, in weights of the templates' pieces together, at most
LEAST_WORDS, CUT_WORDS = 3, (5, 8, 12)  # training pieces of a template
FALSE_ALARMS = 0.999  # share of held-out unknown lines that stay below the threshold
LEAST_PROBABILITY = 0.5
SIMILAR = 0.5  # share of a line's or a template's word pairs in common


def words(line: Column) -> Column:
    """Lower-case words; letters, digits and the dots, plus signs and hyphens between them."""
    apart = F.split(F.lower(line), r"[^\p{L}\p{N}.+-]+")
    return F.filter(F.transform(apart, lambda w: F.btrim(w, F.lit(".+-"))), lambda w: w != "")


def grams(found: Column, n: int) -> Column:
    """The runs of n words."""
    last = F.size(found) - n
    starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(found, i, n), " "))


def _without_common(pairs: Column) -> Column:
    """Drops runs that have no word of weight."""
    common = F.array(*map(F.lit, COMMON))
    return F.filter(pairs, lambda g: F.size(F.array_except(F.split(g, " "), common)) > 0)


def templates(spark: SparkSession) -> DataFrame:
    """(family, template, words)."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, ts in TEMPLATES.items() for t in ts]
    return with_words(spark.range(1).select(F.inline(F.array(*rows))), "template")


def vocabulary(spark: SparkSession) -> list[str]:
    """All word pairs and triples of the templates, but for those of common words only."""
    t = templates(spark)
    both = F.concat(grams(F.col("words"), 2), grams(F.col("words"), 3))
    return sorted(r[0] for r in t.select(F.explode(_without_common(both))).distinct().collect())


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of the lines of each text, from 0; line breaks are \\n, \\r\\n and \\r."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\r\n|\n|\r")).alias("line_no", "line"))


def with_words(rows: DataFrame, text: str) -> DataFrame:
    """Adds `words`. They come out of a generator, so that later expressions over the words read
    the finished array and do not compute it again for each of its elements."""
    return rows.select("*", F.explode(F.array(words(F.col(text)))).alias("words"))


def pair_hashes(found: str) -> Column:
    return F.transform(found, lambda w, i: F.xxhash64(w, F.lit(" "), F.get(F.col(found), i + 1)))


def candidates(numbered: DataFrame, known: list[str]) -> DataFrame:
    """Lines with at least one word pair of the vocabulary. The classifier's only inputs are such
    pairs and longer runs, which contain them, so any other line is unknown without a look."""
    pairs = [g.split(" ") for g in known if g.count(" ") == 1]
    hashes = F.array(*(F.xxhash64(F.lit(a), F.lit(" "), F.lit(b)) for a, b in pairs))
    return with_words(numbered, "line").filter(F.arrays_overlap(pair_hashes("words"), hashes))


def featured(split: DataFrame, known: list[str]) -> DataFrame:
    """Adds the sparse vector of the vocabulary's runs that a line contains."""
    both = F.concat(grams(F.col("words"), 2), grams(F.col("words"), 3))
    return vectors(split.withColumn("_grams", both), known).drop("_grams")


def vectors(split: DataFrame, known: list[str]) -> DataFrame:
    """Adds the sparse vector of the vocabulary's runs in `_grams`."""
    return CountVectorizerModel.from_vocabulary(known, "_grams", "features").setBinary(True).transform(split)


def training_pieces(spark: SparkSession) -> DataFrame:
    """(family, words): templates whole and in overlapping cuts, as wrapped notices show them."""
    t = templates(spark)
    n = F.size("words")
    cuts = [F.array(F.col("words"))]
    for size in CUT_WORDS:
        starts = F.when(n > size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
        cuts.append(F.transform(starts, lambda i, size=size: F.slice("words", i, size)))
    return t.select("family", F.explode(F.concat(*cuts)).alias("words"))


def train(rows: DataFrame, known: list[str]) -> tuple[LogisticRegressionModel, list[str], float]:
    """(model, classes, threshold), learned from all `candidates`.

    The unknown class are the lines that share no run of three words with a template, each once, and an empty
    line. Lines with the same runs of the vocabulary are one row with a weight. All of them weigh
    UNKNOWN_WEIGHT times as much as the pieces of templates at most, so that families do not fade as the table grows. A
    fifth is held out: FALSE_ALARMS of these stay below the threshold on the probability of a family.
    """
    spark = rows.sparkSession
    families = sorted(TEMPLATES)
    triples = F.array(*(F.lit(g) for g in known if g.count(" ") == 2))
    unknown = rows.select("words").filter(~F.arrays_overlap(grams(F.col("words"), 3), triples)).distinct()
    vocab = F.array(*map(F.lit, known))
    both = F.concat(grams(F.col("words"), 2), grams(F.col("words"), 3))
    unknown = unknown.select(F.sort_array(F.array_intersect(both, vocab)).alias("_grams"), F.pmod(F.xxhash64("words"), F.lit(5)).alias("fold"))
    unknown = unknown.groupBy("_grams", "fold").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    blank = spark.range(1).select(F.array().cast("array<string>").alias("_grams"), F.lit(1).cast("long").alias("fold"), F.lit(20.0).alias("weight"))
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double")
    pieces = training_pieces(spark).select(
        F.concat(grams(F.col("words"), 2), grams(F.col("words"), 3)).alias("_grams"), F.lit(1).cast("long").alias("fold"), F.lit(1.0).alias("weight"), label.alias("label")
    )
    learned = vectors(pieces.unionByName(unknown.union(blank).withColumn("label", F.lit(0.0))), known)
    learned = store(learned.drop("_grams"), "licence_lines")
    weighed = learned.filter("fold <> 0 OR label > 0")
    total = {r["of_unknown"]: r["weight"] for r in weighed.groupBy((F.col("label") == 0).alias("of_unknown")).agg(F.sum("weight").alias("weight")).collect()}
    scale = min(1.0, UNKNOWN_WEIGHT * total[False] / total[True])
    weighed = weighed.withColumn("weight", F.when(F.col("label") == 0, F.col("weight") * scale).otherwise(F.col("weight")))
    learner = LogisticRegression(maxIter=60, regParam=1e-3, elasticNetParam=0.3, standardization=False, weightCol="weight")
    model = learner.fit(weighed)
    held = model.transform(learned.filter("fold = 0 AND label = 0"))
    alarm = held.select((1 - vector_to_array("probability")[0]).alias("p"), F.col("weight").cast("long").alias("n"))
    limit = alarm.select(F.percentile("p", F.lit(FALSE_ALARMS), F.col("n"))).first()[0] or 0.0
    return model, [UNKNOWN, *families], max(LEAST_PROBABILITY, float(limit))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, family, probability, template, similarity, confirmed) of each licence line.

    A line is reported if its most probable family, unknown aside, reaches the
    threshold. It is confirmed if a template of that family shares at least SIMILAR of the word
    pairs of the shorter of the two; the most similar template is named (the first of equals).
    Null and empty texts have no rows. Rows that repeat a doc_id are scanned each. Columns other
    than doc_id and text are not read.
    """
    spark = docs.sparkSession
    known = vocabulary(spark)
    rows = store(candidates(lines(docs), known).select("doc_id", "line_no", "words"), "licence_candidates")
    model, classes, threshold = train(rows, known)
    scored = model.transform(featured(rows, known))
    p = vector_to_array("probability")
    found = scored.select("doc_id", "line_no", "words", F.slice(p, 2, len(classes)).alias("p"))
    found = found.withColumn("probability", F.array_max("p")).filter(F.col("probability") >= threshold)
    names = F.array(*map(F.lit, classes[1:]))
    found = found.withColumn("family", F.get(names, (F.array_position("p", F.col("probability")) - 1).cast("int")))
    found = found.withColumn("pairs", F.array_distinct(grams(F.col("words"), 2)))
    own = templates(spark).select("family", "template", F.array_distinct(grams(F.col("words"), 2)).alias("own"))
    by_family = own.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("template", "own"))).alias("templates"))
    compared = found.join(F.broadcast(by_family), "family")  # a row for each family of TEMPLATES
    shared = F.transform(
        "templates",
        lambda t: F.struct(
            (
                F.size(F.array_intersect(F.col("pairs"), t["own"]))
                / F.greatest(F.lit(1), F.least(F.size("pairs"), F.size(t["own"])))
            ).alias("similarity"),
            t["template"].alias("template"),
        ),
    )
    best = F.aggregate(
        F.slice(F.col("shared"), 2, 100), F.get("shared", F.lit(0)),
        lambda a, b: F.when(b["similarity"] > a["similarity"], b).otherwise(a),
    )
    closest = compared.withColumn("shared", shared).withColumn("best", best)
    return closest.select(
        "doc_id", "line_no", "family", "probability", "best.template", "best.similarity",
        (F.col("best.similarity") >= SIMILAR).alias("confirmed"),
    )
