"""Licence families of paragraphs: sparse n-gram logistic regression, confirmed by templates.

A multinomial logistic regression on word uni- and bigrams is trained on notices of each
family, with words left out in turn, and on paragraphs of the corpus that speak of other
things (a bounded sample), which are the unknown class. A paragraph is a line, or several lines
in a row as notices are wrapped. It is given to a family if the model's probability passes a
bound calibrated on the notices, and if enough of one of the family's notices stands in it word
for word; otherwise it stays unknown. All paragraphs are looked through for notices, also those
without any of the usual words: parts of words pass over what cannot hold enough of one.

Built-in expressions and Spark's own learner only; the trained weights are a table.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm.common import content_key, shielded, stored

UNKNOWN = "unknown"
# Short public notices of each family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "public-domain": (
        "This work is released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
}
# A paragraph with one of these is told even if it is of no family; each notice above has one.
CUES = ("licen", "copyright", "permission", "permitted", "redistribut", "public domain", "spdx")
# Enough of a notice may stand in a paragraph without a cue. Of the grams of each notice, less than
# MIN_CONTAINED hold neither a one-word cue nor one of these: without either no family is possible.
MARKS = (
    "apache", "released", "source", "software", "documentation", "obtaining", "modif", "mozilla", "gnu", "4.0",
    "waived", "extent",
)
# Ordinary paragraphs about permissions and such, for the unknown class.
OTHERS = (
    "You need permission to enter this building.",
    "He lost his driving licence and his version of the story changed.",
    "All rights reserved by the copyright holder of the photograph.",
    "The public domain of the mathematical function is the set of its arguments.",
    "A license fee is due every year.",
    "The license plate was covered in dust.",
)
SAMPLE_PARAGRAPHS = 2_000
MIN_CONTAINED = 0.6
GRAM = 3


def _words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and signs that version numbers and names hold."""
    words = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.+-]+", " "), " ")
    bare = F.transform(words, lambda w: F.regexp_replace(w, r"^[.+-]+|[.+-]+$", ""))
    return F.filter(bare, lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.coalesce(grams, F.expr("cast(array() AS array<string>)"))


def _features(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _grams(words, 2)))


def _cued(column: str | Column) -> Column:
    low = F.lower(column)
    return reduce(or_, (F.contains(low, F.lit(word)) for word in CUES))


def _cued_across(text: Column) -> Column:
    """Whether a cue stands in the text, with whatever signs between its words."""
    return _cued(text) | F.lower(text).rlike("|".join(word.replace(" ", r"[^\p{L}\p{N}]+") for word in CUES if " " in word))


def _marked(text: Column) -> Column:
    """Whether a cue or a part of a notice may stand in the text: true of all that can be given a family."""
    low = F.lower(text)
    return reduce(or_, (F.contains(low, F.lit(word)) for word in MARKS), _cued_across(text))


def _near(spark: SparkSession, words: Column) -> Column:
    """Whether some notice stands in the words to ``MIN_CONTAINED``, row by row; as ``_contained`` has it."""
    notices = _notices(spark).groupBy("number").agg(F.max("size").alias("size"), F.collect_list("gram").alias("grams")).collect()
    grams = sorted({gram for notice in notices for gram in notice["grams"]})
    lengths = sorted({gram.count(" ") + 1 for gram in grams})
    # One literal each: expressions of a thousand parts would be planned again with every step.
    every = F.from_json(F.lit(json.dumps(grams)), "array<string>")
    known = F.from_json(F.lit(json.dumps([notice.asDict() for notice in notices])), "array<struct<size:int,grams:array<string>>>")

    def enough(met: Column) -> Column:
        shares = F.transform(known, lambda n: F.size(F.array_intersect(n["grams"], met)) / n["size"])
        return (F.size(met) > 0) & F.exists(shares, lambda share: share >= MIN_CONTAINED)

    # Words and met grams are bound by lambdas, so that nothing computes them again for every gram;
    # only what stands in any notice is compared with each of them.
    met = F.transform(F.array(words), lambda w: F.array_intersect(F.concat(*(_grams(w, n) for n in lengths)), every))
    return F.exists(met, enough)


def _runs(docs: DataFrame) -> DataFrame:
    """``key``, ``run`` and ``lines`` of each run of lines with words that holds a cue or may hold a notice.

    ``lines`` have their number ``at`` and their ``line``. A line without a letter or digit, such
    as a comment sign alone, ends a run.
    """
    lines = F.transform(F.split("text", r"\n"), lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    # Each line as its number and itself, lines without words as nothing: runs stand between those.
    shown = F.transform(
        lines, lambda x: F.when(x["line"].rlike(r"[\p{L}\p{N}]"), F.concat(x["at"].cast("string"), F.lit(":"), x["line"])).otherwise("")
    )
    wide = docs.where(_marked(F.col("text")))
    runs = wide.select(content_key("id", "text").alias("key"), F.explode(F.split(F.array_join(shown, "\n"), r"\n{2,}")).alias("run"))
    runs = runs.select("key", F.filter(F.split("run", r"\n"), lambda x: x != "").alias("shown"))
    runs = runs.select(
        "key",
        F.transform(
            "shown",
            lambda x: F.struct(
                F.substring_index(x, ":", 1).cast("int").alias("at"), F.substr(x, F.instr(x, ":") + F.lit(1)).alias("line")
            ),
        ).alias("lines"),
    )
    joined = F.array_join(F.transform("lines", lambda x: x["line"]), " ")
    runs = runs.where(_marked(joined))
    return runs.select("key", F.col("lines")[0]["at"].alias("run"), "lines").dropDuplicates(["key", "run"])


def _single(runs: DataFrame) -> DataFrame:
    """``key``, ``run``, ``at``, ``last`` (the same), ``cued`` and ``words`` of each line that holds a cue or much of a notice."""
    lines = runs.select("key", "run", F.explode("lines").alias("x")).where(_marked(F.col("x.line")))
    found = lines.select(
        "key", "run", F.col("x.at").alias("at"), F.col("x.at").alias("last"),
        _cued(F.col("x.line")).alias("cued"), _words(F.col("x.line")).alias("words"),
    )
    return found.where(F.col("cued") | _near(runs.sparkSession, F.col("words")))


def _notices(spark: SparkSession) -> DataFrame:
    """``family``, ``number``, ``size`` (of different grams) and ``gram`` of each notice."""
    notices = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    notices = spark.createDataFrame(notices, "family string, text string").withColumn("number", F.xxhash64("text"))
    short = F.least(F.lit(GRAM), F.size("words"))
    notices = notices.withColumn("words", _words(F.col("text"))).withColumn("n", short)
    notices = notices.select("family", "number", "n", F.array_distinct(_grams(F.col("words"), F.col("n"))).alias("grams"))
    return notices.select("family", "number", F.size("grams").alias("size"), F.explode("grams").alias("gram"))


def _contained(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``contained``: the largest share of a notice of each family, for rows with ``words``."""
    grams = F.array_distinct(F.concat(*(_grams(F.col("words"), n) for n in range(1, GRAM + 1))))
    own = rows.select(*keys, F.explode(grams).alias("gram"))
    met = own.join(F.broadcast(_notices(rows.sparkSession)), "gram").groupBy(*keys, "family", "number").agg(
        (F.count(F.lit(1)) / F.max("size")).alias("contained")
    )
    return met.groupBy(*keys, "family").agg(F.max("contained").alias("contained"))


def _windows(runs: DataFrame) -> DataFrame:
    """As ``_single``, for two and more lines of a run that hold much of a notice together.

    A notice that begins in the first line and ends in the last has all words of the lines
    between, so lines of as many words as the longest notice need not be looked at between them.
    """
    several = runs.where(F.size("lines") > 1).select("key", "run", "lines")
    joined = F.array_join(F.transform("lines", lambda x: x["line"]), " ")
    # What holds too little of every notice as a whole does so in every part.
    whole = _contained(several.select("key", "run", _words(joined).alias("words")), ["key", "run"])
    whole = whole.where(F.col("contained") >= MIN_CONTAINED).select("key", "run").distinct()
    several = several.join(whole, ["key", "run"], "left_semi")
    longest = max(len(re.findall(r"[\w.+-]+", text)) for texts in TEMPLATES.values() for text in texts)
    worded = F.transform("lines", lambda x: F.struct(x["at"].alias("at"), _words(x["line"]).alias("words")))
    several = several.withColumn("lines", worded)
    begun = several.select("key", "run", F.explode(F.expr(f"transform(lines, (x, i) -> slice(lines, i + 1, {longest + 2}))")).alias("lines"))
    begun = begun.where(F.size("lines") > 1)
    ended = begun.withColumn("n", F.explode(F.sequence(F.lit(2), F.size("lines"))))
    between = F.flatten(F.transform(F.slice("lines", F.lit(2), F.col("n") - 2), lambda x: x["words"]))
    ended = ended.where(F.size(between) < longest)
    words = F.flatten(F.transform(F.slice("lines", F.lit(1), F.col("n")), lambda x: x["words"]))
    found = ended.select(
        "key", "run", F.col("lines")[0]["at"].alias("at"), F.element_at("lines", F.col("n"))["at"].alias("last"), words.alias("words")
    )
    found = found.where(_marked(F.array_join("words", " "))).where(_near(runs.sparkSession, F.col("words")))
    return found.withColumn("cued", F.lit(True))


def _training(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``family`` and ``words``: notices whole and with each word left out, and other paragraphs."""
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    rows += [(UNKNOWN, text) for text in OTHERS]
    notices = spark.createDataFrame(rows, "family string, text string")
    notices = notices.withColumn("words", _words(F.col("text")))
    part = F.explode(F.sequence(F.lit(0), F.size("words"))).alias("left_out")
    shorter = notices.select("family", "words", part).select(
        "family", F.filter("words", lambda w, i: i + 1 != F.col("left_out")).alias("words")
    )
    # Drawn by content: the paragraphs without a cue of smallest hash, whole and once each. Only
    # hashes are sorted, and the largest of them tells which paragraphs to take.
    line = docs.select(F.explode(F.split("text", r"\n")).alias("line"))
    line = line.where(~_cued("line") & (F.length("line") > 0)).withColumn("draw", F.xxhash64(F.lit(1), "line"))
    smallest = line.select("draw").distinct().orderBy("draw").limit(SAMPLE_PARAGRAPHS)
    last = smallest.agg(F.max("draw")).first()[0]
    taken = line.where(F.col("draw") <= F.lit(last).cast("bigint"))
    drawn = taken.groupBy("draw").agg(F.first("line").alias("line"))
    others = drawn.select(F.lit(UNKNOWN).alias("family"), _words(F.col("line")).alias("words"))
    others = others.where(~_near(spark, F.col("words")))  # a notice without a cue speaks of nothing else
    return shorter.unionByName(others).withColumn("features", _features(F.col("words")))


class Model:
    """Weights as a table: ``feature``, ``weights`` (one a family); ``bias`` and ``least``."""

    def __init__(self, families: list[str], weights: DataFrame, bias: list[float], least: float):
        self.families, self.weights, self.bias, self.least = families, weights, bias, least


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of the notices and a bounded sample of the corpus."""
    spark = docs.sparkSession
    rows, (text,) = shielded(docs, text_col)
    training = stored(_training(spark, rows.select(F.col(text).alias("text"))), "training")
    families = [UNKNOWN, *TEMPLATES]
    index = F.create_map(*(F.lit(x) for pair in zip(families, range(len(families)), strict=True) for x in pair))
    # Features that some notice holds; what only other paragraphs hold says nothing of a family.
    held = training.where(F.col("family") != UNKNOWN).select(F.collect_set("features").alias("f"))
    names = sorted(held.select(F.array_distinct(F.flatten("f"))).first()[0])
    counter = CountVectorizerModel.from_vocabulary(names, "features", "vector")
    labelled = counter.transform(training.withColumn("label", F.element_at(index, F.col("family")).cast("double")))
    size = Window.partitionBy("family")
    labelled = labelled.withColumn("weight", 1.0 / F.count(F.lit(1)).over(size))
    learner = LogisticRegression(
        family="multinomial", regParam=1e-4, elasticNetParam=0.5, weightCol="weight", featuresCol="vector", maxIter=60
    )
    fitted = learner.fit(labelled)
    matrix = fitted.coefficientMatrix.toArray()
    kept = [(name, [float(w) for w in matrix[:, at]]) for at, name in enumerate(names) if matrix[:, at].any()]
    weights = spark.createDataFrame(kept, "feature string, weights array<double>")
    model = Model(families, weights, [float(b) for b in fitted.interceptVector], 0.0)
    # Calibration: all but the weakest hundredth of the notices pass.
    scored = _scored(training.where(F.col("family") != UNKNOWN).withColumn("id", F.monotonically_increasing_id()), model, ["id", "family"])
    least = scored.select(F.percentile_approx(F.element_at("shares", F.element_at(index, F.col("family")) + 1), 0.01)).first()[0]
    model.least = float(least)
    return model


def _scored(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``shares``: the probability of each family, for rows with ``words``."""
    pairs = rows.select(*keys, F.explode(_features(F.col("words"))).alias("feature"))
    # The table has at most the notices' features, a few thousand: a fixed size.
    met = pairs.join(F.broadcast(model.weights), "feature")
    sums = met.groupBy(*keys).agg(*(F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(len(model.families))))
    logits = F.array(*(F.col(f"w{i}") + b for i, b in enumerate(model.bias)))
    sums = sums.withColumn("logits", logits)
    powers = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    sums = sums.withColumn("powers", powers)
    total = F.aggregate("powers", F.lit(0.0), lambda a, x: a + x)
    return sums.withColumn("total", total).select(*keys, F.transform("powers", lambda x: x / F.col("total")).alias("shares"))


def _judged(found: DataFrame, model: Model) -> DataFrame:
    """``guess``, ``probability``, ``contained`` and whether it is ``sure``, of all of ``found``."""
    keys = ["key", "run", "at", "last"]
    shares = _scored(found, model, keys)
    names = F.array(*(F.lit(name) for name in model.families))
    best = F.array_max("shares")
    guess = shares.select(
        *keys,
        F.element_at(names, F.array_position("shares", best).cast("int")).alias("guess"),
        best.alias("probability"),
    )
    contained = _contained(found, keys).withColumnRenamed("family", "guess")
    judged = found.select(*keys, "cued").join(guess, keys, "left").join(contained, [*keys, "guess"], "left")
    sure = (F.col("probability") >= model.least) & (F.col("contained") >= MIN_CONTAINED)
    return judged.select(
        *keys,
        "cued",
        "guess",
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
        F.coalesce("contained", F.lit(0.0)).alias("contained"),
        F.coalesce(sure, F.lit(False)).alias("sure"),
    )


def _chosen(single: DataFrame, windows: DataFrame) -> DataFrame:
    """Judged lines and windows without overlaps: what holds most of a notice goes first, then
    fewer lines. Lines with a cue in no chosen window remain as they are."""
    place = ["key", "at", "last"]
    windows = windows.where("sure")
    # A line that holds a whole notice alone goes before all windows around it.
    settled = single.where(F.col("sure") & (F.col("contained") == 1)).select("key", F.col("at").alias("line"))
    across = windows.select(*place, F.explode(F.sequence("at", "last")).alias("line"))
    windows = windows.join(across.join(settled, ["key", "line"], "left_semi").select(*place).distinct(), place, "left_anti")
    windows = stored(windows, "windows")
    open_runs = windows.select("key", "run").distinct()
    free = single.join(open_runs, ["key", "run"], "left_anti")
    met = single.join(open_runs, ["key", "run"], "left_semi").unionByName(windows)
    ranked = F.struct(
        (-F.col("contained")).alias("lacking"), (F.col("last") - F.col("at")).alias("more"), "at", "last", "probability", "guess", "sure", "contained"
    )
    grouped = met.groupBy("key", "run").agg(F.array_sort(F.collect_list(ranked)).alias("every"))

    def apart(taken: Column, x: Column) -> Column:
        return ~F.exists(taken, lambda y: (y["at"] <= x["last"]) & (x["at"] <= y["last"]))

    none = F.filter("every", lambda x: F.lit(False))
    taken = F.aggregate(
        F.filter("every", lambda x: x["sure"]), none, lambda acc, x: F.when(apart(acc, x), F.array_append(acc, x)).otherwise(acc)
    )
    grouped = grouped.withColumn("taken", taken)
    rest = F.filter("every", lambda x: ~x["sure"] & apart(F.col("taken"), x))
    kept = grouped.select("key", "run", F.explode(F.concat("taken", rest)).alias("x")).select("key", "run", "x.*")
    columns = ["key", "run", "at", "last", "guess", "probability", "contained", "sure"]
    return free.select(*columns).unionByName(kept.select(*columns))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and ``paragraphs``: number of the first line, family, probability, contained share.

    Paragraphs are notices, over as many lines as they are wrapped on, and the other lines with
    a cue; those of no family have family ``unknown``. A null or empty text has none; repeated
    rows come back as often as given.
    """
    rows, (key, text) = shielded(docs, id_col, text_col)
    rows = rows.select(F.col(key).alias("id"), F.col(text).alias("text"))
    runs = stored(_runs(rows), "runs")
    single = _judged(stored(_single(runs), "paragraphs"), model)
    single = stored(single.where(F.col("sure") | F.col("cued")), "single")
    windows = _judged(stored(_windows(runs), "wrapped"), model)
    judged = _chosen(single, windows).select(
        "key",
        F.struct(
            "at",
            F.when(F.col("sure"), F.col("guess")).otherwise(UNKNOWN).alias("family"),
            "probability",
            "contained",
        ).alias("paragraph"),
    )
    by_row = judged.groupBy("key").agg(F.array_sort(F.collect_list("paragraph")).alias("paragraphs"))
    by_row = stored(by_row, "licences")
    every = rows.select("id", content_key("id", "text").alias("key"))
    none = F.expr("cast(array() AS array<struct<at:int,family:string,probability:double,contained:double>>)")
    return every.join(by_row, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("paragraphs", none).alias("paragraphs")
    )
