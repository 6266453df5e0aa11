"""Licence scans: a paragraph classifier trained here, with a calibrated unknown class, confirmed by templates.

A paragraph is a block between blank lines; comment marks are taken off its lines and the lines are joined, so a wrapped notice is whole.
Long paragraphs are read in overlapping windows of WINDOW words. Features are hashed word 1- and 2-grams, the model is a multinomial
logistic regression (Spark ML) over licence families and `unknown`. Its probabilities are calibrated on held-out rows by one
temperature, and a family is named only above the threshold that units of the whole corpus which no template explains hardly ever
reach. A named unit is confirmed if it holds most word pairs of one of the family's templates. Every unit of every paragraph is scored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nightglass.functions.text import with_once
from nightglass.llm.common import join_rows, keyed_texts, write_out

UNKNOWN = "unknown"
# Usual notices of each licence family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
    ],
}
FAMILIES = [UNKNOWN, *TEMPLATES]
# Words around a notice, and near misses: sentences about licences that name none of the families.
LEADS = ["", "This file is ", "This project is ", "Unless stated otherwise, all text here is ", "Note: ", "Copyright 2021 the authors. "]
TAILS = ["", ".", " or any later version.", ", see the file LICENSE.", " (the License);", "; all other rights reserved."]
NEAR_MISSES = [
    "Licensed under the terms of the house", "This work is licensed under a private agreement", "Released under embargo until the first of May", "All rights reserved by the owner of the work",
    "You should have received a copy of the letter along with this note", "The driving license was renewed in version 2 of the form", "Permission is required to obtain a copy of the minutes",
    "The public may attend the general meeting", "Subject to the terms of the contract between the parties", "Licensed to carry passengers and mail", "the author has written this work in four languages",
]
# Bounds of the training sample: unlabelled texts whose units stand for `unknown`, and units of them.
SAMPLE_DOCS, SAMPLE_UNITS = 400, 4_000
FEATURES = 1 << 14
CONFIRMED = 0.6
TEMPERATURES = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
WORD = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"
HELD_OUT = 4
# Words of a window, and from one window to the next: every stretch of WINDOW - STRIDE words is whole in one of them.
WINDOW, STRIDE = 56, 28
# Windows that are scored from one row: two neighbours share STRIDE words, which are hashed once for both.
ROW_WINDOWS = 4
# Marks at the start and the end of a comment's lines; the end's first two characters are looked at before its parts are tried.
MARK_BEFORE = r"(?m)^[ \t]*(?:#+|//+!?|/\*+|\*+/?|--+|;+|%+|<!--+|\{#|@c\b|dnl\b|REM\b)?[ \t]*"
MARK_AFTER = r"(?m)(?=[ \t\r*#-](?:[ \t\r\n\u0085\u2028\u2029*/>#}-]|\z))[ \t]*(?:\*+/|--+>|#\}|\*+)?[ \t\r]*$"
# The least and the greatest threshold of a family's probability.
THRESHOLDS = (0.5, 0.95)


def words_of(unit: Column) -> Column:
    return F.regexp_extract_all(F.lower(unit), F.lit(WORD), F.lit(0))


def pairs_of(words: Column) -> Column:
    both = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, both).otherwise(F.array().cast("array<string>"))


def plain_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.+-][^\W_]+)*", text.lower())


def plain_pairs(text: str) -> list[str]:
    words = plain_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def anchor_words(template: str) -> list[str]:
    """Words of which a text needs one to hold CONFIRMED of the template's pairs, long ones first."""
    left, chosen = [p.split() for p in plain_pairs(template)], []
    need = CONFIRMED * len(left)
    for word in sorted(set(plain_words(template)), key=lambda w: (-len(w), w)):
        if len(left) < need:
            break
        chosen.append(word)
        left = [p for p in left if word not in p]
    return chosen


ALL_PAIRS = sorted({p for ts in TEMPLATES.values() for t in ts for p in plain_pairs(t)})


def paragraphs_of(text: Column) -> Column:
    """Blocks between blank lines that hold a word, without comment marks and with their lines joined."""
    bare = F.regexp_replace(F.regexp_replace(text, MARK_BEFORE, ""), MARK_AFTER, "")
    blocks = F.transform(F.split(bare, r"\n(?:[ \t\r]*\n)+"), lambda b: F.regexp_replace(b, r"\s(?:(?<! )\s*|\s+)", " "))
    return F.filter(blocks, lambda b: b.rlike(r"[\p{L}\p{N}]"))


def units_of(blocks: DataFrame, block: str) -> DataFrame:
    """The rows with `words` and their `word_pairs`, one per window of the block. A block's words are paired once, not in each window."""
    worded = with_once(with_once(blocks, _w=words_of(F.col(block))), _p=pairs_of(F.col("_w")))
    last = F.greatest(F.size("_w") - (WINDOW - STRIDE), F.lit(1))
    starts = worded.withColumn("_at", F.explode(F.sequence(F.lit(0), last - 1, F.lit(STRIDE))))
    window = lambda of, n: F.slice(of, F.col("_at") + 1, F.lit(n))
    return starts.withColumns({"words": window("_w", WINDOW), "word_pairs": window("_p", WINDOW - 1)}).drop("_w", "_p", "_at")


def parts_of(blocks: DataFrame, block: str) -> tuple[DataFrame, list[list[str]]]:
    """The rows with up to ROW_WINDOWS windows each, and for each of these the columns of grams that make it up together.

    A window is two neighbouring strides and the word pair across them. A stride's grams stand in one column that both of its windows name, so that
    what is linear in them is worked out once. `_n` is the number of the row's windows, `_pairs` the template pairs of each.
    """
    worded = with_once(with_once(blocks, _w=words_of(F.col(block))), _p=pairs_of(F.col("_w")))
    # Pairs of no template add to no share: they are looked up once, not in each window.
    marked = with_once(worded, _t=F.transform("_p", lambda p: F.when(p.isin(ALL_PAIRS), p)))
    last = F.greatest(F.size("_w") - (WINDOW - STRIDE), F.lit(1))
    rows = marked.withColumn("_at", F.explode(F.sequence(F.lit(0), last - 1, F.lit(STRIDE * ROW_WINDOWS))))
    cut = lambda of, start, n: F.slice(of, F.col("_at") + (start + 1), F.lit(n))
    parts = {f"_s{j}": F.concat(cut("_w", STRIDE * j, STRIDE), cut("_p", STRIDE * j, STRIDE - 1)) for j in range(1, ROW_WINDOWS)}
    # The pairs across the first two and the last two strides are of one window only, as those outer strides are.
    parts["_s0"] = F.concat(cut("_w", 0, STRIDE), cut("_p", 0, STRIDE))
    parts[f"_s{ROW_WINDOWS}"] = F.concat(cut("_w", STRIDE * ROW_WINDOWS, STRIDE), cut("_p", STRIDE * ROW_WINDOWS - 1, STRIDE))
    parts |= {f"_x{j}": cut("_p", STRIDE * j + STRIDE - 1, 1) for j in range(1, ROW_WINDOWS - 1)}
    held = F.array(*[F.array_except(cut("_t", STRIDE * j, WINDOW - 1), F.array(F.lit(None).cast("string"))) for j in range(ROW_WINDOWS)])
    n = F.least(F.lit(ROW_WINDOWS), F.floor((last - 1 - F.col("_at")) / STRIDE).cast("int") + 1)
    uses = [[f"_s{j}", *[x for x in (f"_x{j}",) if x in parts], f"_s{j + 1}"] for j in range(ROW_WINDOWS)]
    return rows.withColumns({**parts, "_pairs": held, "_n": n}).drop("_w", "_p", "_t", "_at"), uses


def paired(units: DataFrame) -> DataFrame:
    """The rows with `word_pairs`, which units_of has made already."""
    return units if "word_pairs" in units.columns else units.withColumn("word_pairs", pairs_of(F.col("words")))


def with_features(units: DataFrame) -> DataFrame:
    grams = paired(units).withColumn("_g", F.concat("words", "word_pairs"))
    return HashingTF(numFeatures=FEATURES, inputCol="_g", outputCol="features").transform(grams).drop("_g")


def template_share(words: Column, families: list[str] | None = None) -> Column:
    """The greatest share of a template's word pairs that the words hold; per family if families are named."""
    def share(t: str) -> Column:
        own = plain_pairs(t)
        return F.size(F.array_intersect(F.col("pairs"), F.array(*[F.lit(p) for p in own]))) / len(own)

    return F.greatest(*[share(t) for f, ts in TEMPLATES.items() if families is None or f in families for t in ts], F.lit(0.0))


def labelled_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(words, label): every template in every setting and inside prose of the corpus, near misses, and a bounded sample of units of docs.

    The sample takes the texts with the least hashes, copies once. A sampled unit with half of a template's word pairs may be a notice and is left out.
    """
    rows = [{"unit": lead + t + tail, "label": FAMILIES.index(f)} for f, ts in TEMPLATES.items() for t in ts for lead in LEADS for tail in TAILS]
    rows += [{"unit": lead + t + tail, "label": 0} for t in NEAR_MISSES for lead in LEADS for tail in TAILS]
    given = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<unit:string,label:int>>"))).select(words_of(F.col("unit")).alias("words"), "label")
    hashed = docs.select("text", F.xxhash64("text").alias("h"))
    chosen = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS)
    blocks = hashed.join(F.broadcast(chosen), "h", "left_semi").select(F.explode(paragraphs_of(F.col("text"))).alias("block")).distinct()
    windows = blocks.select(words_of(F.col("block")).alias("w")).select(F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - (WINDOW - STRIDE), F.lit(1)) - 1, F.lit(STRIDE)), lambda i: F.slice("w", i + 1, F.lit(WINDOW)))).alias("words"))
    sample = windows.distinct().orderBy(F.xxhash64("words"), "words").limit(SAMPLE_UNITS).withColumn("pairs", F.array_distinct(pairs_of(F.col("words"))))
    plain = write_out(sample.where(template_share(F.col("words")) < 0.5).select("words"), "license-sample")
    # Each template stands inside stretches of that prose, each stretch once.
    numbered = plain.where(F.size("words") > 8).withColumn("n", F.row_number().over(Window.orderBy(F.xxhash64("words"), "words")) - 1).where(F.col("n") < 20 * TEMPLATE_COUNT)
    templates = [{"t": i, "label": FAMILIES.index(f), "own": plain_words(t)} for i, (f, t) in enumerate((f, t) for f, ts in TEMPLATES.items() for t in ts)]
    placed = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(templates)), "array<struct<t:int,label:int,own:array<string>>>")))
    inside = numbered.join(placed, F.col("n") % TEMPLATE_COUNT == F.col("t")).select(F.slice(F.concat(F.slice("words", 1, 14), "own", F.slice("words", 15, WINDOW)), 1, WINDOW).alias("words"), "label")
    return given.unionByName(inside).unionByName(plain.select("words", F.lit(0).alias("label")))


TEMPLATE_COUNT = sum(len(ts) for ts in TEMPLATES.values())


@dataclass(frozen=True)
class Classifier:
    model: LogisticRegressionModel
    temperature: float


def calibrated(raw: Column, of: Column, temperature: float) -> Column:
    """Calibrated probability of the family whose raw score is `of`."""
    return 1 / F.aggregate(raw, F.lit(0.0), lambda a, x: a + F.exp((x - of) / temperature))


def train(spark: SparkSession, docs: DataFrame) -> Classifier:
    # The sample is bounded, so one task holds it; it is written out for the passes of the fit.
    rows = write_out(with_features(labelled_rows(spark, docs)).withColumn("fold", F.pmod(F.xxhash64("words"), F.lit(HELD_OUT))).drop("words", "word_pairs").coalesce(1), "license-training")
    model = LogisticRegression(maxIter=25, regParam=0.002, family="multinomial").fit(rows.where("fold > 0").select("features", "label"))
    held = model.transform(rows.where("fold = 0")).select("label", vector_to_array("rawPrediction").alias("raw"))
    losses = held.agg(*[F.avg(-F.log(calibrated(F.col("raw"), F.element_at("raw", F.col("label") + 1), t) + 1e-12)).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]).first()
    best = min(range(len(TEMPERATURES)), key=lambda i: (losses[i] is None, losses[i] or 0.0))
    return Classifier(model, TEMPERATURES[best])


def scored_units(units: DataFrame, c: Classifier) -> DataFrame:
    """(doc_id, key, pos, family, probability, explained, share): each unit's likeliest family, scored once."""
    # Of a unit's pairs those of no template add to no share.
    pairs = F.array_distinct(F.filter("word_pairs", lambda p: p.isin(ALL_PAIRS))).alias("pairs")
    return judged(c.model.transform(with_features(units)).select("doc_id", "key", "pos", pairs, vector_to_array("rawPrediction").alias("raw")), c)


def scored_windows(blocks: DataFrame, block: str, c: Classifier) -> DataFrame:
    """What scored_units gives for units_of(blocks), for doc_id, key and pos of the blocks; a stride is hashed and scored once for both of its windows.

    The model's scores are linear in the grams: a window's are the sum of its parts', with the intercept counted once.
    """
    rows, uses = parts_of(blocks, block)
    parts = list(dict.fromkeys(p for use in uses for p in use))
    scored = rows.select("doc_id", "key", "pos", "_pairs", "_n", *parts)
    off = {c.model.probabilityCol: "", c.model.predictionCol: ""}
    for p in parts:
        hashed = HashingTF(numFeatures=FEATURES, inputCol=p, outputCol=f"{p}f").transform(scored)
        scored = c.model.transform(hashed, {**off, c.model.featuresCol: f"{p}f", c.model.rawPredictionCol: f"{p}r"}).drop(p, f"{p}f")
    arrays = scored.select("doc_id", "key", "pos", "_pairs", "_n", *[vector_to_array(f"{p}r").alias(p) for p in parts])
    bias = F.array(*[F.lit(float(b)) for b in c.model.interceptVector])

    def window(i: int, first: str, others: list[str]) -> Column:
        raw = F.transform(first, lambda x, k: sum((F.get(F.col(p), k) - F.get(bias, k) for p in others), x))
        return F.struct(F.get(F.col("_pairs"), F.lit(i)).alias("pairs"), raw.alias("raw"))

    windows = [window(i, first, others) for i, (first, *others) in enumerate(uses)]
    return judged(arrays.select("doc_id", "key", "pos", F.inline(F.slice(F.array(*windows), F.lit(1), F.col("_n")))), c)


def judged(scores: DataFrame, c: Classifier) -> DataFrame:
    """(doc_id, key, pos, family, probability, explained, share) of (doc_id, key, pos, pairs, raw): raw scores and template pairs of each unit.

    `explained` is the greatest share of any template that the unit holds, `share` that of its family's templates. What the model gives is written
    out before anything is derived from it, so that no filter or lambda runs the model again.
    """
    known = write_out(scores, "license-scores").withColumn("top", F.array_max(F.slice("raw", 2, len(FAMILIES))))
    family = F.element_at(F.array(*[F.lit(f) for f in FAMILIES[1:]]), F.array_position(F.slice("raw", 2, len(FAMILIES)), F.col("top")).cast("int"))
    shares = F.create_map(*[x for f in TEMPLATES for x in (F.lit(f), template_share(F.col("words"), [f]))])
    found = known.select("doc_id", "key", "pos", family.alias("family"), calibrated(F.col("raw"), F.col("top"), c.temperature).alias("probability"), shares.alias("shares"))
    return write_out(found.select("doc_id", "key", "pos", "family", "probability", F.array_max(F.map_values("shares")).alias("explained"), F.element_at("shares", F.col("family")).alias("share")), "license-units")


def scan(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """(doc_id, n_units, n_licence, n_confirmed, families, probability) per row of docs.

    n_units counts paragraphs, n_licence those with a unit of a named family, n_confirmed those with a confirmed one; families lists the confirmed ones in
    order, comma-joined. The threshold is the 99th percentile of the probabilities of all units that hold less than half of every template. Null and empty texts have no
    paragraphs; very long ones are read in windows. Repeated rows are all kept; rows are matched by (doc_id, text), null ids included.
    """
    texts = keyed_texts(docs)
    c = classifier or train(docs.sparkSession, docs)
    blocks = texts.select("doc_id", "key", F.posexplode(paragraphs_of(F.col("text"))).alias("pos", "block"))
    units = scored_windows(blocks, "block", c)
    reached = units.where("explained < 0.5").agg(F.percentile_approx("probability", 0.99, 10_000).alias("p")).first().p
    threshold = max(THRESHOLDS[0], min(THRESHOLDS[1], reached or 0.0))
    named = units.where(F.col("probability") >= threshold)
    # A set by position: rows that repeat each other find the same units.
    hit = F.struct("pos", "family", (F.col("share") >= CONFIRMED).alias("sure"), "probability")
    found = named.groupBy("doc_id", "key").agg(F.collect_set(hit).alias("hits"))
    # Every paragraph has a unit, so the last one's place tells their number; the texts are not cut up again.
    counted = units.groupBy("doc_id", "key").agg((F.max("pos") + 1).cast("long").alias("n_units"))
    rows = join_rows(texts.select("doc_id", "key"), counted)
    joined = join_rows(rows, found).select("doc_id", F.coalesce("n_units", F.lit(0).cast("long")).alias("n_units"), F.coalesce("hits", F.array()).alias("hits"))
    sure = joined.withColumn("sure", F.filter("hits", lambda h: h["sure"]))
    places = lambda hits: F.size(F.array_distinct(F.transform(hits, lambda h: h["pos"]))).cast("long")
    return sure.select(
        "doc_id", "n_units", places("hits").alias("n_licence"), places("sure").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("sure", lambda h: h["family"]))), ",").alias("families"),
        F.array_max(F.transform("sure", lambda h: h["probability"])).alias("probability"),
    )
