"""Operator 1: licence scan with a trained paragraph classifier, JVM-side throughout.

A text's paragraphs (its lines) become sparse 0/1 vectors of the word 1- and 2-grams of the
licence templates below. Two logistic regressions over them are trained, on thinned copies of the
templates (each copy loses some words and half of them sit inside a corpus paragraph) and
on every corpus paragraph that resembles no template: a binary one tells copies from
paragraphs (class ``unknown``), which weigh together as much as ``UNKNOWN_WEIGHT`` copies; a
multinomial one tells the families of copies apart. A family's probability is the product of
both. All these paragraphs calibrate the unknown class, too: a family needs a
probability above ``FALSE_ALARMS`` of the largest family probabilities seen there (and
above 0.5). Each remaining prediction is confirmed by comparing the paragraph with the
family's templates: it must hold ``CONFIRM`` of the distinct 2-grams of one of them.

Notices are often wrapped, so joins of adjacent lines are classified and confirmed too. From
every line on, the lines that follow as far as the longest template reaches are joined; for
every template of which the join holds ``CONFIRM``, the join is cut behind the line that adds
the last of its 2-grams, and stays if its first line adds some and it has two lines or more.
Only texts that hold ``CONFIRM`` of a template as a whole can have such a join; the others are
passed over without loss. A confirmed join counts as one more licence paragraph, unless a
confirmed line or a better join of the same family lies in it or meets it, or a more similar
line or a better join of another covers half of its lines (better: more similar, then
shorter). A line that adds to a notice wrapped around it is no example of the
unknown class.

Result: one row per document id with the number of paragraphs (lines), of confirmed licence
paragraphs (lines and joins) and of unconfirmed predictions (lines), the confirmed families,
and the family, probability and similarity of the surest confirmed paragraph.

Defined cases: words are runs of letters and digits after lower-casing; null or empty text
has no paragraph and gives a row of zeros; blank lines are no paragraphs; rows with the
same id (null included) are one document; ties in probability go to the greater
similarity, then the greater family name; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import numbered, read_table, written

# The public wording of licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "Copyright. All rights reserved."),
    ("All-rights-reserved", "No part of this publication may be reproduced without the prior written permission of the publisher."),
]
CC_TERMS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = {"4.0": "4.0 International", "3.0": "3.0 Unported"}
for _short, _long in CC_TERMS.items():
    for _version, _full in CC_VERSIONS.items():
        _name = _long if _version == "4.0" else _long.replace("NoDerivatives", "NoDerivs")
        TEMPLATES += [(f"CC-{_short}-{_version}", f"This work is licensed under a Creative Commons {_name} {_full} License."),
                      (f"CC-{_short}-{_version}", f"Licensed under CC {_short} {_version}.")]
# The words that tell related notices apart.
TELLING = {"affero", "lesser", "sharealike", "noncommercial", "noderivatives", "noderivs", "sa", "nc", "nd", "1", "2", "3", "4", "5", "v1", "v2"}
RELATED = 0.5
COPIES, KEEP_WORDS = 40, 88
UNKNOWN_WEIGHT = 2000
FALSE_ALARMS = 0.999
CONFIRM = 0.6
SHORT, CONFIRM_SHORT = 12, 0.7  # a line of a longer notice holds much of a template of few 2-grams
RESEMBLES = 0.3


def words_of(text: Column) -> Column:
    # Only the first and the last part can be empty.
    return let(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: let(F.when(w[0] == "", 2).otherwise(1), lambda first: F.slice(
        w, first, F.greatest(F.size(w) - first + F.when(F.element_at(w, -1) == "", 0).otherwise(1), F.lit(0)))))


def pairs_of(words: Column) -> Column:
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                      F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))


def masked(words: Column, grams: list[str]) -> Column:
    """``words`` with null for those that are in none of ``grams``, so that their pairs are null, too, and cost nothing."""
    some = sorted({w for g in grams for w in g.split(" ")})
    return F.transform(words, lambda w: F.when(w.isin(some), w))


def grams_of(words: Column, vocabulary: list[str]) -> Column:
    """The distinct 1- and 2-grams of ``words`` that are in ``vocabulary``."""
    return let(masked(words, vocabulary), lambda m: F.array_distinct(F.filter(F.concat(m, pairs_of(m)), lambda g: g.isin(vocabulary))))


def template_rows(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, t in templates])
    return (spark.range(1).select(F.inline(rows)).withColumn("words", words_of(F.col("template")))
            .withColumn("pairs", F.array_distinct(pairs_of(F.col("words")))))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hits_of(pairs: Column, known: list[list[str]]) -> Column:
    """The distinct ``pairs`` that a template has."""
    every = sorted({p for t in known for p in t})
    return F.array_distinct(F.filter(pairs, lambda p: p.isin(every)))


def held_by(words: Column, known: list[list[str]]) -> Column:
    """The templates (their 2-grams) of which ``words`` hold ``CONFIRM``. Those of too many 2-grams are passed over by a count."""
    some = sorted({p for t in known for p in t})
    enough = lambda n, t: n >= F.lit(CONFIRM) * F.size(t)
    return let(masked(words, some), lambda w: let(hits_of(pairs_of(w), known), lambda c: F.filter(
        F.lit(known), lambda t: (F.size(c) > 0) & enough(F.size(c), t) & enough(F.size(F.array_intersect(t, c)), t))))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\r\n]+"), lambda p: F.trim(p) != "")


def rivals_of(templates: list[tuple[str, list[str]]]) -> list[list[tuple[list[str], list[str]]]]:
    """For every template ``(family, 2-grams)``, per related template of another family the
    telling 2-grams that only it has and those that only the other has. Templates are related that share
    ``RELATED`` of the smaller one."""
    telling = lambda pairs: sorted(p for p in pairs if not TELLING.isdisjoint(p.split(" ")))
    out = []
    for family, t in templates:
        t = set(t)
        out.append([(telling(t - u), telling(u - t)) for other, u in ((g, set(p)) for g, p in templates)
                    if other != family and len(t & u) >= RELATED * min(len(t), len(u))])
    return out


def part_of(pairs: Column, of: Column) -> Column:
    """The share of ``of`` that ``pairs`` has; a half where there is nothing to have."""
    return F.when(F.size(of) == 0, F.lit(0.5)).otherwise(F.size(F.array_intersect(pairs, of)) / F.size(of))


class LicenseModel:
    """``templates`` has per family the 2-grams of every template with their rivals, ``known`` the
    2-grams of every template, ``reach`` is the number of words of the longest. ``notice`` tells
    copies of templates from other paragraphs, ``regression`` the families of copies."""

    def __init__(self, vectors: CountVectorizerModel, notice, regression, names: list[str], cut: float, templates: DataFrame,
                 known: list[list[str]], reach: int):
        self.vectors, self.notice, self.regression, self.names = vectors, notice, regression, names
        self.cut, self.templates, self.known, self.reach = cut, templates, known, reach

    def scored(self, paragraphs: DataFrame) -> DataFrame:
        """Adds ``family`` (the likeliest one) and ``probability`` to rows with ``grams``."""
        names = F.array(*[F.lit(n) for n in self.names])
        out = self.regression.transform(self.notice.transform(self.vectors.transform(paragraphs)))
        out = out.withColumn("p", vector_to_array(F.col("p_family"))).withColumn("top", F.array_max("p"))
        return (out.withColumn("family", F.element_at(names, F.array_position("p", F.col("top")).cast("int")))
                .withColumn("probability", F.col("top") * vector_to_array(F.col("p_notice"))[1])
                .drop("p_notice", "p_family", "features", "p", "top"))

    def compared(self, paragraphs: DataFrame, *keep: str) -> DataFrame:
        """``keep``, ``family`` (null below the cut), ``probability``, ``similarity`` and ``confirmed`` of rows with
        ``grams`` or ``words``. All 2-grams of the templates are in the vocabulary."""
        if "grams" not in paragraphs.columns:
            paragraphs = paragraphs.withColumn("grams", grams_of(F.col("words"), self.vectors.vocabulary))
        scored = self.scored(paragraphs.select(*keep, "grams")).select(
            *keep, "grams", "probability", F.when(F.col("probability") > self.cut, F.col("family")).alias("family"))
        return (scored.join(F.broadcast(self.templates.withColumnRenamed("family", "f")), F.col("family") == F.col("f"), "left")
                .withColumn("judged", F.when(F.col("family").isNotNull(), F.transform(
                    F.col("templates"), lambda t: let(F.size(F.array_intersect("grams", t["pairs"])) / F.size(t["pairs"]), lambda share: F.struct(
                        ((share >= F.when(F.size(t["pairs"]) > SHORT, CONFIRM).otherwise(CONFIRM_SHORT)) & F.forall(t["rivals"], lambda r: part_of(F.col("grams"), r["own"]) > part_of(F.col("grams"), r["other"]))).alias("ok"), share.alias("share"))))))
                .withColumn("best", F.array_max("judged"))
                .withColumns({"similarity": F.col("best.share"), "confirmed": F.coalesce("best.ok", F.lit(False))})
                .select(*keep, "family", "probability", "similarity", "confirmed"))


def resembled(pairs: Column, of: Column, more_than: Column | None = None) -> Column:
    """Whether ``pairs`` have ``RESEMBLES`` of a template's 2-grams and, of these, more than the pairs ``more_than``."""
    return F.exists(of, lambda t: let(F.size(F.array_intersect(t, pairs)), lambda n: (n >= F.lit(RESEMBLES) * F.size(t)) & (
        F.lit(True) if more_than is None else n > F.size(F.array_intersect(t, more_than)))))


def adds_to_notice(lines: Column, words: Column, i: Column, known: list[list[str]], reach: int, close: Column) -> Column:
    """Whether line ``i`` (from 0) of ``lines``, arrays of words, adds to a template of ``close`` that it resembles
    together with the last ``reach`` words of the lines before it and the first of those after it."""
    n = F.lit(reach)
    last = lambda w: F.slice(w, F.greatest(F.size(w) - n, F.lit(0)) + 1, n)
    before = let(F.flatten(F.transform(F.slice(lines, F.greatest(i - n, F.lit(0)) + 1, F.least(i, n)), last)), last)
    after = F.slice(F.flatten(F.transform(F.slice(lines, i + 2, n), lambda w: F.slice(w, F.lit(1), n))), F.lit(1), n)

    return let(F.struct(before.alias("before"), after.alias("after")), lambda c: let(F.struct(
        hits_of(pairs_of(F.concat(c["before"], words, c["after"])), known).alias("whole"),
        hits_of(F.concat(pairs_of(c["before"]), pairs_of(c["after"])), known).alias("rest")),
        lambda x: (F.size(F.array_except(x["whole"], x["rest"])) > 0) & resembled(x["whole"], close, x["rest"])))


def line_rows(docs: DataFrame, id_col: str, text_col: str, known: list[list[str]], reach: int, vocabulary: list[str]) -> DataFrame:
    """``doc_id, i, grams, taken, whole`` of every line, in one pass over the texts; a text without a line has one row with
    a null ``i``.

    ``taken``: the line resembles a template or adds to a notice around it. A line can only resemble templates that its
    text resembles as a whole (``close``). ``whole``, on the first line of a text that holds ``CONFIRM`` of
    a template and has two lines or more: the words of all its lines, null for those of no template."""
    wanted = sorted({*vocabulary, *(p for t in known for p in t)})

    def read(text: Column) -> Column:
        return let(masked(words_of(text), wanted), lambda m: F.struct(m.alias("words"), F.filter(pairs_of(m), lambda p: p.isin(wanted)).alias("pairs")))

    def borders(lines: Column) -> Column:
        """The 2-grams of the last word of a line and the first of the next that has words."""
        n = F.greatest(F.size(lines) - 1, F.lit(0))
        return F.zip_with(F.slice(lines, F.lit(1), n), F.slice(lines, F.lit(2), n), lambda a, b: F.concat(
            F.element_at(a["words"], -1), F.lit(" "), F.element_at(b["words"], 1)))

    def close_to(lines: Column) -> Column:
        every = F.concat(F.flatten(F.transform(lines, lambda x: x["pairs"])), let(F.filter(lines, lambda x: F.size(x["words"]) > 0), borders))
        return let(hits_of(every, known), lambda c: F.transform(
            F.filter(F.lit(known), lambda t: (F.size(c) > 0) & (F.size(c) >= F.lit(RESEMBLES) * F.size(t)) & (F.size(F.array_intersect(t, c)) >= F.lit(RESEMBLES) * F.size(t))),
            lambda t: F.struct(t.alias("pairs"), (F.size(F.array_intersect(t, c)) >= F.lit(CONFIRM) * F.size(t)).alias("held"))))

    def taken(lines: Column, x: Column, i: Column, close: Column) -> Column:
        own = let(hits_of(x["pairs"], known), lambda c: resembled(c, close))
        return (F.size(close) > 0) & (own | adds_to_notice(F.transform(lines, lambda y: y["words"]), x["words"], i, known, reach, close))

    def judged(lines: Column) -> Column:
        return let(close_to(lines), lambda found: let(F.struct(F.transform(found, lambda t: t["pairs"]).alias("close"), F.exists(found, lambda t: t["held"]).alias("held")), lambda f: F.transform(
            lines, lambda x, i: F.struct(
                F.array_distinct(F.filter(F.concat(x["words"], x["pairs"]), lambda g: g.isin(vocabulary))).alias("grams"),
                taken(lines, x, i, f["close"]).alias("taken"),
                F.when((i == 0) & (F.size(lines) > 1) & f["held"], F.transform(lines, lambda y: y["words"])).alias("whole")))))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(let(F.transform(lines_of(F.col(text_col)), read), judged)).alias("i", "line"))
    return rows.select("doc_id", "i", F.coalesce("line.grams", F.array().cast("array<string>")).alias("grams"), "line.taken", "line.whole")


def examples_of(lines: DataFrame) -> DataFrame:
    """``draw, grams`` of the lines that are examples of the unknown class; ``draw`` is a hash of id and place."""
    return lines.where(~F.col("taken")).select(F.xxhash64("doc_id", "i").alias("draw"), "grams")


def unknown_lines(docs: DataFrame, id_col: str, text_col: str, known: list[list[str]], reach: int, vocabulary: list[str]) -> DataFrame:
    """``draw, grams`` of every line that neither resembles a template nor adds to a notice around it."""
    return examples_of(line_rows(docs, id_col, text_col, known, reach, vocabulary))


def wording(rows: list) -> tuple[list[list[str]], int, list[str]]:
    """The 2-grams of every template, the words of the longest one, and all their 1- and 2-grams."""
    return ([list(map(str, r.pairs)) for r in rows], max((len(r.words) for r in rows), default=0),
            sorted({g for r in rows for g in (*map(str, r.words), *map(str, r.pairs))}))


def read_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``line_rows`` of ``docs`` as a table that both ``train`` and ``scan`` take, so that texts are read once for both."""
    return written(line_rows(docs, id_col, text_col, *wording(template_rows(docs.sparkSession, templates).collect())), "licence-lines")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          templates: list[tuple[str, str]] = TEMPLATES, read: DataFrame | None = None) -> LicenseModel:
    """The model; ``read`` is ``read_lines`` of the same ``docs`` and ``templates`` where the caller has it."""
    spark = docs.sparkSession
    known = template_rows(spark, templates)
    names = sorted({f for f, _ in templates})
    label = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("family")) - 1

    known_rows = known.select("family", "pairs", "words").collect()  # one row per template
    rivals = rivals_of([(r.family, list(r.pairs)) for r in known_rows])
    entries = [{"family": r.family, "pairs": list(r.pairs), "rivals": [{"own": a, "other": b} for a, b in x]} for r, x in zip(known_rows, rivals)]
    kind = "array<struct<family: string, pairs: array<string>, rivals: array<struct<own: array<string>, other: array<string>>>>>"
    grouped = (spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(entries)), kind)))
               .groupBy("family").agg(F.collect_list(F.struct("pairs", "rivals")).alias("templates")))
    grouped = written(grouped, "licence-templates")
    pairs, reach, vocabulary = wording(known_rows)
    lines = examples_of(read_lines(docs, id_col, text_col, templates) if read is None else read)
    n = lines.count()

    # Every second copy sits inside a corpus line: those of the least hashes, one per such copy. The hash bound
    # only keeps the sort small.
    thin = F.filter("words", lambda w, i: w.isin(sorted(TELLING)) | (F.pmod(F.xxhash64(w, i, F.col("copy")), F.lit(100)) < KEEP_WORDS))
    copies = known.select("family", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"), "words") \
        .withColumn("words", F.when(F.col("copy") == 0, F.col("words")).otherwise(thin))
    wanted = len(known_rows) * COPIES // 2
    bound = F.lit(min(2**63 - 1, -2**63 + int(2**64 * min(1.0, 4 * wanted / max(1, n)))))
    around = written(lines.where(F.col("draw") <= bound).orderBy("draw", "grams").limit(wanted)
                     .select((F.row_number().over(Window.orderBy("draw", "grams")) - 1).alias("at"), F.col("grams").alias("context")), "licence-around")
    inside = F.when(F.col("copy") % 2 == 1, F.col("context"))
    positives = (copies.join(around, F.pmod(F.xxhash64("family", "copy"), F.lit(max(1, around.count()))) == F.col("at"), "left")
                 .select(label.cast("double").alias("label"), F.array_distinct(F.concat(
                     grams_of(F.col("words"), vocabulary), F.coalesce(inside, F.array().cast("array<string>")))).alias("grams")))

    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True)
    data = written(vectors.transform(positives).select("label", "features").repartition(4, "label", F.hash("features")), "licence-train")
    regression = LogisticRegression(maxIter=40, regParam=1e-4, family="multinomial").fit(data)
    rows = data.select(F.lit(1.0).alias("label"), F.lit(1.0).alias("weight"), "features").unionByName(
        vectors.transform(lines).select(F.lit(0.0).alias("label"), F.lit(min(1.0, UNKNOWN_WEIGHT / max(1, n))).alias("weight"), "features"))
    notice = LogisticRegression(maxIter=40, regParam=1e-4, family="binomial", weightCol="weight").fit(rows)
    for m, column in ((regression, "p_family"), (notice, "p_notice")):
        m.setProbabilityCol(column).setRawPredictionCol("").setPredictionCol("")
    model = LicenseModel(vectors, notice, regression, names, 0.5, grouped, pairs, reach)
    high = model.scored(lines).agg(F.percentile_approx("probability", FALSE_ALARMS, 100_000)).first()[0]
    model.cut = max(0.5, high or 0.0)
    return model


def joined_lines(lines: DataFrame, known: list[list[str]], reach: int) -> DataFrame:
    """``row, doc_id, i, j, words`` of the joins of lines ``i`` to ``j`` that hold ``CONFIRM`` of a
    template; see the module text. A join has at most ``reach`` words of its first line and of
    every later one."""
    by_row = Window.partitionBy("row").orderBy("i")
    upto = F.sum(F.size("words")).over(by_row)
    later = F.struct((F.col("upto") - F.size("words")).alias("before"), F.slice("words", 1, reach).alias("words"))
    ahead = F.collect_list("later").over(by_row.rowsBetween(1, reach))
    near = F.transform(F.filter("ahead", lambda x: x["before"] - F.col("upto") < reach), lambda x: x["words"])
    tail = F.slice("words", F.greatest(F.size("words") - reach, F.lit(0)) + 1, reach)
    starts = (lines.withColumn("upto", upto).withColumn("later", later).withColumn("ahead", ahead)
              .withColumn("run", F.concat(F.array(tail), near))
              .select("row", "doc_id", "i", "run").where(F.size("run") > 1)
              .select("*", F.explode(held_by(F.flatten("run"), known)).alias("t")))

    def held(lo, n) -> Column:
        return F.size(F.array_intersect(pairs_of(F.flatten(F.slice("run", lo, n))), F.col("t")))

    fits = (starts.withColumn("held", F.transform(F.sequence(F.lit(1), F.size("run")), lambda k: held(F.lit(1), k)))
            .withColumn("most", F.array_max("held"))
            .withColumn("n", F.array_position("held", F.col("most")).cast("int"))
            .where((F.col("n") > 1) & (held(F.lit(2), F.col("n") - 1) < F.col("most"))))
    return fits.select("row", "doc_id", "i", (F.col("i") + F.col("n") - 1).alias("j"),
                       F.flatten(F.slice("run", F.lit(1), F.col("n"))).alias("words")).dropDuplicates(["row", "i", "j"])


def wrapped_notices(read: DataFrame, model: LicenseModel) -> DataFrame:
    """``doc_id, family, probability, similarity, confirmed`` of the confirmed joins of lines."""
    parts = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # masked lines are small for the work they make
    rows = numbered(read.where(F.col("whole").isNotNull()).select("doc_id", "whole"), "row").repartition(parts, "row")
    lines = rows.select("row", "doc_id", F.posexplode(F.filter("whole", lambda w: F.size(w) > 0)).alias("i", "words"))
    alone = lines.select("row", "doc_id", "i", F.col("i").alias("j"), "words").where(F.size(held_by(F.col("words"), model.known)) > 0)
    joins = joined_lines(lines, model.known, model.reach)
    found = model.compared(joins.unionByName(alone), "row", "doc_id", "i", "j").where("confirmed")
    found = found.withColumn("rank", F.struct("similarity", (F.col("i") - F.col("j")).alias("short"), "probability", -F.col("i")))
    others = F.collect_list(F.struct("i", "j", "family", "similarity", "rank")).over(
        Window.partitionBy("row").orderBy("i").rangeBetween(-model.reach, model.reach))

    def outdone(y: Column) -> Column:
        shared = F.least(y["j"], F.col("j")) - F.greatest(y["i"], F.col("i")) + 1
        own, half = (shared > 0) & (y["family"] == F.col("family")), shared * 2 >= F.col("j") - F.col("i") + 1
        return (F.when(y["i"] == y["j"], own | (half & (y["similarity"] > F.col("similarity"))))
                .otherwise((own | half) & (y["rank"] > F.col("rank"))))

    return (found.withColumn("others", others).where("i < j").where(~F.exists("others", outdone))
            .select("doc_id", "family", "probability", "similarity", "confirmed"))


def scan(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text", read: DataFrame | None = None) -> DataFrame:
    """One row per document id; see the module text. ``read`` is ``read_lines`` of the same ``docs`` where the caller has it."""
    if read is None:
        read = written(line_rows(docs, id_col, text_col, model.known, model.reach, model.vectors.vocabulary), "licence-lines")
    lines = model.compared(read.withColumn("real", F.col("i").isNotNull()), "doc_id", "real")
    compared = lines.unionByName(wrapped_notices(read, model).withColumn("real", F.lit(False)))
    surest = F.max(F.when(F.col("confirmed"), F.struct("probability", "similarity", "family")))
    return (compared.groupBy("doc_id").agg(
        F.count(F.when(F.col("real"), 1)).alias("n_paragraphs"), F.count(F.when(F.col("confirmed"), 1)).alias("n_licences"),
        F.count(F.when(F.col("family").isNotNull() & ~F.col("confirmed"), 1)).alias("n_unconfirmed"),
        F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"), surest.alias("best"))
        .select("doc_id", "n_paragraphs", "n_licences", "n_unconfirmed", "families", F.col("best.family").alias("family"),
                F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    read = read_lines(docs)
    return scan(docs, train(docs, read=read), read=read)


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLE: dict[str, str] = {}
