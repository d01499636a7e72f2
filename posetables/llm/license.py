"""License scans by a trained paragraph classifier, in DataFrame operations only.

A document's paragraphs are its lines and, where several lines stand together, such a block as a whole, so that notices
are found on one line or wrapped over many; a block counts only if none of its own lines gives its family.

Training: the notices below, whole and with runs of a few words taken out, are the positive paragraphs of their
families. The unknown class is a bounded sample of the corpus's own paragraphs: plain ones, and hard ones that hold a
word of LICENSE_WORDS but share few word pairs with every notice, beside the sentences of HARD and the notices of FOREIGN_NOTICES,
whose families the model lacks, with cuts of them. A sparse (L1)
multinomial logistic regression over word 1- to 3-grams is fitted on three quarters of the unknown paragraphs, on every second foreign notice and on
cuts of 0, 1, 2 and 4 words; the rest of the unknown, the other foreign notices and cuts of 3 and 6 words, which the fit never saw, calibrate it:
temperature by log loss, and the least probability as the lowest at which at most one in a hundred unknown paragraphs, and at most one in
twenty cuts of the foreign notices held out, gets a family.

Scanning: from the weights follows a list of words of which a paragraph needs at least one to be given any family
(LicenseModel.triggers; the bound is exact, so nothing is lost), and from the notices one of the words without which a paragraph
of more than a few different words can't be confirmed (needed; exact too). Paragraphs with such words are cut into n-grams, which
are joined to the model's weights, a table of at most VOCABULARY rows that is broadcast, and summed for each paragraph.
Softmax with an unknown class gives family and probability. A prediction stands if a notice of the family is similar: its
distinct words and word pairs cover at least COVER of the paragraph's or the paragraph's cover as much of the notice's; a notice of
two words must be there whole.

Defined results: null and empty texts have no paragraphs; each row is a document of its own, so repeated rows give
repeated results and rows that share a doc_id, or have none, don't mix; of notices that cover alike the first counts;
an empty table gives an empty result; further columns are ignored. Paragraphs of any length are read whole.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import shared, table, texts_of, written

#: Bounds of the fit: paragraphs sampled from the corpus, and n-grams of the model.
SAMPLE_PARAGRAPHS = 2000
#: Named paragraphs (three short columns) that are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 500_000
VOCABULARY = 4096
#: Tasks over the training paragraphs, which are bounded too.
FIT_TASKS = 8
#: So many times a notice of two words is taken; it has no cuts, of which a longer one has as many.
SHORT_COPIES = 20
TEMPERATURES = (0.125, 0.25, 0.5, 1.0, 2.0, 4.0)
NGRAMS = (1, 2, 3)
COVER = 0.6
#: N-grams of a paragraph that may be similar to a notice by its common words alone; see needed().
SHORT = 28
#: Share of word pairs that a hard unknown paragraph may have in common with a notice.
FOREIGN = 0.2
#: Shares of held-out unknown paragraphs, and of cuts of held-out foreign notices, that may get a family.
ALARMS, FOREIGN_ALARMS = 0.01, 0.05
LICENSE_WORDS = ("license", "licensed", "licence", "licenced", "copyright", "warranty", "spdx")

#: Notices of licence families. Fixed values.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("apache-2.0", "Released under the Apache 2 license."),
    ("mit", "MIT licensed"),
    ("bsd", "BSD licensed"),
)
#: Short names of families, and what stands before them in a notice of two words. Fixed values.
SHORT_NAMES = (
    ("apache-2.0", "Apache-2.0"), ("mit", "MIT"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"), ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"),
    ("mpl-2.0", "MPL-2.0"), ("isc", "ISC"), ("unlicense", "Unlicense"), ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"), ("cc-by-nc", "CC-BY-NC-4.0"),
)
LABELS = ("License", "Licence", "Lizenz", "Licencia")
TEMPLATES += tuple((family, f"{label}: {name}") for family, name in SHORT_NAMES for label in LABELS)
#: Notices of families that the model lacks; every second one is held out of the fit.
FOREIGN_NOTICES = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission, subsequent versions of the EUPL",
    "Licensed under the Elastic License 2.0; you may not use this file except in compliance with the Elastic License 2.0.",
    "This program is made available under the terms of the Server Side Public License, version 1, as published by the vendor.",
    "All rights reserved. This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    "This document is the confidential property of its owner and may not be reproduced or disclosed without written consent.",
    "Licensed under the Business Source License 1.1; the Change Date is four years after the release of this version.",
    "This software is licensed under the Confluent Community License; you may not provide it as a competing service.",
    "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: EUPL-1.2",
    "License: proprietary", "License: commercial",
    "Licensed under the Artistic License 2.0.", "Released under the Zope Public License.",
    "Use of this software is governed by the end user license agreement that you accepted.", "Use is subject to the license terms of the customer agreement.",
)
#: Sentences that speak of licences and are no notices.
HARD = (
    "The driver renewed the license at the county office on Monday.", "A copyright dispute between the two publishers was settled out of court.", "The warranty covers repairs for two years after purchase.",
    "She obtained a license to sell food at the market.", "Fishing without a license is fined by the county.", "The committee discussed copyright law and free speech.", "Terms and conditions of the warranty apply to all devices sold.",
    "Students distribute copies of the work without charge.", "The software was modified and published by the university.", "You may not use this door except in an emergency.", "The permission to build was granted by the city free of charge.",
)
UNKNOWN = "unknown"


def words(text: Column) -> Column:
    """Words of letters, digits, dots and hyphens, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.-]+|\.(?=\s|$)"), lambda w: w != "")


def ngrams(w: str, sizes=NGRAMS) -> Column:
    """All n-grams of the words in column w, which is named so that Spark computes it once a row."""
    grams, parts = F.col(w), []
    for n in range(1, max(sizes) + 1):
        if n > 1:  # the next word is put to each (n-1)-gram
            left = F.greatest(F.size(w) - (n - 1), F.lit(0))
            grams = F.zip_with(F.slice(grams, F.lit(1), left), F.slice(F.col(w), F.lit(n), left), lambda a, b: F.concat(a, F.lit(" "), b))
        if n in sizes:
            parts.append(grams)
    return F.concat(*parts)


def paragraphs(docs: DataFrame, blocks: bool = True) -> DataFrame:
    """doc (a number for each row), doc_id, kind, para (from 0 in each kind), text: every line that isn't blank, and every block of several."""
    rows = texts_of(docs).withColumn("doc", F.monotonically_increasing_id())
    several = lambda b: F.rtrim(F.ltrim(b)).contains("\n")
    parts = [F.struct(F.lit("line").alias("kind"), F.split("text", "\n").alias("t"))]
    if blocks:
        parts.append(F.struct(F.lit("block").alias("kind"), F.transform(F.split("text", r"\n[\s]*\n"), lambda b: F.when(several(b), b)).alias("t")))
    each = rows.select("doc", "doc_id", F.explode(F.array(*parts)).alias("p")).select("doc", "doc_id", "p.kind", F.posexplode("p.t").alias("para", "text"))
    return each.where(F.col("text").rlike(r"\S"))


def cut(found: DataFrame) -> DataFrame:
    """found (text and others) with w, the words; as an array's one element they are made once, however many filters follow."""
    return found.select("*", F.explode(F.array(words(F.col("text")))).alias("w"))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(templates)], "template_id int, family string, text string")


def _low(n: int, most: int) -> int:
    """The hash up to which about `most` of n texts lie."""
    return min(2**63 - 1, -(2**63) + int(min(1.0, most / max(1, n)) * 2**64))


def _sampled(texts: DataFrame, n: int, most: int) -> DataFrame:
    """About `most` of n texts (w), chosen by a hash, each once: how many there are doesn't depend on partitions."""
    return texts.where(F.xxhash64(F.array_join("w", " ")) <= F.lit(_low(n, most))).distinct()


def _samples(docs: DataFrame, sample: int) -> tuple[DataFrame, DataFrame]:
    """w of sampled lines without and with a word of LICENSE_WORDS. Lines are cut into words once: all that could be sampled are written."""
    n = paragraphs(docs, blocks=False).count()
    named = F.arrays_overlap("w", F.array(*map(F.lit, LICENSE_WORDS)))
    every = cut(paragraphs(docs, blocks=False)).select("w").withColumn("named", F.coalesce(named, F.lit(False)))
    guess = n // 2  # of the lines so many at least are plain, or else all of this is done again
    while True:
        kept = written(every.where(F.col("named") | (F.xxhash64(F.array_join("w", " ")) <= F.lit(_low(guess, sample)))))
        n_named = kept.where("named").count()
        if guess <= n - n_named:
            return _sampled(kept.where("not named").select("w"), n - n_named, sample), _sampled(kept.where("named").select("w"), n_named, sample)
        guess = n - n_named


def training_paragraphs(docs: DataFrame, sample: int = SAMPLE_PARAGRAPHS, templates=TEMPLATES) -> DataFrame:
    """family, w (words), held, foreign (cuts of a foreign notice that is held): cuts of the notices, and the unknown class."""
    spark = docs.sparkSession
    known = template_table(spark, templates).select("family", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    cut = _cuts(known, ["family"]).groupBy("family", "w").agg(F.min("held").alias("held"))  # what the fit saw is not held out
    notices = spark.createDataFrame([(i % 2 == 1, t) for i, t in enumerate(FOREIGN_NOTICES)], "foreign boolean, text string").select("foreign", words(F.col("text")).alias("w"))
    foreign = _cuts(notices, ["foreign"]).groupBy("w").agg(F.min("foreign").alias("foreign"))
    plain, hard = _samples(docs, sample)
    pairs = template_table(spark, templates).select(words(F.col("text")).alias("w")).select(F.array_distinct(ngrams("w", (2,))).alias("t"))
    lists = F.broadcast(pairs.agg(F.collect_list("t").alias("ts")))  # the notices, a fixed list, in one row
    shares = F.transform("ts", lambda t: F.size(F.array_intersect(t, F.col("g"))) / F.greatest(F.least(F.size(t), F.size("g")), F.lit(1)))
    hard = hard.withColumn("g", F.array_distinct(ngrams("w", (2,)))).join(lists).where(F.coalesce(F.array_max(shares), F.lit(0.0)) <= FOREIGN).select("w")
    fixed = spark.createDataFrame([(t,) for t in (*HARD, *LICENSE_WORDS)], "text string").select(words(F.col("text")).alias("w"))
    other = plain.union(hard).union(fixed).select(F.lit(UNKNOWN).alias("family"), "w", (F.pmod(F.xxhash64(F.array_join("w", " "), F.lit(1)), F.lit(4)) == 0).alias("held"))
    other = other.union(foreign.select(F.lit(UNKNOWN), "w", "foreign")).join(F.broadcast(foreign.where("foreign").select("w", "foreign")), "w", "left")  # cuts of a fixed list
    other = other.select("family", "w", "held", F.coalesce("foreign", F.lit(False)).alias("foreign"))
    both = cut.withColumn("foreign", F.lit(False)).unionByName(other)
    copies = F.array_repeat(F.lit(0), F.when(F.size("w") == 2, SHORT_COPIES).otherwise(1).cast("int"))
    return both.withColumn("copy", F.explode(copies)).drop("copy")


def _cuts(notices: DataFrame, keep: list[str]) -> DataFrame:
    """keep, w, held: notices (keep, w) whole and with runs of a few words taken out; held where the run has 3 or 6."""
    cuts = notices.select(*keep, "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("at"), F.explode(F.array(*map(F.lit, (0, 1, 2, 4, 3, 6)))).alias("n"))
    cut = cuts.select(*keep, F.concat(F.expr("slice(w, 1, at)"), F.expr("slice(w, at + n + 1, greatest(size(w) - at - n, 0))")).alias("w"), F.col("n").isin(3, 6).alias("held"), "n")
    return cut.where((F.size("w") >= 3) | (F.col("n") == 0)).drop("n")


class LicenseModel:
    """families; weights (n-gram -> one weight for each family); intercepts; temperature and least probability.

    common, usual: in how many unknown paragraphs of the training a word is, and in how many without a word of LICENSE_WORDS.
    """

    def __init__(self, families: list[str], rows: list[tuple[str, list[float]]], intercepts: list[float], common: dict[str, int], temperature: float = 1.0, least: float = 0.5, usual: dict[str, int] | None = None):
        self.families, self.rows, self.intercepts, self.common, self.temperature, self.least, self.usual = families, rows, intercepts, common, temperature, least, usual or {}

    def probabilities(self, scores: Column) -> Column:
        """Softmax of the families' scores at the model's temperature."""
        shifted = F.transform(scores, lambda s: F.exp((s - F.array_max(scores)) / F.lit(self.temperature)))
        return F.transform(shifted, lambda e: e / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))

    def triggers(self) -> list[str] | None:
        """Words of which a paragraph needs one to get a family; None if there is no such list.

        A family needs evidence against the unknown class of logit(least) and the difference of the intercepts. N-grams are
        left out of the list, those of the commonest words first, as long as all that are left out can't reach this together.
        """
        families = range(1, len(self.families))
        need = [self.temperature * math.log(self.least / (1 - self.least)) + self.intercepts[0] - self.intercepts[k] for k in families]
        if min(need) <= 0:
            return None
        of = {g: min(g.split(" "), key=lambda w: (self.common.get(w, 0), -len(w), w)) for g, _ in self.rows}
        left, listed = [0.0] * len(need), set()
        for g, w in sorted(self.rows, key=lambda r: (-self.common.get(of[r[0]], 0), r[0])):
            more = [a + max(0.0, w[k] - w[0]) for a, k in zip(left, families)]
            if all(a < b - 1e-6 for a, b in zip(more, need)):
                left = more
            elif any(w[k] > w[0] for k in families):
                listed.add(of[g])
        return sorted(listed)


def fit(docs: DataFrame, sample: int = SAMPLE_PARAGRAPHS, templates=TEMPLATES) -> LicenseModel:
    """The model; the driver gets its weights, at most VOCABULARY rows."""
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted({f for f, _ in templates})]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    train = shared(training_paragraphs(docs, sample, templates).select(label.cast("double").alias("label"), ngrams("w").alias("grams"), "held", "foreign").coalesce(FIT_TASKS))
    terms = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=2.0, binary=True).fit(train)
    vectors = terms.transform(train)
    fitted = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, standardization=False).fit(vectors.where("not held"))
    # A family that the sample's folds never reach has no row of its own in the coefficients.
    matrix, cut = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    rows = [(g, [float(matrix[k, i]) if k < len(cut) else 0.0 for k in range(len(families))]) for i, g in enumerate(terms.vocabulary) if matrix[:, i].any()]
    unknown = train.where("label = 0").select(F.explode(F.array_distinct("grams")).alias("g"))
    single = sorted({w for g, _ in rows for w in g.split(" ")})  # at most three for each n-gram
    common = {r["g"]: r["n"] for r in unknown.join(F.broadcast(spark.createDataFrame([(w,) for w in single], "g string")), "g").groupBy("g").agg(F.count("*").alias("n")).collect()}
    plain = train.where("label = 0").where(~F.arrays_overlap("grams", F.array(*map(F.lit, LICENSE_WORDS)))).select(F.explode(F.array_distinct("grams")).alias("g"))
    own = template_table(spark, templates).select(F.explode(words(F.col("text"))).alias("g")).distinct()  # a fixed list
    usual = {r["g"]: r["n"] for r in plain.join(F.broadcast(own), "g").groupBy("g").agg(F.count("*").alias("n")).collect()}
    model = LicenseModel(families, rows, [float(cut[k]) if k < len(cut) else -30.0 for k in range(len(families))], common, usual=usual)
    held = fitted.transform(vectors.where("held")).select("label", "foreign", F.expr("cast(rawPrediction as string)").alias("r")).select("label", "foreign", F.from_json("r", "array<double>").alias("r"))
    held = shared(held)
    loss = lambda t: F.avg(-F.log(F.greatest(F.element_at(model_at(model, t).probabilities(F.col("r")), F.col("label").cast("int") + 1), F.lit(1e-12))))
    losses = held.agg(*map(loss, TEMPERATURES)).first()
    model.temperature = min((x or 0.0, t) for x, t in zip(losses, TEMPERATURES))[1]
    highest = held.where("label = 0").select("foreign", F.array_max(F.slice(model.probabilities(F.col("r")), 2, len(families) - 1)).alias("p"))
    alarms = highest.agg(F.percentile_approx("p", 1 - ALARMS, 10_000), F.percentile_approx(F.when(F.col("foreign"), F.col("p")), 1 - FOREIGN_ALARMS, 10_000)).first()
    model.least = min(0.99, max(0.05, *(float(x or 0.0) + 1e-6 for x in alarms)))  # the outer bounds are for corpora without a hard paragraph, or of nothing else
    return model


def model_at(model: LicenseModel, temperature: float) -> LicenseModel:
    return LicenseModel(model.families, model.rows, model.intercepts, model.common, temperature, model.least)


def needed(notices: list[list[str]], usual: dict[str, int]) -> tuple[list[str], int]:
    """Words, and a number: a paragraph that has none of the words, and more different words than the number, is confirmed by no notice.

    Of each notice (its words and word pairs) the commonest words are left out of the list, as long as what consists of
    such words alone is less than confirm() asks for of the notice, and of a paragraph of SHORT n-grams. A shorter paragraph is
    similar at most if it has no more n-grams than those suffice for; d different words have d - 1 different pairs at least.
    """
    listed, most = set(), 0
    for grams in notices:
        least = (1.0 if len(grams) <= 3 else COVER) - 1e-6
        out, left = set(), 0
        for w in sorted({w for g in grams for w in g.split(" ")}, key=lambda w: (-usual.get(w, 0), w)):
            more = sum(set(g.split(" ")) <= out | {w} for g in grams)
            if more < least * len(grams) and more <= least * SHORT:
                out.add(w)
                left = more
            else:
                listed.add(w)
        most = max(most, int(left / least))
    return sorted(listed), (most + 1) // 2


def scan_licenses(docs: DataFrame, model: LicenseModel, templates=TEMPLATES) -> DataFrame:
    """doc_id, kind, para, family, probability, template_id, cover of every paragraph that is a notice."""
    triggers = model.triggers()
    likely = cut(paragraphs(docs))
    if triggers is not None:  # whole words: as a part of longer words, short triggers are everywhere
        likely = likely.where(F.arrays_overlap("w", F.array(*map(F.lit, triggers))) if triggers else F.lit(False))
    notices = template_table(docs.sparkSession, templates).select(words(F.col("text")).alias("w")).select(F.array_distinct(ngrams("w", (1, 2))).alias("t"))
    listed, few = needed([r["t"] for r in notices.collect()], model.usual)  # a fixed list
    likely = likely.where((F.size(F.array_distinct("w")) <= few) | F.arrays_overlap("w", F.array(*map(F.lit, listed))))
    likely = written(likely.drop("w").withColumn("p", F.monotonically_increasing_id()))  # written, so that the numbers stay
    weights = docs.sparkSession.createDataFrame(model.rows or [("", [0.0] * len(model.families))], "gram string, weight array<double>").coalesce(1)
    grams = likely.select("p", words(F.col("text")).alias("w")).select("p", F.explode(F.array_distinct(ngrams("w"))).alias("gram"))
    met = grams.join(F.broadcast(weights), "gram")  # VOCABULARY rows at most
    sums = met.groupBy("p").agg(*[F.sum(F.element_at("weight", k + 1)).alias(f"s{k}") for k in range(len(model.families))])
    scores = F.array(*[F.col(f"s{k}") + F.lit(b) for k, b in enumerate(model.intercepts)])
    q = sums.select("p", scores.alias("scores")).withColumn("q", model.probabilities(F.col("scores"))).withColumn("best", F.array_position("q", F.array_max("q")).cast("int"))
    named = q.where((F.col("best") > 1) & (F.array_max("q") >= model.least)).select("p", F.element_at(F.array(*map(F.lit, model.families)), F.col("best")).alias("family"), F.array_max("q").alias("probability"))
    named = shared(named)
    few = named.count() <= MOST_BROADCAST  # then the texts stay where they are
    found = shared(confirm(likely.join(F.broadcast(named) if few else named, "p").withColumn("w", words(F.col("text"))), templates))
    lines, blocks = found.where("kind = 'line'"), found.where("kind = 'block'")
    inner = blocks.select("p", "doc", "family", F.explode(F.split("text", "\n")).alias("text")).join(lines.select("doc", "family", "text").distinct(), ["doc", "family", "text"], "left_semi")
    blocks = blocks.join(inner.select("p").distinct(), "p", "left_anti")  # equal lines are judged alike, so the line that was found stands in the block
    return lines.unionByName(blocks).select("doc_id", "kind", "para", "family", "probability", "template_id", "cover")


def confirm(named: DataFrame, templates=TEMPLATES) -> DataFrame:
    """named (p, family, w and others) where a notice of the family covers the paragraph's words w or is covered by them, with the best one."""
    pairs = F.array_distinct(ngrams("w", (1, 2)))
    known = template_table(named.sparkSession, templates).select("template_id", F.col("family").alias("f"), words(F.col("text")).alias("w")).select("template_id", "f", pairs.alias("t"))
    both = F.size(F.array_intersect("g", "t"))
    near = named.withColumn("g", pairs).join(F.broadcast(known), F.col("family") == F.col("f"))  # the notices, a fixed list
    near = near.withColumn("cover", F.round(both / F.greatest(F.least(F.size("g"), F.size("t")), F.lit(1)), 6)).where(F.col("cover") >= F.when(F.size("t") <= 3, 1.0).otherwise(COVER))
    best = near.groupBy("p").agg(F.max(F.struct("cover", (-F.col("template_id")).alias("k"))).alias("b"))
    return named.join(best, "p").select("p", "doc", "doc_id", "kind", "text", "para", "family", "probability", (-F.col("b.k")).alias("template_id"), F.col("b.cover").alias("cover"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_licenses(docs, fit(docs))
