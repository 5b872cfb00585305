"""License scans: a trained paragraph classifier, with DataFrame functions only.

A paragraph is a line of a document; its words are lower-cased runs of letters, digits and dots, and
its features the distinct words and pairs of neighbouring words. Notices may be wrapped: neighbouring
lines with words are also joined and scored as one, as far as the longest template goes. A
multinomial logistic regression
with a lasso penalty tells licence families, other legal notices (*unknown*) and plain text apart.
It is trained on the templates below, whole, cut and with text around them, and on a bounded sample
of the corpus' paragraphs as plain text: distinct ones of distinct documents, without those that hold
half of a template's grams. All grams of the templates are features; the lasso chooses among them.

* A paragraph whose likeliest class is a family is *unknown* after all if that family's probability
  is below a bound. The bound is calibrated on labelled rows that the model was not fitted on:
  it is the smallest probability of the rows it gets right, but at least ``LEAST``.
* A prediction is confirmed if the paragraph holds ``CONFIRM`` of the word pairs of one of the
  family's templates.
* Joined lines are a notice if they hold ``CONFIRM`` of the word pairs of a template of their class
  (of any template if the class is *unknown*) and no fewer of them do. A line in such a notice that
  is not confirmed by itself belongs to it and is no notice of its own.

Scoring is row by row: paragraphs are tested for words without which no class but plain text can win
(``LicenceModel.gate``), and only those that hold one are scored, by the model's few weights as
literals; lines are joined around words without which no template can be held
(``LicenceModel.anchors``). Both are looked for in one pass over the text. Nothing is shuffled.

A NULL text counts as empty and has no paragraphs. Repeated paragraphs count each time.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.scratch import Scratch, without

RUNS = "array<struct<line:struct<first:int,last:int>,text:string>>"
WORD = r"[\p{L}\p{N}.]*[\p{L}\p{N}]"
PLAIN, UNKNOWN = "none", "unknown"
#: Distinct paragraphs of the corpus used as plain text, from distinct texts chosen by their hash.
SAMPLE_DOCUMENTS = 1000
SAMPLE_ROWS = 4000
BESIDE = 24
LASSO = 0.001
LEAST = 0.5
CONFIRM = 0.8

# The usual notices of each family, and other legal notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License.",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    UNKNOWN: [
        "All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "This software is proprietary and confidential.",
        "Unauthorized copying of this file is strictly prohibited.",
        "Licensed under the terms of the agreement between the parties.",
        "Used by permission of the copyright holder.",
        "Distributed under a custom license.",
        "Licensed under the Unlicensed Sample License.",
        "See the license file for details.",
    ],
}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def pairs_of(words: Column) -> Column:
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))


def grams_of(words: Column) -> Column:
    """Distinct words and pairs; the last word has a pair of its own, with nothing."""
    return F.array_distinct(F.concat(words, pairs_of(words)))


def named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_words(words: list[str]) -> str:
    """Pattern of any of ``words`` as a whole word."""
    either = "|".join(w.replace(".", r"\.") for w in words) or "(?!)"
    return rf"(?<![\p{{L}}\p{{N}}.])(?:{either})(?![\p{{L}}\p{{N}}])"


def template_rows(spark: SparkSession) -> DataFrame:
    """(label, text, grams) of all templates."""
    entries = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(t).alias("text")) for k, each in TEMPLATES.items() for t in each])
    return spark.range(1).select(F.inline(entries)).withColumn("grams", grams_of(words_of(F.col("text"))))


def training_rows(docs: DataFrame, templates: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """(label, grams, fold): plain paragraphs of a bounded sample, and the templates in several
    forms, each with some of those paragraphs around it."""
    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    # Copies count once; only hashes are moved to choose.
    chosen = texts.select("_hash").distinct().orderBy("_hash").limit(SAMPLE_DOCUMENTS)
    lines = (
        texts.join(F.broadcast(chosen), "_hash").groupBy("_hash").agg(F.min("_text").alias("_text"))
        .select(F.explode(F.split("_text", "\n")).alias("line")).where(F.trim("line") != "").distinct()
        .orderBy(F.xxhash64("line")).limit(SAMPLE_ROWS)
        .withColumn("order", F.xxhash64(F.lit(1), "line"))
    )
    # What holds half of a template is no plain text.
    known = F.array(*[F.array(*[F.lit(g) for g in r["grams"]]) for r in templates.collect()])
    # Stored, as a filter would compute the grams anew for every template.
    grams = scratch.store(lines.withColumn("grams", grams_of(words_of(F.col("line")))), "paragraphs")
    licence = F.exists(known, lambda t: F.size(F.array_intersect("grams", t)) * 2 >= F.size(t))
    plain = grams.where(~licence).select(F.lit(PLAIN).alias("label"), "line", "order")
    # Some paragraphs, each with every template: both are fixed in number.
    beside = plain.orderBy("order").limit(BESIDE).select(F.substring("line", 1, 80).alias("beside"), F.pmod("order", F.lit(3)).alias("side"))
    notices = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(t).alias("text")) for k, each in TEMPLATES.items() for t in each])
    placed = F.when(F.col("side") == 0, F.concat_ws(" ", "beside", "text")).when(F.col("side") == 1, F.concat_ws(" ", "text", "beside")).otherwise(F.upper("text"))
    around = beside.select("beside", "side", F.inline(notices)).select("label", placed.alias("line"))
    alone = templates.select("label", F.col("text").alias("line"))
    rows = plain.select("label", "line").unionAll(alone).unionAll(alone).unionAll(alone).unionAll(around)
    return rows.select("label", grams_of(words_of(F.col("line"))).alias("grams"), F.pmod(F.xxhash64("line"), F.lit(4)).alias("fold"))


@dataclass
class LicenceModel:
    classes: list[str]
    intercepts: list[float]
    weights: dict[str, list[float]]
    bound: float
    templates: dict[str, list[list[str]]]
    #: Share of the sampled plain paragraphs that hold a gram; it decides what is looked for, not what is found.
    frequency: dict[str, float] = field(default_factory=dict)

    def gate_grams(self) -> set[str]:
        """Grams of which a paragraph must hold one for any class to be likelier than plain text.

        A gram's margin is what it adds to a class over plain text. For each class, the grams most
        frequent in plain text are passed over, as long as all their margins together do not make up for
        plain text's lead in the intercepts; one of the others must be there.
        """
        plain, found = self.classes.index(PLAIN), set()
        for c, name in enumerate(self.classes):
            if c == plain:
                continue
            lead = self.intercepts[plain] - self.intercepts[c]
            margins = [(w[c] - w[plain], g) for g, w in self.weights.items() if w[c] > w[plain]]
            for margin, gram in sorted(margins, key=lambda x: (-self.frequency.get(x[1], 0.0), x)):
                lead -= margin
                if lead <= 0:
                    found.add(gram)
        return found

    def gate(self) -> list[str]:
        """A word of each of these grams: the rarer one in plain text, or else the longer one."""
        return sorted({min(g.split(), key=lambda w: (self.frequency.get(w, 0.0), -len(w), w)) for g in self.gate_grams()})

    def gate_pattern(self) -> str:
        """The gate's words as whole words."""
        return whole_words(self.gate())

    def anchors(self) -> list[str]:
        """Words of which a text must hold one to hold ``CONFIRM`` of any template's pairs: of each
        template, the longest words that stand in more of its pairs than may be missing."""
        found: set[str] = set()
        for template in (t for each in self.templates.values() for t in each):
            missing, met = len(template) - math.ceil(CONFIRM * len(template)), set()
            for word in sorted({w for g in template for w in g.split()}, key=lambda w: (-len(w), w)):
                if len(met) > missing:
                    break
                found.add(word)
                met |= {g for g in template if word in g.split()}
        return sorted(found)

    def joined(self, lines: Column) -> Column:
        """Array of struct(line: struct(first, last), text) of all runs of two lines and more that
        hold an anchor. A run has words in every line, and is not carried on once the lines after
        its first hold as many words as the longest template."""
        longest = max((len(t) + 1 for each in self.templates.values() for t in each), default=0)
        anchor = F.lit(whole_words(self.anchors()))
        rows = F.transform(lines, lambda x, i: F.struct(
            (i + 1).alias("line"), x.alias("text"), F.size(words_of(x)).alias("n"), F.regexp_like(F.lower(x), anchor).alias("anchor")
        ))

        def state(going: Column, n: Column, text: Column, anchor: Column, runs: Column) -> Column:
            return F.struct(going.alias("going"), n.alias("n"), text.alias("text"), anchor.alias("anchor"), runs.alias("runs"))

        def runs_from(x: Column, after: Column) -> Column:
            def add(a: Column, y: Column) -> Column:
                text, anchor = F.concat_ws(" ", a["text"], y["text"]), a["anchor"] | y["anchor"]
                run = F.struct(F.struct(x["line"].alias("first"), y["line"].alias("last")).alias("line"), text.alias("text"))
                more = state(F.lit(True), a["n"] + y["n"], text, anchor, F.when(anchor, F.concat(a["runs"], F.array(run))).otherwise(a["runs"]))
                return F.when(a["going"] & (y["n"] > 0) & (a["n"] < longest), more).otherwise(state(F.lit(False), a["n"], a["text"], a["anchor"], a["runs"]))

            return F.aggregate(after, state(F.lit(True), F.lit(0), x["text"], x["anchor"], F.array().cast(RUNS)), add, lambda a: a["runs"])

        def runs(rows: Column) -> Column:
            first = F.filter(rows, lambda x: (x["n"] > 0) & F.exists(F.slice(rows, x["line"], longest + 1), lambda y: y["anchor"]))
            return F.flatten(F.transform(first, lambda x: runs_from(x, F.slice(rows, x["line"] + 1, longest))))

        return named(rows, runs)

    def notices(self, judged: Column) -> Column:
        """Of judged lines and runs: the notices, by line. Only what lies near in the order by lines
        can be a part of a run or hold it, so each is compared with a bounded number."""
        longest = max((len(t) + 1 for each in self.templates.values() for t in each), default=0)
        reach = (longest + 1) * (longest + 2)

        def near(all_: Column, i: Column) -> Column:
            return F.slice(all_, F.greatest(i + 1 - reach, F.lit(1)), 2 * reach + 1)

        def within(x: Column, y: Column) -> Column:
            return (y["line"]["first"] <= x["line"]["first"]) & (x["line"]["last"] <= y["line"]["last"])

        def several(x: Column) -> Column:
            return x["line"]["first"] < x["line"]["last"]

        def least(all_: Column) -> Column:
            return F.filter(all_, lambda x, i: ~several(x) | ~F.exists(
                near(all_, i), lambda y: y["held"] & (y["family"] == x["family"]) & within(y, x) & (y["line"] != x["line"])
            ))

        def apart(all_: Column) -> Column:
            return F.filter(all_, lambda x, i: several(x) | x["confirmed"] | ~F.exists(near(all_, i), lambda y: several(y) & within(x, y)))

        found = F.array_sort(F.filter(judged, lambda x: (x["family"] != PLAIN) & (~several(x) | x["held"])))
        return F.transform(named(named(found, least), apart), lambda x: F.struct(
            x["line"]["first"].alias("line"), x["family"].alias("family"), x["probability"].alias("probability"), x["confirmed"].alias("confirmed")
        ))

    def judged(self, lines: Column) -> Column:
        """Of an array of struct(line, text): struct(line, family, probability, confirmed, held). Each
        transform() names what the next one uses more than once, so that it is computed once."""
        table = F.create_map(*[x for g, w in self.weights.items() for x in (F.lit(g), F.array(*[F.lit(float(v)) for v in w]))])
        start = F.array(*[F.lit(float(b)) for b in self.intercepts])
        names, weighed = F.array(*[F.lit(c) for c in self.classes]), F.array(*[F.lit(g) for g in self.weights])

        def powers(x: Column) -> Column:
            known = F.array_intersect(x["grams"], weighed)
            totals = F.aggregate(known, start, lambda a, g: F.zip_with(a, F.element_at(table, g), lambda u, v: u + v))
            return F.struct(x["line"].alias("line"), x["grams"].alias("grams"), F.transform(totals, lambda t: F.exp(t)).alias("powers"))

        def decide(x: Column) -> Column:
            best = F.array_max(x["powers"])
            chance = best / F.aggregate(x["powers"], F.lit(0.0), lambda a, y: a + y)
            name = F.element_at(names, F.array_position(x["powers"], best).cast("int"))
            family = F.when((name != PLAIN) & (chance < self.bound), F.lit(UNKNOWN)).otherwise(name)
            return F.struct(x["line"].alias("line"), x["grams"].alias("grams"), family.alias("family"), chance.alias("probability"))

        def confirm(x: Column) -> Column:
            sure = F.when(x["family"].isin(PLAIN, UNKNOWN), F.lit(False)).otherwise(self.confirmed(x["family"], x["grams"]))
            return F.struct(x["line"].alias("line"), x["family"].alias("family"), x["probability"].alias("probability"), x["grams"].alias("grams"), sure.alias("confirmed"))

        def hold(x: Column) -> Column:
            any_held = reduce(Column.__or__, [self.confirmed(F.lit(k), x["grams"]) for k in self.templates], F.lit(False))
            held = F.when(x["family"] == UNKNOWN, any_held).otherwise(x["confirmed"])
            return F.struct(x["line"].alias("line"), x["family"].alias("family"), x["probability"].alias("probability"), x["confirmed"].alias("confirmed"), held.alias("held"))

        out = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), grams_of(words_of(x["text"])).alias("grams")))
        for step in (powers, decide, confirm, hold):
            out = F.transform(out, step)
        return out

    def confirmed(self, family: Column, grams: Column) -> Column:
        out = F.lit(False)
        for name, each in self.templates.items():
            hit = F.lit(False)
            for template in each:
                pairs = F.array(*[F.lit(g) for g in template])
                hit = hit | (F.size(F.array_intersect(grams, pairs)) >= CONFIRM * len(template))
            out = F.when(family == name, hit).otherwise(out)
        return out


def fit(docs: DataFrame, text: str = "text") -> LicenceModel:
    spark = docs.sparkSession
    scratch = Scratch(spark)
    templates = template_rows(spark)
    listed = templates.collect()  # the literal templates above, as grams
    vocabulary = sorted({g for r in listed for g in r["grams"]})
    classes = [PLAIN, *TEMPLATES]
    code = F.element_at(F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))]), F.col("label"))
    rows = scratch.store(training_rows(docs, templates, text, scratch).select(code.alias("label"), "grams", "fold").coalesce(4), "licences")
    names = F.array(*[F.lit(g) for g in vocabulary])
    met = rows.where("label = 0").agg(F.count("fold")).first()[0]
    plain = rows.where("label = 0").select(F.explode(F.array_intersect("grams", names)).alias("gram")).groupBy("gram").count()
    frequency = {r["gram"]: r["count"] / met for r in plain.collect()}  # no more than the templates' grams
    holds = F.transform(names, lambda g: F.array_contains("grams", g).cast("double")).alias("holds")
    rows = scratch.store(rows.select("label", "fold", holds), "vectors")
    vectors = rows.select("label", "fold", array_to_vector("holds").alias("features"))
    lasso = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False)
    # Every class has templates in each fold but for the smallest; fold 0 calibrates.
    fitted = lasso.fit(vectors.where("fold > 0"))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    held = fitted.transform(vectors.where("fold = 0")).where("prediction = label AND label > 0")
    from pyspark.ml.functions import vector_to_array

    least = held.agg(F.min(F.array_max(vector_to_array("probability")))).first()[0]
    scratch.drop("paragraphs", "licences", "vectors")
    size = matrix.shape[0]
    weights = {g: [float(x) for x in matrix[:, i]] for i, g in enumerate(vocabulary) if abs(matrix[:, i]).max() > 1e-9}
    shown = {}
    for r in listed:
        shown.setdefault(r["label"], []).append([g for g in r["grams"] if " " in g] or list(r["grams"]))
    return LicenceModel(classes[:size], [float(x) for x in intercepts], weights, max(LEAST, least or LEAST), shown, frequency)


def scanned(docs: DataFrame, model: LicenceModel, text: str = "text") -> DataFrame:
    """``docs`` with ``n_paragraphs`` (lines with a word), ``notices`` (number of the first line,
    family, probability, confirmed; of lines and joined lines that are not plain text), ``licenses``
    (confirmed families) and ``has_unknown``."""
    docs = without(docs, "n_paragraphs", "notices", "licenses", "has_unknown")
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(whole, "\n")
    numbered = F.transform(lines, lambda x, i: F.struct(F.struct((i + 1).alias("first"), (i + 1).alias("last")).alias("line"), x.alias("text")))
    lowered = F.lower(whole)
    gated = F.filter(numbered, lambda x: F.regexp_like(F.lower(x["text"]), F.lit(model.gate_pattern())))
    # Most documents are done with one look at the whole text.
    none = F.array().cast(RUNS)
    candidates = F.when(F.regexp_like(lowered, F.lit(model.gate_pattern())), gated).otherwise(none)
    runs = F.when(F.regexp_like(lowered, F.lit(whole_words(model.anchors()))), model.joined(lines)).otherwise(none)
    notices = model.notices(model.judged(F.concat(candidates, runs)))
    # From a line's first character of a word to its end.
    count = F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D][^\n]*")).cast("long")
    found = docs.withColumns({"n_paragraphs": count, "notices": notices})
    sure = F.filter("notices", lambda x: x["confirmed"] & (x["family"] != UNKNOWN))
    return found.withColumns({
        "licenses": F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))),
        "has_unknown": F.exists("notices", lambda x: x["family"] == UNKNOWN),
    })
