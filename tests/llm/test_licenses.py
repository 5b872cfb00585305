import pytest
from pyspark.sql import functions as F

from stayrate.llm import licenses
from stayrate.llm.scratch import Scratch
from stayrate.sources.subscribers import read_table
from tests.llm.conftest import edge_rows, phrase

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit(read_table(spark, SMALL, "documents"))


CASES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "licensed under cc by-nc 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}


def test_notices_inside_of_documents(spark, model):
    rows = [(i, f"{phrase(i, 40)}\n{notice}\n\n{phrase(i + 9, 30)}") for i, notice in enumerate(CASES)]
    rows += [(90, phrase(3, 50) + "\n" + "Copyright 2020 the authors. All rights reserved."), (91, phrase(3, 500)), (92, "the license of the of"), (93, None), (94, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Notices", F.lit(1))
    out = licenses.scanned(docs, model)
    assert out.columns == ["doc_id", "text", "n_paragraphs", "notices", "licenses", "has_unknown"]
    got = {r["doc_id"]: r for r in out.collect()}
    for i, (notice, family) in enumerate(CASES.items()):
        assert got[i]["licenses"] == [family], notice
        assert got[i]["n_paragraphs"] == 3 and [n["line"] for n in got[i]["notices"]] == [2]
    assert got[90]["has_unknown"] and not got[90]["licenses"]
    assert not got[91]["notices"]
    assert got[93]["n_paragraphs"] == got[94]["n_paragraphs"] == 0


def test_gate_loses_nothing(spark, model):
    """Scoring every paragraph gives the same notices as scoring those that pass the gate."""
    lines = read_table(spark, SMALL, "documents").select(F.explode(F.split("text", "\n")).alias("line")).orderBy(F.xxhash64("line")).limit(3000)
    one = F.array(F.struct(F.lit(1).alias("line"), F.col("line").alias("text")))
    scored = lines.withColumn("is", F.element_at(model.judged(one), 1)).withColumn("gated", F.regexp_like(F.lower("line"), F.lit(model.gate_pattern())))
    assert scored.where("NOT gated").where(F.col("is.family") != licenses.PLAIN).count() == 0
    # It is a gate: few documents without a notice pass.
    docs = read_table(spark, SMALL, "documents").select(F.lower("text").alias("text"))
    passed = docs.where(F.regexp_like("text", F.lit(model.gate_pattern())) | F.regexp_like("text", F.lit(licenses.whole_words(model.anchors())))).count()
    assert 0 < passed < 0.2 * docs.count()


@pytest.mark.parametrize("seed", range(20))
def test_gate_of_any_weights(seed):
    """No choice of grams outside the gate makes a class likelier than plain text."""
    import random

    pick = random.Random(seed)
    grams = [f"w{i}" for i in range(12)] + [f"w{i} w{i + 1}" for i in range(6)]
    weights = {g: [pick.uniform(-1, 2) for _ in range(4)] for g in grams}
    model = licenses.LicenceModel([licenses.PLAIN, "a", "b", licenses.UNKNOWN], [pick.uniform(1, 6), 0.0, -0.5, 0.3], weights, 0.5, {}, {g: pick.random() for g in grams})
    outside = [g for g in grams if g not in model.gate_grams()]
    for _ in range(500):
        held = [g for g in outside if pick.random() < pick.choice([0.3, 0.9, 1.0])]
        powers = [b + sum(weights[g][c] for g in held) for c, b in enumerate(model.intercepts)]
        assert max(powers[1:]) <= powers[0] + 1e-9
    assert all(any(w in g.split() for w in model.gate()) for g in model.gate_grams())


def test_plan_has_no_python(spark, model):
    plan = licenses.scanned(read_table(spark, SMALL, "documents"), model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_all_documents_of_the_sample(spark, model):
    docs = read_table(spark, SMALL, "documents")
    rows = licenses.scanned(docs, model).collect()
    named = {r["doc_id"]: {k for t, k in CASES.items() if t.lower() in r["text"].lower()} for r in rows}
    assert sum(map(len, named.values())) > 20
    assert all(set(r["licenses"]) == named[r["doc_id"]] for r in rows)


def test_edge_rows(edges, none, model):
    assert licenses.scanned(edges, model).count() == len(edge_rows())
    assert licenses.scanned(none, model).collect() == []
    assert licenses.scanned(none, licenses.fit(none)).collect() == []


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "GPL-3.0": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.""",
    "LGPL": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 3 of the License, or (at your option) any later version.""",
    "BSD-3-Clause": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are
# met:""",
    "Apache-2.0": """// Licensed under the Apache License,
// Version 2.0 (the "License"); you may not
// use this file except in compliance with
// the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of
the Mozilla Public License, v. 2.0.""",
    "CC-BY-SA-4.0": """This work is licensed under a Creative Commons
Attribution-ShareAlike 4.0
International License.""",
}


def test_wrapped_notices(spark, model):
    rows = [(i, f"{phrase(i, 40)}\n{notice}\n{phrase(i + 9, 30)}") for i, notice in enumerate(WRAPPED.values())]
    rows += [(i + 50, "\r\n".join(w for w in notice.split() if w not in ("*", "#", "//"))) for i, notice in enumerate(WRAPPED.values())]
    rows += [(90, WRAPPED["MIT"].replace("\n", "\n\n")), (91, "\n\n".join(WRAPPED.values())), (92, "Unauthorized copying of this\nfile is strictly prohibited.")]
    got = {r["doc_id"]: r for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, family in enumerate(WRAPPED):
        assert got[i]["licenses"] == [family]
        assert sum(n["confirmed"] for n in got[i]["notices"]) == 1
        assert got[i + 50]["licenses"] == [family]
    assert not got[90]["licenses"], "blank lines part paragraphs"
    assert got[91]["licenses"] == sorted(WRAPPED)
    assert got[92]["has_unknown"] and not got[92]["licenses"]


def test_anchors_lose_nothing(model):
    """Whoever leaves out all anchors leaves too little of every template."""
    for template in (t for each in model.templates.values() for t in each):
        left = [g for g in template if not set(g.split()) & set(model.anchors())]
        assert len(left) < licenses.CONFIRM * len(template)


def test_no_copies_fill_the_sample(spark):
    """Of 1,200 copies of the text of lowest hash one is sampled, and notices are no plain text."""
    own = spark.createDataFrame([(phrase(i, 20),) for i in range(50)] + [(phrase(99, 20) + "\nAll rights reserved.",)], "text string")
    copied = own.orderBy(F.xxhash64("text")).limit(1).crossJoin(spark.range(1200)).select("text")
    scratch = Scratch(spark)
    rows = licenses.training_rows(own.union(copied), licenses.template_rows(spark), "text", scratch)
    plain = [tuple(r["grams"]) for r in rows.where(F.col("label") == licenses.PLAIN).collect()]
    scratch.drop("paragraphs")
    assert len(plain) == len(set(plain)) >= 51
    assert not any("reserved" in grams for grams in plain)


def test_a_footer_takes_no_features(spark):
    docs = spark.createDataFrame([(phrase(i, 20) + f"\nlicense copyright mit {i}" * (i % 10 == 0),) for i in range(300)], "text string")
    model = licenses.fit(docs)
    assert {"license", "mit"} & set(model.weights)
    got = licenses.scanned(spark.createDataFrame([(t,) for t in CASES], "text string"), model).collect()
    assert {r["text"]: r["licenses"] for r in got} == {t: [f] for t, f in CASES.items()}
