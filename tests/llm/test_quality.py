import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.llm import quality_model, quality_rules
from stayrate.llm.measures import COUNTS
from stayrate.sources.subscribers import read_table
from tests.conftest import SMALL
from tests.llm.conftest import edge_rows

MIDDLE = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(edges, none):
    out = quality_rules.judged(edges.withColumn("Kept", F.lit("x")), None)
    assert out.columns == [*edges.columns, *quality_rules.RESULTS]
    got = sorted([(str(r["doc_id"]), str(r["text"]), *[r[c] for c in COUNTS], r["base_failed"], r["kept"]) for r in out.collect()])
    want = []
    for r in edge_rows():
        n = plain(r[1])
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        want.append((str(r[0]), str(r[1]), *n, failed, not failed))
    assert got == sorted(want)
    assert quality_rules.judged(none, None).collect() == []


def test_path_lengths_by_hand():
    rows = np.array([[0.0, 1.0], [0.1, 1.0], [0.2, 1.0], [9.0, 1.0]] * 30)
    forest = quality_rules.grow(rows[:-1], rows.min(axis=0), rows.max(axis=0))
    lengths = forest.path_lengths(rows[:4])

    def walk(tree, row):
        node = 0
        while forest.feature[tree, node] >= 0:
            node = forest.left[tree, node] + (row[forest.feature[tree, node]] >= forest.cut[tree, node])
        return forest.length[tree, node]

    for row, length in zip(rows[:4], lengths):
        assert length == pytest.approx(np.mean([walk(t, row) for t in range(quality_rules.TREES)]))
    assert lengths.argmin() == 3


def test_forest_keeps_good_and_rejects_odd(spark):
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    judged = quality_rules.judged(docs, quality_rules.fit(docs, labels)).join(labels, "doc_id").where("NOT base_failed")
    rate = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert rate[1] > 0.99
    assert rate[0] < 0.3


def test_all_rates_reach_a_verdict(spark):
    """A table of numbers is odd in digits and word length alone; long clean documents are kept."""
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    forest = quality_rules.fit(docs, labels)
    good = docs.join(labels.where("quality = 1"), "doc_id").orderBy("doc_id").limit(200)
    texts = [r["text"] for r in good.select("text").collect()]
    rows = [("numbers", " ".join(map(str, range(100_000, 100_400)))), ("long", "\n".join(texts)), ("clean", texts[0])]
    out = quality_rules.judged(spark.createDataFrame(rows, "doc_id string, text string"), forest)
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in out.collect()} == {"numbers": (False, False), "long": (False, True), "clean": (False, True)}


def test_fit_without_labels(edges, spark, none):
    empty = spark.createDataFrame([], LABELS)
    assert quality_rules.fit(edges, empty) is None
    odd = spark.createDataFrame([(None, 1, 0), (0, None, 0), (3, 1, 0), (3, 0, 0)], LABELS)
    forest = quality_rules.fit(edges, odd)
    kept = quality_rules.judged(edges, forest).where("kept").count()
    assert kept == quality_rules.judged(edges, None).where("kept").count()
    assert quality_rules.keep_good(none, odd).collect() == []
    out = quality_rules.keep_good(edges.withColumn("kept", F.lit(5)), odd)
    assert out.columns == [*edges.columns, "kept"] and out.count() == kept


def test_every_labelled_row_counts(spark):
    """More good documents than any bound on fitted rows: all are counted in every tree, and the last ones set the span."""
    n = 9000
    texts = F.concat(F.repeat(F.concat(F.lit("word"), F.pmod("id", F.lit(7)), F.lit(". ")), 30), F.when(F.col("id") == n - 1, F.repeat(F.lit("# "), 40)).otherwise(""))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), texts.alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    rows = quality_rules.labelled_rates(docs, labels, "doc_id", "text", "quality")
    x = np.array([r["rates"] for r in rows.collect()])
    assert len(x) == n
    forest = quality_rules.fit(docs, labels)
    whole = quality_rules.grow(x, x.min(axis=0), x.max(axis=0))
    assert all(np.array_equal(getattr(forest, f), getattr(whole, f)) for f in ("feature", "cut", "left", "length"))
    assert forest.threshold == -np.inf


def test_threshold_by_hand(spark):
    """The cut of all labelled rows, as found on their sorted lengths."""
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    forest = quality_rules.fit(docs, labels)
    rows = quality_rules.labelled_rates(docs, labels, "doc_id", "text", "quality").collect()
    lengths, good = forest.path_lengths(np.array([r["rates"] for r in rows])), np.array([r["good"] for r in rows])
    gains = {}
    for cut in np.unique(lengths):
        lost_good, lost_bad = (lengths[good] < cut).mean(), (lengths[~good] < cut).mean()
        if 1 - lost_good >= quality_rules.KEEP_GOOD:
            gains[cut] = lost_bad - lost_good
    best = max(gains, key=lambda c: (gains[c], -c))
    shorter = lengths[lengths < best]
    assert forest.threshold == pytest.approx((shorter.max() + best) / 2 if len(shorter) else -np.inf)


def test_classifier_on_held_out_rows(spark):
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    scored = quality_model.scored(docs.select("doc_id", "text"), quality_model.fit(docs, labels)).drop("text")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    right = sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 500 and right / len(rows) > 0.97
    assert scored.count() == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_held_out_rows_teach_nothing(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    turned = labels.withColumn("quality", F.when(quality_model.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_model.fit(docs, labels) == quality_model.fit(docs, turned)


def test_expression_equals_rules(edges):
    rules = [((("symbols", True, 0.2), ("distinct", False, 0.5)), -2.0), ((("upper", False, 0.3),), 1.5)]
    model = quality_model.RuleModel(0.25, rules)
    rows = quality_model.with_statistics(edges.select("doc_id", "text"), "text", "s").select("s.*", model.score(F.col("s")).alias("score")).collect()
    for r in rows:
        total = 0.25 + sum(w for rule, w in rules if all((r[n] > b) == g for n, g, b in rule))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-total)))


def test_classifier_without_both_labels(edges, spark, none):
    empty = spark.createDataFrame([], LABELS)
    half = quality_model.scored(edges.withColumn("Score", F.lit(1)), quality_model.fit(edges, empty))
    assert {r["score"] for r in half.collect()} == {0.5} and half.count() == len(edge_rows())
    good = spark.createDataFrame([(0, 1, 0), (4, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0)], LABELS)
    assert min(r["score"] for r in quality_model.scored(edges, quality_model.fit(edges, good)).collect()) > 0.99
    assert quality_model.scored(none, quality_model.fit(none, good)).collect() == []
