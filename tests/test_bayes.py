"""Naive Bayes against plain arithmetic, and with more levels than a projection could hold."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from stayrate.operators.bayes import FLOOR, fit_bayes

ROWS = [
    ("a", "x", "u", 1.0, "No"), ("b", "x", "v", 2.0, "No"), ("c", "y", None, 4.0, "No"), ("d", "y", "u", 7.0, "Yes"),
    ("e", "z", "u", 9.0, "Yes"), ("f", "x", "v", None, "Yes"), ("g", None, "w", 3.0, "No"),
]
SCHEMA = "customerID string, p string, q string, n double, Churn string"


def by_hand(train, row):
    total = {}
    for label in ("No", "Yes"):
        side = [r for r in train if r[4] == label]
        score = math.log(len(side) / len(train))
        for i in (1, 2):
            known = {r[i] for r in train if r[i] is not None}
            if row[i] in known:
                whole = sum(r[i] is not None for r in side)
                n = sum(r[i] == row[i] for r in side)
                score += math.log(n / whole if n else FLOOR)
        numbers = [r[3] for r in side if r[3] is not None]
        if row[3] is not None:
            m, s = statistics.mean(numbers), statistics.stdev(numbers)
            score += -0.5 * ((row[3] - m) / s) ** 2 - math.log(s) - 0.5 * math.log(2 * math.pi)
        total[label] = score
    return 1 / (1 + math.exp(total["No"] - total["Yes"]))


def test_scores_by_hand(spark):
    train = spark.createDataFrame(ROWS, SCHEMA)
    model = fit_bayes(train, ["n"], ["p", "q"])
    unseen = [("h", "never", "u", 5.0, "No"), ("i", None, None, None, "Yes")]
    got = {r["customerID"]: r for r in model.score(spark.createDataFrame(ROWS + unseen, SCHEMA)).collect()}
    assert len(got) == 9
    for row in ROWS + unseen:
        assert got[row[0]]["score"] == pytest.approx(by_hand(ROWS, row))
        assert got[row[0]]["yhat"] == (got[row[0]]["score"] > 0.5)
    assert model.score(train.limit(0)).count() == 0


def test_many_levels(spark):
    """Level frequencies are a table: 100,000 of them pass, one of which holds a third of all rows."""
    i = F.col("id")
    rows = spark.range(300_000).select(
        i.cast("string").alias("customerID"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), i % 100_000)).alias("p"),
        (i % 7).cast("double").alias("n"),
        F.when(i % 2 == 0, "Yes").otherwise("No").alias("Churn"),
    )
    model = fit_bayes(rows, ["n"], ["p"])
    assert model.levels.count() == 100_001
    hot = model.levels.where("value = 'hot'").head()["tilt"]
    assert hot == pytest.approx(0.0, abs=1e-12)
    out = model.score(rows).agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("scored")).head()
    assert out["n"] == out["scored"] == 300_000
