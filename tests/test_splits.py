"""Splits, weights and balancing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.operators.balancing import smote
from stayrate.operators.splitting import class_weights, split_random, split_stratified, with_class_weight


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(5000).select(
        F.concat(F.lit("c"), "id").alias("customerID"),
        F.when(F.col("id") % 10 < 3, "Yes").when(F.col("id") % 1000 == 999, F.lit(None)).otherwise("No").alias("Churn"),
    )


@pytest.mark.parametrize(("digits", "ranked"), [(1, 10_000), (3, 10_000), (1, 20)])
def test_stratified_quota_is_exact_for_every_label(people, digits, ranked):
    """With few rows to rank, the prefix is refined until no task ranks more."""
    split = split_stratified(people, digits=digits, ranked=ranked)
    assert split.count() == people.count()
    sizes = {r["Churn"]: r["n"] for r in people.groupBy("Churn").agg(F.count(F.lit(1)).alias("n")).collect()}
    tests = {r["Churn"]: r["n"] for r in split.where("split = 'test'").groupBy("Churn").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert tests == {k: int(np.floor(n * 0.2 + 0.5)) for k, n in sizes.items() if round(n * 0.2)}


def test_splits_do_not_depend_on_partitioning(people):
    for split in (split_random, split_stratified):
        a = {(r["customerID"], r["split"]) for r in split(people).collect()}
        b = {(r["customerID"], r["split"]) for r in split(people.repartition(13)).collect()}
        assert a == b


def test_no_test_rows_when_the_quota_is_zero(people):
    assert {r["split"] for r in split_stratified(people, test_size=0.0).select("split").distinct().collect()} == {"train"}
    assert {r["split"] for r in split_stratified(people, test_size=1.0).select("split").distinct().collect()} == {"test"}


def test_any_number_of_labels(spark):
    many = spark.range(40_000).select(F.concat(F.lit("c"), "id").alias("customerID"), (F.col("id") % 20_000).cast("string").alias("Churn"))
    split = split_stratified(many, test_size=0.5)
    assert split.where("split = 'test'").groupBy("Churn").count().agg(F.count("*"), F.max("count")).head() == (20_000, 1)
    assert with_class_weight(many).agg(F.min("weight"), F.max("weight")).head() == (1.0, 1.0)


def test_balanced_weights(spark):
    df = spark.createDataFrame([("Yes",)] * 2 + [("No",)] * 6, "Churn string")
    assert {r["Churn"]: r["weight"] for r in class_weights(df).collect()} == {"Yes": 2.0, "No": pytest.approx(8 / 12)}
    assert with_class_weight(df).agg(F.sum("weight")).head()[0] == pytest.approx(8.0)


def test_smote_fills_up_and_stays_on_segments(spark):
    rng = np.random.default_rng(1)
    rows = [(f"n{i}", rng.normal(5, 1, 3).tolist(), 0) for i in range(60)]
    rows += [(f"p{i}", rng.normal(0, 1, 3).tolist(), 1) for i in range(17)]
    rows += [(f"q{i}", [9.0, 9.0, 9.0], 1) for i in range(6)]  # copies of one point
    df = spark.createDataFrame(rows, "id string, x array<double>, y int")
    out = smote(df).collect()
    assert sum(r["y"] == 1 for r in out) == sum(r["y"] == 0 for r in out) == 60
    assert sum(not r["synthetic"] for r in out) == len(rows) and len({r["id"] for r in out}) == len(out)
    minority = np.array([x for _, x, y in rows if y == 1])
    for r in (r for r in out if r["synthetic"]):
        base = np.array(next(x for i, x, _ in rows if i == r["id"].rsplit("+", 1)[0]))
        step, to = np.array(r["x"]) - base, minority - base
        on_segment = [
            np.allclose(step, 0) or (np.linalg.norm(t) > 0 and 0 <= (g := step @ t / (t @ t)) <= 1 and np.allclose(step, g * t)) for t in to
        ]
        assert any(on_segment)
    assert {tuple(r["x"]) for r in smote(df.repartition(5)).collect()} == {tuple(r["x"]) for r in out}


def test_smote_needs_two_classes(spark):
    df = spark.createDataFrame([("a", [1.0], 1), ("b", [2.0], 1)], "id string, x array<double>, y int")
    with pytest.raises(ValueError, match="two classes"):
        smote(df)
