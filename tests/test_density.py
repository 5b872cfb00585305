"""Kernel density against its formula."""

import numpy as np
import pytest

from stayrate.operators.statistics import density


def test_density_by_formula(spark):
    rng = np.random.default_rng(3)
    a = np.round(rng.gamma(2.0, 10.0, 5000))
    rows = [(float(v), float(i % 7) if i % 5 else None, 1.0) for i, v in enumerate(a)] + [(None, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, same double").repartition(7)
    got = {}
    for r in density(df, ["a", "b", "same"], points=50).collect():
        got.setdefault(r["column"], {})[r["point"]] = (r["x"], r["density"])
    assert set(got) == {"a", "b"}
    for name, values in (("a", a), ("b", np.array([float(i % 7) for i in range(5000) if i % 5]))):
        width = values.std(ddof=1) * len(values) ** -0.2
        at = np.linspace(values.min() - 3 * width, values.max() + 3 * width, 50)
        want = np.exp(-0.5 * ((at[:, None] - values) / width) ** 2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
        assert [got[name][i][0] for i in range(50)] == pytest.approx(at)
        assert [got[name][i][1] for i in range(50)] == pytest.approx(want)


def test_only_grids_are_shuffled(spark):
    df = spark.range(100_000, numPartitions=6).selectExpr("id * 1.5 AS a")
    grids = density(df, ["a"], points=20)
    plan = grids._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "MapInPandas" in plan
    assert grids.count() == 20


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double")
    assert density(df, ["a"]).collect() == []
