"""Running totals and quantiles against pandas, across many slices and with hot values."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayrate.functions.ranks import exact_quantiles, running_totals


@pytest.fixture
def many_slices(spark):
    """Small advisory sizes make AQE keep several slices for a few rows."""
    settings_ = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_running_totals_match_pandas(spark, many_slices):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 3000, p=[0.7, 0.2, 0.1]), "v": rng.integers(0, 400, 3000).astype(float)})
    pdf.loc[pdf.index % 3 == 0, "v"] = 7.0  # a third of all rows share one value
    df = spark.createDataFrame(pdf)
    for descending in (False, True):
        got = running_totals(df, ["k"], "v", {"n": F.count(F.lit(1))}, descending).toPandas()
        want = pdf.groupby(["k", "v"]).size().rename("n").reset_index().sort_values(["k", "v"], ascending=[True, not descending])
        want["cum_n"] = want.groupby("k")["n"].cumsum()
        want["all_n"] = want.groupby("k")["n"].transform("sum")
        merged = got.merge(want, on=["k", "v"], suffixes=("", "_w"))
        assert len(merged) == len(got) == len(want)
        assert (merged["cum_n"] == merged["cum_n_w"]).all() and (merged["all_n"] == merged["all_n_w"]).all()


def test_slices_are_really_several(spark, many_slices):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    ranged = df.repartitionByRange("v").select(F.spark_partition_id().alias("p")).distinct().count()
    assert ranged > 1
    got = running_totals(df, [], "v", {"n": F.count(F.lit(1))})
    assert got.where(F.col("cum_n") != F.col("v") + 1).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=40))
def test_quantiles_match_numpy(spark, values):
    known = [v for v in values if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["probability"]: r["quantile"] for r in exact_quantiles(df, ["x"], probabilities).collect()}
    if not known:
        assert got == {}
    else:
        for p in probabilities:
            assert got[p] == pytest.approx(np.quantile(known, p))


def test_quantiles_by_group(spark, many_slices):
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 5, "x": [float(i * i % 17) for i in range(55)]})
    got = exact_quantiles(spark.createDataFrame(pdf), ["x"], [0.25, 0.75], ["g"]).toPandas()
    for row in got.itertuples():
        assert row.quantile == pytest.approx(pdf[pdf.g == row.g].x.quantile(row.probability))
