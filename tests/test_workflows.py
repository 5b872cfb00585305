"""Prepare, train and score end to end on the smallest tables."""

import pytest

from stayrate import workflows
from stayrate.operators.scoring import prediction_summary
from stayrate.session import shared_path, store
from stayrate.sources.subscribers import load_subscribers
from tests.conftest import SMALL

CONFIG = {"logistic_regression": {"maxIter": 20}, "decision_tree": {"maxDepth": 3}}


def test_three_steps(spark):
    folder = shared_path(spark, "work")
    raw = store(load_subscribers(spark, SMALL))
    workflows.prepare_run(raw, folder, "20240101_000000")
    encoded = workflows.prepare_run(raw, folder, "20240201_000000")
    run = workflows.train_run(spark, folder, CONFIG)
    assert run.run_ts == "20240201_000000" and run.best in CONFIG and not run.errors
    output = shared_path(spark, "predictions")
    scored = workflows.score_run(encoded, folder, run.run_ts, output)
    assert scored.count() == encoded.count()
    summary = prediction_summary(scored.withColumnRenamed("predicted_churn", "prediction")).head()
    assert summary["high_risk"] + summary["medium_risk"] + summary["low_risk"] == summary["total_records"]
    assert spark.read.option("header", True).csv(output).count() == encoded.count()
    metrics = spark.read.parquet(f"{folder}/metrics")
    assert set(CONFIG) == {r["model"] for r in metrics.select("model").distinct().collect()}


def test_missing_feature_columns_count_as_zero(spark):
    frame = workflows.model_frame(spark.createDataFrame([("a", 2.0)], "customerID string, x double"), ["y (1)", "x"])
    assert list(frame.head()["features"].toArray()) == [0.0, 2.0]


def test_scoring_without_a_model_fails(spark):
    with pytest.raises(FileNotFoundError):
        workflows.score_run(spark.createDataFrame([("a",)], "customerID string"), shared_path(spark, "none"), "x")
