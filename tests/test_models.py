"""Model registry, training, importance, persistence and clusters, with light settings."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayrate.operators import clusters, evaluation, models, vectors
from stayrate.schema import NUMERIC
from stayrate.session import shared_path, store
from stayrate.sources import readers
from stayrate.sources.subscribers import load_subscribers
from stayrate.operators.cleaning import drop_blank_totals
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def clean(spark):
    return store(drop_blank_totals(load_subscribers(spark, SMALL)))


@pytest.fixture(scope="module")
def rows(clean):
    fitted = vectors.fit_vectors(clean)
    out = vectors.apply_vectors(fitted, clean)
    return out.select("customerID", "label", F.col("scaled_features").alias("features"), F.col("features").alias("raw"))


def test_unknown_model():
    with pytest.raises(ValueError, match="available: logistic_regression"):
        models.create_model("neural")


def test_parameters_override_defaults(spark):
    tree = models.create_model("decision_tree", maxDepth=3)
    assert tree.getMaxDepth() == 3 and tree.getMinInstancesPerNode() == 5 and tree.getWeightCol() == "weight"
    assert set(models.all_models()) == set(models.available_models())


def test_one_failure_does_not_stop_the_others(rows):
    config = {"decision_tree": {"maxDepth": 3}, "logistic_regression": {"maxIter": 5}, "svm": {"maxIter": -1}, "random_forest": {"enabled": False}}
    fitted, errors, table = models.train_all(rows, rows, config)
    assert set(fitted) == {"decision_tree", "logistic_regression"} and set(errors) == {"svm"}
    got = table.collect()
    assert [r["model"] for r in got] == [r["model"] for r in sorted(got, key=lambda r: (-r["f1_score"], r["model"]))]
    assert evaluation.best_model(table).head()["model"] == got[0]["model"]


def test_importance_names_every_slot(rows):
    names = vectors.slot_names(rows, "raw")
    table = models.importance(models.train("decision_tree", rows, maxDepth=3), names).collect()
    assert len(table) == len(names) == len(set(names)) and "tenure" in names and "Contract_encoded_One year" in names
    assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)


def test_saved_model_is_found_after_missing_candidates(spark, rows):
    folder = shared_path(spark, "models")
    model = models.train("logistic_regression", rows, maxIter=5)
    Pipeline(stages=[model]).fit(rows).write().save(f"{folder}/second")
    loaded = readers.load_model(spark, [f"{folder}/first", f"{folder}/second"])
    a = models.batch_scores(loaded, rows, ["customerID"]).orderBy("customerID").collect()
    b = models.batch_scores(model, rows, ["customerID"]).orderBy("customerID").collect()
    assert a == b and all(0 <= r["churn_probability"] <= 1 for r in a)
    assert readers.load_model(spark, [f"{folder}/none"]) is None


def test_svm_probabilities_are_calibrated(spark, rows):
    """They add up to the churners, rise with the margin, and survive saving."""
    data = store(rows.select("customerID", "label", "features"))
    model = models.train("svm", data, maxIter=20)
    scored = models.predict(model, data).select("customerID", "y", "score", vector_to_array("rawPrediction")[1].alias("m"))
    got = scored.orderBy("m").collect()
    assert sum(r["score"] for r in got) == pytest.approx(sum(r["y"] for r in got), abs=0.05)
    assert [r["score"] for r in got] == sorted(r["score"] for r in got)
    assert models.importance(model, vectors.slot_names(rows, "raw")).count() == len(vectors.slot_names(rows, "raw"))
    path = shared_path(spark, "svm")
    Pipeline(stages=[model]).fit(data).write().save(path)
    again = models.predict(readers.load_model(spark, [path]), data)
    assert {r["customerID"]: r["score"] for r in again.collect()} == {r["customerID"]: r["score"] for r in got}
    with pytest.raises(ValueError, match="calibrate"):
        models.predict(model.stages[0], data)


def test_clusters_are_numbered_by_tenure(clean):
    data = clusters.scaled_vectors(clean)
    model = clusters.fit_clusters(data, restarts=2)
    profile = clusters.cluster_profile(clusters.assign_clusters(model, data)).collect()
    assert [r["cluster"] for r in profile] == [1, 2, 3, 4]
    assert sum(r["n"] for r in profile) == clean.count()
    assert [r["avg_tenure"] for r in profile] == sorted(r["avg_tenure"] for r in profile)
    curve = clusters.elbow(data, (1, 2, 4)).collect()
    assert curve[0]["wss"] == pytest.approx(len(NUMERIC) * clean.count(), rel=1e-6)
    assert curve[0]["wss"] > curve[1]["wss"] > curve[2]["wss"]


def test_restarts_share_their_passes(spark, clean):
    """The default restarts find MLlib's best cost, and more restarts take no more jobs."""
    from pyspark.ml.clustering import KMeans

    data = clusters.scaled_vectors(clean)
    model = clusters.fit_clusters(data)
    theirs = min(KMeans(k=4, seed=s).fit(data).summary.trainingCost for s in range(8))
    assert model.cost <= theirs * 1.001
    x = np.array([r["features"].toArray() for r in data.select("features").collect()])
    gaps = ((x[:, None, :] - model.centres[None]) ** 2).sum(axis=2)
    assert model.cost == pytest.approx(gaps.min(axis=1).sum())
    near = data.select(model.nearest(vector_to_array("features")).alias("n")).collect()
    assert [r["n"] for r in near] == gaps.argmin(axis=1).tolist()
    assert clusters.fit_clusters(data).cost == pytest.approx(model.cost)

    def jobs(restarts):
        spark.sparkContext.setJobGroup(f"restarts-{restarts}", "")
        clusters.fit_runs(data, [4] * restarts, steps=3, tolerance=0.0)
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"restarts-{restarts}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(found)

    assert jobs(12) <= jobs(2) + 2


def test_clusters_of_copies_and_of_nothing(spark):
    rows = spark.createDataFrame([(i, [float(i % 2), 2.0]) for i in range(9)], "id int, x array<double>")
    data = rows.select("id", array_to_vector("x").alias("features"))
    found = clusters.fit_runs(data, [1, 2, 5])
    assert [len(f.centres) for f in found] == [1, 2, 2]
    assert [f.cost for f in found] == pytest.approx([20 / 9, 0, 0])
    with pytest.raises(ValueError, match="no rows"):
        clusters.fit_runs(data.limit(0), [2])


def test_csv_reader(spark, make):
    from stayrate.sources.sinks import write_csv

    df = make({"TotalCharges": " "}, {})
    path = write_csv(df, shared_path(spark, "csv"))
    assert sorted(readers.read_csv(spark, path).collect()) == sorted(df.collect())
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, path + "-missing")
    records = readers.read_records(spark, [{"a": 1, "b": "x"}, {"a": 2, "b": None}])
    assert records.count() == 2 and readers.read_records(spark, {"a": 1}).columns == ["a"]


def test_fits_take_even_tasks(spark):
    """A table read in uneven tasks is spread over all cores, whole; a small one is left as it lies."""
    uneven = spark.range(models.SPREAD_ROWS).repartition(1).union(spark.range(3).repartition(1))
    sizes = models.spread(uneven).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(r["count"] for r in sizes) == models.SPREAD_ROWS + 3
    assert max(r["count"] for r in sizes) < 1.1 * min(r["count"] for r in sizes)
    small = spark.range(30).repartition(3)
    assert models.spread(small) is small


def test_fits_run_side_by_side():
    from threading import Barrier

    meet = Barrier(2, timeout=30)  # a fit that ran alone would wait in vain
    ended = models.train_side_by_side({"b": meet.wait, "a": meet.wait, "c": lambda: 1 / 0})
    assert list(ended) == ["b", "a", "c"] and {ended["a"].result(), ended["b"].result()} == {0, 1}
    with pytest.raises(ZeroDivisionError):
        ended["c"].result()
