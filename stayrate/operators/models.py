"""Classifiers: a registry of MLlib estimators, training, importance and scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from functools import partial

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators import evaluation as ev
from stayrate.operators.scoring import batch_category
from stayrate.operators.splitting import with_class_weight
from stayrate.session import store

SEED = 42
#: Rows that a task of a fit takes at most, about.
TASK_ROWS = 250_000
#: Fewer rows are left as they lie.
SPREAD_ROWS = 20_000
#: Fits that run at the same time: their many short jobs leave cores idle that another one can use.
FITS = 4

# Default parameters. ``balanced`` weights classes by inverse frequency; ``C`` is the
# inverse strength of the penalty, for the loss summed over all rows.
DEFAULTS: dict[str, dict] = {
    "logistic_regression": {"maxIter": 1000, "C": 1.0, "balanced": True},
    "decision_tree": {"maxDepth": 10, "minInstancesPerNode": 5, "seed": SEED, "balanced": True},
    "random_forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 5, "seed": SEED, "balanced": True},
    "gradient_boosting": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "minInstancesPerNode": 5, "seed": SEED},
    "svm": {"maxIter": 100, "C": 1.0, "balanced": True},
}
BUILDERS: dict[str, Callable] = {
    "logistic_regression": LogisticRegression,
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "gradient_boosting": GBTClassifier,
    "svm": LinearSVC,
}


def available_models() -> list[str]:
    return list(BUILDERS)


def default_params(name: str) -> dict:
    if name not in BUILDERS:
        raise ValueError(f"unknown model {name!r}; available: {', '.join(BUILDERS)}")
    return dict(DEFAULTS[name])


def create_model(name: str, rows: int | None = None, **params):
    """An estimator with the defaults of ``name``, overridden by ``params``.

    MLlib averages the loss, so ``C`` becomes a penalty only when the number of rows is known.
    """
    settings = {**default_params(name), **params}
    if settings.pop("balanced", False):
        settings["weightCol"] = "weight"
    strength = settings.pop("C", None)
    if strength and rows and "regParam" not in settings:
        settings["regParam"] = 1.0 / (strength * rows)
        settings["standardization"] = False
    return BUILDERS[name](featuresCol="features", labelCol="label", **settings)


def all_models(**params) -> dict:
    return {name: create_model(name, **params) for name in BUILDERS}


def calibrate(model: Model, rows: DataFrame) -> PipelineModel:
    """The model followed by Platt's fit: a slope and an offset that turn margins into probabilities.

    The fit has no penalty and no weights, so on ``rows`` the probabilities add up to the number
    of 1-labels.
    """
    platt = LogisticRegression(
        featuresCol="rawPrediction", labelCol="label", predictionCol="_side", rawPredictionCol="_odds", maxIter=200, tol=1e-12
    )
    return PipelineModel([model, platt.fit(model.transform(rows).select("rawPrediction", "label"))])


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` in tasks of equal size, as many as there are cores or a multiple of it. Feature vectors compress
    well, so a stored table is read in few and uneven tasks, and a fit reads it in every step."""
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * -(-count // (cores * TASK_ROWS))) if count >= SPREAD_ROWS else rows


def train(name: str, rows: DataFrame, **params) -> Model:
    """Fit on rows with ``features`` and ``label``; class weights are attached when needed, and a
    model that gives margins is calibrated on the same rows."""
    penalised = "C" in default_params(name)
    estimator = create_model(name, rows.count() if penalised else None, **params)
    if estimator.isSet("weightCol"):
        rows = with_class_weight(rows, "label")
    rows = spread(rows)
    model = estimator.fit(rows)
    return calibrate(model, rows) if name == "svm" else model


def churn_probability(predictions: DataFrame) -> Column:
    """Probability of class 1."""
    if "probability" not in predictions.columns:
        raise ValueError("these predictions are margins: calibrate the model first")
    return vector_to_array("probability")[1]


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """Truth ``y``, prediction ``yhat`` and ``score`` beside the input columns."""
    out = model.transform(rows)
    return out.withColumns(
        {
            "y": F.col("label").cast("int"),
            "yhat": F.col("prediction").cast("int"),
            "score": churn_probability(out),
        }
    )


def batch_scores(model: Model, rows: DataFrame, keep: list[str], high: float = 0.7, medium: float = 0.5) -> DataFrame:
    """Input columns with label, probability and risk category: one transform, no join."""
    out = model.transform(rows)
    p = churn_probability(out)
    return out.select(
        *keep,
        F.col("prediction").cast("int").alias("predicted_churn"),
        F.when(F.col("prediction") == 1.0, "Churn").otherwise("No Churn").alias("prediction_label"),
        p.alias("churn_probability"),
        batch_category(p, high, medium).alias("risk_category"),
    )


def score_rows(predictions: DataFrame, model: str) -> DataFrame:
    return predictions.select(F.lit(model).alias("model"), "y", "yhat", "score")


def train_side_by_side(fits: Mapping[str, Callable[[], Model]]) -> dict[str, Future]:
    """The ended fits by name, in the order given; a failed one holds its error."""
    with ThreadPoolExecutor(FITS) as pool:
        return {name: pool.submit(fit) for name, fit in fits.items()}


def train_all(
    train_rows: DataFrame, test_rows: DataFrame, config: dict[str, dict] | None = None
) -> tuple[dict[str, Model], dict[str, str], DataFrame | None]:
    """Fit every enabled model. One that fails is recorded and the others go on.

    Returns the models, the errors, and the comparison of all fitted models: they are judged
    together in one aggregation.
    """
    models: dict[str, Model] = {}
    errors: dict[str, str] = {}
    judged = None
    fits = {}
    for name, settings in (config or {n: {} for n in BUILDERS}).items():
        settings = dict(settings)
        if settings.pop("enabled", True):
            fits[name] = partial(train, name, train_rows, **settings)
    test_rows = spread(test_rows)
    for name, fit in train_side_by_side(fits).items():
        try:
            models[name] = fit.result()
        except Exception as error:  # recorded, as the caller asked for all models
            errors[name] = str(error).splitlines()[0]
            continue
        rows = score_rows(predict(models[name], test_rows), name)
        judged = rows if judged is None else judged.unionByName(rows)
    # The comparison reads the scores twice.
    return models, errors, None if judged is None else ev.compare(store(judged, "scores"))


def importance(model: Model, names: list[str]) -> DataFrame | None:
    """Rows ``(feature, importance)``, highest first; None for a model without either measure."""
    if isinstance(model, PipelineModel):  # a calibrated one
        model = model.stages[0]
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        values = np.abs(model.coefficients.toArray())
    else:
        return None
    rows = [(name, float(v)) for name, v in zip(names, values, strict=True)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
