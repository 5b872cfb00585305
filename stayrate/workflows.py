"""The three batch steps end to end: prepare a run, train on the newest run, score with its best model.

They meet only in files: a run dataset partitioned by run and side, and a folder of models. Each
step reads what the one before it wrote, so they may run apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators import cleaning, encoding, evaluation, features, models, quality, splitting
from stayrate.schema import ID, TARGET
from stayrate.session import store
from stayrate.sources import readers, sinks


@dataclass(frozen=True)
class TrainedRun:
    run_ts: str
    models: dict[str, Model]
    errors: dict[str, str]
    comparison: DataFrame
    best: str


def prepare_run(raw: DataFrame, folder: str, run_ts: str, test_size: float = 0.2) -> DataFrame:
    """Validate, clean, derive, split, encode and save one run; the encoded rows are returned.

    Levels are taken from the training side, so the test side tells nothing to the encoder.
    """
    quality.require_valid(raw)
    clean = store(cleaning.drop_blank_totals(raw).dropna("any"), "prepared")
    derived = features.batch_features(clean)
    split = splitting.split_stratified(derived, test_size)
    train = split.where("split = 'train'")
    levels = encoding.fit_levels(train, encoding.BATCH_DUMMIES)
    encoded = encoding.encode_batch(split, levels)
    sinks.write_run(encoded, f"{folder}/data", run_ts)
    names = [c for c in encoded.columns if c not in (ID, TARGET, "split")]
    sinks.write_metadata(encoded, f"{folder}/metadata/{run_ts}", run_ts, names)
    return encoded


def feature_list(spark: SparkSession, folder: str, run_ts: str) -> list[str]:
    return list(readers.read_metadata(spark, f"{folder}/metadata/{run_ts}").head()["features"])


def model_frame(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns aligned with the training features, and their vector."""
    keep = [c for c in (ID, TARGET) if c in df.columns]
    aligned = cleaning.align_to(df, [*keep, *names])
    plain = [f"_f{i}" for i in range(len(names))]
    numbered = aligned.select(*keep, *[F.col(f"`{n}`").cast("double").alias(p) for n, p in zip(names, plain, strict=True)])
    out = VectorAssembler(inputCols=plain, outputCol="features", handleInvalid="skip").transform(numbered)
    return out.select(*keep, "features")


def train_run(spark: SparkSession, folder: str, config: dict[str, dict] | None = None) -> TrainedRun:
    """Train every configured model on the newest run, keep all of them and the best by F1."""
    rows = readers.latest_run(spark, f"{folder}/data")
    run_ts = rows.select("run_ts").head()["run_ts"]  # the newest run has one name
    names = feature_list(spark, folder, run_ts)

    def side(name: str) -> DataFrame:
        frame = model_frame(rows.where(F.col("split") == name), names)
        return store(frame.select(ID, F.col(TARGET).cast("double").alias("label"), "features"), name)

    train, test = side("train"), side("test")
    fitted, errors, table = models.train_all(train, test, config)
    if table is None:
        raise ValueError(f"no model could be trained: {errors}")
    comparison = store(table, "comparison")
    best = evaluation.best_model(comparison).head()["model"]
    for name, model in {**fitted, "best_model": fitted[best]}.items():
        PipelineModel(stages=[model]).write().overwrite().save(f"{folder}/models/{run_ts}/{name}")
    sinks.append_metrics(comparison, f"{folder}/metrics", run_ts)
    return TrainedRun(run_ts, fitted, errors, comparison, best)


def score_run(encoded: DataFrame, folder: str, run_ts: str, output: str | None = None) -> DataFrame:
    """Score encoded rows with the best model of a run, and export them when a path is given."""
    spark = encoded.sparkSession
    model = readers.load_model(
        spark, [f"{folder}/models/{run_ts}/best_model", f"{folder}/models/{run_ts}/logistic_regression"]
    )
    if model is None:
        raise FileNotFoundError(f"no model of run {run_ts}")
    scored = models.batch_scores(model, model_frame(encoded, feature_list(spark, folder, run_ts)), [ID])
    if output is not None:
        sinks.write_predictions(scored, output)
    return scored
