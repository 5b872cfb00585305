"""Feature vectors: index, one-hot, assemble and scale, as one MLlib pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import is_yes
from stayrate.schema import CATEGORICAL, NUMERIC, TARGET


def onehot_stages(columns: Sequence[str]) -> list:
    """Indexer and encoder. Levels are ordered by name, so equal data gives equal vectors; a level
    unseen in fitting has a slot of its own."""
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(
            inputCols=list(columns), outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_encoded" for c in columns], handleInvalid="keep"),
    ]


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    """Rows with a NULL in any input are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")


def vector_stages(
    categorical: Sequence[str] = tuple(CATEGORICAL), numeric: Sequence[str] = tuple(NUMERIC), center: bool = False
) -> list:
    inputs = [f"{c}_encoded" for c in categorical] + list(numeric)
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=center)
    return [*onehot_stages(categorical), assembler(inputs), scaler]


def prepare(df: DataFrame) -> DataFrame:
    """Categories as text and the target as an explicit 0/1 label."""
    text = {c: F.col(c).cast("string") for c in CATEGORICAL if c in df.columns}
    return df.withColumns({**text, "label": is_yes(TARGET).cast("double")})


def fit_vectors(df: DataFrame, categorical: Sequence[str] = tuple(CATEGORICAL)) -> PipelineModel:
    return Pipeline(stages=vector_stages(categorical)).fit(prepare(df))


def apply_vectors(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(prepare(df))


def slot_names(df: DataFrame, column: str = "features") -> list[str]:
    """Name of every vector slot, from the column's metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a["idx"], a["name"]) for group in groups for a in group)
    return [name for _, name in slots]
