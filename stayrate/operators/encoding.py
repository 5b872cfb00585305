"""Encoding, imputation and scaling. ``fit_*`` reads the data once; applying is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS
from stayrate.functions.columns import as_col, flag, recode
from stayrate.functions.longform import unpivot_strings
from stayrate.functions.ranks import exact_quantiles, running_totals
from stayrate.schema import TARGET

YES_NO = {"Yes": 1, "No": 0}
BINARY = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]


def encode_binary(df: DataFrame, columns: Sequence[str] = tuple(BINARY)) -> DataFrame:
    """Yes/No to 1/0, gender to Male=1; anything else becomes NULL."""
    maps = {c: recode(c, YES_NO) for c in [*columns, TARGET] if c in df.columns}
    if "gender" in df.columns:
        maps["gender"] = recode("gender", {"Male": 1, "Female": 0})
    return df.withColumns(maps)


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column, NULL left out.

    Each level becomes a column of the result, so the levels come to the driver, which plans with
    them. For columns of many levels use ``vectors.onehot_stages``, whose vectors are sparse.
    """
    distinct = unpivot_strings(df, columns).where(F.col("value").isNotNull()).distinct()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in distinct.collect():
        levels[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in levels.items()}


def dummy_columns(levels: Mapping[str, Sequence[str]], drop_first: bool, missing: str | None = None) -> list[Column]:
    """``<column>_<level>`` indicator per level; a NULL or unknown value is zero everywhere."""
    out = []
    for column, values in levels.items():
        value = as_col(column).cast("string")
        if missing is not None:
            value = F.coalesce(value, F.lit(missing))
        out += [flag(value == v).alias(f"{column}_{v}") for v in list(values)[1 if drop_first else 0 :]]
    return out


def dummies(
    df: DataFrame,
    columns: Sequence[str],
    levels: Mapping[str, Sequence[str]] | None = None,
    drop_first: bool = True,
) -> DataFrame:
    """Replace each column by its indicator columns."""
    levels = levels or fit_levels(df, columns)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in set(columns)]
    return df.select(*keep, *dummy_columns(levels, drop_first))


def onehot_full(df: DataFrame, columns: Sequence[str], missing: str = "missing") -> DataFrame:
    """Indicators for every level, NULL being a level of its own."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns})
    return dummies(filled, columns, drop_first=False)


def label_encode(df: DataFrame, columns: Sequence[str], offset: int = 0) -> DataFrame:
    """Alphabetical integer codes from ``offset``, in place."""
    text = df.withColumns({c: F.col(c).cast("string") for c in columns})
    names = [f"_{c}_code" for c in columns]
    model = StringIndexer(
        inputCols=list(columns), outputCols=names, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(text)
    coded = model.transform(text)
    return coded.withColumns({c: (F.col(n) + offset).cast("int") for c, n in zip(columns, names, strict=True)}).drop(*names)


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, code)`` with alphabetical 0-based codes, for any number of levels."""
    long = unpivot_strings(df, columns).where(F.col("value").isNotNull())
    ranked = running_totals(long, ["column"], "value", {"n": F.max(F.lit(1))})
    return ranked.select("column", "value", (F.col("cum_n") - 1).cast("int").alias("code"))


def attach_codes(df: DataFrame, columns: Sequence[str], id_column: str) -> DataFrame:
    """Long form ``(id, column, value, code)``."""
    return unpivot_strings(df, columns, [id_column]).join(label_codes(df, columns), ["column", "value"], "left")


def ordinal(column: str, levels: Sequence[object]) -> Column:
    """0-based position in ``levels``; unknown and NULL are -1."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(column))
    return (F.coalesce(position, F.lit(0)) - 1).cast("int")


def fill_constant(df: DataFrame, columns: Sequence[str], value: str = "missing") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in columns})


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column; a column without values has none."""
    return {r["column"]: r["quantile"] for r in exact_quantiles(df, columns, [0.5]).collect()}


def impute_median(df: DataFrame, columns: Sequence[str], fitted: Mapping[str, float] | None = None) -> DataFrame:
    fitted = fitted if fitted is not None else medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fitted.get(c))) for c in columns})


@dataclass(frozen=True)
class Moments:
    mean: float | None
    std: float | None
    low: float | None
    high: float | None


def fit_moments(df: DataFrame, columns: Sequence[str], sample: bool = False) -> dict[str, Moments]:
    """Mean, deviation, minimum and maximum of each column: one aggregation, one row."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    exprs = []
    for c in columns:
        value = F.col(f"`{c}`").cast("double")
        exprs.append(F.struct(F.avg(value), deviation(value), F.min(value), F.max(value)).alias(c))
    row = df.agg(*exprs).head()
    return {c: Moments(*row[c]) for c in columns}


def _rescale(column: str, shift: float | None, width: float | None) -> Column:
    """``(x - shift) / width``; a column of one value becomes 0."""
    x = F.col(column)
    return F.coalesce(F.try_divide(x - F.lit(shift), F.lit(width)), F.when(x.isNotNull(), 0.0))


def scale_standard(
    df: DataFrame, columns: Sequence[str], sample: bool = False, fitted: Mapping[str, Moments] | None = None
) -> DataFrame:
    """Centre and divide by the deviation (population unless ``sample``)."""
    fitted = fitted or fit_moments(df, columns, sample)
    return df.withColumns({c: _rescale(c, fitted[c].mean, fitted[c].std) for c in columns})


def scale_minmax(df: DataFrame, columns: Sequence[str], fitted: Mapping[str, Moments] | None = None) -> DataFrame:
    """Map the observed range to 0..1."""
    fitted = fitted or fit_moments(df, columns)
    return df.withColumns(
        {
            c: _rescale(c, m.low, None if m.low is None or m.high is None else m.high - m.low)
            for c, m in ((c, fitted[c]) for c in columns)
        }
    )


# Multi-level columns of the batch data step.
BATCH_DUMMIES = [
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "Contract", "PaymentMethod",
]


def encode_batch(df: DataFrame, levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Binary columns to 0/1 and multi-level columns to indicators, the first level dropped.

    Bucket columns have their labels for levels, in bucket order, whether or not a row has them.
    Pass the ``levels`` of the training data to encode other data alike.
    """
    fixed = {"tenure_bucket": BUCKETS["dp"].labels, "charges_bucket": BUCKETS["chg_dp"].labels}
    fitted = levels or fit_levels(df, [c for c in BATCH_DUMMIES if c in df.columns])
    chosen = {**fitted, **{c: v for c, v in fixed.items() if c in df.columns}}
    return dummies(encode_binary(df), list(chosen), chosen)


# Column roles of the preprocessing step and its ordinal level orders.
PP_NUMERIC = ["MonthlyCharges", "TotalCharges", "AvgMonthlyChargesPerService"]
PP_NOMINAL = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
    "PaperlessBilling", "PaymentMethod", "HasInternetService",
]
PP_ORDINAL = {
    "tenure": ["New", "Established", "Loyal"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "ServiceAdoptionScore": [1, 2, 3, 4, 5, 6, 7, 8, 9],
    "PaymentReliability": ["Low", "High"],
}
# Encoded columns that repeat another one, or that say little about churn.
REDUNDANT = [
    "gender_Male", "SeniorCitizen_0", "Partner_No", "Dependents_No", "PhoneService_0", "MultipleLines_0",
    "InternetService_No", "OnlineSecurity_0", "OnlineBackup_0", "DeviceProtection_0", "TechSupport_0",
    "StreamingTV_0", "StreamingMovies_0", "PaperlessBilling_No", "PaymentMethod_Credit card (automatic)",
    "HasInternetService_0",
]
LOW_CORRELATION = ["gender_Female", "PhoneService_1", "ServiceAdoptionScore"]


def preprocess(df: DataFrame, id_column: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Numeric: median and z-score. Nominal: every level. Ordinal: position. Plus the 0/1 label.

    ``df`` carries bucketed tenure and the adoption columns. Fitted on ``fit_on`` (for instance
    the training rows) or on ``df`` itself.
    """
    base = fit_on if fit_on is not None else df
    levels = fit_levels(fill_constant(base, PP_NOMINAL), PP_NOMINAL)
    middle = medians(base, PP_NUMERIC)
    moments = fit_moments(impute_median(base, PP_NUMERIC, middle), PP_NUMERIC)
    scaled = scale_standard(impute_median(df, PP_NUMERIC, middle), PP_NUMERIC, fitted=moments)
    return scaled.select(
        id_column,
        *PP_NUMERIC,
        *dummy_columns(levels, drop_first=False, missing="missing"),
        *[ordinal(c, values).alias(c) for c, values in PP_ORDINAL.items()],
        flag(F.col(TARGET) == "Yes").alias(TARGET),
    )


def select_features(df: DataFrame) -> DataFrame:
    """Drop the redundant and the low-correlation encoded columns, where present."""
    return df.drop(*REDUNDANT, *LOW_CORRELATION)
