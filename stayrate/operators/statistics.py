"""Statistical tests, correlations, outliers and density curves."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import add_up, flag, is_yes
from stayrate.functions.longform import unpivot_numbers, unpivot_strings
from stayrate.functions.ranks import quantile_columns
from stayrate.functions.special import tail
from stayrate.operators.encoding import fit_moments
from stayrate.schema import NUMERIC, TARGET
from stayrate.session import cut_lineage

KERNEL_ROWS = 4096  # values that are compared with a grid at once


def chi_square(df: DataFrame, columns: Sequence[str], label: str = TARGET) -> DataFrame:
    """Chi-square of every column against the Yes/No label: ``(column, statistic, dof)``.

    A 2x2 table gets the continuity correction. One scan and one shuffle of category counts for
    all columns; the totals joined back are one row per tested column.
    """
    # A row per category level: stored, because both the totals and the cells read it.
    cells = cut_lineage(
        unpivot_strings(df, columns, [label])
        .where(F.col("value").isNotNull() & F.col(label).isNotNull())
        .groupBy("column", "value")
        .agg(F.sum(is_yes(label)).alias("yes"), F.count(F.lit(1)).alias("n"))
        .withColumn("no", F.col("n") - F.col("yes"))
    )
    totals = cells.groupBy("column").agg(
        F.sum("yes").alias("all_yes"),
        F.sum("no").alias("all_no"),
        F.sum("n").alias("all_n"),
        (F.count(F.lit(1)) - 1).alias("dof"),
    )
    joined = cells.join(F.broadcast(totals), "column")

    def part(seen: str, margin: str) -> Column:
        expected = F.col("n") * F.col(margin) / F.col("all_n")
        gap = F.abs(F.col(seen) - expected)
        corrected = F.when(F.col("dof") == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.coalesce(F.try_divide(corrected * corrected, expected), F.lit(0.0))

    return joined.groupBy("column").agg(
        F.sum(part("yes", "all_yes") + part("no", "all_no")).alias("statistic"),
        F.first("dof").cast("int").alias("dof"),
    )


def welch(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), label: str = TARGET) -> DataFrame:
    """Unequal-variance t-test of churned against retained: ``(column, statistic, dof)``."""
    yes = F.when(F.col(label) == "Yes", F.col("value"))
    no = F.when(F.col(label) == "No", F.col("value"))
    sides = (
        unpivot_numbers(df, columns, [label])
        .groupBy("column")
        .agg(
            (F.var_samp(yes) / F.count(yes)).alias("vy"),
            (F.var_samp(no) / F.count(no)).alias("vn"),
            F.count(yes).alias("ny"),
            F.count(no).alias("nn"),
            (F.avg(yes) - F.avg(no)).alias("gap"),
        )
    )
    spread = F.col("vy") + F.col("vn")
    dof = F.try_divide(
        spread * spread,
        F.col("vy") * F.col("vy") / (F.col("ny") - 1) + F.col("vn") * F.col("vn") / (F.col("nn") - 1),
    )
    return sides.select("column", F.try_divide(F.col("gap"), F.sqrt(spread)).alias("statistic"), dof.alias("dof"))


def with_p_value(tests: DataFrame, kind: str) -> DataFrame:
    return tests.withColumn("p_value", tail(kind, "statistic", "dof"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix as rows ``(a, b, r)``; one distributed pass, rows with NULL left out."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v", handleInvalid="skip").transform(
        df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    )
    matrix = Correlation.corr(vectors.select("v"), "v").head()[0].toArray()
    rows = [(a, b, float(matrix[i][j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Rows ``(feature, r)``, highest first; one aggregation for all columns."""
    row = df.agg(
        *[F.corr(F.col(f"`{c}`").cast("double"), F.col(target).cast("double")).alias(c) for c in columns]
    )
    return row.unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "r").orderBy(F.desc("r"), "feature")


def z_outliers(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), limit: float = 3.0) -> DataFrame:
    """Rows with any population z-score beyond the limit."""
    moments = fit_moments(df, columns)
    beyond = F.lit(False)
    for c in columns:
        z = F.try_divide(F.col(c) - F.lit(moments[c].mean), F.lit(moments[c].std))
        beyond = beyond | F.coalesce(F.abs(z) > limit, F.lit(False))
    return df.where(beyond)


def fences(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> dict[str, tuple[float, float]]:
    """Lower and upper outlier fence per column, from its exact quartiles."""
    out = {}
    for row in quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75}).collect():
        span = (row["q3"] - row["q1"]) * reach
        out[row["column"]] = (row["q1"] - span, row["q3"] + span)
    return out


def iqr_masks(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), reach: float = 1.5) -> dict[str, Column]:
    limits = fences(df, columns, reach)
    return {c: flag((F.col(c) < limits[c][0]) | (F.col(c) > limits[c][1])) for c in columns if c in limits}


def iqr_report(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), reach: float = 1.5) -> DataFrame:
    """Outliers and their share per column."""
    masks = iqr_masks(df, columns, reach)
    row = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(mask).alias(c) for c, mask in masks.items()]
    )
    return row.unpivot(["_n"], list(masks), "column", "n_outliers").select(
        "column", "n_outliers", F.round(F.try_divide(F.col("n_outliers").cast("double"), F.col("_n")), 3).alias("share")
    )


def iqr_multi(
    df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), flagged: int = 2, reach: float = 1.5
) -> DataFrame:
    """Rows flagged in exactly ``flagged`` columns."""
    masks = iqr_masks(df, columns, reach)
    return df.withColumn("outlier_count", add_up(list(masks.values()))).where(F.col("outlier_count") == flagged)


def density(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density at ``points`` grid values per column (Scott bandwidth).

    A task adds its rows to one grid per column and sends the grids alone, so what is shuffled is
    tasks times columns times grid points. NULL and NaN count as missing.
    """
    fields, numbers = [], {}
    for c in columns:
        x = F.col(c).cast("double")
        numbers[c] = x = F.when(~F.isnan(x), x)
        width = F.stddev_samp(x) * F.pow(F.count(x).cast("double"), F.lit(-0.2))
        fields.append(
            F.struct(
                F.min(x).alias("lo"), F.max(x).alias("hi"), width.alias("width"), F.count(x).alias("n")
            ).alias(c)
        )
    params = df.agg(*fields).head()

    # A column of fewer than two values, or of one value, has no bandwidth and gives no curve.
    drawn = {c: params[c].asDict() for c in columns if params[c]["width"]}
    grid = {
        c: p["lo"] - p["width"] * cut + (p["hi"] - p["lo"] + p["width"] * (2 * cut)) / (points - 1) * np.arange(points)
        for c, p in drawn.items()
    }

    def add_grids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {c: np.zeros(points) for c in drawn}
        for batch in batches:
            for c, at in grid.items():
                values, n = np.unique(batch[c].dropna().to_numpy(dtype=float), return_counts=True)
                for i in range(0, len(values), KERNEL_ROWS):
                    u = (at - values[i : i + KERNEL_ROWS, None]) / drawn[c]["width"]
                    total[c] += n[i : i + KERNEL_ROWS] @ np.exp(u * u * -0.5)
        for c, at in grid.items():
            scale = drawn[c]["n"] * drawn[c]["width"] * math.sqrt(2 * math.pi)
            yield pd.DataFrame({"column": c, "point": np.arange(points), "x": at, "part": total[c] / scale})

    rows = df.select(*[numbers[c].alias(c) for c in drawn] or [F.lit(None).cast("double").alias("none")])
    grids = rows.mapInPandas(add_grids, "column string, point int, x double, part double")
    return grids.groupBy("column", "point").agg(F.first("x").alias("x"), F.sum("part").alias("density"))
