"""Naive Bayes on mixed columns: Gaussian for numbers, level frequencies for categories."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import add_up, is_yes
from stayrate.functions.longform import unpivot_numbers, unpivot_strings
from stayrate.schema import ID, TARGET
from stayrate.session import cut_lineage

FLOOR = 0.001  # stands in for a zero level frequency or deviation


@dataclass(frozen=True)
class MixedBayes:
    """Class shares, moments of the numbers, and level frequencies.

    ``levels`` is a table ``(column, value, tilt)`` that is joined, so there may be any number of
    levels; its tilt is the logarithm of a level's frequency among the 0-labels over that among
    the 1-labels.
    """

    prior: dict[int, float]
    categorical: tuple[str, ...]
    levels: DataFrame
    moments: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def number_score(self, label: int) -> Column:
        """Logarithm of the class share and of the densities of all numbers."""
        parts = [F.lit(math.log(self.prior[label]))]
        for column, sides in self.moments.items():
            mean, deviation = sides[label]
            z = (F.col(column).cast("double") - F.lit(mean)) / F.lit(deviation)
            term = z * z * -0.5 - F.lit(math.log(deviation) + 0.5 * math.log(2 * math.pi))
            parts.append(F.coalesce(term, F.lit(0.0)))
        return add_up(parts)

    def score(self, df: DataFrame, id_column: str = ID) -> DataFrame:
        """Adds ``score``, the probability of churn, and ``yhat``. Ids must be unique.

        An absent or unseen level says nothing about the class.
        """
        values = unpivot_strings(df, self.categorical, [id_column])
        tilts = values.join(self.levels, ["column", "value"]).groupBy(id_column).agg(F.sum("tilt").alias("_tilt"))
        margin = self.number_score(0) - self.number_score(1) + F.coalesce("_tilt", F.lit(0.0))
        scored = df.join(tilts, id_column, "left").withColumn(
            "score", F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(margin, F.lit(700.0))))
        )
        return scored.withColumn("yhat", F.when(F.col("score") > 0.5, 1).otherwise(0)).drop("_tilt")


def level_table(df: DataFrame, categorical: Sequence[str], label: str) -> DataFrame:
    """Rows ``(column, value, tilt)``, one per level that occurs."""
    counts = unpivot_strings(df, categorical, [label]).where(F.col("value").isNotNull())
    counts = counts.groupBy("column", "value").agg(
        F.sum(is_yes(label)).alias("yes"), F.count_if(F.col(label) == "No").alias("no")
    )
    # One row per column.
    whole = counts.groupBy("column").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))

    def frequency(side: str) -> Column:
        return F.when(F.col(side) > 0, F.col(side) / F.col(f"all_{side}")).otherwise(F.lit(FLOOR))

    tilt = F.ln(frequency("no")) - F.ln(frequency("yes"))
    return counts.join(whole, "column").select("column", "value", tilt.alias("tilt"))


def fit_bayes(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = TARGET) -> MixedBayes:
    """Level counts of all categories, moments of all numbers, and class shares."""
    levels = cut_lineage(level_table(df, categorical, label))

    def side(name: str) -> Column:
        return F.when(F.col(label) == name, F.col("value"))

    stats = unpivot_numbers(df, numeric, [label]).groupBy("column").agg(
        *[f(side(name)).alias(f"{key}_{name}") for name in ("No", "Yes") for key, f in (("m", F.avg), ("s", F.stddev_samp))]
    )
    # One row per numeric column.
    moments = {
        r["column"]: tuple((r[f"m_{name}"], r[f"s_{name}"] or FLOOR) for name in ("No", "Yes")) for r in stats.collect()
    }
    sizes = df.agg(F.sum(is_yes(label)).alias("yes"), F.count_if(F.col(label) == "No").alias("no")).head()
    rows = sizes["yes"] + sizes["no"]
    return MixedBayes({0: sizes["no"] / rows, 1: sizes["yes"] / rows}, tuple(categorical), levels, moments)
