"""Wide to long: one scan that yields a row per input row and column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_strings(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep.., column, value)`` with values as text."""
    texts = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot(list(keep), list(columns), "column", "value")


def unpivot_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    numbers = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot(list(keep), list(columns), "column", "value")
