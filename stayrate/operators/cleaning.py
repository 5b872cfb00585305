"""Cleaning, projection and filter operators: DataFrame in, DataFrame out, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.functions.columns import is_blank, loose_yes, to_number, trim_null
from stayrate.schema import ID, ROLES, TARGET


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def drop_id(df: DataFrame, id_column: str = ID) -> DataFrame:
    return df.drop(id_column)


def select_roles(df: DataFrame, *roles: str) -> DataFrame:
    """The columns of the named roles, without repeats, in role order."""
    wanted = dict.fromkeys(name for role in roles for name in ROLES[role])
    return df.select(*[name for name in wanted if name in df.columns])


def target_last(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.select(*[c for c in df.columns if c != target], target)


def align_to(df: DataFrame, columns: Iterable[str], default: object = 0) -> DataFrame:
    """Exactly ``columns`` in order: missing ones are ``default``, others are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(default).alias(c) for c in columns])


def numeric_totals(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    return df.withColumn(column, to_number(column))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn empty strings into NULL, in one projection."""
    text = set(string_columns(df))
    return df.select(*[trim_null(c).alias(c) if c in text else F.col(c) for c in df.columns])


def drop_blank_totals(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    """Numeric total charges; rows whose total cannot be read are dropped."""
    return numeric_totals(df, column).dropna(subset=[column])


def keep_nonblank(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    return df.where(~is_blank(column))


def fill_charges(df: DataFrame) -> DataFrame:
    """Unreadable tenure becomes 0 months, unreadable charges 0.0."""
    return df.withColumns(
        {
            "tenure": F.coalesce(to_number(F.col("tenure").cast("string")), F.lit(0.0)).cast("int"),
            "MonthlyCharges": F.coalesce(to_number(F.col("MonthlyCharges").cast("string")), F.lit(0.0)),
        }
    )


def churn_flag(df: DataFrame, column: str = TARGET, output: str = "ChurnFlag") -> DataFrame:
    return df.withColumn(output, loose_yes(column))


def senior_text(df: DataFrame) -> DataFrame:
    return df.withColumn("SeniorCitizen", F.when(F.col("SeniorCitizen") == 1, "Yes").otherwise("No"))


def clean_any(df: DataFrame) -> DataFrame:
    """Drop the id, read the totals, drop every row with a NULL anywhere."""
    return drop_id(numeric_totals(df)).dropna("any")


def clean_subset(df: DataFrame) -> DataFrame:
    """Drop the id, drop rows without a total, spell the senior flag out."""
    return senior_text(drop_id(drop_blank_totals(df)))


def rows_removed(before: DataFrame, column: str = "TotalCharges") -> DataFrame:
    """Row counts around the cleaning step, in one pass over the input."""
    kept = F.count(to_number(column))
    return before.agg(
        F.count(F.lit(1)).alias("rows_before"),
        kept.alias("rows_after"),
        (F.count(F.lit(1)) - kept).alias("rows_removed"),
    )
