"""Validation and profiling. Each report reads its input once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from stayrate.functions.columns import add_up, is_blank, is_yes, percent, total
from stayrate.functions.longform import unpivot_strings
from stayrate.functions.ranks import quantile_columns
from stayrate.operators.cleaning import string_columns
from stayrate.schema import NUMERIC, REQUIRED, TARGET


class ValidationError(ValueError):
    """Raised by ``require_valid`` for input that fails a hard check."""


def missing_columns(df: DataFrame, required: Sequence[str] = tuple(REQUIRED)) -> list[str]:
    return sorted(set(required) - set(df.columns))


def null_cells(columns: Sequence[str]) -> Column:
    return F.sum(add_up([F.col(c).isNull().cast("long") for c in columns]))


def equal_rows(df: DataFrame, *more: Column) -> GroupedData:
    """Rows grouped by two 64-bit hashes of all their columns. Only the hashes move, whatever the
    width of a row, and a row repeated a billion times moves once per map task. Each column's NULL
    flag is hashed, too: a hash skips NULLs. Unequal rows agree by chance once in 2^128 pairs."""
    parts = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashes = [F.xxhash64(F.lit(seed), *parts).alias(f"_h{seed}") for seed in (1, 2)]
    return df.select(*hashes, *more).groupBy("_h1", "_h2")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    groups = equal_rows(df).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def missing_percent(df: DataFrame) -> DataFrame:
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(
        null_cells(df.columns).alias("missing_cells"),
        cells.alias("cells"),
        percent(null_cells(df.columns), cells, 4).alias("missing_percent"),
    )


def empty_check(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("rows"), (rows == 0).alias("is_empty"))


def required_check(df: DataFrame, required: Sequence[str] = tuple(REQUIRED)) -> DataFrame:
    missing = missing_columns(df, required)
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(
        F.lit("required_columns").alias("check"),
        F.lit("error" if missing else "ok").alias("status"),
        F.lit(", ".join(missing)).alias("detail"),
        "rows",
    )


def validation_report(
    df: DataFrame, required: Sequence[str] = tuple(REQUIRED), missing_limit: float = 10.0
) -> DataFrame:
    """Rows ``(check, status, detail)``; status is ok, warning or error."""
    missing = missing_columns(df, required)
    # Equal rows have equally many NULLs, so one shuffle answers all three counts.
    nulls = add_up([F.col(c).isNull().cast("long") for c in df.columns]).alias("_nulls")
    groups = equal_rows(df, nulls).agg(F.count(F.lit(1)).alias("_n"), F.max("_nulls").alias("_nulls"))
    facts = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dups"),
        F.coalesce(F.sum(F.col("_nulls") * F.col("_n")), F.lit(0)).alias("nulls"),
    )
    # The limit holds for the share itself; only its text is rounded.
    exact = F.coalesce(F.try_divide(F.col("nulls") * F.lit(100.0), F.col("rows") * len(df.columns)), F.lit(0.0))
    share = F.coalesce(percent(F.col("nulls"), F.col("rows") * len(df.columns), 1), F.lit(0.0))

    def line(check: str, status: Column, detail: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), status.alias("status"), detail.alias("detail"))

    def status(bad: Column, level: str) -> Column:
        return F.when(bad, level).otherwise("ok")

    lines = F.array(
        line("required_columns", F.lit("error" if missing else "ok"), F.lit(", ".join(missing))),
        line("empty", status(F.col("rows") == 0, "error"), F.concat(F.col("rows").cast("string"), F.lit(" rows"))),
        line("duplicates", status(F.col("dups") > 0, "warning"), F.concat(F.col("dups").cast("string"), F.lit(" duplicate rows"))),
        line("missing", status(exact > missing_limit, "warning"), F.concat(share.cast("string"), F.lit("% missing"))),
    )
    return facts.select(F.inline(lines))


def require_valid(df: DataFrame, required: Sequence[str] = tuple(REQUIRED)) -> DataFrame:
    """The input itself, or ``ValidationError`` with every failed hard check."""
    errors = [
        f"{r['check']}: {r['detail']}" for r in validation_report(df, required).where("status = 'error'").collect()
    ]
    if errors:
        raise ValidationError("; ".join(errors))
    return df


def data_summary(df: DataFrame) -> DataFrame:
    """Customers, churn percent, mean tenure, mean charge and customers per contract, long form.

    ``rollup`` yields the contract rows and the grand total in one pass.
    """
    rolled = df.rollup("Contract").agg(
        F.grouping("Contract").alias("g"),
        F.count(F.lit(1)).alias("n"),
        F.sum(is_yes(TARGET)).alias("c"),
        F.sum("tenure").alias("t"),
        total("MonthlyCharges").alias("m"),
    )

    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metric"), value.cast("double").alias("value"))

    def per_customer(value: Column) -> Column:
        return F.round(F.try_divide(value, F.col("n")), 4)

    overall = F.array(
        entry(F.lit("total_customers"), F.col("n")),
        entry(F.lit("churn_rate"), per_customer(F.col("c") * 100.0)),
        entry(F.lit("avg_tenure"), per_customer(F.col("t"))),
        entry(F.lit("avg_monthly_charges"), per_customer(F.col("m"))),
    )
    contract = F.array(entry(F.concat(F.lit("contract: "), F.coalesce("Contract", F.lit(""))), F.col("n")))
    return rolled.select(F.inline(F.when(F.col("g") == 1, overall).otherwise(contract)))


def missing_by_column(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Rows ``(column, n_missing)``."""
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    long = row.unpivot([], df.columns, "column", "n_missing")
    return long.where(F.col("n_missing") > 0) if only_missing else long


def missing_after_trim(df: DataFrame) -> DataFrame:
    """Missing counts when empty or all-space text counts as missing; only columns with any."""
    text = set(string_columns(df))
    row = df.agg(
        *[
            F.sum(
                ((F.col(c).isNull() | is_blank(c)) if c in text else F.col(c).isNull()).cast("long")
            ).alias(c)
            for c in df.columns
        ]
    )
    return row.unpivot([], df.columns, "column", "n_missing").where(F.col("n_missing") > 0)


def explore(df: DataFrame) -> DataFrame:
    """Shape, missing cells per column, target distribution and churn percent as ``(metric, value)``."""
    row = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.lit(float(len(df.columns))).alias("columns"),
        F.sum(is_yes(TARGET)).cast("double").alias("target: Yes"),
        F.sum(F.when(F.col(TARGET) == "No", 1).otherwise(0)).cast("double").alias("target: No"),
        percent(F.sum(is_yes(TARGET)), F.count(F.lit(1))).alias("churn_rate"),
        *[F.sum(F.col(c).isNull().cast("int")).cast("double").alias(f"missing: {c}") for c in df.columns],
    )
    return row.unpivot([], row.columns, "metric", "value")


def numeric_profile(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), digits: int = 2) -> DataFrame:
    """Rows ``(column, mean, min, max, std)``, one scan for all columns."""
    row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.round(F.avg(c), digits).alias("mean"),
                F.round(F.min(c).cast("double"), digits).alias("min"),
                F.round(F.max(c).cast("double"), digits).alias("max"),
                F.round(F.stddev_samp(c), digits).alias("std"),
            ).alias(c)
            for c in columns
        ]
    )
    return row.select(F.inline(F.array(*columns)))


def describe(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), digits: int = 4) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    basic = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.round(F.avg(c), digits).alias("mean"),
                F.round(F.stddev_samp(c), digits).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*columns)))
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = quantile_columns(df, columns, names)
    return basic.join(quartiles, "column").withColumns({n: F.round(n, digits) for n in names})


def schema_rows(df: DataFrame) -> DataFrame:
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, is_nullable boolean"
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column: one scan, one shuffle."""
    return unpivot_strings(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def imbalance(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Majority and minority class and the ratio of their sizes."""
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    size = F.struct("n", label)
    return classes.agg(
        F.max(size)[label].alias("majority"),
        F.min(size)[label].alias("minority"),
        F.round(F.max("n") / F.min("n"), 4).alias("ratio"),
    )
