"""Churn aggregations. Every grouped report is one hash aggregation with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.buckets import Buckets, equal_width_bin
from stayrate.functions.columns import is_yes, percent, total
from stayrate.functions.longform import unpivot_numbers, unpivot_strings
from stayrate.functions.ranks import quantile_columns
from stayrate.schema import TARGET

def churned() -> Column:
    return F.sum(is_yes(TARGET))


def retained() -> Column:
    return F.sum(F.when(F.col(TARGET) == "No", 1).otherwise(0))


def churn_rate(digits: int = 2) -> Column:
    return percent(churned(), F.count(F.lit(1)), digits)


def churn_by(
    df: DataFrame,
    keys: Sequence[Column | str],
    *,
    count: str = "total_customers",
    extra: Sequence[Column] = (),
    digits: int = 2,
    rate: str = "churn_rate",
) -> DataFrame:
    """Customers, churned customers and churn rate per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        churned().alias("churned"),
        *extra,
        churn_rate(digits).alias(rate),
    )


def by_rate(df: DataFrame, *ties: str, rate: str = "churn_rate") -> DataFrame:
    """Highest rate first; ties are ordered by the keys so the order is stable."""
    return df.orderBy(F.desc(rate), *ties)


def churn_by_each(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Churn per value of each column: one scan and one shuffle for all of them."""
    return churn_by(
        unpivot_strings(df, columns, [TARGET]),
        [F.col("column").alias("service_name"), F.col("value").alias("service_status")],
        count="customers",
    )


def with_all_labels(df: DataFrame, key: str, labels: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Keep a row for every label, with zero counts where no row had it.

    ``df`` is aggregated by ``key``, so at most one row per literal label is broadcast.
    """
    one = df.sparkSession.range(1, numPartitions=1)
    order = one.select(F.posexplode(F.array(*[F.lit(v) for v in labels])).alias("_rank", key))
    known = df.where(F.col(key).isin(list(labels)))
    joined = order.join(F.broadcast(known), key, "left")
    return joined.select(
        key,
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in counts else F.col(c) for c in df.columns if c != key],
        "_rank",
    )


def bucket_report(df: DataFrame, buckets: Buckets, key: str, digits: int = 1) -> DataFrame:
    """Customers, churned and rate for every bucket, empty ones included, in bucket order."""
    grouped = churn_by(df.select(buckets.expr().alias(key), TARGET), [key], digits=digits)
    full = with_all_labels(grouped, key, buckets.all_labels(), ["total_customers", "churned"])
    return full.withColumn("churn_rate", F.coalesce("churn_rate", F.lit(0.0))).orderBy("_rank").drop("_rank")


def share(df: DataFrame, value: str, output: str, digits: int = 2) -> DataFrame:
    """Percent of the grand total, for aggregated rows.

    The window runs over one row per category, so its single partition stays as small as the
    report, and the input is read once.
    """
    whole = F.sum(value).over(Window.partitionBy(F.lit(0)))
    return df.withColumn(output, percent(F.col(value), whole, digits))


def extents(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    """Minimum and maximum of each column: one aggregation, one row to the driver."""
    row = df.agg(*[F.struct(F.min(c).cast("double"), F.max(c).cast("double")).alias(c) for c in columns]).head()
    return {c: (F.lit(row[c][0]), F.lit(row[c][1])) for c in columns}


def charge_bins(df: DataFrame, column: str = "MonthlyCharges", bins: int = 5) -> DataFrame:
    """Equal-width bins over the observed range, with label, count and churn percent."""
    low, high = extents(df, [column])[column]
    grouped = churn_by(
        df.select(TARGET, equal_width_bin(column, low, high, bins).alias("bin")), ["bin"], digits=1
    )
    spark = df.sparkSession
    every = spark.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / F.lit(float(bins))
    # The lowest label starts a thousandth of the range early so that it holds the minimum.
    left = F.when(F.col("bin") == 0, low - (high - low) * 0.001).otherwise(low + width * F.col("bin"))
    right = low + width * (F.col("bin") + 1)
    text = [F.round(c, 2).cast("decimal(18,2)").cast("string") for c in (left, right)]
    return (
        every.join(F.broadcast(grouped), "bin", "left")
        .orderBy("bin")
        .select(
            F.concat_ws("-", *text).alias("range"),
            F.coalesce("total_customers", F.lit(0)).alias("count"),
            F.coalesce("churn_rate", F.lit(0.0)).alias("avgChurn"),
        )
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Counts by churn over equal-width bins of each column's observed range, in one pass."""
    ranges = extents(df, columns)
    binned = df.select(
        TARGET, *[equal_width_bin(c, *ranges[c], bins, closed="left").alias(c) for c in columns]
    )
    return (
        binned.unpivot([TARGET], list(columns), "column", "bin")
        .groupBy("column", "bin", TARGET)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_numbers(
    df: DataFrame, columns: Sequence[str], by: str = TARGET, levels: Sequence[str] = ("No", "Yes")
) -> DataFrame:
    """Box-plot numbers per column and group: quartiles, whiskers, and points beyond them."""
    df = df.where(F.col(by).isin(list(levels)))
    quartiles = quantile_columns(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    # len(columns) * len(levels) quartile rows: broadcast, so no group's rows meet in one task.
    return (
        unpivot_numbers(df, columns, [by])
        .where(F.col("value").isNotNull())
        .join(F.broadcast(quartiles), [by, "column"])
        .groupBy("column", by)
        .agg(
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def crosstab(df: DataFrame, key: str, levels: Sequence[str] = ("No", "Yes")) -> DataFrame:
    """Contingency table against churn with zeros filled in."""
    table = df.groupBy(key).pivot(TARGET, list(levels)).agg(F.count(F.lit(1)))
    return table.na.fill(0, list(levels))


def row_shares(table: DataFrame, key: str, levels: Sequence[str] = ("No", "Yes"), digits: int = 4) -> DataFrame:
    whole = sum((F.col(c) for c in levels[1:]), F.col(levels[0]))
    return table.select(
        key, *[F.round(F.try_divide(F.col(c).cast("double"), whole), digits).alias(c) for c in levels]
    )


def revenue_impact(df: DataFrame) -> DataFrame:
    """Revenue lost with churned customers, its 12-month projection, and a tenth of that."""
    yearly = total("MonthlyCharges") * 12
    return df.where(F.col(TARGET) == "Yes").agg(
        F.round(total("TotalCharges"), 2).alias("historical_loss"),
        F.round(yearly, 2).alias("projected_loss_12m"),
        F.round(yearly * 0.10, 2).alias("savings_10_percent"),
    )
