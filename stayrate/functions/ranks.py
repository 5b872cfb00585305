"""Order statistics and running totals that scale: no unpartitioned window over raw rows.

Rows are first folded to one row per distinct value, which also removes any hot value. The
distinct values are range-partitioned, so each task holds one contiguous slice; slice totals
are a few rows, and their prefix sums give every slice its starting offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.longform import unpivot_numbers
from stayrate.session import cut_lineage


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sums: dict[str, Column],
    descending: bool = False,
) -> DataFrame:
    """One row per (keys, value) with ``<name>``, ``cum_<name>`` and ``all_<name>`` per sum.

    ``cum_`` includes the row itself; ``all_`` is the total of the row's key.
    The range-partitioned frame is checkpointed, so that slice numbers stay the same for both
    of its readers even if an executor is lost between them.
    """
    keys = list(keys)
    names = list(sums)
    folded = df.groupBy(*keys, value).agg(*[expr.alias(name) for name, expr in sums.items()])
    order = F.col(value).desc() if descending else F.col(value).asc()
    sliced = cut_lineage(
        folded.repartitionByRange(*[F.col(k) for k in keys], order).withColumn("_slice", F.spark_partition_id())
    )
    per_slice = sliced.groupBy(*keys, "_slice").agg(*[F.sum(n).alias(f"_sum_{n}") for n in names])
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A row per key and slice. The join is left to the planner: joining by shuffle already
    # leaves the rows partitioned as the last window needs them.
    offsets = per_slice.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_slice").alias("_at"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"all_{n}") for n in names],
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_slice") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return sliced.join(offsets, same).select(
        *keys,
        value,
        *names,
        *[(F.sum(n).over(within) + F.col(f"_off_{n}")).alias(f"cum_{n}") for n in names],
        *[f"all_{n}" for n in names],
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolated quantiles: rows ``(by.., column, probability, quantile)``.

    NULLs are ignored. Work grows with the distinct values, and no task sees a whole column.
    """
    by = list(by)
    long = unpivot_numbers(df, list(columns), by).where(F.col("value").isNotNull())
    ranked = running_totals(long, [*by, "column"], "value", {"n": F.count(F.lit(1))})
    first = F.col("cum_n") - F.col("n")  # 0-based rank of the value's first copy
    picks = []
    for i, p in enumerate(probabilities):
        position = (F.col("all_n") - 1) * F.lit(float(p))
        for name, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(
                F.max(F.when((first <= rank) & (rank < F.col("cum_n")), F.col("value"))).alias(f"{name}{i}")
            )
        picks.append(F.max(position - F.floor(position)).alias(f"d{i}"))
    wide = ranked.groupBy(*by, "column").agg(*picks)
    entries = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("probability"),
                (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"d{i}")).alias("quantile"),
            )
            for i, p in enumerate(probabilities)
        ]
    )
    return wide.select(*by, "column", F.inline(entries))


def quantile_columns(
    df: DataFrame, columns: Sequence[str], names: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """``exact_quantiles`` with one column per named probability."""
    long = exact_quantiles(df, columns, list(names.values()), by)
    return long.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("probability") == float(p), F.col("quantile"))).alias(n) for n, p in names.items()]
    )
