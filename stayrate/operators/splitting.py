"""Train/test splits and class weights. Rows are assigned by a hash of their id, so an
assignment never depends on partitioning, and a lost task repeats it exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.schema import ID, TARGET
from stayrate.session import cut_lineage

SEED = 42
HASH_DIGITS = 32
#: Rows of one label that a task may rank.
RANKED = 10_000


def id_hash(id_column: str = ID, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def split_random(df: DataFrame, test_size: float = 0.2, id_column: str = ID, seed: int = SEED) -> DataFrame:
    """``split`` = test for about ``test_size`` of the ids: the hash below a threshold."""
    threshold = f"{int(test_size * 16**8):08x}"
    is_test = F.substring(id_hash(id_column, seed), 1, 8) < threshold
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def split_stratified(
    df: DataFrame,
    test_size: float = 0.2,
    label: str = TARGET,
    id_column: str = ID,
    seed: int = SEED,
    digits: int = 3,
    ranked: int = RANKED,
) -> DataFrame:
    """``round(test_size * n)`` rows of every label are test: those of lowest hash.

    Ranking a whole label would sort a third of all rows or more in one task. Instead rows are
    counted per label and hash prefix, which tells the one prefix per label where the quota is
    reached; the rows of that prefix are counted by a longer one, and so on until it has at most
    ``ranked`` rows (or the whole hash is used up: rows of one id). Only those are ranked, to find
    the last hash that is still test. What is known of a label is a row of a small frame, joined
    with the rows, so there may be any number of labels. Rows that share an id stay on one side.
    """
    hashed = df.select(F.col(label).alias("_label"), F.col(id_column).alias("_id"), id_hash(id_column, seed).alias("_hash"))
    totals = hashed.groupBy("_label").agg(F.count(F.lit(1)).alias("_n"))
    edges = totals.select(
        "_label", F.lit("").alias("_prefix"), F.round(F.col("_n") * F.lit(test_size)).cast("long").alias("_owed")
    ).where("_owed > 0")
    length = 0
    while True:
        length = min(length + digits, HASH_DIGITS)
        inside = _at_edges(hashed, edges).withColumn("_next", F.substring("_hash", 1, length))
        counts = inside.groupBy("_label", "_next", "_owed").agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy("_label").orderBy("_next").rowsBetween(Window.unboundedPreceding, 0))
        reached = (F.col("_upto") >= F.col("_owed")) & (F.col("_upto") - F.col("_n") < F.col("_owed"))
        edges = cut_lineage(
            counts.withColumn("_upto", upto).where(reached)
            .select("_label", F.col("_next").alias("_prefix"), (F.col("_owed") - F.col("_upto") + F.col("_n")).alias("_owed"), "_n")
        )
        largest = edges.agg(F.max("_n")).head()[0] or 0
        edges = edges.drop("_n")
        if largest <= ranked or length == HASH_DIGITS:
            break
    order = Window.partitionBy("_label").orderBy("_hash", "_id")
    last = _at_edges(hashed, edges).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == F.col("_owed"))
    last = cut_lineage(last.select("_label", F.col("_hash").alias("_last")))
    joined = df.join(last, F.col(label).eqNullSafe(F.col("_label")), "left")
    is_test = F.coalesce(id_hash(id_column, seed) <= F.col("_last"), F.lit(False))
    return joined.select(*[df[c] for c in df.columns], F.when(is_test, "test").otherwise("train").alias("split"))


def _at_edges(hashed: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows whose hash begins with their label's prefix."""
    known = edges.withColumnRenamed("_label", "_at")
    same = F.col("_label").eqNullSafe(F.col("_at")) & F.startswith("_hash", "_prefix")
    return hashed.join(known, same).drop("_at", "_prefix")


def split_report(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and churn percent per side of a split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col(label) == "Yes", 1).otherwise(0)).alias("churned"),
        F.round(F.avg(F.when(F.col(label) == "Yes", 100.0).otherwise(0.0)), 2).alias("churn_rate"),
    )


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))
    return counts.select(
        label, "n", (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight")
    )


def with_class_weight(df: DataFrame, label: str = TARGET, output: str = "weight") -> DataFrame:
    """The weight of each row's class, joined: there may be any number of classes."""
    weights = class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias(output))
    kept = [df[c] for c in df.columns if c != output]
    return df.join(weights, F.col(label).eqNullSafe(F.col("_class")), "left").select(*kept, output)
