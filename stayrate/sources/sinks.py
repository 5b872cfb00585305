"""Writers. All go through Spark's commit protocol, so a retried task leaves no half output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> str:
    """Headered CSV; leading and trailing spaces are data (a blank total is one space)."""
    writer = df.write.mode("overwrite").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_run(df: DataFrame, path: str, run_ts: str) -> str:
    """Append one run of a split dataset below ``path``, partitioned by run and side."""
    df.withColumn("run_ts", F.lit(run_ts)).write.mode("append").partitionBy("run_ts", "split").parquet(path)
    return path


def write_metadata(df: DataFrame, path: str, run_ts: str, features: list[str]) -> str:
    """One-row JSON with the run id, row counts per side and the feature list."""
    df.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    ).select(
        F.lit(run_ts).alias("run_ts"), "*", F.array(*[F.lit(f) for f in features]).alias("features")
    ).write.mode("overwrite").json(path)
    return path


def write_split(df: DataFrame, path: str) -> str:
    """Balanced and unbalanced sides in one dataset, so that a reader prunes by partition."""
    df.write.mode("overwrite").partitionBy("balance", "split").parquet(path)
    return path


def write_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """CREATE TABLE AS SELECT with its files at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_metrics(table: DataFrame, path: str, run_ts: str, model: str = "model") -> str:
    """Comparison rows as ``(run_ts, model, metric, value)``, appended to the metrics dataset."""
    metrics = [c for c in table.columns if c != model]
    long = table.unpivot([model], metrics, "metric", "value")
    long.withColumn("run_ts", F.lit(run_ts)).write.mode("append").partitionBy("run_ts").parquet(path)
    return path


def write_predictions(predictions: DataFrame, path: str) -> str:
    return write_csv(predictions, path)


def write_reports(reports: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Each named report as CSV below ``path``."""
    return {name: write_csv(df, f"{path}/{name}") for name, df in reports.items()}


def kafka_sink_options(servers: str = "localhost:9094", topic: str = "churn-predictions") -> dict[str, str]:
    """Options of a topic sink that waits for all replicas and retries."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.retry.backoff.ms": "500",
    }
