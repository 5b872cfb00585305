"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


PARTITION_BYTES = 256 << 20


def build_session(
    app_name: str = "stayrate", master: str | None = None, input_bytes: int | None = None, **conf: object
) -> SparkSession:
    """A session with the settings the library expects; ``conf`` overrides any of them.

    With ``input_bytes``, the size of the largest table, shuffles start with a partition per
    256 MB of it. That is more than needed, as rows are pruned and folded before they move: AQE
    merges what turns out small, but it cannot cut what turns out large.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
    if input_bytes:
        partitions = max(200, min(100_000, input_bytes // PARTITION_BYTES))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
        settings["spark.sql.files.maxPartitionBytes"] = str(PARTITION_BYTES)
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a machine-local
    folder would lose checkpoints together with the executor that wrote them.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stayrate-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "stayrate", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for narrow frames: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """A table in the shared folder, for a frame that several passes read: it is computed once,
    and every pass then reads only the columns it needs."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
