"""Readers: CSV, records, run datasets, metadata, model files, and message streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.schema import SUBSCRIBER

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType = SUBSCRIBER, keep_corrupt: bool = False) -> DataFrame:
    """Headered CSV under a fixed schema: no inference scan, and total charges stay text.

    A missing path raises ``FileNotFoundError``. With ``keep_corrupt`` unreadable lines are kept
    in ``_corrupt_record``.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return _load(reader.csv, path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with inferred types; costs a second scan."""
    return _load(spark.read.option("header", True).option("inferSchema", True).csv, path)


def _load(load, path: str) -> DataFrame:
    try:
        return load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise FileNotFoundError(path) from error
        raise


def read_records(
    spark: SparkSession, records: DataFrame | dict | Iterable[dict], schema: T.StructType | None = None
) -> DataFrame:
    """A frame from one record, a list of records, or a frame itself."""
    if isinstance(records, DataFrame):
        return records
    rows = [records] if isinstance(records, dict) else list(records)
    if schema is None:
        return spark.createDataFrame([Row(**r) for r in rows])
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    """The newest run only. The filter is on the partition column, so other runs are not read."""
    runs = spark.read.parquet(path)
    newest = runs.select("run_ts").agg(F.max("run_ts")).scalar()
    return runs.where(F.col("run_ts") == newest)


def read_split(spark: SparkSession, path: str, balance: str, split: str) -> DataFrame:
    """One side of a saved split; both filters are on partition columns."""
    return spark.read.parquet(path).where((F.col("balance") == balance) & (F.col("split") == split))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def load_model(spark: SparkSession, candidates: Sequence[str]) -> PipelineModel | None:
    """The first candidate path that holds a model; None when none does, so that the caller
    falls back to the rule score."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in candidates:
        marker = hadoop(path, "metadata")
        if marker.getFileSystem(conf).exists(marker):
            return PipelineModel.load(path)
    return None


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message lines of a growing folder, as a stream with a ``value`` column."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_kafka(
    spark: SparkSession,
    servers: str = "localhost:9094",
    topic: str = "customer-events",
    group: str = "churn-prediction-group",
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> DataFrame:
    """The same messages from a topic; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", group)
        .option("startingOffsets", starting)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
