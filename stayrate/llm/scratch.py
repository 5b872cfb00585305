"""Tables between the passes of one operator call, in the cluster's shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stayrate.session import shared_path


class Scratch:
    """Writes intermediate tables and deletes those that no later pass needs.

    What a returned DataFrame still reads must stay: only tables that were read to the end, by
    an action, may be dropped.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table: computed once, and safe from the loss of any executor."""
        path = shared_path(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(nullable(df.schema)).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Between passes: shuffles of frames that are no longer referred to are deleted on all executors
        once the driver's garbage is collected, so it is asked to."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def nullable(schema: StructType) -> StructType:
    """The schema as Parquet gives it back, so that reading needs no job for the footers."""
    return StructType.fromJson({**schema.jsonValue(), "fields": [{**f, "nullable": True} for f in schema.jsonValue()["fields"]]})


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that results of these names replace."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
