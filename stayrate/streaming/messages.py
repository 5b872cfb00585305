"""Event messages: subscriber rows to JSON and back. Batch and stream share all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.functions.ranks import running_totals
from stayrate.operators.scoring import iso_utc, to_event_fields
from stayrate.schema import EVENT, EVENT_FIELDS, EVENT_TYPE, ID

CORRUPT = "_corrupt"


def to_events(df: DataFrame, event_time: str | None = None) -> DataFrame:
    """Event rows of subscribers. ``event_time`` is an ISO-8601 moment; the default is now."""
    moment = F.to_timestamp(F.lit(event_time)) if event_time else F.current_timestamp()
    return to_event_fields(df).select(
        *EVENT_FIELDS,
        F.concat(F.lit("evt_"), "customer_id", F.lit("_"), F.unix_millis(moment).cast("string")).alias("event_id"),
        (F.lit(event_time) if event_time else iso_utc(moment)).alias("event_timestamp"),
        F.lit(EVENT_TYPE).alias("event_type"),
    )


def to_messages(rows: DataFrame, key: str = "customer_id") -> DataFrame:
    """``(key, value)`` with the whole row as JSON; absent values are written as null."""
    return rows.select(
        F.col(key).alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )


def parse(messages: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Message plus parsed event ``e`` and ``valid``. A broken message parses to a struct of
    NULLs, so validity is read from the corrupt-record field."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = messages.withColumn("e", F.from_json("value", with_corrupt, options))
    ok = F.col("e").isNotNull() & F.col(f"e.{CORRUPT}").isNull() & (F.trim("value") != "")
    return parsed.withColumn("valid", F.coalesce(ok, F.lit(False)))


def events_of(parsed: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    return parsed.where("valid").select(*[F.col(f"e.{f.name}").alias(f.name) for f in schema.fields])


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that could not be read, for a sink of their own."""
    return parsed.where(~F.col("valid")).select("value")


def sample_events(df: DataFrame, n: int, seed: int = 42, key: str = ID) -> DataFrame:
    """``n`` subscribers drawn at random with replacement; none if there are none.

    Draw ``i`` takes the subscriber whose place in key order is a hash of seed and ``i``, modulo the
    number of keys. It does not depend on partitions, a task that runs again draws the same, and
    exactly ``n`` rows come out of unique keys. Only keys are put in order; the drawn ones are then
    joined with their rows.
    """
    places = running_totals(df.select(key), [], key, {"one": F.max(F.lit(1))})
    keys = places.count()
    if not keys:
        return df
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("id"))), 1, 15), 16, 10).cast("long")
    draws = df.sparkSession.range(n).select((F.pmod(number, F.lit(keys)) + 1).alias("_place"))
    drawn = places.join(draws, F.col("cum_one") == F.col("_place")).select(key)
    return df.join(drawn, key).select(*df.columns)
