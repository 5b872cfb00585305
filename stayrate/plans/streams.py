"""Streaming queries. Messages are written from the subscriber table, read as a stream, and the
result of the finished stream is compared with the batch computation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators.splitting import split_random
from stayrate.plans.registry import Inputs, query
from stayrate.plans.scoring import PREDICTED, STAMP
from stayrate.schema import EVENT_TYPE, MODEL_VERSION, PREDICTION
from stayrate.session import shared_path, store
from stayrate.sources.readers import stream_messages
from stayrate.streaming import jobs
from stayrate.streaming.messages import dead_letters, events_of, parse, sample_events, to_events, to_messages

PREDICTIONS_SQL = f"""WITH {PREDICTED} SELECT * EXCLUDE (Churn), '{STAMP}' AS predicted_at,
  '{MODEL_VERSION}' AS model_version FROM predicted"""
EVENTS_SQL = f"""SELECT customerID AS customer_id, gender, SeniorCitizen AS senior_citizen, Partner AS partner,
  Dependents AS dependents, tenure, PhoneService AS phone_service, MultipleLines AS multiple_lines,
  InternetService AS internet_service, OnlineSecurity AS online_security, OnlineBackup AS online_backup,
  DeviceProtection AS device_protection, TechSupport AS tech_support, StreamingTV AS streaming_tv,
  StreamingMovies AS streaming_movies, Contract AS contract, PaperlessBilling AS paperless_billing,
  PaymentMethod AS payment_method, MonthlyCharges AS monthly_charges,
  TRY_CAST(trim(TotalCharges) AS DOUBLE) AS total_charges, 'evt_' || customerID || '_1706659200000' AS event_id,
  '{STAMP}' AS event_timestamp, '{EVENT_TYPE}' AS event_type FROM subscribers"""


def publish(t: Inputs, folder: str | None = None, rows=None) -> str:
    """Write subscribers, by default all of them, as JSON message lines."""
    folder = folder or shared_path(t.spark, "messages")
    messages = to_messages(to_events(rows if rows is not None else t.subscribers, STAMP))
    messages.select("value").write.mode("append").text(folder)
    return folder


def run(query_) -> None:
    query_.awaitTermination()
    if query_.exception() is not None:
        raise query_.exception()


def read_predictions(t: Inputs, sink: str):
    rows = t.spark.read.parquet(sink)
    return rows.select(F.from_json("value", PREDICTION).alias("p")).select("p.*")


def score(t: Inputs, folder: str, sink: str, checkpoint: str, max_files: int | None = None) -> None:
    messages = stream_messages(t.spark, folder, max_files)
    run(jobs.start_scoring(messages, sink, checkpoint, predicted_at=STAMP))


@query("stm_events", EVENTS_SQL)
def events(t: Inputs):
    return to_events(t.subscribers, STAMP)


@query("stm_sample", f"""WITH e AS ({EVENTS_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY customer_id) - 1 AS place, count(*) OVER () AS n FROM e),
d AS (SELECT i, ('0x' || substr(md5('42:' || i), 1, 15))::BIGINT AS h FROM range(100) x(i))
SELECT r.* EXCLUDE (place, n) FROM r JOIN d ON r.place = d.h % r.n""")
def sample(t: Inputs, n: int = 100):
    """A seeded draw of ``n`` customers with replacement, as events."""
    return to_events(sample_events(t.subscribers, n), STAMP)


# Every row's message, cut short on the wire when its id ends in 7.
BROKEN = "customerID LIKE '%7'"


@query("stm_parse", f"""SELECT customer_id, tenure, monthly_charges, total_charges, status FROM (
  SELECT customerID AS customer_id, tenure, MonthlyCharges AS monthly_charges,
    TRY_CAST(trim(TotalCharges) AS DOUBLE) AS total_charges, 'event' AS status FROM subscribers WHERE NOT ({BROKEN})
  UNION ALL SELECT NULL, NULL, NULL, NULL, 'dead letter' FROM subscribers WHERE {BROKEN})""")
def parsed(t: Inputs):
    messages = to_messages(to_events(t.subscribers, STAMP))
    cut = F.when(F.col("key").like("%7"), F.expr("substring(value, 1, length(value) div 2)")).otherwise(F.col("value"))
    both = parse(store(messages.select("key", cut.alias("value")), "messages"))
    fields = ["customer_id", "tenure", "monthly_charges", "total_charges"]
    good = events_of(both).select(*fields, F.lit("event").alias("status"))
    bad = dead_letters(both).select(
        *[F.lit(None).cast(good.schema[f].dataType).alias(f) for f in fields], F.lit("dead letter").alias("status")
    )
    return good.unionByName(bad)


@query("stm_score", PREDICTIONS_SQL)
def scored(t: Inputs):
    sink = shared_path(t.spark, "predictions")
    score(t, publish(t), sink, shared_path(t.spark, "checkpoint"))
    return read_predictions(t, sink)


@query("stm_bounded", PREDICTIONS_SQL)
def bounded(t: Inputs):
    """The same in micro-batches of one file each, stopping when all is read."""
    sink = shared_path(t.spark, "predictions")
    score(t, publish(t), sink, shared_path(t.spark, "checkpoint"), max_files=1)
    return read_predictions(t, sink)


@query("stm_delivery", PREDICTIONS_SQL)
def delivery(t: Inputs):
    """Half the messages, a stop, the other half, and a restart on the same checkpoint."""
    sink, checkpoint = shared_path(t.spark, "predictions"), shared_path(t.spark, "checkpoint")
    halves = split_random(t.stored_subscribers(), 0.5)
    folder = publish(t, rows=halves.where("split = 'train'"))
    score(t, folder, sink, checkpoint)
    publish(t, folder, halves.where("split = 'test'"))
    score(t, folder, sink, checkpoint)
    score(t, folder, sink, checkpoint)
    return read_predictions(t, sink)


@query("stm_stats", f"""WITH {PREDICTED} SELECT count(*) AS total_predictions, count(*) FILTER (WHERE risk_category = 'High') AS high_risk_count,
  round(count(*) FILTER (WHERE risk_category = 'High') * 100.0 / greatest(count(*), 1), 2) AS high_risk_percentage FROM predicted""")
def statistics(t: Inputs):
    sink = shared_path(t.spark, "statistics")
    messages = stream_messages(t.spark, publish(t), max_files=1)
    run(jobs.start_statistics(messages, sink, shared_path(t.spark, "checkpoint")))
    return jobs.final_statistics(t.spark, sink)


@query("src_stream", EVENTS_SQL)
def source(t: Inputs):
    """Events as the stream source delivers them, before scoring."""
    sink = shared_path(t.spark, "events")
    stream = events_of(parse(stream_messages(t.spark, publish(t))))
    writer = stream.writeStream.format("parquet").option("path", sink)
    run(writer.option("checkpointLocation", shared_path(t.spark, "checkpoint")).trigger(availableNow=True).start())
    return t.spark.read.parquet(sink)


@query("snk_stream", f"WITH {PREDICTED} SELECT customer_id AS key, risk_category FROM predicted")
def keyed(t: Inputs):
    """The published message key is the customer."""
    sink = shared_path(t.spark, "predictions")
    score(t, publish(t), sink, shared_path(t.spark, "checkpoint"))
    return t.spark.read.parquet(sink).select("key", F.get_json_object("value", "$.risk_category").alias("risk_category"))
