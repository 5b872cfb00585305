"""Rule score, evaluation, and batch against stream."""

import json

import pytest
from pyspark.sql import functions as F

from stayrate.operators import evaluation as ev
from stayrate.operators import scoring
from stayrate.schema import EVENT_FIELDS
from stayrate.session import shared_path
from stayrate.sources.readers import stream_messages
from stayrate.streaming import jobs
from stayrate.streaming.messages import dead_letters, events_of, parse, sample_events, to_events, to_messages

RISKY = {
    "Contract": "Month-to-month", "tenure": 2, "InternetService": "Fiber optic", "PaperlessBilling": "Yes",
    "PaymentMethod": "Electronic check", "MonthlyCharges": 90.0,
}


def test_points(make):
    df = make(RISKY, {"OnlineSecurity": "Yes", "TechSupport": "Yes"}, {"MonthlyCharges": 70.0}, {"tenure": 12, "MonthlyCharges": 70.01})
    rows = scoring.score_events(scoring.to_event_fields(df), "now").orderBy("customer_id").collect()
    assert [r["churn_probability"] for r in rows] == [1.0, 0.2, 0.4, 0.3]
    assert [r["prediction"] for r in rows] == [1, 0, 0, 0]
    assert [r["confidence"] for r in rows] == [1.0, 0.8, 0.6, 0.7]
    assert [r["risk_category"] for r in rows] == ["High", "Low", "Medium", "Low"]
    direct = df.select("customerID", scoring.risk_score(EVENT_FIELDS).alias("p")).orderBy("customerID").collect()
    assert [r["p"] for r in direct] == [r["churn_probability"] for r in rows]


def test_risk_scales(spark):
    p = F.col("p")
    df = spark.createDataFrame([(0.0,), (0.4,), (0.5,), (0.7,), (1.0,)], "p double")
    rows = df.select(scoring.stream_category(p).alias("s"), scoring.batch_category(p).alias("b")).collect()
    assert [r["s"] for r in rows] == ["Low", "Medium", "Medium", "High", "High"]
    assert [r["b"] for r in rows] == ["Low Risk", "Low Risk", "Medium Risk", "High Risk", "High Risk"]


MESSAGES = [
    '{"customer_id": "a", "contract": "Month-to-month", "tenure": 1, "monthly_charges": 80.0, "total_charges": NaN}',
    '{"customer_id": "b"}',
    '{"customer_id": "c", "monthly_charges": NaN, "tenure": 20}',
    '{"customer_id": "d", "tenure": "soon"}',
    '{"customer_id": "e", "tenure"',
    "",
    "not json",
]


def test_messages(spark):
    parsed = parse(spark.createDataFrame([(m,) for m in MESSAGES], "value string"))
    events = events_of(parsed)
    assert sorted(r["customer_id"] for r in events.collect()) == ["a", "b", "c"]
    assert dead_letters(parsed).count() == 4
    scores = {r["customer_id"]: r["churn_probability"] for r in scoring.score_events(events, "now").collect()}
    # A missing tenure counts as 0 months; a NaN charge is no charge.
    assert scores == {"a": 0.5, "b": 0.2, "c": 0.0}
    features = {r["customer_id"]: r for r in scoring.event_features(events).collect()}
    assert features["a"]["total_charges"] == 0.0 and features["b"]["payment_electronic"] == 0.0


def test_message_round_trip(make):
    events = to_events(make(RISKY, {"TotalCharges": " "}), "2024-01-31T00:00:00+00:00")
    message = json.loads(to_messages(events).orderBy("key").collect()[1]["value"])
    assert len(message) == 23 and message["total_charges"] is None
    assert message["event_id"] == "evt_c1_1706659200000"
    back = events_of(parse(to_messages(events)))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, events.collect()), key=str)


def test_now_is_utc_iso(make):
    stamp = scoring.score_events(scoring.to_event_fields(make({}))).head()["predicted_at"]
    assert stamp.endswith("+00:00") and "T" in stamp


def test_stream_equals_batch_over_restarts(spark):
    folder, sink, dead = (shared_path(spark, n) for n in ("in", "out", "dead"))
    marks = [shared_path(spark, "mark") for _ in range(3)]
    subs = spark.range(60).select(
        F.to_json(F.struct(F.concat(F.lit("c"), "id").alias("customer_id"), (F.col("id") % 30).alias("tenure"), F.lit("Fiber optic").alias("internet_service"))).alias("value")
    )
    totals = shared_path(spark, "totals")
    for part in range(3):
        subs.where(F.col("value").isNotNull()).limit(60).repartition(3).write.mode("append").text(folder) if part == 0 else spark.createDataFrame([("broken{",)], "value string").write.mode("append").text(folder)
        stream = stream_messages(spark, folder, max_files=1)
        for query in (
            jobs.start_scoring(stream, sink, marks[0], predicted_at="now"),
            jobs.start_dead_letters(stream, dead, marks[1]),
            jobs.start_statistics(stream, totals, marks[2]),
        ):
            query.awaitTermination()
    streamed = spark.read.parquet(sink)
    assert streamed.count() == streamed.select("key").distinct().count() == 60
    batch = jobs.predictions_of(spark.read.text(folder), "now")
    want = {(r["key"], r["value"]) for r in to_messages(batch).collect()}
    assert {(r["key"], r["value"]) for r in streamed.collect()} == want
    assert spark.read.parquet(dead).count() == 2
    assert jobs.final_statistics(spark, totals).head().asDict() == scoring.running_statistics(batch).head().asDict()


def test_sample_size(make):
    df = make(*[{} for _ in range(20)])
    assert sample_events(df, 50).count() == 50


def frame(spark, rows):
    return spark.createDataFrame(rows, "y int, yhat int, score double")


def test_ranking_metrics_with_ties(spark):
    rows = [(1, 1, 0.9), (0, 1, 0.9), (1, 1, 0.6), (0, 0, 0.3), (0, 0, 0.3), (1, 0, 0.1)]
    got = ev.ranking_metrics(frame(spark, rows)).head()
    pairs = [(1.0 if p > n else 0.5 if p == n else 0.0) for y, _, p in rows if y for z, _, n in rows if not z]
    assert got["roc_auc"] == pytest.approx(sum(pairs) / len(pairs), abs=1e-6)
    assert got["average_precision"] == pytest.approx((1 / 3) * (1 / 2) + (1 / 3) * (2 / 3) + (1 / 3) * (3 / 6), abs=1e-6)


def test_area_under_the_saved_points(spark):
    rows = frame(spark, [((i * 7) % 5 // 3, 1, (i * 37 % 11) / 11) for i in range(60)])
    auc = ev.ranking_metrics(rows).head()["roc_auc"]
    points = sorted((r["fpr"], r["tpr"]) for r in ev.roc_points(rows).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(auc, abs=1e-4)
    assert (0.0, 1.0) in {(r["recall"], r["precision"]) for r in ev.pr_points(rows).collect()}
    by = rows.select(F.lit("m").alias("model"), "*")
    assert ev.roc_points(by, ["model"]).count() == len(points)


def test_draws_repeat_and_do_not_depend_on_partitions(spark, make):
    df = make(*[{"tenure": i} for i in range(40)])
    first = sorted(map(str, sample_events(df, 30).collect()))
    assert first == sorted(map(str, sample_events(df.repartition(7), 30).collect()))
    assert first != sorted(map(str, sample_events(df, 30, seed=1).collect()))
    assert sample_events(df.limit(0), 30).count() == 0


def test_single_class_and_zero_division(spark):
    rows = frame(spark, [(0, 0, 0.2), (0, 0, 0.4)])
    metrics = ev.basic_metrics(ev.confusion(rows)).head()
    assert metrics["precision"] == metrics["recall"] == metrics["f1_score"] == 0.0 and metrics["accuracy"] == 1.0
    assert ev.ranking_metrics(rows).head()["roc_auc"] is None


def test_log_loss_is_clipped(spark):
    assert ev.log_loss(frame(spark, [(1, 0, 0.0)])).head()["log_loss"] == pytest.approx(36.043653, abs=1e-6)


def test_best_model_takes_the_first_of_equals(spark):
    table = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "model string, f1_score double")
    assert ev.best_model(table).head()["model"] == "a"
