"""Rule score and risk categories: column expressions shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import add_up, flag, percent, to_number
from stayrate.schema import EVENT_FIELDS, MODEL_VERSION


def to_event_fields(df: DataFrame) -> DataFrame:
    """Subscriber rows under event field names and types; an unreadable total is NULL."""
    return df.select(
        *[
            (to_number(source) if name == "total_charges" else F.col(source)).alias(name)
            for name, source in EVENT_FIELDS.items()
        ]
    )


def field(names: dict[str, str] | None, name: str) -> Column:
    """An event field; ``names`` maps fields to the columns of a table that is no event table."""
    return F.col((names or {}).get(name, name))


def known(value: Column, default: object) -> Column:
    """The value, or its default where there is none; a JSON NaN counts as none."""
    if isinstance(default, float):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return F.coalesce(value, F.lit(default))


def signals(names: dict[str, str] | None = None) -> dict[str, Column]:
    """The 0/1 risk signals of an event."""

    def at(name: str) -> Column:
        return field(names, name)

    return {
        "contract_monthly": flag(at("contract") == "Month-to-month"),
        "new_customer": flag(known(at("tenure"), 0) < 12),
        "internet_fiber": flag(at("internet_service") == "Fiber optic"),
        "online_security_no": flag(at("online_security") == "No"),
        "tech_support_no": flag(at("tech_support") == "No"),
        "paperless_billing": flag(at("paperless_billing") == "Yes"),
        "payment_electronic": flag(known(at("payment_method"), "").contains("Electronic")),
        "high_charges": flag(known(at("monthly_charges"), 0.0) > 70),
    }


# Signals that count more than one point.
DOUBLE_POINTS = ("contract_monthly", "new_customer")


def risk_score(names: dict[str, str] | None = None, max_points: float = 10.0) -> Column:
    """Risk points of the signals over their maximum, at most 1."""
    points = [s * 2 if n in DOUBLE_POINTS else s for n, s in signals(names).items()]
    return F.least(add_up(points) / F.lit(max_points), F.lit(1.0))


def risk_category(
    probability: Column, high: float, medium: float, labels: tuple[str, str, str] = ("High", "Medium", "Low")
) -> Column:
    return (
        F.when(probability >= high, labels[0]).when(probability >= medium, labels[1]).otherwise(labels[2])
    )


def stream_category(probability: Column) -> Column:
    return risk_category(probability, 0.7, 0.4)


def batch_category(probability: Column, high: float = 0.7, medium: float = 0.5) -> Column:
    return risk_category(probability, high, medium, ("High Risk", "Medium Risk", "Low Risk"))


def iso_utc(moment: Column) -> Column:
    """ISO-8601 text in UTC, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def score_events(events: DataFrame, predicted_at: str | None = None) -> DataFrame:
    """Prediction per event. ``predicted_at`` fixes the time stamp; the default is now."""
    score = F.col("_score")
    prediction = flag(score >= 0.5)
    stamp = F.lit(predicted_at) if predicted_at else iso_utc(F.current_timestamp())
    return events.select("customer_id", risk_score().alias("_score")).select(
        "customer_id",
        prediction.alias("prediction"),
        F.round(score, 4).alias("churn_probability"),
        F.round(F.when(score >= 0.5, score).otherwise(1 - score), 4).alias("confidence"),
        stream_category(score).alias("risk_category"),
        stamp.alias("predicted_at"),
        F.lit(MODEL_VERSION).alias("model_version"),
    )


def event_features(events: DataFrame) -> DataFrame:
    """The ten numeric features of an event, with defaults for absent fields."""
    numbers = {
        "senior_citizen": known(F.col("senior_citizen"), 0),
        "tenure": known(F.col("tenure"), 0),
        "monthly_charges": known(F.col("monthly_charges"), 0.0),
        "total_charges": known(F.col("total_charges"), 0.0),
    }
    flags = signals()
    names = [
        "contract_monthly", "internet_fiber", "online_security_no", "tech_support_no",
        "paperless_billing", "payment_electronic",
    ]
    columns = {**numbers, **{n: flags[n] for n in names}}
    return events.select("customer_id", *[c.cast("double").alias(n) for n, c in columns.items()])


def prediction_summary(predictions: DataFrame, category: str = "risk_category", label: str = "prediction") -> DataFrame:
    """Totals, churn percent and rows per risk category, in one aggregation."""
    rows, churn = F.count(F.lit(1)), F.sum(label)

    def of(name: str) -> Column:
        return F.count_if(F.col(category).startswith(name))

    return predictions.agg(
        rows.alias("total_records"),
        F.coalesce(churn, F.lit(0)).alias("churn_count"),
        (rows - F.coalesce(churn, F.lit(0))).alias("retained_count"),
        percent(churn, rows).alias("churn_rate"),
        of("High").alias("high_risk"),
        of("Medium").alias("medium_risk"),
        of("Low").alias("low_risk"),
    )


def running_statistics(predictions: DataFrame) -> DataFrame:
    """Predictions made, high-risk customers and their percent; the same on a batch or a stream."""
    high = F.count_if(F.col("risk_category") == "High")
    rows = F.count(F.lit(1))
    return predictions.agg(
        rows.alias("total_predictions"),
        high.alias("high_risk_count"),
        F.round(high * 100.0 / F.greatest(rows, F.lit(1)), 2).alias("high_risk_percentage"),
    )


def run_log(predictions: DataFrame, stamp: str) -> DataFrame:
    """One log row per scoring call."""
    return predictions.agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(F.sum("prediction"), F.lit(0)).alias("churn_count"),
        F.round(F.coalesce(F.avg("churn_probability"), F.lit(0.0)), 6).alias("avg_probability"),
    ).select(F.lit(stamp).alias("timestamp"), "*")
