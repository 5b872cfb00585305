"""Schemas, column roles and fixed values of the subscriber data model."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "customerID"
TARGET = "Churn"

# Column names, their order and their roles.
SUBSCRIBER = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)

REQUIRED = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents",
    "tenure", "PhoneService", "Contract", "MonthlyCharges", "TotalCharges", "Churn",
]

NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
]
SERVICES = [
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
]
PREMIUM = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
STREAMING = ["StreamingTV", "StreamingMovies"]

ROLES = {
    "id": [ID],
    "target": [TARGET],
    "numeric": NUMERIC,
    "categorical": CATEGORICAL,
    "binary": ["gender", "Partner", "Dependents", "PhoneService", "PaperlessBilling"],
    "demographic": ["gender", "SeniorCitizen", "Partner", "Dependents"],
    "behavioural": ["tenure", "Contract", "PaperlessBilling", "PaymentMethod"],
    "financial": ["MonthlyCharges", "TotalCharges"],
    "service": SERVICES,
}

# Event field <- subscriber column, in message order.
EVENT_FIELDS = {
    "customer_id": "customerID",
    "gender": "gender",
    "senior_citizen": "SeniorCitizen",
    "partner": "Partner",
    "dependents": "Dependents",
    "tenure": "tenure",
    "phone_service": "PhoneService",
    "multiple_lines": "MultipleLines",
    "internet_service": "InternetService",
    "online_security": "OnlineSecurity",
    "online_backup": "OnlineBackup",
    "device_protection": "DeviceProtection",
    "tech_support": "TechSupport",
    "streaming_tv": "StreamingTV",
    "streaming_movies": "StreamingMovies",
    "contract": "Contract",
    "paperless_billing": "PaperlessBilling",
    "payment_method": "PaymentMethod",
    "monthly_charges": "MonthlyCharges",
    "total_charges": "TotalCharges",
}
EVENT_TYPE = "customer_activity"
MODEL_VERSION = "rule_based_v1.0"

_EVENT_TYPES = {
    "senior_citizen": T.IntegerType(),
    "tenure": T.IntegerType(),
    "monthly_charges": T.DoubleType(),
    "total_charges": T.DoubleType(),
}
EVENT = T.StructType(
    [T.StructField(name, _EVENT_TYPES.get(name, T.StringType())) for name in EVENT_FIELDS]
    + [T.StructField(name, T.StringType()) for name in ("event_id", "event_timestamp", "event_type")]
)

PREDICTION = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("risk_category", T.StringType()),
        T.StructField("predicted_at", T.StringType()),
        T.StructField("model_version", T.StringType()),
    ]
)
