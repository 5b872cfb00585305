import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stayrate.schema import SUBSCRIBER  # noqa: E402
from stayrate.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


BASE = {
    "customerID": "c1", "gender": "Male", "SeniorCitizen": 0, "Partner": "No", "Dependents": "No", "tenure": 10,
    "PhoneService": "Yes", "MultipleLines": "No", "InternetService": "DSL", "OnlineSecurity": "No",
    "OnlineBackup": "No", "DeviceProtection": "No", "TechSupport": "No", "StreamingTV": "No",
    "StreamingMovies": "No", "Contract": "One year", "PaperlessBilling": "No", "PaymentMethod": "Mailed check",
    "MonthlyCharges": 50.0, "TotalCharges": "500.0", "Churn": "No",
}


@pytest.fixture(scope="session")
def make(spark):
    """Frame of subscribers from the fields that differ from a plain customer."""

    def build(*changes: dict):
        rows = [{**BASE, "customerID": f"c{i}", **c} for i, c in enumerate(changes)]
        return spark.createDataFrame([tuple(r[f] for f in SUBSCRIBER.names) for r in rows], SUBSCRIBER)

    return build
