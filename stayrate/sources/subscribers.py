"""The subscriber view: customers joined with facts drawn from their orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayrate.schema import SUBSCRIBER


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Line items folded to one row per order: the join then moves one row per order and not one per
# line, and an order or a customer with a third of all lines is folded map-side.
LINES = """
    SELECT l_orderkey,
      count_if(l_returnflag = 'R') AS r, count_if(l_returnflag = 'A') AS a, count_if(l_returnflag = 'N') AS n,
      count_if(l_linestatus = 'O') AS op, count_if(l_quantity > 25) AS q, count_if(l_tax > 0.04) AS t
    FROM {lineitem} GROUP BY l_orderkey"""

# The right side of this join is unique on its key, so Catalyst drops the join, and with it the
# scan of the line items, for every query that needs none of their counts.
FACTS = f"""
    SELECT o_custkey, count(*) AS n_orders,
      count_if(o_orderpriority = '1-URGENT') AS urg, count_if(o_orderstatus = 'F') AS fin,
      min(o_orderdate) AS f, max(o_orderdate) AS l,
      coalesce(sum(r), 0) AS r, coalesce(sum(a), 0) AS a, coalesce(sum(n), 0) AS n,
      coalesce(sum(op), 0) AS op, coalesce(sum(q), 0) AS q, coalesce(sum(t), 0) AS t
    FROM {{orders}} LEFT JOIN ({LINES}) ON o_orderkey = l_orderkey
    GROUP BY o_custkey"""

CUSTOMERS = f"""
    SELECT c_custkey, c_nationkey, c_mktsegment, n_orders, urg, fin, r, a, n, op, q, t,
      datediff(l, f) % 73 AS tenure,
      datediff((SELECT max(o_orderdate) FROM {{orders}}), l) AS gap,
      cast((1825 + abs(cast(round(c_acctbal * 100) AS bigint)) % 10051) / 100.0D AS decimal(10,2)) AS mc,
      c_custkey % 9 AS net
    FROM {{customer}} JOIN ({FACTS}) ON c_custkey = o_custkey"""


def _online(count: str) -> str:
    return f"CASE WHEN net >= 7 THEN 'No internet service' WHEN {count} % 2 = 0 THEN 'Yes' ELSE 'No' END"


COLUMNS = {
    "customerID": "c_custkey",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "SeniorCitizen": "CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END",
    "Partner": "CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "Dependents": "CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END",
    "tenure": "tenure",
    "PhoneService": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No' ELSE 'Yes' END",
    "MultipleLines": """CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No phone service'
        WHEN urg % 2 = 0 THEN 'Yes' ELSE 'No' END""",
    "InternetService": "CASE WHEN net < 4 THEN 'Fiber optic' WHEN net < 7 THEN 'DSL' ELSE 'No' END",
    "OnlineSecurity": _online("r"),
    "OnlineBackup": _online("a"),
    "DeviceProtection": _online("n"),
    "TechSupport": _online("op"),
    "StreamingTV": _online("q"),
    "StreamingMovies": _online("t"),
    "Contract": """CASE WHEN n_orders % 11 < 6 THEN 'Month-to-month' WHEN n_orders % 11 < 8 THEN 'One year'
        ELSE 'Two year' END""",
    "PaperlessBilling": "CASE WHEN fin % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "PaymentMethod": """CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
        WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END""",
    "MonthlyCharges": "mc",
    "TotalCharges": "CASE WHEN tenure = 0 THEN ' ' ELSE cast(cast(mc * tenure AS decimal(10,2)) AS string) END",
    "Churn": "CASE WHEN gap > 300 THEN 'Yes' ELSE 'No' END",
}
SELECTED = ", ".join(f"cast({COLUMNS[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in SUBSCRIBER.fields)
VIEW = f"SELECT {SELECTED} FROM ({CUSTOMERS})"


def subscribers(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per customer with orders, in the 21-column subscriber shape."""
    return customer.sparkSession.sql(VIEW, customer=customer, orders=orders, lineitem=lineitem)


def load_subscribers(spark: SparkSession, folder: str) -> DataFrame:
    return subscribers(
        read_table(spark, folder, "customer"),
        read_table(spark, folder, "orders"),
        read_table(spark, folder, "lineitem"),
    )
