"""The subscriber view on hand-made tables, with a hot customer and a hot order."""

import datetime as dt

import pytest

from stayrate.operators.aggregate import churn_by
from stayrate.sources.subscribers import subscribers

DAY = dt.datetime(2024, 1, 1)
LINES = 300


@pytest.fixture(scope="module")
def tables(spark):
    customers = [(i, i % 25, 100.0 + i, "MACHINERY" if i == 3 else "BUILDING") for i in range(1, 9)]
    # Customer 1 has most orders; order 100 has most lines; customer 8 has no order; order 900 no customer.
    orders = [(100 + i, 1, "F" if i % 2 else "O", DAY + dt.timedelta(days=i), "1-URGENT") for i in range(40)]
    orders += [(200 + c, c, "O", DAY + dt.timedelta(days=400 * (c % 2)), "5-LOW") for c in range(2, 8)]
    orders += [(900, 99, "F", DAY + dt.timedelta(days=800), "5-LOW")]
    lines = [(100, "R" if i % 3 else "A", "O", float(i % 50), 0.05) for i in range(LINES)] + [(202, "N", "F", 10.0, 0.01)]
    return (
        spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        spark.createDataFrame(lines, "l_orderkey long, l_returnflag string, l_linestatus string, l_quantity double, l_tax double"),
    )


def test_view(tables):
    rows = {r["customerID"]: r for r in subscribers(*tables).collect()}
    assert sorted(rows) == [str(i) for i in range(1, 8)]
    hot = rows["1"]
    assert hot["tenure"] == 39 and hot["Contract"] == "One year"  # 40 orders, 40 % 11 = 7
    assert hot["OnlineSecurity"] == ("Yes" if sum(i % 3 != 0 for i in range(LINES)) % 2 == 0 else "No")
    assert hot["PaperlessBilling"] == "Yes" and hot["MultipleLines"] == "Yes"  # 20 finished, 40 urgent
    assert rows["2"]["TotalCharges"] == " " and rows["2"]["tenure"] == 0
    assert rows["3"]["PhoneService"] == "No" and rows["3"]["MultipleLines"] == "No phone service"
    # The last order of all is on day 800; nobody else ordered within 300 days of it but at day 400.
    assert {r["Churn"] for r in rows.values()} == {"Yes"}
    assert rows["1"]["MonthlyCharges"] == (1825 + 10100 % 10051) / 100


def test_lineless_orders_count_nothing(tables):
    customer, orders, lineitem = tables
    rows = {r["customerID"]: r for r in subscribers(customer, orders, lineitem).collect()}
    # Customer 4 has an order without lines: every count is 0, which is even.
    assert rows["4"]["OnlineBackup"] == "Yes" and rows["4"]["TechSupport"] == "Yes"


def test_reports_do_not_depend_on_partitioning(tables):
    customer, orders, lineitem = tables
    shuffled = subscribers(customer.repartition(5), orders.repartition(7), lineitem.repartition(3))
    for key in ("Contract", "PaymentMethod", "InternetService"):
        a = {tuple(r) for r in churn_by(subscribers(*tables), [key]).collect()}
        assert a == {tuple(r) for r in churn_by(shuffled, [key]).collect()}
