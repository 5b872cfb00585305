"""The SQL report set: overview, demographics, services, finance, tenure, risk, dashboards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS
from stayrate.functions.columns import is_blank, is_yes, mean, percent, total
from stayrate.operators.aggregate import (
    by_rate,
    churn_by,
    churn_by_each,
    churn_rate,
    churned,
    retained,
    share,
    with_all_labels,
)
from stayrate.operators.cleaning import keep_nonblank
from stayrate.operators.features import spark_features, transformed_table
from stayrate.plans import base_sql as b
from stayrate.plans.base_sql import CHURNED, RETAINED, money, rate
from stayrate.plans.registry import Inputs, query
from stayrate.schema import TARGET

CONTRACTS = ["Month-to-month", "One year", "Two year"]


def age_group():
    return F.when(F.col("SeniorCitizen") == 1, "Senior").otherwise("Non-Senior")


@query("agg_q11", f"""SELECT count(*) AS total_records, count(DISTINCT customerID) AS unique_customers,
  {CHURNED} AS churned_customers, {RETAINED} AS retained_customers, {rate()} AS churn_rate_percent
FROM subscribers""")
def overview(t: Inputs):
    # Counting the ids of one row per id first keeps the distinct count out of a single task.
    per_id = t.subscribers.groupBy("customerID").agg(
        F.count(F.lit(1)).alias("n"), churned().alias("c"), retained().alias("r")
    )
    return per_id.agg(
        F.sum("n").alias("total_records"),
        F.count("customerID").alias("unique_customers"),
        F.sum("c").alias("churned_customers"),
        F.sum("r").alias("retained_customers"),
        percent(F.sum("c"), F.sum("n")).alias("churn_rate_percent"),
    )


@query("agg_q12", """SELECT 'TotalCharges' AS column_name, count(*) AS total_records,
  count(*) FILTER (WHERE TotalCharges IS NULL OR trim(TotalCharges) = '') AS missing_count,
  round(count(*) FILTER (WHERE TotalCharges IS NULL OR trim(TotalCharges) = '') * 100.0 / count(*), 2) AS missing_percent
FROM subscribers""")
def missing_totals(t: Inputs):
    missing = F.count_if(F.col("TotalCharges").isNull() | is_blank("TotalCharges"))
    return t.subscribers.agg(
        F.count(F.lit(1)).alias("total_records"),
        missing.alias("missing_count"),
        percent(missing, F.count(F.lit(1))).alias("missing_percent"),
    ).select(F.lit("TotalCharges").alias("column_name"), "*")


@query("agg_q21", f"""SELECT gender, count(*) AS total_customers, {CHURNED} AS churned, {RETAINED} AS retained,
  {rate()} AS churn_rate FROM subscribers GROUP BY gender""")
def by_gender(t: Inputs):
    return by_rate(churn_by(t.subscribers, ["gender"], extra=[retained().alias("retained")]), "gender")


@query("agg_q22", f"""SELECT CASE WHEN SeniorCitizen = 1 THEN 'Senior' ELSE 'Non-Senior' END AS customer_type,
  count(*) AS total_customers, {CHURNED} AS churned, {rate()} AS churn_rate
FROM subscribers GROUP BY SeniorCitizen""")
def by_senior(t: Inputs):
    grouped = churn_by(t.subscribers, ["SeniorCitizen"])
    return by_rate(
        grouped.select(age_group().alias("customer_type"), "total_customers", "churned", "churn_rate"),
        "customer_type",
    )


@query("agg_q23", f"""SELECT Partner, Dependents, count(*) AS total_customers, {CHURNED} AS churned,
  {rate()} AS churn_rate FROM subscribers GROUP BY Partner, Dependents""")
def by_family(t: Inputs):
    return by_rate(churn_by(t.subscribers, ["Partner", "Dependents"]), "Partner", "Dependents")


@query("agg_q31", f"""SELECT InternetService, count(*) AS total_customers, {CHURNED} AS churned,
  {b.mean('MonthlyCharges')} AS avg_monthly_charges, {rate()} AS churn_rate
FROM subscribers GROUP BY InternetService""")
def by_internet(t: Inputs):
    extra = [mean("MonthlyCharges").alias("avg_monthly_charges")]
    return by_rate(churn_by(t.subscribers, ["InternetService"], extra=extra), "InternetService")


@query("agg_q32", f"""SELECT Contract, count(*) AS total_customers, {CHURNED} AS churned,
  round(avg(tenure), 1) AS avg_tenure_months, {rate()} AS churn_rate
FROM subscribers GROUP BY Contract""")
def by_contract(t: Inputs):
    extra = [F.round(F.avg("tenure"), 1).alias("avg_tenure_months")]
    return by_rate(churn_by(t.subscribers, ["Contract"], extra=extra), "Contract")


@query("agg_q33", f"""SELECT 'OnlineSecurity' AS service_name, OnlineSecurity AS service_status, count(*) AS customers,
  {CHURNED} AS churned, {rate()} AS churn_rate
FROM subscribers WHERE InternetService != 'No' GROUP BY OnlineSecurity
UNION ALL
SELECT 'TechSupport', TechSupport, count(*), {CHURNED}, {rate()}
FROM subscribers WHERE InternetService != 'No' GROUP BY TechSupport""")
def service_adoption(t: Inputs):
    online = t.subscribers.where(F.col("InternetService") != "No")
    grouped = churn_by_each(online, ["OnlineSecurity", "TechSupport"])
    return grouped.orderBy("service_name", F.desc("churn_rate"), "service_status")


@query("agg_q41", f"""SELECT PaymentMethod, count(*) AS total_customers, {CHURNED} AS churned,
  {b.mean('MonthlyCharges')} AS avg_monthly, {b.mean('TotalCharges')} AS avg_total, {rate()} AS churn_rate
FROM clean GROUP BY PaymentMethod""")
def by_payment(t: Inputs):
    extra = [mean("MonthlyCharges").alias("avg_monthly"), mean("TotalCharges").alias("avg_total")]
    return by_rate(churn_by(t.clean, ["PaymentMethod"], extra=extra), "PaymentMethod")


@query("agg_q42", f"""SELECT Churn, count(*) AS customers, round(min(MonthlyCharges), 2) AS min_charges,
  {b.mean('MonthlyCharges')} AS avg_charges, round(max(MonthlyCharges), 2) AS max_charges,
  round(stddev_samp(MonthlyCharges), 2) AS std_charges
FROM subscribers GROUP BY Churn""")
def charges_by_churn(t: Inputs):
    return t.subscribers.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.min("MonthlyCharges"), 2).alias("min_charges"),
        mean("MonthlyCharges").alias("avg_charges"),
        F.round(F.max("MonthlyCharges"), 2).alias("max_charges"),
        F.round(F.stddev_samp("MonthlyCharges"), 2).alias("std_charges"),
    )


@query("agg_q43", f"""SELECT Churn, count(*) AS customer_count, {money('MonthlyCharges')} AS monthly_revenue,
  {money('TotalCharges')} AS lifetime_revenue,
  round({money('MonthlyCharges')} * 12 / count(*), 2) AS projected_annual_revenue
FROM clean GROUP BY Churn""")
def revenue_at_risk(t: Inputs):
    return t.clean.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("customer_count"),
        total("MonthlyCharges").alias("monthly_revenue"),
        total("TotalCharges").alias("lifetime_revenue"),
        F.round(total("MonthlyCharges") * 12 / F.count(F.lit(1)), 2).alias("projected_annual_revenue"),
    )


def bucket_sql(name: str) -> str:
    spec = BUCKETS[name]
    return b.bucket_case(
        spec.edges, spec.labels, spec.column, "<=" if spec.closed == "right" else "<",
        spec.rest, spec.lowest, spec.include_lowest,
    )


@query("agg_q51", f"""SELECT {bucket_sql('sql5')} AS tenure_bucket, count(*) AS total_customers, {CHURNED} AS churned,
  {b.mean('MonthlyCharges')} AS avg_monthly_charges, {rate()} AS churn_rate
FROM subscribers GROUP BY 1""")
def by_tenure(t: Inputs):
    key = BUCKETS["sql5"].expr().alias("tenure_bucket")
    extra = [mean("MonthlyCharges").alias("avg_monthly_charges")]
    return by_rate(churn_by(t.subscribers, [key], extra=extra), "tenure_bucket")


PROFILE = [
    "customerID", "gender", "SeniorCitizen", "Contract", "tenure", "MonthlyCharges",
    "PaymentMethod", "InternetService", "OnlineSecurity", "TechSupport", "Churn",
]
HIGH_RISK_SQL = """Contract = 'Month-to-month' AND tenure < 12 AND InternetService = 'Fiber optic'
  AND OnlineSecurity = 'No' AND TechSupport = 'No'"""


def high_risk(df):
    return df.where(
        (F.col("Contract") == "Month-to-month")
        & (F.col("tenure") < 12)
        & (F.col("InternetService") == "Fiber optic")
        & (F.col("OnlineSecurity") == "No")
        & (F.col("TechSupport") == "No")
    )


@query("agg_q61", f"""SELECT {', '.join(PROFILE)} FROM subscribers WHERE {HIGH_RISK_SQL}
ORDER BY MonthlyCharges DESC, customerID LIMIT 100""")
def high_risk_profile(t: Inputs):
    # The 100-row limit is the report itself: TakeOrderedAndProject, no global sort.
    return high_risk(t.subscribers).select(*PROFILE).orderBy(F.desc("MonthlyCharges"), "customerID").limit(100)


@query("agg_q62", f"""SELECT Contract, InternetService,
  CASE WHEN SeniorCitizen = 1 THEN 'Senior' ELSE 'Non-Senior' END AS age_group, count(*) AS segment_size,
  {b.mean('MonthlyCharges')} AS avg_charges, round(avg(tenure), 1) AS avg_tenure, {CHURNED} AS churned,
  {rate()} AS churn_rate
FROM subscribers GROUP BY Contract, InternetService, SeniorCitizen HAVING count(*) > 50""")
def segments(t: Inputs):
    grouped = churn_by(
        t.subscribers,
        ["Contract", "InternetService", "SeniorCitizen"],
        count="segment_size",
        extra=[mean("MonthlyCharges").alias("avg_charges"), F.round(F.avg("tenure"), 1).alias("avg_tenure")],
    ).where(F.col("segment_size") > 50)
    return by_rate(
        grouped.withColumn("age_group", age_group()).drop("SeniorCitizen"),
        "Contract", "InternetService", "age_group",
    )


ADOPTION_SQL = """((PhoneService = 'Yes')::INT + (MultipleLines = 'Yes')::INT + (InternetService != 'No')::INT
  + (OnlineSecurity = 'Yes')::INT + (OnlineBackup = 'Yes')::INT + (DeviceProtection = 'Yes')::INT
  + (TechSupport = 'Yes')::INT + (StreamingTV = 'Yes')::INT + (StreamingMovies = 'Yes')::INT)"""
TRANSFORMED_SQL = f"""SELECT customerID, gender, SeniorCitizen, Partner, Dependents, tenure,
  {bucket_sql('sql3')} AS tenure_category, PhoneService, MultipleLines, InternetService, OnlineSecurity,
  OnlineBackup, DeviceProtection, TechSupport, StreamingTV, StreamingMovies, Contract, PaperlessBilling,
  PaymentMethod, MonthlyCharges, CAST(CAST(trim(TotalCharges) AS DECIMAL(10,2)) AS DOUBLE) AS TotalCharges,
  CAST({ADOPTION_SQL} AS INTEGER) AS service_adoption_score,
  CASE WHEN PaymentMethod LIKE '%automatic%' THEN 'High' ELSE 'Low' END AS payment_reliability,
  Churn, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS churn_flag
FROM subscribers WHERE trim(TotalCharges) != ''"""


@query("fe_q71", TRANSFORMED_SQL)
def transformed(t: Inputs):
    return transformed_table(keep_nonblank(t.subscribers)).withColumn(
        "TotalCharges", F.col("TotalCharges").cast("double")
    )


REPORT_DATE = dt.date(2024, 1, 31)


@query("agg_q81", f"""SELECT '2024-01' AS report_month, count(*) AS total_customers, {CHURNED} AS churned_customers,
  {rate()} AS churn_rate, {money('MonthlyCharges')} AS total_monthly_revenue,
  CAST(sum(CAST(CASE WHEN Churn = 'Yes' THEN MonthlyCharges ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS revenue_at_risk
FROM subscribers""")
def monthly_summary(t: Inputs, report_date: dt.date = REPORT_DATE):
    at_risk = F.when(F.col(TARGET) == "Yes", F.col("MonthlyCharges")).otherwise(0.0)
    return t.subscribers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        churned().alias("churned_customers"),
        churn_rate().alias("churn_rate"),
        total("MonthlyCharges").alias("total_monthly_revenue"),
        total(at_risk).alias("revenue_at_risk"),
    ).select(F.date_format(F.lit(report_date), "yyyy-MM").alias("report_month"), "*")


@query("agg_q82", " UNION ALL ".join(
    f"""SELECT '{c}' AS contract_type, count(*) FILTER (WHERE Contract = '{c}') AS total,
  count(*) FILTER (WHERE Contract = '{c}' AND Churn = 'Yes') AS churned FROM subscribers""" for c in CONTRACTS))
def contract_pivot(t: Inputs):
    grouped = t.subscribers.groupBy(F.col("Contract").alias("contract_type")).agg(
        F.count(F.lit(1)).alias("total"), churned().alias("churned")
    )
    full = with_all_labels(grouped, "contract_type", CONTRACTS, ["total", "churned"])
    return full.orderBy("_rank").drop("_rank")


@query("agg_sp1", f"""SELECT Contract, count(*) AS total_customers, {CHURNED} AS churned, {rate()} AS churn_rate
FROM clean GROUP BY Contract""")
def sp_contract(t: Inputs):
    return by_rate(churn_by(t.clean, ["Contract"]), "Contract")


@query("agg_sp2", f"""SELECT InternetService, count(*) AS total_customers,
  {b.mean('MonthlyCharges')} AS avg_monthly_charges, {rate()} AS churn_rate FROM clean GROUP BY InternetService""")
def sp_internet(t: Inputs):
    extra = [mean("MonthlyCharges").alias("avg_monthly_charges")]
    return by_rate(churn_by(t.clean, ["InternetService"], extra=extra), "InternetService").drop("churned")


@query("agg_sp3", f"""SELECT {bucket_sql('spark4')} AS tenure_bucket,
  CASE WHEN MonthlyCharges > 70 THEN 'Yes' ELSE 'No' END AS high_value_customer,
  count(*) AS customer_count, {rate()} AS churn_rate FROM clean GROUP BY 1, 2""")
def sp_segments(t: Inputs):
    grouped = churn_by(
        spark_features(t.clean), ["tenure_bucket", "high_value_customer"], count="customer_count"
    )
    return by_rate(grouped, "tenure_bucket", "high_value_customer").drop("churned")


@query("agg_sp4", f"""SELECT Churn, count(*) AS customers, {money('MonthlyCharges')} AS total_monthly_revenue,
  {b.mean('MonthlyCharges')} AS avg_monthly_charges, {money('TotalCharges')} AS lifetime_revenue
FROM clean GROUP BY Churn""")
def sp_revenue(t: Inputs):
    return t.clean.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("customers"),
        total("MonthlyCharges").alias("total_monthly_revenue"),
        mean("MonthlyCharges").alias("avg_monthly_charges"),
        total("TotalCharges").alias("lifetime_revenue"),
    )


@query("agg_spdist", f"""SELECT Churn, count(*) AS customers,
  round(count(*) * 100.0 / (SELECT count(*) FROM subscribers), 2) AS percent FROM subscribers GROUP BY Churn""")
def sp_distribution(t: Inputs):
    grouped = t.subscribers.groupBy(TARGET).agg(F.count(F.lit(1)).alias("customers"))
    return share(grouped, "customers", "percent")


# --- set operations, sorts and limits over the same reports -------------------------------


@query("set_union", f"""SELECT 'Contract' AS dimension, Contract AS level, count(*) AS customers, {CHURNED} AS churned
FROM subscribers GROUP BY Contract
UNION ALL SELECT 'PaymentMethod', PaymentMethod, count(*), {CHURNED} FROM subscribers GROUP BY PaymentMethod
UNION ALL SELECT 'InternetService', InternetService, count(*), {CHURNED} FROM subscribers GROUP BY InternetService""")
def union_of_reports(t: Inputs):
    columns = ("Contract", "PaymentMethod", "InternetService")
    rows = t.stored_subscribers(*columns, TARGET)
    parts = [
        rows.groupBy(F.lit(c).alias("dimension"), F.col(c).alias("level")).agg(
            F.count(F.lit(1)).alias("customers"), churned().alias("churned")
        )
        for c in columns
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("srt_desc", f"SELECT PaymentMethod, {rate()} AS churn_rate FROM subscribers GROUP BY PaymentMethod ORDER BY 2 DESC, 1")
def sort_desc(t: Inputs):
    return by_rate(churn_by(t.subscribers, ["PaymentMethod"]).select("PaymentMethod", "churn_rate"), "PaymentMethod")


@query("srt_multi", f"""SELECT * FROM (SELECT 'OnlineBackup' AS service_name, OnlineBackup AS service_status, {rate()} AS churn_rate
FROM subscribers GROUP BY OnlineBackup UNION ALL SELECT 'DeviceProtection', DeviceProtection, {rate()}
FROM subscribers GROUP BY DeviceProtection) ORDER BY service_name, churn_rate DESC, service_status""")
def sort_multi(t: Inputs):
    grouped = churn_by_each(t.subscribers, ["OnlineBackup", "DeviceProtection"])
    return grouped.select("service_name", "service_status", "churn_rate").orderBy(
        "service_name", F.desc("churn_rate"), "service_status"
    )


@query("srt_index", "SELECT PaymentMethod, count(*) AS customers FROM subscribers GROUP BY 1 ORDER BY 1")
def sort_index(t: Inputs):
    return t.subscribers.groupBy("PaymentMethod").agg(F.count(F.lit(1)).alias("customers")).orderBy("PaymentMethod")


TENURE_ORDER = ["Established (25-48 months)", "New (0-12 months)", "Loyal (49+ months)", "Unknown"]


@query("srt_custom", f"""WITH o(rank, tenure_bucket) AS (VALUES {', '.join(f"({i}, '{v}')" for i, v in enumerate(TENURE_ORDER))}),
g AS (SELECT {bucket_sql('nb4')} AS tenure_bucket, {rate()} AS churn_rate FROM clean GROUP BY 1)
SELECT tenure_bucket, churn_rate FROM o LEFT JOIN g USING (tenure_bucket) ORDER BY rank""")
def sort_custom(t: Inputs):
    """Rates in a caller's order; a label that no row has stays, with an unknown rate."""
    grouped = churn_by(t.clean, [BUCKETS["nb4"].expr().alias("tenure_bucket")]).select("tenure_bucket", "churn_rate")
    return with_all_labels(grouped, "tenure_bucket", TENURE_ORDER, []).orderBy("_rank").drop("_rank")


@query("srt_topk", """SELECT customerID, MonthlyCharges FROM subscribers
ORDER BY MonthlyCharges DESC, customerID LIMIT 10""")
def top_charges(t: Inputs, k: int = 10):
    return t.subscribers.select("customerID", "MonthlyCharges").orderBy(F.desc("MonthlyCharges"), "customerID").limit(k)


@query("src_view", f"SELECT Contract, count(*) AS customers, {CHURNED} AS churned FROM subscribers GROUP BY Contract")
def sql_view(t: Inputs):
    """The same table through a registered view and SQL text."""
    t.subscribers.createOrReplaceTempView("subscribers")
    return t.spark.sql(
        """SELECT Contract, count(*) AS customers, sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS churned
           FROM subscribers GROUP BY Contract"""
    )


@query("src_table", "SELECT o_orderstatus, count(*) AS orders, min(o_orderkey) AS first_key FROM orders GROUP BY 1", base=False)
def tables(t: Inputs):
    return t.table("orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_key")
    )


@query("jn_base", "SELECT * FROM subscribers")
def base_view(t: Inputs):
    return t.subscribers
