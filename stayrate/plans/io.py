"""Source and sink queries: write through the sink, read back through the source."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stayrate.operators import evaluation as ev
from stayrate.operators import scoring, splitting
from stayrate.operators.aggregate import charge_bins
from stayrate.operators.cleaning import keep_nonblank
from stayrate.operators.features import transformed_table
from stayrate.plans.base_sql import CHURNED, rate
from stayrate.plans.encoding import STRATIFIED
from stayrate.plans.registry import Inputs, query
from stayrate.plans.scoring import COMPARE_SQL, POINTS_SQL, candidates
from stayrate.plans.sql_reports import TRANSFORMED_SQL
from stayrate.plans.table_reports import dashboard_rows, x_by, x_distribution, x_internet, x_tenure
from stayrate.schema import EVENT_FIELDS, ID, SUBSCRIBER
from stayrate.session import shared_path
from stayrate.sources import readers, sinks

RUNS = ["20240101_000000", "20240201_000000"]


@query("src_csv", "SELECT * FROM subscribers")
def csv(t: Inputs):
    path = sinks.write_csv(t.subscribers, shared_path(t.spark, "csv"))
    return readers.read_csv(t.spark, path)


@query("src_csv_infer", "SELECT * REPLACE (CAST(customerID AS INTEGER) AS customerID) FROM subscribers")
def csv_inferred(t: Inputs):
    path = sinks.write_csv(t.subscribers, shared_path(t.spark, "csv"))
    return readers.read_csv_inferred(t.spark, path)


@query("src_records", "SELECT customerID, tenure, Contract, MonthlyCharges FROM subscribers")
def records(t: Inputs):
    """Rows out of given records: each a JSON object, parsed where it lies."""
    rows = t.subscribers.select(ID, "tenure", "Contract", "MonthlyCharges")
    given = rows.select(F.to_json(F.struct("*")).alias("record"))
    return given.select(F.from_json("record", rows.schema).alias("r")).select("r.*")


@query("snk_csv", "SELECT * EXCLUDE (customerID) FROM clean")
def snk_csv(t: Inputs):
    cleaned = t.clean.drop(ID)
    path = sinks.write_csv(cleaned, shared_path(t.spark, "cleaned"))
    return readers.read_csv(t.spark, path, cleaned.schema)


def split_runs(t: Inputs) -> str:
    """Two runs of one dataset: a random split, then the stratified one."""
    path = shared_path(t.spark, "runs")
    rows = t.stored_subscribers(ID, "tenure", "MonthlyCharges", "Churn")
    sinks.write_run(splitting.split_random(rows), path, RUNS[0])
    sinks.write_run(splitting.split_stratified(rows), path, RUNS[1])
    return path


@query("src_latest_run", f"WITH {STRATIFIED} SELECT customerID, tenure, MonthlyCharges, Churn, split, '{RUNS[1]}' AS run_ts FROM stratified")
def latest(t: Inputs):
    return readers.latest_run(t.spark, split_runs(t))


@query("snk_split_run", f"""WITH {STRATIFIED} SELECT '{RUNS[1]}' AS run_ts, split, count(*) AS rows,
  count(*) FILTER (WHERE Churn = 'Yes') AS churned FROM stratified GROUP BY split""")
def split_run(t: Inputs):
    path = shared_path(t.spark, "runs")
    sinks.write_run(splitting.split_stratified(t.stored_subscribers()), path, RUNS[1])
    return readers.latest_run(t.spark, path).groupBy("run_ts", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Churn") == "Yes").alias("churned")
    )


@query("src_json_meta", f"""WITH {STRATIFIED} SELECT '{RUNS[1]}' AS run_ts, count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'test') AS test_rows, 21 AS n_features FROM stratified""")
def metadata(t: Inputs):
    path = shared_path(t.spark, "metadata")
    sinks.write_metadata(splitting.split_stratified(t.stored_subscribers(ID, "Churn")), path, RUNS[1], SUBSCRIBER.names)
    return readers.read_metadata(t.spark, path).withColumn("n_features", F.size("features")).drop("features")


@query("snk_ctas", TRANSFORMED_SQL)
def ctas(t: Inputs):
    name = f"transformed_{uuid.uuid4().hex}"
    table = sinks.write_table(transformed_table(keep_nonblank(t.subscribers)), name, shared_path(t.spark, name))
    return table.withColumn("TotalCharges", F.col("TotalCharges").cast("double"))


@query("snk_metrics", f"""WITH {COMPARE_SQL} SELECT '{RUNS[1]}' AS run_ts, model, metric, value FROM compared
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1_score, specificity, roc_auc))""")
def metrics(t: Inputs):
    path = sinks.append_metrics(ev.compare(candidates(t)), shared_path(t.spark, "metrics"), RUNS[1])
    return readers.latest_run(t.spark, path)


@query("snk_predictions", f"""SELECT * EXCLUDE (p), CASE WHEN p >= 5 THEN 1 ELSE 0 END AS predicted_churn,
  CASE WHEN p >= 5 THEN 'Churn' ELSE 'No Churn' END AS prediction_label, p / 10.0::DOUBLE AS churn_probability,
  CASE WHEN p >= 7 THEN 'High Risk' WHEN p >= 5 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category
FROM (SELECT *, {POINTS_SQL} AS p FROM subscribers)""")
def predictions(t: Inputs):
    """Input columns with the prediction beside them: added by expression, never joined."""
    scored = t.subscribers.withColumn("churn_probability", scoring.risk_score(EVENT_FIELDS)).select(
        *SUBSCRIBER.names,
        F.when(F.col("churn_probability") >= 0.5, 1).otherwise(0).alias("predicted_churn"),
        F.when(F.col("churn_probability") >= 0.5, "Churn").otherwise("No Churn").alias("prediction_label"),
        "churn_probability",
        scoring.batch_category(F.col("churn_probability")).alias("risk_category"),
    )
    path = sinks.write_predictions(scored, shared_path(t.spark, "predictions"))
    return readers.read_csv(t.spark, path, scored.schema)


@query("snk_dashboard", f"""SELECT 'churn_distribution' AS report, 2::BIGINT AS rows, count(*) AS customers FROM subscribers
UNION ALL SELECT 'contract_distribution', count(DISTINCT Contract), count(*) FROM subscribers
UNION ALL SELECT 'tenure_buckets', 5, count(*) FROM subscribers
UNION ALL SELECT 'payment_methods', count(DISTINCT PaymentMethod), count(*) FROM subscribers
UNION ALL SELECT 'internet_service', count(DISTINCT InternetService), count(*) FROM subscribers
UNION ALL SELECT 'monthly_charges_bins', 5, count(*) FROM subscribers""")
def dashboard(t: Inputs):
    """All six exports written, then counted from their files."""
    rows = dashboard_rows(t.stored_subscribers())
    reports = {
        "churn_distribution": (x_distribution(rows), "value"),
        "contract_distribution": (x_by(rows, "Contract", "contract"), "total_customers"),
        "tenure_buckets": (x_tenure(rows), "customers"),
        "payment_methods": (x_by(rows, "PaymentMethod", "method"), "total_customers"),
        "internet_service": (x_internet(rows), "total_customers"),
        "monthly_charges_bins": (charge_bins(rows), "count"),
    }
    paths = sinks.write_reports({k: df for k, (df, _) in reports.items()}, shared_path(t.spark, "dashboard"))
    counted = [
        readers.read_csv(t.spark, paths[k], df.schema).agg(
            F.lit(k).alias("report"), F.count(F.lit(1)).alias("rows"), F.sum(c).alias("customers")
        )
        for k, (df, c) in reports.items()
    ]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out
