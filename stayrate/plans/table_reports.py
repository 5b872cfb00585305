"""Table reports: notebook summaries, verifier numbers, dashboard exports, plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS
from stayrate.functions.columns import mean, percent, total
from stayrate.functions.longform import unpivot_strings
from stayrate.operators.aggregate import (
    box_numbers,
    bucket_report,
    by_rate,
    charge_bins,
    churn_by,
    churn_rate,
    churned,
    crosstab,
    histogram,
    retained,
    revenue_impact,
    row_shares,
    share,
)
from stayrate.operators.cleaning import churn_flag, fill_charges, numeric_totals
from stayrate.plans import base_sql as b
from stayrate.plans.base_sql import CHURNED, RETAINED, money, rate
from stayrate.plans.registry import Inputs, query
from stayrate.plans.sql_reports import bucket_sql
from stayrate.schema import CATEGORICAL, NUMERIC, TARGET


@query("agg_dist_pct", """SELECT Churn, count(*) AS total_customers,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage FROM clean GROUP BY Churn""")
def distribution(t: Inputs):
    grouped = t.clean.groupBy(TARGET).agg(F.count(F.lit(1)).alias("total_customers"))
    return share(grouped, "total_customers", "percentage")


@query("win_share", """SELECT PaymentMethod, monthly, round(monthly * 100.0 / sum(monthly) OVER (), 2) AS share_percent FROM (
  SELECT PaymentMethod, CAST(sum(CAST(MonthlyCharges AS DECIMAL(18,2))) AS DOUBLE) AS monthly FROM clean GROUP BY 1)""")
def revenue_share(t: Inputs):
    grouped = t.clean.groupBy("PaymentMethod").agg(total("MonthlyCharges").alias("monthly"))
    return share(grouped, "monthly", "share_percent")


@query("agg_nb_contract", f"""SELECT Contract, count(*) AS total_customers, {CHURNED} AS churned, {RETAINED} AS retained,
  {rate()} AS churn_rate FROM clean GROUP BY Contract""")
def nb_contract(t: Inputs):
    return by_rate(churn_by(t.clean, ["Contract"], extra=[retained().alias("retained")]), "Contract")


@query("agg_nb_internet", f"""SELECT InternetService, count(*) AS total_customers, {CHURNED} AS churned,
  {b.mean('MonthlyCharges')} AS avg_monthly_charges, {rate()} AS churn_rate FROM clean GROUP BY InternetService""")
def nb_internet(t: Inputs):
    extra = [mean("MonthlyCharges").alias("avg_monthly_charges")]
    return by_rate(churn_by(t.clean, ["InternetService"], extra=extra), "InternetService")


@query("agg_nb_payment", f"""SELECT PaymentMethod, count(*) AS total_customers, {CHURNED} AS churned,
  {b.mean('MonthlyCharges', 6)} AS avg_monthly, {b.mean('TotalCharges', 6)} AS avg_total, {rate()} AS churn_rate
FROM clean GROUP BY PaymentMethod""")
def nb_payment(t: Inputs):
    extra = [mean("MonthlyCharges", 6).alias("avg_monthly"), mean("TotalCharges", 6).alias("avg_total")]
    return by_rate(churn_by(t.clean, ["PaymentMethod"], extra=extra), "PaymentMethod")


@query("agg_nb_revenue", f"""SELECT Churn, count(*) AS customer_count, {money('MonthlyCharges')} AS total_monthly_revenue,
  {b.mean('MonthlyCharges')} AS avg_monthly_charges, {money('TotalCharges')} AS total_lifetime_revenue,
  round(avg(tenure), 1) AS avg_tenure,
  CASE WHEN Churn = 'Yes' THEN {money('MonthlyCharges')} ELSE 0.0 END AS monthly_at_risk,
  CASE WHEN Churn = 'Yes' THEN round({money('MonthlyCharges')} * 12, 2) ELSE 0.0 END AS annual_at_risk
FROM clean GROUP BY Churn""")
def nb_revenue(t: Inputs):
    grouped = t.clean.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("customer_count"),
        total("MonthlyCharges").alias("total_monthly_revenue"),
        mean("MonthlyCharges").alias("avg_monthly_charges"),
        total("TotalCharges").alias("total_lifetime_revenue"),
        F.round(F.avg("tenure"), 1).alias("avg_tenure"),
    )
    at_risk = F.when(F.col(TARGET) == "Yes", F.col("total_monthly_revenue")).otherwise(0.0)
    return grouped.withColumns({"monthly_at_risk": at_risk, "annual_at_risk": F.round(at_risk * 12, 2)})


@query("agg_nb_tenure", f"""SELECT {bucket_sql('nb4')} AS tenure_bucket, count(*) AS total_customers,
  {CHURNED} AS churned, {rate()} AS churn_rate FROM clean GROUP BY 1""")
def nb_tenure(t: Inputs):
    return by_rate(churn_by(t.clean, [BUCKETS["nb4"].expr().alias("tenure_bucket")]), "tenure_bucket")


@query("agg_nb_summary", f"""WITH s AS (SELECT
    (SELECT count(*) FROM subscribers)::DOUBLE AS original_records, count(*)::DOUBLE AS cleaned_records,
    (SELECT count(*) FROM subscribers)::DOUBLE - count(*) AS records_removed, {rate()} AS churn_rate,
    ({CHURNED})::DOUBLE AS churned_customers, ({RETAINED})::DOUBLE AS retained_customers,
    {money('MonthlyCharges')} AS total_monthly_revenue, {b.mean('MonthlyCharges')} AS avg_monthly_charges,
    {money('TotalCharges')} AS total_lifetime_revenue FROM clean)
SELECT metric, value FROM s UNPIVOT (value FOR metric IN (original_records, cleaned_records, records_removed, churn_rate,
  churned_customers, retained_customers, total_monthly_revenue, avg_monthly_charges, total_lifetime_revenue))""")
def nb_summary(t: Inputs):
    # One pass: a row was cleaned away exactly when its total could not be read.
    raw = numeric_totals(t.subscribers)
    kept = F.col("TotalCharges").isNotNull()
    rows, clean = F.count(F.lit(1)), F.count("TotalCharges")
    lost = F.count_if(kept & (F.col(TARGET) == "Yes"))
    monthly = total(F.when(kept, F.col("MonthlyCharges")))
    row = raw.agg(
        rows.cast("double").alias("original_records"),
        clean.cast("double").alias("cleaned_records"),
        (rows - clean).cast("double").alias("records_removed"),
        percent(lost, clean).alias("churn_rate"),
        lost.cast("double").alias("churned_customers"),
        F.count_if(kept & (F.col(TARGET) == "No")).cast("double").alias("retained_customers"),
        monthly.alias("total_monthly_revenue"),
        F.round(F.try_divide(monthly, clean), 2).alias("avg_monthly_charges"),
        total("TotalCharges").alias("total_lifetime_revenue"),
    )
    return row.unpivot([], row.columns, "metric", "value")


@query("agg_revenue_impact", f"""SELECT {money('TotalCharges')} AS historical_loss,
  round({money('MonthlyCharges')} * 12, 2) AS projected_loss_12m,
  round({money('MonthlyCharges')} * 12 * 0.10::DOUBLE, 2) AS savings_10_percent FROM clean WHERE Churn = 'Yes'""")
def impact(t: Inputs):
    return revenue_impact(t.clean)


@query("agg_v_overall", f"""SELECT count(*) AS total_customers, {rate()} AS churn_rate,
  {b.mean('MonthlyCharges')} AS avg_monthly_revenue, {CHURNED} AS churned FROM clean""")
def v_overall(t: Inputs):
    return t.clean.agg(
        F.count(F.lit(1)).alias("total_customers"),
        churn_rate().alias("churn_rate"),
        mean("MonthlyCharges").alias("avg_monthly_revenue"),
        churned().alias("churned"),
    )


DIMENSIONS = ["Contract", "PaymentMethod", "InternetService"]


@query("agg_v_dim", " UNION ALL ".join(
    f"""SELECT '{c}' AS dimension, {c} AS level, count(*) AS total_customers, {CHURNED} AS churned,
  {rate(1)} AS churn_rate FROM clean GROUP BY {c}""" for c in DIMENSIONS))
def v_dimensions(t: Inputs):
    long = unpivot_strings(t.clean, DIMENSIONS, [TARGET])
    keys = [F.col("column").alias("dimension"), F.col("value").alias("level")]
    return churn_by(long, keys, digits=1).orderBy("dimension", "level")


def bucket_report_sql(name: str, key: str) -> str:
    spec = BUCKETS[name]
    values = ", ".join(f"({i}, '{v}')" for i, v in enumerate(spec.all_labels()))
    return f"""WITH o(rank, {key}) AS (VALUES {values}), g AS (SELECT {bucket_sql(name)} AS {key},
  count(*) AS total_customers, {CHURNED} AS churned, {rate(1)} AS churn_rate FROM clean GROUP BY 1)
SELECT {key}, coalesce(total_customers, 0) AS total_customers, coalesce(churned, 0) AS churned,
  coalesce(churn_rate, 0.0::DOUBLE) AS churn_rate FROM o LEFT JOIN g USING ({key}) ORDER BY rank"""


@query("agg_v_tenure", bucket_report_sql("v", "tenure_bucket"))
def v_tenure(t: Inputs):
    return bucket_report(t.clean, BUCKETS["v"], "tenure_bucket")


@query("agg_v_charges", bucket_report_sql("chg_v", "charge_bucket"))
def v_charges(t: Inputs):
    return bucket_report(t.clean, BUCKETS["chg_v"], "charge_bucket")


# --- dashboard exports: raw population, loosely read labels, one decimal -------------------

# Chart colours.
COLOURS = {"Retained": "#4ecdc4", "Churned": "#ff6b6b"}
SERVICE_COLOURS = (("Fiber", "#ff6b6b"), ("DSL", "#4ecdc4"), (None, "#ffd93d"))


def dashboard_rows(df):
    """Charges and tenure filled, churn label normalised to Yes/No."""
    return churn_flag(fill_charges(df)).withColumn(
        TARGET, F.when(F.col("ChurnFlag") == 1, "Yes").otherwise("No")
    )


def x_distribution(df):
    row = df.agg(retained().alias("Retained"), churned().alias("Churned"))
    long = row.unpivot([], ["Retained", "Churned"], "label", "value")
    colour = F.when(F.col("label") == "Retained", COLOURS["Retained"]).otherwise(COLOURS["Churned"])
    return long.withColumn("color", colour)


def x_by(df, key: str, name: str):
    return churn_by(
        df, [F.col(key).alias(name)], extra=[retained().alias("retained")], digits=1, rate="churnRate"
    ).orderBy(name)


def x_internet(df):
    service = F.coalesce(F.col("service"), F.lit(""))
    (fiber, red), (dsl, teal), (_, yellow) = SERVICE_COLOURS
    colour = F.when(service.contains(fiber), red).when(service.contains(dsl), teal).otherwise(yellow)
    return x_by(df, "InternetService", "service").withColumn("color", colour)


def x_tenure(df):
    report = bucket_report(df, BUCKETS["x"], "tenure")
    return report.select("tenure", F.col("total_customers").alias("customers"), F.col("churn_rate").alias("churnRate"))


@query("agg_x_dist", f"""SELECT 'Retained' AS label, {RETAINED} AS value, '#4ecdc4' AS color FROM subscribers
UNION ALL SELECT 'Churned', {CHURNED}, '#ff6b6b' FROM subscribers""")
def export_distribution(t: Inputs):
    return x_distribution(dashboard_rows(t.subscribers))


def x_sql(key: str, name: str, extra: str = "") -> str:
    return f"""SELECT {key} AS {name}, count(*) AS total_customers, {CHURNED} AS churned, {RETAINED} AS retained,
  {rate(1)} AS "churnRate" {extra} FROM subscribers GROUP BY {key}"""


@query("agg_x_contract", x_sql("Contract", "contract"))
def export_contract(t: Inputs):
    return x_by(dashboard_rows(t.subscribers), "Contract", "contract")


@query("agg_x_payment", x_sql("PaymentMethod", "method"))
def export_payment(t: Inputs):
    return x_by(dashboard_rows(t.subscribers), "PaymentMethod", "method")


@query("agg_x_internet", x_sql("InternetService", "service", """, CASE WHEN InternetService LIKE '%Fiber%' THEN '#ff6b6b'
  WHEN InternetService LIKE '%DSL%' THEN '#4ecdc4' ELSE '#ffd93d' END AS color"""))
def export_internet(t: Inputs):
    return x_internet(dashboard_rows(t.subscribers))


@query("agg_x_tenure", f"""WITH o(rank, tenure) AS (VALUES (0, '0-12'), (1, '13-24'), (2, '25-48'), (3, '49-60'), (4, '61-72')),
g AS (SELECT CASE WHEN tenure BETWEEN 0 AND 12 THEN '0-12' WHEN tenure BETWEEN 13 AND 24 THEN '13-24'
  WHEN tenure BETWEEN 25 AND 48 THEN '25-48' WHEN tenure BETWEEN 49 AND 60 THEN '49-60'
  WHEN tenure BETWEEN 61 AND 9999 THEN '61-72' END AS label, count(*) AS n, {rate(1)} AS r FROM subscribers GROUP BY 1)
SELECT tenure, coalesce(n, 0) AS customers, coalesce(r, 0.0::DOUBLE) AS "churnRate"
FROM o LEFT JOIN g ON label = tenure""")
def export_tenure(t: Inputs):
    return x_tenure(dashboard_rows(t.subscribers))


def bin_sql(column: str, bins: int, op: str) -> str:
    return " + ".join(
        f"CAST({column} {op} (hi - lo) / {bins}.0::DOUBLE * {i}.0::DOUBLE + lo AS INTEGER)" for i in range(1, bins)
    )


@query("agg_x_bins", f"""WITH e AS (SELECT min(MonthlyCharges) AS lo, max(MonthlyCharges) AS hi FROM subscribers),
g AS (SELECT {bin_sql('MonthlyCharges', 5, '>')} AS bin, count(*) AS n, {rate(1)} AS r FROM subscribers, e GROUP BY 1)
SELECT CAST(CAST(round(CASE WHEN i = 0 THEN lo - (hi - lo) * 0.001::DOUBLE ELSE lo + (hi - lo) / 5.0::DOUBLE * i END, 2) AS DECIMAL(18,2)) AS VARCHAR)
  || '-' || CAST(CAST(round(lo + (hi - lo) / 5.0::DOUBLE * (i + 1), 2) AS DECIMAL(18,2)) AS VARCHAR) AS range,
  coalesce(n, 0) AS count, coalesce(r, 0.0::DOUBLE) AS "avgChurn"
FROM e, range(5) x(i) LEFT JOIN g ON bin = i""")
def export_bins(t: Inputs):
    return charge_bins(dashboard_rows(t.stored_subscribers("tenure", "MonthlyCharges", TARGET)))


# --- plot data ------------------------------------------------------------------------------


@query("agg_crosstab", f"""SELECT Contract, {RETAINED} AS "No", {CHURNED} AS "Yes" FROM subscribers GROUP BY Contract""")
def contract_crosstab(t: Inputs):
    return crosstab(t.subscribers, "Contract")


@query("agg_crosstab_share", f"""SELECT Contract, round({RETAINED} / count(*), 4) AS "No",
  round({CHURNED} / count(*), 4) AS "Yes" FROM subscribers GROUP BY Contract""")
def contract_shares(t: Inputs):
    return row_shares(crosstab(t.subscribers, "Contract"), "Contract")


def hist_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", bin, Churn, count(*) AS n FROM (SELECT {bin_sql(column, 30, '>=')} AS bin, Churn
  FROM (SELECT {column}::DOUBLE AS {column}, Churn FROM clean),
       (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM clean)) GROUP BY bin, Churn"""


@query("agg_hist", " UNION ALL ".join(hist_sql(c) for c in NUMERIC))
def histograms(t: Inputs):
    return histogram(t.stored_clean(*NUMERIC, TARGET), NUMERIC)


def box_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", Churn, round(min(q1), 6) AS q1, round(min(q2), 6) AS median, round(min(q3), 6) AS q3,
  min(x) FILTER (WHERE x >= q1 - (q3 - q1) * 1.5 AND x <= q3 + (q3 - q1) * 1.5) AS lower_whisker,
  max(x) FILTER (WHERE x >= q1 - (q3 - q1) * 1.5 AND x <= q3 + (q3 - q1) * 1.5) AS upper_whisker,
  count(*) FILTER (WHERE NOT (x >= q1 - (q3 - q1) * 1.5 AND x <= q3 + (q3 - q1) * 1.5)) AS outliers
FROM (SELECT Churn, {column}::DOUBLE AS x, quantile_cont({column}::DOUBLE, 0.25) OVER (PARTITION BY Churn) AS q1,
  quantile_cont({column}::DOUBLE, 0.5) OVER (PARTITION BY Churn) AS q2,
  quantile_cont({column}::DOUBLE, 0.75) OVER (PARTITION BY Churn) AS q3 FROM clean) GROUP BY Churn"""


@query("agg_box", " UNION ALL ".join(box_sql(c) for c in NUMERIC))
def boxes(t: Inputs):
    rounded = {c: F.round(c, 6) for c in ("q1", "median", "q3")}
    return box_numbers(t.stored_clean(*NUMERIC, TARGET), NUMERIC).withColumns(rounded)


@query("agg_count_by_hue", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, Churn, count(*) AS n FROM subscribers GROUP BY {c}, Churn"""
    for c in CATEGORICAL))
def counts_by_hue(t: Inputs):
    long = unpivot_strings(t.subscribers, CATEGORICAL, [TARGET])
    return long.groupBy("column", "value", TARGET).agg(F.count(F.lit(1)).alias("n"))
