"""Validation, profiling, cleaning, projection and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions.columns import is_blank
from stayrate.operators import cleaning, quality
from stayrate.plans.registry import Inputs, query
from stayrate.schema import CATEGORICAL, NUMERIC, ROLES, SUBSCRIBER

COLUMNS = [f.name for f in SUBSCRIBER.fields]
TEXT = [f.name for f in SUBSCRIBER.fields if f.dataType.simpleString() == "string"]


@query("val_required", "SELECT 'required_columns' AS check, 'ok' AS status, '' AS detail, count(*) AS rows FROM subscribers")
def required(t: Inputs):
    return quality.required_check(t.subscribers)


@query("val_empty", "SELECT count(*) AS rows, count(*) = 0 AS is_empty FROM subscribers")
def empty(t: Inputs):
    return quality.empty_check(t.subscribers)


DUPS = "(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {0})) FROM {0})"


@query("val_dups", f"SELECT {DUPS.format('subscribers')} AS duplicate_rows")
def duplicates(t: Inputs):
    return quality.duplicate_rows(t.subscribers)


@query("val_dups_profile", f"""WITH profile AS (SELECT gender, SeniorCitizen, Partner, Dependents, tenure, Contract FROM subscribers)
SELECT {DUPS.format('profile')} AS duplicate_rows""")
def duplicate_profiles(t: Inputs):
    """The same count on a projection that does repeat."""
    return quality.duplicate_rows(t.subscribers.select("gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "Contract"))


NULLS = " + ".join(f"count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '')" for c in COLUMNS)


@query("val_missing_pct", f"""SELECT CAST({NULLS} AS BIGINT) AS missing_cells, count(*) * 21 AS cells,
  round(({NULLS}) * 100.0 / (count(*) * 21), 4) AS missing_percent FROM subscribers""")
def missing_pct(t: Inputs):
    return quality.missing_percent(cleaning.trim_strings(t.subscribers))


@query("val_report", f"""WITH f AS (SELECT count(*) AS n, {DUPS.format('subscribers')} AS d FROM subscribers)
SELECT 'required_columns' AS check, 'ok' AS status, '' AS detail FROM f
UNION ALL SELECT 'empty', CASE WHEN n = 0 THEN 'error' ELSE 'ok' END, n || ' rows' FROM f
UNION ALL SELECT 'duplicates', CASE WHEN d > 0 THEN 'warning' ELSE 'ok' END, d || ' duplicate rows' FROM f
UNION ALL SELECT 'missing', 'ok', '0.0% missing' FROM f""")
def report(t: Inputs):
    return quality.validation_report(t.subscribers)


@query("prof_summary", """SELECT 'total_customers' AS metric, count(*)::DOUBLE AS value FROM subscribers
UNION ALL SELECT 'churn_rate', round(count(*) FILTER (WHERE Churn = 'Yes') * 100.0 / count(*), 4) FROM subscribers
UNION ALL SELECT 'avg_tenure', round(avg(tenure), 4) FROM subscribers
UNION ALL SELECT 'avg_monthly_charges', round(CAST(sum(CAST(MonthlyCharges AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) FROM subscribers
UNION ALL SELECT 'contract: ' || Contract, count(*)::DOUBLE FROM subscribers GROUP BY Contract""")
def summary(t: Inputs):
    return quality.data_summary(t.subscribers)


@query("prof_missing", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM typed""" for c in COLUMNS
).join(["WITH typed AS (SELECT * REPLACE (TRY_CAST(trim(TotalCharges) AS DOUBLE) AS TotalCharges) FROM subscribers) ", ""]))
def missing(t: Inputs):
    return quality.missing_by_column(cleaning.numeric_totals(t.subscribers))


@query("prof_missing_trim", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS n_missing FROM subscribers"""
    for c in TEXT) + ") WHERE n_missing > 0")
def missing_trimmed(t: Inputs):
    return quality.missing_after_trim(t.subscribers)


@query("prof_blank", "SELECT count(*) FILTER (WHERE trim(TotalCharges) = '') AS blank_totals FROM subscribers")
def blanks(t: Inputs):
    return t.subscribers.agg(F.count_if(is_blank("TotalCharges")).alias("blank_totals"))


@query("prof_explore", """WITH f AS (SELECT count(*)::DOUBLE AS n, (count(*) FILTER (WHERE Churn = 'Yes'))::DOUBLE AS y,
  (count(*) FILTER (WHERE Churn = 'No'))::DOUBLE AS x FROM clean)
SELECT 'rows' AS metric, n AS value FROM f UNION ALL SELECT 'columns', 21.0::DOUBLE
UNION ALL SELECT 'target: Yes', y FROM f UNION ALL SELECT 'target: No', x FROM f
UNION ALL SELECT 'churn_rate', round(y * 100.0 / n, 2) FROM f""" + "".join(
    f" UNION ALL SELECT 'missing: {c}', 0.0::DOUBLE" for c in COLUMNS))
def explore(t: Inputs):
    return quality.explore(t.clean)


@query("prof_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 2) AS mean, round(min({c})::DOUBLE, 2) AS min,
  round(max({c})::DOUBLE, 2) AS max, round(stddev_samp({c}), 2) AS std FROM clean""" for c in NUMERIC))
def numeric(t: Inputs):
    return quality.numeric_profile(t.clean)


@query("prof_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
  round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75 FROM clean"""
    for c in NUMERIC))
def describe(t: Inputs):
    return quality.describe(t.stored_clean(*NUMERIC))


@query("prof_schema", """SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name,
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type,
  "null" = 'YES' AS is_nullable FROM (DESCRIBE orders)""", base=False)
def schema(t: Inputs):
    return quality.schema_rows(t.table("orders"))


@query("prof_valuecounts", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM subscribers GROUP BY {c}"""
    for c in CATEGORICAL))
def value_counts(t: Inputs):
    return quality.value_counts(t.subscribers, CATEGORICAL)


@query("prof_imbalance", """WITH g AS (SELECT Churn, count(*) AS n FROM subscribers GROUP BY Churn)
SELECT (SELECT Churn FROM g ORDER BY n DESC, Churn DESC LIMIT 1) AS majority,
  (SELECT Churn FROM g ORDER BY n, Churn LIMIT 1) AS minority, round(max(n) / min(n), 4) AS ratio FROM g""")
def imbalance(t: Inputs):
    return quality.imbalance(t.subscribers)


# --- projections ----------------------------------------------------------------------------


@query("prj_drop", "SELECT * EXCLUDE (customerID) FROM subscribers")
def drop(t: Inputs):
    return cleaning.drop_id(t.subscribers)


@query("prj_select_roles", f"""SELECT customerID, {', '.join(dict.fromkeys(ROLES['numeric'] + ROLES['demographic'] + ROLES['financial']))}
FROM subscribers""")
def roles(t: Inputs):
    return cleaning.select_roles(t.subscribers, "id", "numeric", "demographic", "financial")


@query("prj_select_types", "SELECT customerID, SeniorCitizen, tenure, MonthlyCharges FROM subscribers")
def by_type(t: Inputs):
    return t.subscribers.select("customerID", *cleaning.numeric_columns(t.subscribers))


@query("prj_rename", """SELECT customerID AS id, Contract AS contract, PaymentMethod AS method, InternetService AS service
FROM subscribers""")
def rename(t: Inputs):
    names = {"customerID": "id", "Contract": "contract", "PaymentMethod": "method", "InternetService": "service"}
    return t.subscribers.select(*names).withColumnsRenamed(names)


@query("prj_target_last", "SELECT customerID, tenure, MonthlyCharges, Churn FROM subscribers")
def last(t: Inputs):
    return cleaning.target_last(t.subscribers.select("customerID", "Churn", "tenure", "MonthlyCharges"))


ALIGNED = ["customerID", "tenure", "MonthlyCharges", "charges_per_service", "is_fiber"]


@query("prj_align", """SELECT customerID, tenure, MonthlyCharges, 0 AS charges_per_service, 0 AS is_fiber FROM subscribers""")
def align(t: Inputs):
    return cleaning.align_to(t.subscribers, ALIGNED)


# --- filters --------------------------------------------------------------------------------


@query("flt_compare", """SELECT customerID, tenure, MonthlyCharges FROM subscribers
WHERE Contract = 'Month-to-month' AND InternetService = 'Fiber optic' AND tenure < 12""")
def compare(t: Inputs):
    return t.subscribers.where(
        (F.col("Contract") == "Month-to-month") & (F.col("InternetService") == "Fiber optic") & (F.col("tenure") < 12)
    ).select("customerID", "tenure", "MonthlyCharges")


@query("flt_neq", "SELECT customerID, InternetService FROM subscribers WHERE InternetService != 'No'")
def not_equal(t: Inputs):
    return t.subscribers.where(F.col("InternetService") != "No").select("customerID", "InternetService")


@query("flt_subset", "SELECT customerID, MonthlyCharges FROM subscribers WHERE Churn = 'Yes'")
def subset(t: Inputs):
    return t.subscribers.where(F.col("Churn") == "Yes").select("customerID", "MonthlyCharges")


@query("flt_range", "SELECT customerID, tenure FROM subscribers WHERE tenure >= 13 AND tenure <= 24")
def between(t: Inputs):
    return t.subscribers.where(F.col("tenure").between(13, 24)).select("customerID", "tenure")


@query("flt_dropna", "SELECT customerID, TotalCharges FROM clean")
def dropna_subset(t: Inputs):
    return cleaning.numeric_totals(t.subscribers).dropna(subset=["TotalCharges"]).select("customerID", "TotalCharges")


@query("flt_dropna_any", "SELECT * FROM subscribers WHERE trim(TotalCharges) != ''")
def dropna_any(t: Inputs):
    return cleaning.trim_strings(t.subscribers).dropna("any")


@query("flt_nonblank", "SELECT customerID, TotalCharges FROM subscribers WHERE trim(TotalCharges) != ''")
def nonblank(t: Inputs):
    return cleaning.keep_nonblank(t.subscribers).select("customerID", "TotalCharges")


# --- cleaning -------------------------------------------------------------------------------


@query("cln_numeric", "SELECT customerID, TRY_CAST(trim(TotalCharges) AS DOUBLE) AS TotalCharges FROM subscribers")
def to_numbers(t: Inputs):
    return cleaning.numeric_totals(t.subscribers).select("customerID", "TotalCharges")


@query("cln_trim_null", f"""SELECT SeniorCitizen, tenure, MonthlyCharges, {', '.join(f"nullif(trim({c}), '') AS {c}" for c in TEXT)}
FROM subscribers""")
def trim_null(t: Inputs):
    return cleaning.trim_strings(t.subscribers)


@query("cln_fill", """SELECT customerID, CAST(coalesce(tenure, 0) AS INTEGER) AS tenure,
  coalesce(MonthlyCharges, 0.0::DOUBLE) AS MonthlyCharges FROM subscribers""")
def fill(t: Inputs):
    return cleaning.fill_charges(t.subscribers).select("customerID", "tenure", "MonthlyCharges")


@query("cln_flag", """SELECT customerID, CASE WHEN lower(trim(Churn)) = 'yes' THEN 1 ELSE 0 END AS "ChurnFlag" FROM subscribers""")
def churn_flags(t: Inputs):
    return cleaning.churn_flag(t.subscribers).select("customerID", "ChurnFlag")


@query("cln_senior", """SELECT customerID, CASE WHEN SeniorCitizen = 1 THEN 'Yes' ELSE 'No' END AS "SeniorCitizen" FROM subscribers""")
def senior(t: Inputs):
    return cleaning.senior_text(t.subscribers).select("customerID", "SeniorCitizen")


@query("cln_any", "SELECT * EXCLUDE (customerID) FROM clean")
def clean_any(t: Inputs):
    return cleaning.clean_any(t.subscribers)


@query("cln_subset", """SELECT * EXCLUDE (customerID) REPLACE (CASE WHEN SeniorCitizen = 1 THEN 'Yes' ELSE 'No' END AS SeniorCitizen)
FROM clean""")
def clean_subset(t: Inputs):
    return cleaning.clean_subset(t.subscribers)


@query("cln_rows_removed", """SELECT count(*) AS rows_before, (SELECT count(*) FROM clean) AS rows_after,
  count(*) - (SELECT count(*) FROM clean) AS rows_removed FROM subscribers""")
def rows_removed(t: Inputs):
    return cleaning.rows_removed(t.subscribers)
