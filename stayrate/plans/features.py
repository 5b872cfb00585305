"""Bucket and derived-feature queries, one row per subscriber."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions import columns as c
from stayrate.functions.buckets import BUCKETS, equal_width_bin
from stayrate.operators import features as fe
from stayrate.operators.aggregate import extents
from stayrate.plans.registry import Inputs, query
from stayrate.plans.sql_reports import ADOPTION_SQL, bucket_sql
from stayrate.plans.table_reports import bin_sql
from stayrate.schema import PREMIUM, SERVICES, STREAMING


def register_bucket(name: str) -> None:
    spec = BUCKETS[name]

    @query(f"bkt_{name}", f"SELECT customerID, {spec.column}, {bucket_sql(name)} AS bucket FROM subscribers")
    def bucket(t: Inputs):
        return t.subscribers.select("customerID", spec.column, spec.expr().alias("bucket"))


for _name in BUCKETS:
    register_bucket(_name)


@query("bkt_width", f"""SELECT customerID, MonthlyCharges, {bin_sql('MonthlyCharges', 8, '>')} AS bucket
FROM subscribers, (SELECT min(MonthlyCharges) AS lo, max(MonthlyCharges) AS hi FROM subscribers)""")
def width_bucket(t: Inputs, bins: int = 8):
    rows = t.stored_subscribers("customerID", "MonthlyCharges")
    low, high = extents(rows, ["MonthlyCharges"])["MonthlyCharges"]
    return rows.select(
        "customerID", "MonthlyCharges", equal_width_bin("MonthlyCharges", low, high, bins).alias("bucket")
    )


def register(name: str, sql_columns: str, build, source: str = "clean") -> None:
    """A query that projects the id and derived columns."""

    @query(name, f"SELECT customerID, {sql_columns} FROM {source}")
    def project(t: Inputs):
        df = t.clean if source == "clean" else t.subscribers
        new = build(df)
        return df.select("customerID", *[v.alias(k) for k, v in new.items()])


TENURE_SQL = f"""{bucket_sql('fe')} AS tenure_bucket, tenure / 12.0::DOUBLE AS tenure_years,
  (tenure <= 6)::INT AS is_new_customer, (tenure > 48)::INT AS is_loyal_customer"""
MEDIAN_SQL = "(MonthlyCharges > (SELECT median(MonthlyCharges) FROM clean))::INT"
FINANCE_SQL = f"""{bucket_sql('chg_fe')} AS charges_bucket, TotalCharges / (tenure + 1) AS avg_charges_per_tenure,
  TotalCharges - MonthlyCharges * tenure AS charges_difference, {MEDIAN_SQL} AS is_high_value"""


def count_sql(columns=SERVICES) -> str:
    return " + ".join(f"({x} IN ('Yes', 'DSL', 'Fiber optic'))::INT" for x in columns)


def any_sql(columns) -> str:
    return "(" + " OR ".join(f"{x} = 'Yes'" for x in columns) + ")::INT"


SERVICE_SQL = f"""{count_sql()} AS total_services, (InternetService != 'No')::INT AS has_internet,
  (PhoneService = 'Yes')::INT AS has_phone, {any_sql(PREMIUM)} AS has_premium_services, {any_sql(STREAMING)} AS has_streaming"""
RISK_SQL = "CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 END"
PAY_SQL = """CASE PaymentMethod WHEN 'Electronic check' THEN 3 WHEN 'Mailed check' THEN 2
  WHEN 'Bank transfer (automatic)' THEN 1 WHEN 'Credit card (automatic)' THEN 1 END"""
CONTRACT_SQL = f"""{RISK_SQL} AS contract_risk_score, (Contract = 'Month-to-month')::INT AS is_month_to_month,
  {PAY_SQL} AS payment_risk_score, (lower(PaymentMethod) LIKE '%automatic%')::INT AS is_auto_payment"""
PEOPLE_SQL = """(Partner = 'Yes' OR Dependents = 'Yes')::INT AS has_family,
  (SeniorCitizen = 1 AND Partner = 'No' AND Dependents = 'No')::INT AS is_single_senior"""


def pick(group, *names):
    return lambda df: {n: group()[n] for n in names}


register("fe_tenure_years", "tenure / 12.0::DOUBLE AS tenure_years", pick(fe.tenure_features, "tenure_years"))
register("fe_is_new", "(tenure <= 6)::INT AS is_new_customer", pick(fe.tenure_features, "is_new_customer"))
register("fe_is_loyal", "(tenure > 48)::INT AS is_loyal_customer", pick(fe.tenure_features, "is_loyal_customer"))
register("fe_avg_charge_p1", "TotalCharges / (tenure + 1) AS avg_charges", lambda df: {"avg_charges": fe.charge_per_month()})
register(
    "fe_avg_charge_guard",
    "CASE WHEN tenure > 0 THEN TRY_CAST(trim(TotalCharges) AS DOUBLE) / tenure ELSE MonthlyCharges END AS avg_charges",
    lambda df: {
        "avg_charges": F.when(F.col("tenure") > 0, F.try_divide(c.to_number("TotalCharges"), F.col("tenure"))).otherwise(
            F.col("MonthlyCharges")
        )
    },
    "subscribers",
)
register("fe_charge_diff", "TotalCharges - MonthlyCharges * tenure AS charges_difference", lambda df: {"charges_difference": fe.charge_difference()})


@query("fe_high_median", f"SELECT customerID, MonthlyCharges, {MEDIAN_SQL} AS is_high_value FROM clean")
def high_median(t: Inputs):
    rows = t.stored_clean("customerID", "MonthlyCharges")
    return rows.withColumn("is_high_value", fe.above_median(rows))


register("fe_high_70", "CASE WHEN MonthlyCharges > 70 THEN 'Yes' ELSE 'No' END AS high_value_customer",
         lambda df: {"high_value_customer": fe.high_value()})
register(
    "fe_service_count",
    ", ".join(f"({x} IN ('Yes', 'DSL', 'Fiber optic'))::INT AS \"{x}_flag\"" for x in SERVICES) + f", {count_sql()} AS service_count",
    lambda df: {**fe.service_flags(), "service_count": fe.service_count()},
)
register("fe_adoption_sql", f"{ADOPTION_SQL} AS service_adoption_score", lambda df: {"service_adoption_score": fe.adoption_score()})
register("fe_has_internet", "(InternetService != 'No')::INT AS has_internet", pick(fe.service_features, "has_internet"))
register("fe_has_phone", "(PhoneService = 'Yes')::INT AS has_phone", pick(fe.service_features, "has_phone"))
register("fe_has_premium", f"{any_sql(PREMIUM)} AS has_premium_services", pick(fe.service_features, "has_premium_services"))
register("fe_has_streaming", f"{any_sql(STREAMING)} AS has_streaming", pick(fe.service_features, "has_streaming"))
register("fe_contract_risk", f"{RISK_SQL} AS contract_risk_score", pick(fe.contract_features, "contract_risk_score"))
register("fe_payment_risk", f"{PAY_SQL} AS payment_risk_score", pick(fe.contract_features, "payment_risk_score"))
register("fe_is_m2m", "(Contract = 'Month-to-month')::INT AS is_month_to_month", pick(fe.contract_features, "is_month_to_month"))
register("fe_auto_pay", "(lower(PaymentMethod) LIKE '%automatic%')::INT AS is_auto_payment", pick(fe.contract_features, "is_auto_payment"))
register("fe_pay_reliability", "CASE WHEN PaymentMethod LIKE '%automatic%' THEN 'High' ELSE 'Low' END AS payment_reliability",
         lambda df: {"payment_reliability": fe.payment_reliability()})
register("fe_has_family", "(Partner = 'Yes' OR Dependents = 'Yes')::INT AS has_family", pick(fe.demographic_features, "has_family"))
register("fe_single_senior", "(SeniorCitizen = 1 AND Partner = 'No' AND Dependents = 'No')::INT AS is_single_senior",
         pick(fe.demographic_features, "is_single_senior"))
register("fe_churn_flag", "(Churn = 'Yes')::INT AS churn_flag", lambda df: {"churn_flag": c.is_yes("Churn")})

RECODED = [x for x in SERVICES if x != "InternetService"]
ADOPT_NB_SQL = f"({' + '.join(f'({x} = {chr(39)}Yes{chr(39)})::INT' for x in RECODED)} + (InternetService != 'No')::INT)"
PER_SERVICE_SQL = f"CASE WHEN {ADOPT_NB_SQL} > 0 THEN MonthlyCharges / {ADOPT_NB_SQL} ELSE 0.0::DOUBLE END"


@query("fe_adoption_nb2", f"""SELECT customerID, (InternetService != 'No')::INT AS "HasInternetService",
  {', '.join(f'({x} = {chr(39)}Yes{chr(39)})::INT AS {x}' for x in RECODED)}, {ADOPT_NB_SQL} AS "ServiceAdoptionScore"
FROM clean""")
def adoption(t: Inputs):
    return fe.adoption_recode(t.clean).select("customerID", "HasInternetService", *RECODED, "ServiceAdoptionScore")


@query("fe_charge_per_service", f"""SELECT customerID, {PER_SERVICE_SQL} AS "AvgMonthlyChargesPerService",
  CASE WHEN lower(PaymentMethod) LIKE '%automatic%' THEN 'High' ELSE 'Low' END AS "PaymentReliability" FROM clean""")
def per_service(t: Inputs):
    return fe.adoption_recode(t.clean).select("customerID", "AvgMonthlyChargesPerService", "PaymentReliability")


@query("fe_all", f"""SELECT *, {TENURE_SQL}, {FINANCE_SQL}, {SERVICE_SQL}, {CONTRACT_SQL}, {PEOPLE_SQL} FROM clean""")
def every_feature(t: Inputs):
    return fe.all_features(t.stored_clean())


@query("fe_all_batch", f"""SELECT *, {bucket_sql('dp')} AS tenure_bucket, {bucket_sql('chg_dp')} AS charges_bucket,
  {count_sql()} AS service_count, TotalCharges / (tenure + 1) AS avg_charges_per_month, {MEDIAN_SQL} AS high_value,
  {RISK_SQL} AS contract_risk FROM clean""")
def batch_features(t: Inputs):
    return fe.batch_features(t.stored_clean())


@query("fe_all_spark", f"""SELECT *, {bucket_sql('spark4')} AS tenure_bucket,
  CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END AS avg_charges_per_tenure,
  CASE WHEN MonthlyCharges > 70 THEN 'Yes' ELSE 'No' END AS high_value_customer,
  {', '.join(f"({x} IN ('Yes', 'DSL', 'Fiber optic'))::INT AS {chr(34)}{x}_flag{chr(34)}" for x in SERVICES)},
  {count_sql()} AS service_count FROM clean""")
def spark_features(t: Inputs):
    return fe.spark_features(t.clean)


@query("agg_service_counts", f"""SELECT service_count, count(*) AS customers FROM
  (SELECT {count_sql()} AS service_count FROM clean) GROUP BY 1 ORDER BY 1""")
def service_counts(t: Inputs):
    grouped = t.clean.groupBy(fe.service_count().alias("service_count")).agg(F.count(F.lit(1)).alias("customers"))
    return grouped.orderBy("service_count")


# Every scalar function of the reports, side by side.
@query("scalars", """SELECT customerID,
  CASE WHEN SeniorCitizen = 1 THEN 'Senior' ELSE 'Non-Senior' END AS sc_case,
  nullif(trim(TotalCharges), '') AS sc_nullif,
  CAST(TRY_CAST(trim(TotalCharges) AS DECIMAL(10,2)) AS DOUBLE) AS sc_cast,
  PaymentMethod LIKE '%automatic%' AS sc_like,
  contains(PaymentMethod, 'Electronic') AS sc_contains,
  InternetService IN ('DSL', 'Fiber optic') AS sc_isin,
  CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 END AS sc_map,
  lower(trim(PaymentMethod)) AS sc_trim_lower,
  round(MonthlyCharges, 1) AS sc_round,
  CASE WHEN tenure = 0 THEN NULL ELSE least(MonthlyCharges * 2 - 1, 200.0::DOUBLE) / tenure END AS sc_arith,
  abs(MonthlyCharges - 70) AS sc_abs,
  '2024-01' AS sc_datefmt,
  'evt_' || customerID || '_1706659200000' AS sc_strfmt,
  '{"customer_id":"' || customerID || '","tenure":' || tenure || '}' AS sc_json,
  coalesce(TRY_CAST(trim(TotalCharges) AS DOUBLE), 0.0::DOUBLE) AS sc_default
FROM subscribers""")
def scalars(t: Inputs):
    tenure, charge = F.col("tenure"), F.col("MonthlyCharges")
    stamp = F.lit("2024-01-31T00:00:00").cast("timestamp_ntz")
    millis = F.unix_millis(F.to_timestamp(F.lit("2024-01-31T00:00:00+00:00")))
    return t.subscribers.select(
        "customerID",
        F.when(F.col("SeniorCitizen") == 1, "Senior").otherwise("Non-Senior").alias("sc_case"),
        c.trim_null("TotalCharges").alias("sc_nullif"),
        F.trim("TotalCharges").try_cast("decimal(10,2)").cast("double").alias("sc_cast"),
        F.col("PaymentMethod").like("%automatic%").alias("sc_like"),
        F.col("PaymentMethod").contains("Electronic").alias("sc_contains"),
        F.col("InternetService").isin("DSL", "Fiber optic").alias("sc_isin"),
        c.recode("Contract", fe.CONTRACT_RISK).alias("sc_map"),
        F.lower(F.trim("PaymentMethod")).alias("sc_trim_lower"),
        F.round(charge, 1).alias("sc_round"),
        F.try_divide(F.least(charge * 2 - 1, F.lit(200.0)), tenure).alias("sc_arith"),
        F.abs(charge - 70).alias("sc_abs"),
        F.date_format(stamp, "yyyy-MM").alias("sc_datefmt"),
        F.concat(F.lit("evt_"), "customerID", F.lit("_"), millis.cast("string")).alias("sc_strfmt"),
        F.to_json(F.struct(F.col("customerID").alias("customer_id"), "tenure")).alias("sc_json"),
        F.coalesce(c.to_number("TotalCharges"), F.lit(0.0)).alias("sc_default"),
    )
