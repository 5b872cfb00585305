"""Encoding, scaling, split and balance queries, and the joins that carry split membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS
from stayrate.operators import encoding, splitting
from stayrate.operators.cleaning import numeric_totals
from stayrate.operators.features import adoption_recode, batch_features
from stayrate.plans.features import ADOPT_NB_SQL, MEDIAN_SQL, PER_SERVICE_SQL, RECODED, RISK_SQL, count_sql
from stayrate.plans.registry import Inputs, query
from stayrate.plans.sql_reports import bucket_sql
from stayrate.schema import CATEGORICAL, NUMERIC

ONLINE_LEVELS = ["No", "No internet service", "Yes"]
# Levels of the subscriber view, sorted; the check SQL needs them spelled out.
LEVELS = {
    "gender": ["Female", "Male"],
    "SeniorCitizen": ["0", "1"],
    "Partner": ["No", "Yes"],
    "Dependents": ["No", "Yes"],
    "PhoneService": ["No", "Yes"],
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ONLINE_LEVELS,
    "OnlineBackup": ONLINE_LEVELS,
    "DeviceProtection": ONLINE_LEVELS,
    "TechSupport": ONLINE_LEVELS,
    "StreamingTV": ONLINE_LEVELS,
    "StreamingMovies": ONLINE_LEVELS,
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": ["No", "Yes"],
    "PaymentMethod": ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"],
}
MULTI = [c for c in CATEGORICAL if len(LEVELS[c]) > 2]


def dummies_sql(columns, skip: int) -> str:
    return ", ".join(
        f"""CASE WHEN CAST({c} AS VARCHAR) = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}" """ for c in columns for v in LEVELS[c][skip:]
    )


def yes_sql(column: str) -> str:
    return f"CASE {column} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS {column}"


@query("enc_binary", f"""SELECT customerID, CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS gender,
  {', '.join(yes_sql(c) for c in encoding.BINARY)}, {yes_sql('Churn')} FROM subscribers""")
def binary(t: Inputs):
    return encoding.encode_binary(t.subscribers).select("customerID", "gender", *encoding.BINARY, "Churn")


@query("enc_dummies", f"SELECT customerID, {dummies_sql(MULTI, 1)} FROM subscribers")
def dummies(t: Inputs):
    return encoding.dummies(t.stored_subscribers("customerID", *MULTI), MULTI)


@query("enc_onehot_full", f"SELECT customerID, {dummies_sql(['gender', *MULTI], 0)} FROM subscribers")
def onehot(t: Inputs):
    columns = ["gender", *MULTI]
    return encoding.onehot_full(t.stored_subscribers("customerID", *columns), columns)


def code_sql(column: str, offset: int = 0) -> str:
    cases = " ".join(f"WHEN '{v}' THEN {i + offset}" for i, v in enumerate(LEVELS[column]))
    return f"CASE CAST({column} AS VARCHAR) {cases} END AS {column}"


@query("enc_label", f"SELECT customerID, {', '.join(code_sql(c) for c in CATEGORICAL)} FROM subscribers")
def label(t: Inputs):
    return encoding.label_encode(t.stored_subscribers("customerID", *CATEGORICAL), CATEGORICAL)


@query("src_csv_factor", f"SELECT customerID, {', '.join(code_sql(c, 1) for c in MULTI)} FROM subscribers")
def factor(t: Inputs):
    """Factor codes count from one."""
    return encoding.label_encode(t.stored_subscribers("customerID", *MULTI), MULTI, offset=1)


@query("win_label_code", " UNION ALL ".join(
    f"""SELECT customerID, '{c}' AS "column", CAST({c} AS VARCHAR) AS value,
  CAST(dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS INTEGER) AS code FROM subscribers""" for c in CATEGORICAL))
def codes(t: Inputs):
    return encoding.attach_codes(t.stored_subscribers("customerID", *CATEGORICAL), CATEGORICAL, "customerID")


@query("enc_ordinal", """SELECT customerID, CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1
  WHEN 'Two year' THEN 2 ELSE -1 END AS contract_code, CASE InternetService WHEN 'No' THEN 0 WHEN 'DSL' THEN 1 ELSE -1 END AS internet_code
FROM subscribers""")
def ordinals(t: Inputs):
    return t.subscribers.select(
        "customerID",
        encoding.ordinal("Contract", LEVELS["Contract"]).alias("contract_code"),
        encoding.ordinal("InternetService", ["No", "DSL"]).alias("internet_code"),
    )


@query("enc_label_index", "SELECT customerID, CASE Churn WHEN 'Yes' THEN 1.0::DOUBLE WHEN 'No' THEN 0.0::DOUBLE END AS label FROM subscribers")
def label_index(t: Inputs):
    return t.subscribers.select(
        "customerID", encoding.recode("Churn", encoding.YES_NO).cast("double").alias("label")
    )


TYPED = "typed AS (SELECT * REPLACE (TRY_CAST(trim(TotalCharges) AS DOUBLE) AS TotalCharges) FROM subscribers)"


@query("imp_median", f"""WITH {TYPED} SELECT customerID, {', '.join(
    f'round(coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM typed)), 6) AS {c}' for c in NUMERIC)} FROM typed""")
def median(t: Inputs):
    filled = encoding.impute_median(numeric_totals(t.stored_subscribers("customerID", *NUMERIC)), NUMERIC)
    return filled.select("customerID", *[F.round(c, 6).alias(c) for c in NUMERIC])


@query("imp_const", """SELECT customerID, coalesce(nullif(trim(TotalCharges), ''), 'missing') AS "TotalCharges" FROM subscribers""")
def constant(t: Inputs):
    blank = t.subscribers.select("customerID", F.nullif(F.trim("TotalCharges"), F.lit("")).alias("TotalCharges"))
    return encoding.fill_constant(blank, ["TotalCharges"])


def scaled_sql(expr: str) -> str:
    return "SELECT customerID, " + ", ".join(f"round({expr.format(c=c)}, 6) AS {c}" for c in NUMERIC) + " FROM clean"


def rounded(df):
    return df.select("customerID", *[F.round(c, 6).alias(c) for c in NUMERIC])


@query("scl_standard", scaled_sql("({c} - (SELECT avg({c}) FROM clean)) / (SELECT stddev_pop({c}) FROM clean)"))
def standard(t: Inputs):
    return rounded(encoding.scale_standard(t.stored_clean("customerID", *NUMERIC), NUMERIC))


@query("scl_standard_sample", scaled_sql("({c} - (SELECT avg({c}) FROM clean)) / (SELECT stddev_samp({c}) FROM clean)"))
def standard_sample(t: Inputs):
    return rounded(encoding.scale_standard(t.stored_clean("customerID", *NUMERIC), NUMERIC, sample=True))


@query("scl_minmax", scaled_sql("({c} - (SELECT min({c}) FROM clean)) / (SELECT max({c}) - min({c}) FROM clean)::DOUBLE"))
def minmax(t: Inputs):
    return rounded(encoding.scale_minmax(t.stored_clean("customerID", *NUMERIC), NUMERIC))


BATCH_LEVELS = {
    **{c: LEVELS[c] for c in encoding.BATCH_DUMMIES},
    "tenure_bucket": list(BUCKETS["dp"].labels),
    "charges_bucket": list(BUCKETS["chg_dp"].labels),
}
BATCH_SQL = ", ".join(
    f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}" """ for c, values in BATCH_LEVELS.items() for v in values[1:]
)


@query("enc_all_batch", f"""SELECT customerID, CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS gender, SeniorCitizen,
  {', '.join(yes_sql(c) for c in encoding.BINARY)}, tenure, MonthlyCharges, TotalCharges, {yes_sql('Churn')}, service_count,
  avg_charges_per_month, high_value, contract_risk, {BATCH_SQL} FROM (
  SELECT *, {bucket_sql('dp')} AS tenure_bucket, {bucket_sql('chg_dp')} AS charges_bucket, {count_sql()} AS service_count,
    TotalCharges / (tenure + 1) AS avg_charges_per_month, {MEDIAN_SQL} AS high_value, {RISK_SQL} AS contract_risk FROM clean)""")
def batch_encoding(t: Inputs):
    """Derived features of the batch step, then its encoding."""
    return encoding.encode_batch(batch_features(t.stored_clean()))


# --- the preprocessing step: three branches in one projection -------------------------------

ADOPTED = f"""adopted AS (SELECT * REPLACE ({bucket_sql('nb2')} AS tenure,
    {', '.join(f'({x} = {chr(39)}Yes{chr(39)})::INT AS {x}' for x in RECODED)}),
  (InternetService != 'No')::INT AS HasInternetService, {ADOPT_NB_SQL} AS ServiceAdoptionScore,
  {PER_SERVICE_SQL} AS AvgMonthlyChargesPerService,
  CASE WHEN lower(PaymentMethod) LIKE '%automatic%' THEN 'High' ELSE 'Low' END AS PaymentReliability FROM clean)"""
PP_LEVELS = {
    c: (["0", "1"] if c in RECODED or c == "HasInternetService" else LEVELS[c]) for c in encoding.PP_NOMINAL
}


def pp_sql(drop=()) -> str:
    parts = [
        f"""round(({c} - (SELECT avg({c}) FROM adopted)) / (SELECT stddev_pop({c}) FROM adopted), 6) AS "{c}" """
        for c in encoding.PP_NUMERIC
    ]
    for c, values in PP_LEVELS.items():
        parts += [
            f"""CASE WHEN CAST({c} AS VARCHAR) = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}" """
            for v in values
            if f"{c}_{v}" not in drop
        ]
    for c, values in encoding.PP_ORDINAL.items():
        if c not in drop:
            cases = " ".join(f"WHEN {v!r} THEN {i}" for i, v in enumerate(values))
            parts.append(f"""CASE {c} {cases} ELSE -1 END AS "{c}" """)
    parts.append("(Churn = 'Yes')::INT AS \"Churn\"")
    return f"WITH {ADOPTED} SELECT customerID, {', '.join(parts)} FROM adopted"


def preprocessed(t: Inputs):
    adopted = adoption_recode(t.stored_clean()).withColumn("tenure", BUCKETS["nb2"].expr())
    encoded = encoding.preprocess(adopted, "customerID")
    return encoded.withColumns({c: F.round(c, 6) for c in encoding.PP_NUMERIC})


@query("pp_columns", pp_sql())
def pp_columns(t: Inputs):
    return preprocessed(t)


@query("prj_drop_list", pp_sql({*encoding.REDUNDANT, *encoding.LOW_CORRELATION}))
def drop_list(t: Inputs):
    return encoding.select_features(preprocessed(t))


# --- splits ---------------------------------------------------------------------------------

HASH = "md5('42:' || customerID)"
RANDOM_SQL = f"CASE WHEN substr({HASH}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END"
STRATIFIED = f"""stratified AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY Churn ORDER BY {HASH}, customerID)
  <= round(count(*) OVER (PARTITION BY Churn) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM subscribers)"""


@query("spl_random", f"SELECT customerID, Churn, {RANDOM_SQL} AS split FROM subscribers")
def random_split(t: Inputs):
    return splitting.split_random(t.subscribers.select("customerID", "Churn"))


@query("win_strat", f"WITH {STRATIFIED} SELECT customerID, Churn, split FROM stratified")
def stratified(t: Inputs):
    return splitting.split_stratified(t.stored_subscribers("customerID", "Churn"))


@query("spl_strat", f"""WITH {STRATIFIED} SELECT split, count(*) AS rows, count(*) FILTER (WHERE Churn = 'Yes') AS churned,
  round(avg(CASE WHEN Churn = 'Yes' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS churn_rate FROM stratified GROUP BY split""")
def stratified_report(t: Inputs):
    return splitting.split_report(splitting.split_stratified(t.stored_subscribers("customerID", "Churn")))


@query("bal_weights", """SELECT Churn, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM subscribers GROUP BY Churn""")
def weights(t: Inputs):
    return splitting.class_weights(t.subscribers).withColumn("weight", F.round("weight", 6))


# --- joins ----------------------------------------------------------------------------------


@query("jn_concat_cols", """SELECT customerID, tenure, (tenure > 48)::INT AS is_loyal, (Churn = 'Yes')::INT AS label FROM subscribers""")
def concat_columns(t: Inputs):
    """Columns computed apart, put together on the id."""
    rows = t.stored_subscribers("customerID", "tenure", "Churn")
    features = rows.select("customerID", "tenure", F.when(F.col("tenure") > 48, 1).otherwise(0).alias("is_loyal"))
    label = rows.select("customerID", F.when(F.col("Churn") == "Yes", 1).otherwise(0).alias("label"))
    return features.join(label, "customerID")


@query("jn_partition_rows", f"""SELECT customerID, 'train' AS part FROM subscribers WHERE {RANDOM_SQL} = 'train'
UNION ALL SELECT customerID, 'test' FROM subscribers WHERE {RANDOM_SQL} = 'test'""")
def partition_rows(t: Inputs):
    """Training rows by a list of ids, test rows as its complement."""
    rows = t.stored_subscribers("customerID")
    train_ids = splitting.split_random(rows).where("split = 'train'").select("customerID")
    train = rows.join(train_ids, "customerID", "left_semi").withColumn("part", F.lit("train"))
    test = rows.join(train_ids, "customerID", "left_anti").withColumn("part", F.lit("test"))
    return train.unionByName(test)
