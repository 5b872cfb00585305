"""Rule scores and every evaluation metric, with the rule score as the probability."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions.columns import is_yes
from stayrate.operators import evaluation as ev
from stayrate.operators import scoring
from stayrate.plans.registry import Inputs, query
from stayrate.schema import EVENT_FIELDS, MODEL_VERSION
from stayrate.session import store

STAMP = "2024-01-31T00:00:00+00:00"

POINTS_SQL = """least(10, 2 * (Contract = 'Month-to-month')::INT + 2 * (tenure < 12)::INT
  + (InternetService = 'Fiber optic')::INT + (OnlineSecurity = 'No')::INT + (TechSupport = 'No')::INT
  + (PaperlessBilling = 'Yes')::INT + (PaymentMethod LIKE '%Electronic%')::INT + (MonthlyCharges > 70)::INT)"""
PREDICTED = f"""predicted AS (SELECT customerID AS customer_id, Churn, CASE WHEN p >= 5 THEN 1 ELSE 0 END AS prediction,
  p / 10.0::DOUBLE AS churn_probability, CASE WHEN p >= 5 THEN p / 10.0::DOUBLE ELSE (10 - p) / 10.0::DOUBLE END AS confidence,
  CASE WHEN p >= 7 THEN 'High' WHEN p >= 4 THEN 'Medium' ELSE 'Low' END AS risk_category
  FROM (SELECT *, {POINTS_SQL} AS p FROM subscribers))"""


@query("sco_rules", f"""WITH {PREDICTED} SELECT * EXCLUDE (Churn), '{STAMP}' AS predicted_at, '{MODEL_VERSION}' AS model_version
FROM predicted""")
def rules(t: Inputs):
    return scoring.score_events(scoring.to_event_fields(t.subscribers), STAMP)


@query("sco_risk", f"""WITH {PREDICTED} SELECT customer_id, churn_probability, risk_category AS stream_category,
  CASE WHEN churn_probability >= 0.7 THEN 'High Risk' WHEN churn_probability >= 0.5 THEN 'Medium Risk' ELSE 'Low Risk' END AS batch_category
FROM predicted""")
def risk(t: Inputs):
    scored = rules(t)
    p = F.col("churn_probability")
    return scored.select(
        "customer_id", p, scoring.stream_category(p).alias("stream_category"), scoring.batch_category(p).alias("batch_category")
    )


@query("sco_event_features", """SELECT customerID AS customer_id, SeniorCitizen::DOUBLE AS senior_citizen, tenure::DOUBLE AS tenure,
  MonthlyCharges AS monthly_charges, coalesce(TRY_CAST(trim(TotalCharges) AS DOUBLE), 0.0::DOUBLE) AS total_charges,
  (Contract = 'Month-to-month')::INT::DOUBLE AS contract_monthly, (InternetService = 'Fiber optic')::INT::DOUBLE AS internet_fiber,
  (OnlineSecurity = 'No')::INT::DOUBLE AS online_security_no, (TechSupport = 'No')::INT::DOUBLE AS tech_support_no,
  (PaperlessBilling = 'Yes')::INT::DOUBLE AS paperless_billing, (PaymentMethod LIKE '%Electronic%')::INT::DOUBLE AS payment_electronic
FROM subscribers""")
def event_features(t: Inputs):
    return scoring.event_features(scoring.to_event_fields(t.subscribers))


@query("agg_pred_summary", f"""WITH {PREDICTED} SELECT count(*) AS total_records, CAST(sum(prediction) AS BIGINT) AS churn_count,
  CAST(count(*) - sum(prediction) AS BIGINT) AS retained_count, round(sum(prediction) * 100.0 / count(*), 2) AS churn_rate,
  count(*) FILTER (WHERE risk_category = 'High') AS high_risk, count(*) FILTER (WHERE risk_category = 'Medium') AS medium_risk,
  count(*) FILTER (WHERE risk_category = 'Low') AS low_risk FROM predicted""")
def prediction_summary(t: Inputs):
    return scoring.prediction_summary(rules(t))


@query("snk_runlog", f"""WITH {PREDICTED} SELECT '{STAMP}' AS timestamp, count(*) AS count, CAST(sum(prediction) AS BIGINT) AS churn_count,
  round(avg(churn_probability), 6) AS avg_probability FROM predicted""")
def run_log(t: Inputs):
    return scoring.run_log(rules(t), STAMP)


# --- evaluation -----------------------------------------------------------------------------


def judged(t: Inputs):
    """Truth, prediction and score per subscriber."""
    scored = t.subscribers.select(
        "customerID", is_yes("Churn").alias("y"), scoring.risk_score(EVENT_FIELDS).alias("score")
    )
    return scored.withColumn("yhat", F.when(F.col("score") >= 0.5, 1).otherwise(0))


CELLS = """cells AS (SELECT count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp FROM scored)"""


@query("ev_confusion", f"WITH {CELLS} SELECT * FROM cells")
def confusion(t: Inputs):
    return ev.confusion(judged(t))


BASIC = """round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score,
  round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS specificity"""


@query("ev_basic", f"WITH {CELLS} SELECT {BASIC} FROM cells")
def basic(t: Inputs):
    return ev.basic_metrics(ev.confusion(judged(t)))


def steps_sql(source: str = "scored", by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""steps AS (SELECT {lead}score, sum(y) AS pos, count(*) - sum(y) AS neg FROM {source} GROUP BY {lead}score),
cum AS (SELECT *, sum(pos) OVER (w ORDER BY score DESC) AS cp, sum(neg) OVER (w ORDER BY score DESC) AS cn,
  sum(pos) OVER w AS ap, sum(neg) OVER w AS an FROM steps WINDOW w AS ({part}))"""


AUC_SQL = "round(sum(pos * (an - cn + neg * 0.5::DOUBLE)) / max(ap::DOUBLE * an), 6)"


@query("ev_auc", f"WITH {steps_sql()} SELECT {AUC_SQL} AS roc_auc FROM cum")
def auc(t: Inputs):
    return ev.ranking_metrics(judged(t)).select("roc_auc")


@query("ev_ap", f"WITH {steps_sql()} SELECT round(sum(pos / ap * (cp / (cp + cn))), 6) AS average_precision FROM cum")
def average_precision(t: Inputs):
    return ev.ranking_metrics(judged(t)).select("average_precision")


@query("ev_logloss", """SELECT round(avg(-CASE WHEN y = 1 THEN ln(greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
  ELSE ln(1 - greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) END), 6) AS log_loss FROM scored""")
def log_loss(t: Inputs):
    return ev.log_loss(judged(t))


@query("win_cum_scores", f"WITH {steps_sql()} SELECT score, CAST(cp AS BIGINT) AS tp, CAST(cn AS BIGINT) AS fp FROM cum")
def cumulative(t: Inputs):
    return ev.cumulative_scores(judged(t))


@query("ev_roc", f"WITH {steps_sql()} SELECT score AS threshold, round(cn / an, 6) AS fpr, round(cp / ap, 6) AS tpr FROM cum UNION ALL SELECT 'infinity'::DOUBLE, 0, 0")
def roc(t: Inputs):
    return ev.roc_points(judged(t))


@query("ev_pr", f"WITH {steps_sql()} SELECT score AS threshold, round(cp / (cp + cn), 6) AS precision, round(cp / ap, 6) AS recall FROM cum UNION ALL SELECT 'infinity'::DOUBLE, 1, 0")
def pr(t: Inputs):
    return ev.pr_points(judged(t))


@query("ev_report", f"""WITH {CELLS},
m AS (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
  coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, tn + fp AS n0, tp + fn AS n1 FROM cells),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM m)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, n0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), n1 FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n0 + n1 FROM f
UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / (n0 + n1), 6), round((r0 * n0 + r1 * n1) / (n0 + n1), 6),
  round((f0 * n0 + f1 * n1) / (n0 + n1), 6), n0 + n1 FROM f""")
def report(t: Inputs):
    return ev.class_report(judged(t))


@query("ev_summary", f"""WITH {CELLS}, {steps_sql()}, b AS (SELECT {BASIC} FROM cells)
SELECT 'Accuracy' AS "Metric", accuracy AS "Value" FROM b UNION ALL SELECT 'Precision', precision FROM b
UNION ALL SELECT 'Recall', recall FROM b UNION ALL SELECT 'F1-Score', f1_score FROM b
UNION ALL SELECT 'Specificity', specificity FROM b UNION ALL SELECT 'ROC-AUC', {AUC_SQL} FROM cum""")
def summary(t: Inputs):
    return ev.summary(store(judged(t), "judged"))


CANDIDATES = {
    "contract": ("CASE WHEN Contract = 'Month-to-month' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"),
    "tenure": "(72 - tenure) / 72.0::DOUBLE",
    "charges": "(MonthlyCharges - 18.25) / 100.5::DOUBLE",
}
JUDGED_SQL = f"""judged AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat FROM (
  SELECT 'rules' AS model, y, score FROM scored {' '.join(
      f"UNION ALL SELECT '{m}', (Churn = 'Yes')::INT, {e} FROM subscribers" for m, e in CANDIDATES.items())}))"""
COMPARE_SQL = f"""{JUDGED_SQL}, {steps_sql('judged', 'model')},
cells AS (SELECT model, count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp FROM judged GROUP BY model),
compared AS (SELECT model, {BASIC}, roc_auc FROM cells JOIN (SELECT model, {AUC_SQL} AS roc_auc FROM cum GROUP BY model) USING (model))"""


def candidates(t: Inputs):
    """Four scores per subscriber, computed in one pass and put in long form."""
    scores = t.subscribers.select(
        is_yes("Churn").alias("y"),
        scoring.risk_score(EVENT_FIELDS).alias("rules"),
        F.when(F.col("Contract") == "Month-to-month", 1.0).otherwise(0.0).alias("contract"),
        ((F.lit(72) - F.col("tenure")) / F.lit(72.0)).alias("tenure"),
        ((F.col("MonthlyCharges") - F.lit(18.25)) / F.lit(100.5)).alias("charges"),
    )
    wide = store(scores, "scores")  # both the confusion counts and the ranking read it
    long = wide.unpivot(["y"], ["rules", *CANDIDATES], "model", "score")
    return long.withColumn("yhat", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query("ev_compare", f"WITH {COMPARE_SQL} SELECT * FROM compared")
def compare(t: Inputs):
    return ev.compare(candidates(t))


@query("ev_compare_long", f"""WITH {COMPARE_SQL} SELECT model, metric, value FROM compared
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1_score, specificity, roc_auc))""")
def compare_long(t: Inputs):
    return ev.compare_long(ev.compare(candidates(t)))


@query("srt_models", f"WITH {COMPARE_SQL} SELECT * FROM compared ORDER BY f1_score DESC, model LIMIT 1")
def best(t: Inputs):
    return ev.best_model(ev.compare(candidates(t)))
