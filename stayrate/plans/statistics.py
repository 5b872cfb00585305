"""Statistical test, correlation, outlier and density queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators import statistics as st
from stayrate.operators.encoding import ordinal
from stayrate.functions.columns import is_yes
from stayrate.plans.encoding import LEVELS, PP_LEVELS, pp_sql, preprocessed
from stayrate.operators.encoding import PP_NUMERIC, PP_ORDINAL
from stayrate.plans.registry import Inputs, query
from stayrate.schema import CATEGORICAL, NUMERIC

CHI_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) FILTER (WHERE Churn = 'Yes') AS y,
  count(*) FILTER (WHERE Churn = 'No') AS x FROM subscribers GROUP BY {c}""" for c in CATEGORICAL)


CHI_STATISTICS = f"""WITH cells AS ({CHI_SQL}),
t AS (SELECT *, sum(y) OVER w AS ay, sum(x) OVER w AS ax, count(*) OVER w - 1 AS dof FROM cells WINDOW w AS (PARTITION BY "column")),
e AS (SELECT "column", dof, unnest([y, x])::DOUBLE AS o, unnest([(y + x) * ay / (ay + ax), (y + x) * ax / (ay + ax)])::DOUBLE AS e FROM t),
g AS (SELECT "column", dof, e, CASE WHEN dof = 1 THEN abs(o - e) - least(0.5::DOUBLE, abs(o - e)) ELSE abs(o - e) END AS d FROM e)
SELECT "column", round(sum(d * d / e), 6) AS statistic, CAST(min(dof) AS INTEGER) AS dof FROM g GROUP BY "column" """


@query("st_chi2", CHI_STATISTICS)
def chi_square(t: Inputs):
    return st.chi_square(t.subscribers, CATEGORICAL).withColumn("statistic", F.round("statistic", 6))


def tail_sql(tests: str, start: str, density: str) -> str:
    """p-values by Simpson's rule: ``density`` of s, from ``start`` on for 40 units in 8000 steps."""
    return f"""SELECT "column", round(statistic, 6) AS statistic, dof,
  round(sum((CASE WHEN i = 0 OR i = 8000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {density}) * 0.005::DOUBLE / 3, 6) AS p_value
FROM (SELECT *, {start} + i * 0.005::DOUBLE AS s FROM ({tests}), range(8001) steps(i)) GROUP BY ALL"""


# The square root of a chi-square variable has a density without a pole.
CHI_DENSITY = "pow(2, 1 - dof / 2.0::DOUBLE) * pow(s, dof - 1) * exp(-s * s / 2) / gamma(dof / 2.0::DOUBLE)"
CHI_TESTS = CHI_STATISTICS.replace('round(sum(d * d / e), 6)', 'sum(d * d / e)')


@query("st_chi2_p", tail_sql(CHI_TESTS, "sqrt(statistic)", CHI_DENSITY))
def chi_square_p(t: Inputs):
    tests = st.with_p_value(st.chi_square(t.subscribers, CATEGORICAL), "chi2")
    return tests.withColumns({c: F.round(c, 6) for c in ("statistic", "p_value")})


def welch_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", avg({c}) FILTER (WHERE Churn = 'Yes') - avg({c}) FILTER (WHERE Churn = 'No') AS gap,
  var_samp({c}) FILTER (WHERE Churn = 'Yes') / count({c}) FILTER (WHERE Churn = 'Yes') AS vy,
  var_samp({c}) FILTER (WHERE Churn = 'No') / count({c}) FILTER (WHERE Churn = 'No') AS vn,
  count({c}) FILTER (WHERE Churn = 'Yes') AS ny, count({c}) FILTER (WHERE Churn = 'No') AS nn FROM clean"""


@query("st_ttest", f"""WITH s AS ({' UNION ALL '.join(welch_sql(c) for c in NUMERIC)})
SELECT "column", round(gap / sqrt(vy + vn), 6) AS statistic,
  round((vy + vn) * (vy + vn) / (vy * vy / (ny - 1) + vn * vn / (nn - 1)), 4) AS dof FROM s""")
def t_test(t: Inputs):
    return st.welch(t.clean).withColumns({"statistic": F.round("statistic", 6), "dof": F.round("dof", 4)})


T_TESTS = f"""WITH s AS ({' UNION ALL '.join(welch_sql(c) for c in NUMERIC)})
SELECT "column", gap / sqrt(vy + vn) AS statistic, (vy + vn) * (vy + vn) / (vy * vy / (ny - 1) + vn * vn / (nn - 1)) AS dof FROM s"""
T_DENSITY = "2 * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - (dof + 1) / 2 * ln(1 + s * s / dof)) / sqrt(dof * pi())"


@query("st_ttest_p", f"""SELECT * REPLACE (round(dof, 4) AS dof) FROM ({tail_sql(T_TESTS, "abs(statistic)", T_DENSITY)})""")
def t_test_p(t: Inputs):
    tests = st.with_p_value(st.welch(t.clean), "t")
    return tests.withColumns({"statistic": F.round("statistic", 6), "dof": F.round("dof", 4), "p_value": F.round("p_value", 6)})


CORR = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "contract_code", "churn_flag"]
CODED_SQL = """coded AS (SELECT tenure, MonthlyCharges, TotalCharges, SeniorCitizen,
  CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 END AS contract_code,
  (Churn = 'Yes')::INT AS churn_flag FROM clean)"""


@query("st_corr", f"WITH {CODED_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM coded" for a in CORR for b in CORR))
def correlations(t: Inputs):
    coded = t.stored_clean(*NUMERIC, "SeniorCitizen", "Contract", "Churn").withColumns(
        {"contract_code": ordinal("Contract", LEVELS["Contract"]), "churn_flag": is_yes("Churn")}
    )
    return st.correlation_matrix(coded, CORR).withColumn("r", F.round("r", 6))


PP_FEATURES = [*PP_NUMERIC, *[f"{c}_{v}" for c, vs in PP_LEVELS.items() for v in vs], *PP_ORDINAL]


@query("st_corr_target", pp_sql().replace(" SELECT customerID, ", ", pp AS (SELECT customerID, ", 1) + ") " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(corr("{c}", "Churn"), 6) AS r FROM pp""" for c in PP_FEATURES))
def correlation_with_target(t: Inputs):
    return st.correlation_with(preprocessed(t), PP_FEATURES, "Churn").withColumn("r", F.round("r", 6))


def z_sql(limit) -> str:
    tests = " OR ".join(f"abs(({c} - (SELECT avg({c}) FROM clean)) / (SELECT stddev_pop({c}) FROM clean)) > {limit}" for c in NUMERIC)
    return f"SELECT customerID, {', '.join(NUMERIC)} FROM clean WHERE {tests}"


@query("st_zout", z_sql(3))
def z_outliers(t: Inputs):
    return st.z_outliers(t.stored_clean("customerID", *NUMERIC)).select("customerID", *NUMERIC)


@query("st_zout_2", z_sql(2))
def z_outliers_2(t: Inputs):
    """A closer limit, which these tables do pass."""
    return st.z_outliers(t.stored_clean("customerID", *NUMERIC), limit=2.0).select("customerID", *NUMERIC)


def mask_sql(c: str, reach) -> str:
    q1, q3 = (f"(SELECT quantile_cont({c}::DOUBLE, {p}) FROM clean)" for p in (0.25, 0.75))
    return f"(({c} < {q1} - ({q3} - {q1}) * {reach}::DOUBLE) OR ({c} > {q3} + ({q3} - {q1}) * {reach}::DOUBLE))::INT"


def iqr_sql(reach) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum({mask_sql(c, reach)}) AS BIGINT) AS n_outliers,
  round(sum({mask_sql(c, reach)})::DOUBLE / count(*), 3) AS share FROM clean""" for c in NUMERIC)


@query("st_iqr", iqr_sql(1.5))
def iqr(t: Inputs):
    return st.iqr_report(t.stored_clean(*NUMERIC))


@query("st_iqr_near", iqr_sql(0.25))
def iqr_near(t: Inputs):
    """Closer fences, which these tables do pass."""
    return st.iqr_report(t.stored_clean(*NUMERIC), reach=0.25)


def multi_sql(reach) -> str:
    return f"""SELECT customerID, {' + '.join(mask_sql(c, reach) for c in NUMERIC)} AS outlier_count FROM clean
WHERE {' + '.join(mask_sql(c, reach) for c in NUMERIC)} = 2"""


@query("st_iqr_multi", multi_sql(1.5))
def iqr_multi(t: Inputs):
    return st.iqr_multi(t.stored_clean("customerID", *NUMERIC)).select("customerID", "outlier_count")


@query("st_iqr_multi_near", multi_sql(0.25))
def iqr_multi_near(t: Inputs):
    return st.iqr_multi(t.stored_clean("customerID", *NUMERIC), reach=0.25).select("customerID", "outlier_count")


def kde_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(i AS INTEGER) AS point, round(min(x), 4) AS x, round(sum(k), 8) AS density FROM (
  SELECT i, x, n * exp(-0.5 * ((x - v) / w) * ((x - v) / w)) / (total * w * sqrt(2 * pi())) AS k FROM (
    SELECT i, v, n, w, total, lo - w * 3 + (hi - lo + w * 6) / 199.0::DOUBLE * i AS x FROM
      (SELECT {c}::DOUBLE AS v, count(*) AS n FROM clean GROUP BY 1),
      (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, count({c}) AS total,
         stddev_samp({c}) * pow(count({c})::DOUBLE, -0.2::DOUBLE) AS w FROM clean), range(200) r(i))) GROUP BY i"""


@query("st_kde", " UNION ALL ".join(kde_sql(c) for c in NUMERIC))
def kde(t: Inputs):
    return st.density(t.stored_clean(*NUMERIC)).withColumns({"x": F.round("x", 4), "density": F.round("density", 8)})
