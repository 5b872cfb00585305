"""Edge rules of cleaning, buckets, features, aggregation, encoding and validation."""

import pytest
from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS, equal_width_bin
from stayrate.operators import aggregate, cleaning, encoding, features, quality
from stayrate.operators.statistics import chi_square, iqr_multi, iqr_report, z_outliers

TENURES = [0, 1, 6, 7, 11, 12, 13, 24, 25, 36, 48, 49, 60, 61, 72, 73, None]


def bucketed(spark, name, values):
    spec = BUCKETS[name]
    kind = "int" if spec.column == "tenure" else "double"
    df = spark.createDataFrame([(v,) for v in values], f"{spec.column} {kind}")
    return {r[0]: r[1] for r in df.select(spec.column, spec.expr()).collect()}


def test_right_closed_edges_and_rest(spark):
    got = bucketed(spark, "sql5", TENURES)
    assert got[0] == got[12] == "0-12 months (New)" and got[13] == "13-24 months (Growing)"
    assert got[60] == "49-60 months (Loyal)" and got[61] == got[None] == "60+ months (Very Loyal)"


def test_zero_and_above_the_top_edge(spark):
    strict, lowest = bucketed(spark, "sparkpd", TENURES), bucketed(spark, "dp", TENURES)
    assert strict[0] is None and lowest[0] == "0-12"
    assert strict[72] == "Loyal" and strict[73] is None and lowest[73] is None and lowest[None] is None


def test_left_closed_charges(spark):
    got = bucketed(spark, "chg_v", [0.0, 29.99, 30.0, 60.0, 89.99, 90.0])
    assert [got[v] for v in (29.99, 30.0, 60.0, 90.0)] == ["$0-30", "$30-60", "$60-90", "$90+"]


def test_out_of_range_tenure_raises(spark):
    assert bucketed(spark, "nb2", [90, 91, 600])[600] == "Very Loyal"
    with pytest.raises(Exception, match="600 months"):
        bucketed(spark, "nb2", [601])


def test_equal_width_bins_keep_edge_values(spark):
    low, high, bins = 18.25, 118.75, 5
    edges = [(high - low) / bins * i + low for i in range(bins + 1)]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(edges)], "i int, v double")
    for closed, expected in (("right", [0, 0, 1, 2, 3, 4]), ("left", [0, 1, 2, 3, 4, 4])):
        got = df.select("i", equal_width_bin("v", F.lit(low), F.lit(high), bins, closed).alias("b")).orderBy("i")
        assert [r["b"] for r in got.collect()] == expected


def test_unreadable_totals(make):
    df = make({"TotalCharges": " "}, {"TotalCharges": ""}, {"TotalCharges": " 29.85 "}, {"TotalCharges": "abc"}, {"TotalCharges": None})
    assert [r[0] for r in cleaning.numeric_totals(df).orderBy("customerID").select("TotalCharges").collect()] == [None, None, 29.85, None, None]
    assert cleaning.drop_blank_totals(df).count() == 1
    removed = cleaning.rows_removed(df).head()
    assert (removed["rows_before"], removed["rows_after"], removed["rows_removed"]) == (5, 1, 4)


def test_trim_and_align(make):
    df = make({"gender": "  Male ", "Partner": "   "})
    row = cleaning.trim_strings(df).head()
    assert row["gender"] == "Male" and row["Partner"] is None
    aligned = cleaning.align_to(df, ["tenure", "unknown"])
    assert aligned.columns == ["tenure", "unknown"] and aligned.head()["unknown"] == 0
    assert cleaning.drop_id(df.drop("customerID")).columns == df.drop("customerID").columns


def test_loose_labels(make):
    rows = cleaning.churn_flag(make({"Churn": " YES "}, {"Churn": "no"}, {"Churn": None})).orderBy("customerID").collect()
    assert [r["ChurnFlag"] for r in rows] == [1, 0, 0]


def test_null_services_count_as_absent(make):
    df = make({"InternetService": None, "OnlineSecurity": None, "TechSupport": "No internet service", "MultipleLines": "?"})
    row = df.select(features.service_count().alias("n"), *[c.alias(k) for k, c in features.service_features().items()]).head()
    assert row["n"] == 1 and row["has_internet"] == 0 and row["has_premium_services"] == 0


def test_guarded_averages(make):
    row = make({"tenure": 0, "TotalCharges": "0"}).withColumn("TotalCharges", F.lit(0.0)).select(
        features.charge_per_tenure().alias("a"), features.charge_per_month().alias("b"),
        features.charge_per_service(F.lit(0)).alias("c"),
    ).head()
    assert (row["a"], row["b"], row["c"]) == (50.0, 0.0, 0.0)


# Customers and churned customers per level, and the published rate (one decimal).
GOLDEN = {
    "Month-to-month": (3875, 1655, 42.7), "One year": (1472, 166, 11.3), "Two year": (1685, 48, 2.8),
    "DSL": (2421, 459, 19.0), "Fiber optic": (3096, 1297, 41.9), "No": (1526, 113, 7.4),
    "Electronic check": (2365, 1071, 45.3), "Mailed check": (1612, 308, 19.1),
}


def test_churn_rates_from_known_counts(spark):
    rows = [(k, n, c) for k, (n, c, _) in GOLDEN.items()]
    counts = spark.createDataFrame(rows, "level string, n int, c int")
    people = counts.select("level", "c", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select(
        "level", F.when(F.col("i") <= F.col("c"), "Yes").otherwise("No").alias("Churn")
    )
    got = aggregate.churn_by(people, ["level"], extra=[aggregate.retained().alias("retained")], digits=1)
    for row in got.collect():
        n, c, rate = GOLDEN[row["level"]]
        assert (row["total_customers"], row["churned"], row["churn_rate"]) == (n, c, rate)
        assert row["churned"] + row["retained"] == row["total_customers"]


def test_empty_buckets_are_kept(make):
    rows = aggregate.bucket_report(make({"tenure": 5}, {"tenure": 6, "Churn": "Yes"}), BUCKETS["v"], "bucket").collect()
    assert [r["total_customers"] for r in rows] == [2, 0, 0, 0, 0]
    assert [r["churn_rate"] for r in rows] == [50.0, 0.0, 0.0, 0.0, 0.0]


def test_bin_labels(make):
    rows = aggregate.charge_bins(make({"MonthlyCharges": 18.25}, {"MonthlyCharges": 118.75}, {"MonthlyCharges": 38.35})).collect()
    assert [r["range"] for r in rows] == ["18.15-38.35", "38.35-58.45", "58.45-78.55", "78.55-98.65", "98.65-118.75"]
    assert [r["count"] for r in rows] == [2, 0, 0, 0, 1]


def test_duplicates_missing_and_validation(make, spark):
    df = make({}, {"customerID": "c0"}, {"customerID": "c0", "tenure": 3})
    assert quality.duplicate_rows(df).head()[0] == 1
    report = {r["check"]: r["status"] for r in quality.validation_report(df).collect()}
    assert report == {"required_columns": "ok", "empty": "ok", "duplicates": "warning", "missing": "ok"}
    with pytest.raises(quality.ValidationError, match="tenure"):
        quality.require_valid(df.drop("tenure"))
    with pytest.raises(quality.ValidationError, match="empty"):
        quality.require_valid(df.limit(0))
    sparse = df.select(*[F.lit(None).cast("string").alias(c) if c == "gender" else F.col(c) for c in df.columns])
    assert {r["column"]: r["n_missing"] for r in quality.missing_by_column(sparse, only_missing=True).collect()} == {"gender": 3}


def test_dummies_labels_and_ordinals(make):
    df = make({"Contract": "Two year"}, {"Contract": "One year"}, {"Contract": None}).select("customerID", "Contract")
    rows = encoding.dummies(df, ["Contract"]).orderBy("customerID").collect()
    assert [r["Contract_Two year"] for r in rows] == [1, 0, 0] and "Contract_One year" not in rows[0].asDict()
    full = encoding.onehot_full(df, ["Contract"]).orderBy("customerID").collect()
    assert full[2]["Contract_missing"] == 1
    codes = df.select("customerID", encoding.ordinal("Contract", ["One year", "Three year"]).alias("c")).orderBy("customerID")
    assert [r["c"] for r in codes.collect()] == [-1, 0, -1]
    assert [r["Contract"] for r in encoding.label_encode(df.dropna(), ["Contract"], 1).orderBy("customerID").collect()] == [2, 1]


def test_any_number_of_levels(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("c"))
    assert len(encoding.fit_levels(df, ["c"])["c"]) == 20_000
    codes = encoding.attach_codes(df.withColumn("id", F.col("c")), ["c"], "id")
    assert codes.agg(F.count_distinct("code"), F.max("code")).head() == (20_000, 19_999)


def test_missing_share_is_compared_before_rounding(spark):
    """501 of 5000 cells are 10.02 percent: more than ten, though the text says 10.0."""
    df = spark.range(5000).select(F.when(F.col("id") >= 501, F.col("id")).alias("a"))
    line = quality.validation_report(df, ["a"]).where("check = 'missing'").head()
    assert (line["status"], line["detail"]) == ("warning", "10.0% missing")
    exact = spark.range(5000).select(F.when(F.col("id") >= 500, F.col("id")).alias("a"))
    assert quality.validation_report(exact, ["a"]).where("check = 'missing'").head()["status"] == "ok"


def test_equal_rows_are_told_by_value_and_place_of_nulls(spark):
    rows = [("a", None), (None, "a"), ("a", None), ("a", "a"), (None, None), (None, None), (None, None)]
    assert quality.duplicate_rows(spark.createDataFrame(rows, "x string, y string")).head()[0] == 3


def test_scaling_of_a_constant_column(make):
    df = make({}, {}, {"MonthlyCharges": None})
    for scaled in (encoding.scale_standard(df, ["MonthlyCharges"]), encoding.scale_minmax(df, ["MonthlyCharges"])):
        assert [r["MonthlyCharges"] for r in scaled.orderBy("customerID").collect()] == [0.0, 0.0, None]


def test_scaling_fitted_on_other_rows(spark):
    fitted = encoding.fit_moments(spark.createDataFrame([(0.0,), (10.0,)], "x double"), ["x"])
    got = encoding.scale_minmax(spark.createDataFrame([(20.0,)], "x double"), ["x"], fitted)
    assert got.head()["x"] == 2.0


def test_outliers(spark):
    rows = [(float(i), float(i), 0.0) for i in range(20)] + [(500.0, 600.0, 0.0), (10.0, 900.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert z_outliers(df, ["a"]).count() == 1
    report = {r["column"]: r["n_outliers"] for r in iqr_report(df, ["a", "b", "c"]).collect()}
    assert report == {"a": 1, "b": 2, "c": 0}
    assert iqr_multi(df, ["a", "b", "c"]).count() == 1


def test_chi_square_uses_the_continuity_correction_on_two_by_two(spark):
    counts = [("x", "Yes", 10), ("x", "No", 20), ("y", "Yes", 25), ("y", "No", 15)]
    df = spark.createDataFrame([(a, b) for a, b, n in counts for _ in range(n)], "v string, Churn string")
    row = chi_square(df, ["v"]).head()
    n, a, b, c, d = 70, 10, 20, 25, 15
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert row["dof"] == 1 and row["statistic"] == pytest.approx(want)
