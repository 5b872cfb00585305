"""Training, clustering, neighbour and balancing queries."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS
from stayrate.functions.columns import is_yes
from stayrate.operators import clusters, encoding, evaluation, models, vectors
from stayrate.operators.balancing import smote
from stayrate.operators.bayes import fit_bayes
from stayrate.operators.features import adoption_recode
from stayrate.operators.neighbours import knn_vote, nearest_neighbours
from stayrate.operators.splitting import split_random, split_stratified
from stayrate.plans.encoding import LEVELS, RANDOM_SQL, STRATIFIED
from stayrate.plans.registry import Inputs, query
from stayrate.schema import CATEGORICAL, ID, NUMERIC
from stayrate.session import shared_path, store
from stayrate.sources import readers, sinks


def model_rows(t: Inputs):
    """Train and test rows with ``features`` and ``label``. The encoder is fitted on the training
    rows alone; the vectors are stored once, as every fit reads them many times."""
    split = split_stratified(t.stored_clean())
    train = split.where("split = 'train'")
    fitted = vectors.fit_vectors(train)
    encoded = vectors.apply_vectors(fitted, split)
    rows = store(encoded.select(ID, "split", "label", F.col("scaled_features").alias("features")), "vectors")
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


#: The models that the training step enables.
ENABLED: dict[str, dict] = {n: {} for n in ("logistic_regression", "decision_tree", "random_forest", "gradient_boosting")}


def judged(name: str, predictions):
    # The comparison reads the scores twice.
    return evaluation.compare(store(models.score_rows(predictions, name), "scores"))


def register_model(key: str, name: str) -> None:
    @query(key)
    def fit_and_judge(t: Inputs):
        train, test = model_rows(t)
        return judged(name, models.predict(models.train(name, train), models.spread(test)))


register_model("ml_logreg", "logistic_regression")
register_model("ml_tree", "decision_tree")
register_model("ml_forest", "random_forest")
register_model("ml_gbt", "gradient_boosting")
register_model("ml_svm", "svm")


@query("ml_svm_calibration", f"""WITH {STRATIFIED.replace('FROM subscribers', 'FROM clean')}
SELECT count(*) AS n, count(*) FILTER (WHERE Churn = 'Yes') AS churned, round(count(*) FILTER (WHERE Churn = 'Yes')::DOUBLE, 1) AS expected
FROM stratified WHERE split = 'train'""")
def svm_calibration(t: Inputs):
    """Calibrated probabilities of the training rows add up to the churners among them."""
    train, _ = model_rows(t)
    scored = models.predict(models.train("svm", train), train)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("churned"), F.round(F.sum("score"), 1).alias("expected")
    )


@query("ml_tree_shallow")
def shallow_tree(t: Inputs):
    """The smaller tree: depth 5 and a least gain per split."""
    train, test = model_rows(t)
    model = models.train("decision_tree", train, maxDepth=5, minInfoGain=0.01, balanced=False)
    return judged("decision_tree", models.predict(model, test))


@query("ml_factory")
def factory(t: Inputs):
    """An estimator of every name, fitted with its defaults on the training rows."""
    train, test = model_rows(t)
    return models.train_all(train, test)[2]


@query("ml_train_all")
def train_all(t: Inputs):
    """Every model that the training step enables, with its defaults."""
    train, test = model_rows(t)
    _, errors, table = models.train_all(train, test, ENABLED)
    if errors:
        raise RuntimeError(f"not trained: {errors}")
    return table


@query("ml_importance")
def importance(t: Inputs):
    """Of the best model by F1, and of the logistic regression, whose measure is the size of its
    coefficients."""
    split = split_stratified(t.stored_clean())
    fitted = vectors.fit_vectors(split.where("split = 'train'"))
    rows = store(vectors.apply_vectors(fitted, split).select(ID, "split", "label", "features", "scaled_features"), "vectors")
    names = vectors.slot_names(vectors.apply_vectors(fitted, split))
    ready = rows.select(ID, "split", "label", F.col("scaled_features").alias("features"))
    train, test = (ready.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    found, _, table = models.train_all(train, test, ENABLED)
    best = evaluation.best_model(table).head()["model"]
    parts = [
        models.importance(found[n], names).withColumn("model", F.lit(n)).withColumn("is_best", F.lit(n == best))
        for n in dict.fromkeys([best, "logistic_regression"])
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("vec_assemble", "SELECT customerID, 3 AS slots, tenure::DOUBLE AS f0, MonthlyCharges AS f1, TotalCharges AS f2 FROM clean")
def assemble(t: Inputs):
    """Rows with an unreadable total are skipped by the assembler."""
    numbers = t.subscribers.select(ID, "tenure", "MonthlyCharges", F.trim("TotalCharges").try_cast("double").alias("TotalCharges"))
    out = vectors.assembler(NUMERIC).transform(numbers)
    slots = vector_to_array("features")
    return out.select(ID, F.size(slots).alias("slots"), *[slots[i].alias(f"f{i}") for i in range(3)])


def hot_sql(column: str) -> str:
    cases = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(LEVELS[column]))
    return f"""CASE {column} {cases} END AS "{column}_hot", {len(LEVELS[column]) + 1} AS "{column}_slots" """


ONEHOT = ["Contract", "PaymentMethod", "InternetService"]


@query("enc_onehot_vec", f"SELECT customerID, {', '.join(hot_sql(c) for c in ONEHOT)} FROM subscribers")
def onehot_vectors(t: Inputs):
    """The slot of each level; one more slot is kept for unseen levels."""
    rows = t.stored_subscribers(ID, *ONEHOT)
    out = Pipeline(stages=vectors.onehot_stages(ONEHOT)).fit(rows).transform(rows)
    parts = []
    for c in ONEHOT:
        slots = vector_to_array(f"{c}_encoded")
        parts += [
            (F.array_position(slots, 1.0) - 1).cast("int").alias(f"{c}_hot"), F.size(slots).alias(f"{c}_slots")
        ]
    return out.select(ID, *parts)


@query("vec_full", f"""SELECT customerID, (Churn = 'Yes')::INT::DOUBLE AS label,
  {sum(len(LEVELS[c]) + 1 for c in CATEGORICAL) + len(NUMERIC)} AS slots,
  {', '.join(f'round({c} / (SELECT stddev_samp({c}) FROM clean), 6) AS {c}' for c in NUMERIC)} FROM clean""")
def full_vectors(t: Inputs):
    """Index, encode, assemble and scale, fitted on all rows."""
    rows = t.stored_clean()
    out = vectors.apply_vectors(vectors.fit_vectors(rows), rows)
    slots = vector_to_array("scaled_features")
    numbers = [F.round(F.element_at(slots, i - len(NUMERIC)), 6).alias(c) for i, c in enumerate(NUMERIC)]
    return out.select(ID, "label", F.size(slots).alias("slots"), *numbers)


@query("sco_batch")
def batch(t: Inputs):
    train, test = model_rows(t)
    return models.batch_scores(models.train("logistic_regression", train), test, [ID])


@query("jn_attach_pred")
def attach(t: Inputs):
    """Predictions beside the rows they belong to, by transform and not by position."""
    train, test = model_rows(t)
    out = models.predict(models.train("logistic_regression", train), test)
    return out.select(ID, "y", "yhat", F.round("score", 6).alias("score"))


@query("snk_model")
def save_model(t: Inputs):
    """Every fitted model saved, and the best one under a name of its own."""
    train, test = model_rows(t)
    folder = shared_path(t.spark, "models")
    fitted, _, table = models.train_all(train, test)
    best = evaluation.best_model(table).head()["model"]
    saved = []
    for name, model in fitted.items():
        path = f"{folder}/{name}"
        Pipeline(stages=[model]).fit(train).write().overwrite().save(path)
        saved.append((name, name == best))
    Pipeline(stages=[fitted[best]]).fit(train).write().overwrite().save(f"{folder}/best_model")
    return t.spark.createDataFrame(saved, "model string, is_best boolean")


@query("src_model")
def stored_model(t: Inputs):
    """The first candidate path with a model is loaded and scores the test rows."""
    train, test = model_rows(t)
    folder = shared_path(t.spark, "models")
    fitted = models.train("logistic_regression", train)
    Pipeline(stages=[fitted]).fit(train).write().overwrite().save(f"{folder}/logistic_regression")
    model = readers.load_model(t.spark, [f"{folder}/best_model", f"{folder}/logistic_regression"])
    return models.batch_scores(model, test, [ID])


# --- clusters -------------------------------------------------------------------------------

RESTARTS = 25
CLUSTERED = [ID, *NUMERIC, "Churn"]


@query("ml_kmeans")
def kmeans(t: Inputs):
    rows = clusters.scaled_vectors(t.stored_clean(*CLUSTERED))
    return clusters.assign_clusters(clusters.fit_clusters(rows, restarts=RESTARTS), rows).select(ID, "cluster")


@query("agg_cluster_profile")
def profile(t: Inputs):
    rows = clusters.scaled_vectors(t.stored_clean(*CLUSTERED), sample=True)
    model = clusters.fit_clusters(rows, restarts=RESTARTS)
    return clusters.cluster_profile(clusters.assign_clusters(model, rows))


@query("ml_elbow")
def elbow(t: Inputs):
    return clusters.elbow(clusters.scaled_vectors(t.stored_clean(*CLUSTERED), sample=True))


@query("ml_pca2")
def plane(t: Inputs):
    return clusters.plane(clusters.scaled_vectors(t.stored_clean(*CLUSTERED), sample=True))


# --- neighbours -----------------------------------------------------------------------------


@query("win_knn_topk", """WITH p AS (SELECT customerID AS id, tenure * 100 AS a, CAST(round(MonthlyCharges * 100) AS BIGINT) AS b FROM subscribers),
d AS (SELECT q.id AS qid, r.id AS rid, sqrt(((q.a - r.a) * (q.a - r.a) + (q.b - r.b) * (q.b - r.b))::DOUBLE) AS dist
  FROM p q JOIN p r ON q.id <> r.id)
SELECT qid, rid, round(dist, 6) AS dist, CAST(row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS INTEGER) AS rank
FROM d QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, rid) <= 5""")
def neighbours(t: Inputs, k: int = 5):
    """Nearest customers by tenure and charge."""
    rows = points(t.stored_subscribers(ID, "tenure", "MonthlyCharges"))
    found = nearest_neighbours(rows.withColumnRenamed("id", "qid"), rows.withColumnRenamed("id", "rid"), k)
    return found.withColumn("dist", F.round("dist", 6))


def points(df, *more):
    """Tenure and charge in hundredths, as a point of whole numbers."""
    return df.select(F.col(ID).alias("id"), F.array(F.col("tenure") * 100.0, F.round(F.col("MonthlyCharges") * 100)).alias("x"), *more)


@query("ml_knn_vote", f"""WITH {STRATIFIED},
p AS (SELECT customerID AS id, split, (Churn = 'Yes')::INT AS y, tenure * 100 AS a, CAST(round(MonthlyCharges * 100) AS BIGINT) AS b FROM stratified),
d AS (SELECT q.id AS qid, r.id AS rid, r.y, sqrt(((q.a - r.a) * (q.a - r.a) + (q.b - r.b) * (q.b - r.b))::DOUBLE) AS dist
  FROM p q JOIN p r ON q.split = 'test' AND r.split = 'train'
  QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY dist, r.id) <= 5)
SELECT qid AS "customerID", round(CASE WHEN min(dist) = 0 THEN sum(y) FILTER (WHERE dist = 0)::DOUBLE / count(*) FILTER (WHERE dist = 0)
  ELSE sum(y / dist) / sum(1 / dist) END, 6) AS score FROM d GROUP BY qid""")
def knn_scores(t: Inputs):
    """Distance-weighted vote of the nearest training customers by tenure and charge."""
    split = split_stratified(t.stored_subscribers(ID, "tenure", "MonthlyCharges", "Churn"))
    refs = points(split.where("split = 'train'"), is_yes("Churn").alias("y")).withColumnRenamed("id", "rid")
    queries = points(split.where("split = 'test'")).withColumnRenamed("id", "qid")
    return knn_vote(queries, refs, k=5).select(F.col("qid").alias(ID), F.round("score", 6).alias("score"))


@query("ml_knn")
def knn(t: Inputs):
    train, test = model_rows(t)
    refs = train.select(F.col(ID).alias("rid"), vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"))
    queries = test.select(F.col(ID).alias("qid"), vector_to_array("features").alias("x"))
    votes = knn_vote(queries, refs, k=5)
    scored = test.select(F.col(ID).alias("qid"), F.col("label").cast("int").alias("y")).join(votes, "qid")
    return judged("knn", scored.withColumn("yhat", F.when(F.col("score") > 0.5, 1).otherwise(0)))


# --- naive Bayes ----------------------------------------------------------------------------

_LEVEL_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) FILTER (WHERE Churn = 'No') AS n0,
  count(*) FILTER (WHERE Churn = 'Yes') AS n1 FROM train GROUP BY {c}""" for c in CATEGORICAL)
_ROW_SQL = " UNION ALL ".join(f"SELECT customerID, '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM test" for c in CATEGORICAL)


def _gauss(c: str, name: str) -> str:
    m = f"(SELECT avg({c}) FROM train WHERE Churn = '{name}')"
    s = f"(SELECT stddev_samp({c}) FROM train WHERE Churn = '{name}')"
    return f"(-0.5 * (({c} - {m}) / {s}) * (({c} - {m}) / {s}) - ln({s}) - 0.5 * ln(2 * pi()))"


@query("ml_nb", f"""WITH {STRATIFIED.replace('FROM subscribers', 'FROM clean')},
train AS (SELECT * FROM stratified WHERE split = 'train'), test AS (SELECT * FROM stratified WHERE split = 'test'),
lv AS ({_LEVEL_SQL}),
lp AS (SELECT col, value, ln(CASE WHEN n0 = 0 THEN 0.001 ELSE n0 / sum(n0) OVER (PARTITION BY col) END) AS l0,
  ln(CASE WHEN n1 = 0 THEN 0.001 ELSE n1 / sum(n1) OVER (PARTITION BY col) END) AS l1 FROM lv),
cat AS (SELECT customerID, sum(l0) AS l0, sum(l1) AS l1 FROM ({_ROW_SQL}) JOIN lp USING (col, value) GROUP BY customerID),
tot AS (SELECT customerID, Churn,
  cat.l0 + ln((SELECT avg((Churn = 'No')::INT) FROM train)) + {' + '.join(_gauss(c, 'No') for c in NUMERIC)} AS l0,
  cat.l1 + ln((SELECT avg((Churn = 'Yes')::INT) FROM train)) + {' + '.join(_gauss(c, 'Yes') for c in NUMERIC)} AS l1
  FROM test JOIN cat USING (customerID))
SELECT customerID, (Churn = 'Yes')::INT AS y, (1 / (1 + exp(l0 - l1)) > 0.5)::INT AS yhat, round(1 / (1 + exp(l0 - l1)), 6) AS score
FROM tot""")
def bayes(t: Inputs):
    split = split_stratified(t.stored_clean())
    model = fit_bayes(split.where("split = 'train'"), NUMERIC, CATEGORICAL)
    scored = model.score(split.where("split = 'test'"))
    return scored.select(ID, is_yes("Churn").alias("y"), "yhat", F.round("score", 6).alias("score"))


# --- balancing ------------------------------------------------------------------------------


def encoded_split(t: Inputs):
    """Selected encoded features as an array, the label, and a random split; encoders and scaler
    are fitted on the training rows."""
    adopted = split_random(adoption_recode(t.stored_clean()).withColumn("tenure", BUCKETS["nb2"].expr()))
    train = adopted.where("split = 'train'")
    encoded = encoding.select_features(encoding.preprocess(adopted, ID, fit_on=train))
    names = [c for c in encoded.columns if c not in (ID, "Churn")]
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    # The side is a hash of the id, so it can be told again from the encoded row.
    rows = encoded.select(F.col(ID).alias("id"), x.alias("x"), F.col("Churn").alias("y"))
    return split_random(rows, id_column="id")


def balanced(t: Inputs):
    """All rows of the unbalanced and the balanced variant; the test side is the same in both."""
    rows = store(encoded_split(t), "encoded")
    train = rows.where("split = 'train'").drop("split")
    plain = rows.select("id", "x", "y", F.lit(False).alias("synthetic"), "split", F.lit("imbalanced").alias("balance"))
    grown = smote(train).select("id", "x", "y", "synthetic", F.lit("train").alias("split"), F.lit("balanced").alias("balance"))
    test = plain.where("split = 'test'").withColumn("balance", F.lit("balanced"))
    return plain.unionByName(grown).unionByName(test)


DIST_SQL = f"""WITH s AS (SELECT (Churn = 'Yes')::INT AS y, {RANDOM_SQL} AS split FROM clean),
c AS (SELECT split, y, count(*) AS n FROM s GROUP BY split, y)
SELECT 'imbalanced' AS balance, split, y, n FROM c
UNION ALL SELECT 'balanced', split, y, CASE WHEN split = 'train' THEN (SELECT max(n) FROM c WHERE split = 'train') ELSE n END FROM c"""


@query("bal_smote")
def smote_rows(t: Inputs):
    train = encoded_split(t).where("split = 'train'").drop("split")
    return smote(train)


@query("agg_split_dist", DIST_SQL)
def split_distribution(t: Inputs):
    return balanced(t).groupBy("balance", "split", "y").agg(F.count(F.lit(1)).alias("n"))


def saved_splits(t: Inputs) -> str:
    return sinks.write_split(balanced(t), shared_path(t.spark, "splits"))


@query("snk_splits", DIST_SQL)
def save_splits(t: Inputs):
    return t.spark.read.parquet(saved_splits(t)).groupBy("balance", "split", "y").agg(F.count(F.lit(1)).alias("n"))


@query("src_splits", f"""WITH s AS (SELECT customerID AS id, (Churn = 'Yes')::INT AS y, {RANDOM_SQL} AS split FROM clean)
SELECT id, y FROM s WHERE split = 'test'""")
def read_splits(t: Inputs):
    """The test side is no part of the balancing, so only it is written for this."""
    test = encoded_split(t).where("split = 'test'").select("id", "x", "y", F.lit(False).alias("synthetic"), "split", F.lit("balanced").alias("balance"))
    path = sinks.write_split(test, shared_path(t.spark, "splits"))
    return readers.read_split(t.spark, path, "balanced", "test").select("id", "y")


@query("ev_balance_compare")
def balance_compare(t: Inputs):
    """Models trained on unbalanced and on balanced rows, judged on the same test rows."""
    rows = store(balanced(t).select("balance", "split", array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label")), "balanced")
    test = models.spread(rows.where("split = 'test' AND balance = 'imbalanced'"))
    fits = {}
    for variant in ("imbalanced", "balanced"):
        train = rows.where((F.col("split") == "train") & (F.col("balance") == variant))
        fits |= {f"{name}: {variant}": partial(models.train, name, train, balanced=False) for name in ENABLED}
    fitted = models.train_side_by_side(fits)
    parts = [models.score_rows(models.predict(model.result(), test), name) for name, model in fitted.items()]
    return evaluation.compare(store(reduce(lambda a, b: a.unionByName(b), parts), "scores"))
