"""Quality classifier: a sparse rule ensemble.

Trees of a random forest over text statistics (``measures.RATES``) give conjunctive rules: every path
from a root to a node is one. A lasso logistic regression over the rules keeps few and weighs them.
The result is compiled into one column expression: the score is the logistic function of the sum
of the weights of the rules that hold.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows, chosen by a hash of their id, of which
``held_out`` rows are none. Labels, language, source and id are no inputs of a score. Every whole
text is scored; a NULL text counts as empty, for which all statistics are 0. With labels of one kind
only, or none, the score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stayrate.llm.measures import RATES, measure
from stayrate.llm.scratch import Scratch, without
from stayrate.llm.text import WordHashes, utf8

SAMPLE_ROWS = 8192
TREES = 20
DEPTH = 3
LASSO = 0.002
THRESHOLD = 0.7
STATISTICS = (*RATES, "log_words")
RESULTS = ("held_out", "score", "predicted")

#: (statistic, is_greater, bound); a rule holds if all its conditions do.
Condition = tuple[str, bool, float]


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]

    def score(self, statistics: Column) -> Column:
        """The score as a column expression over the struct of statistics."""
        total = reduce(
            Column.__add__,
            [F.when(holds(rule, statistics), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules],
            F.lit(self.intercept),
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: tuple[Condition, ...], statistics: Column) -> Column:
    tests = [statistics[name] > bound if greater else statistics[name] <= bound for name, greater, bound in rule]
    return reduce(Column.__and__, tests)


def held_out(id_column: str) -> Column:
    """Rows that labels are never learnt from: remainder 2 of the id's CRC-32 by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_statistics(df: DataFrame, text: str, into: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [measure(b, hashes) for b in utf8(batch.column(text))]
            rows = [(*rates, math.log1p(counts[0])) for counts, rates in found]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(STATISTICS))]
            kept = [i for i, name in enumerate(batch.schema.names) if name != text]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.StructArray.from_arrays(columns, list(STATISTICS))],
                names=[*[batch.schema.names[i] for i in kept], into],
            )

    struct = StructType([StructField(n, DoubleType()) for n in STATISTICS])
    fields = [f for f in df.schema.fields if f.name != text]
    return df.mapInArrow(run, StructType([*fields, StructField(into, struct)]))


def tree_rules(model) -> list[tuple[Condition, ...]]:
    """The distinct rules of all paths in a forest; a path keeps the tightest bound of its kind."""
    found: dict[tuple[Condition, ...], None] = {}

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            found[tuple((name, greater, bound) for (name, greater), bound in sorted(path.items()))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, bound = STATISTICS[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), {**path, (name, False): min(bound, path.get((name, False), bound))})
        walk(node.rightChild(), {**path, (name, True): max(bound, path.get((name, True), bound))})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality") -> RuleModel:
    some = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id")).agg(F.min(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_ROWS)
    )
    # The sample has a fixed bound, so it may be broadcast.
    joined = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(some), "_id")
    scratch = Scratch(docs.sparkSession)
    sample = scratch.store(
        with_statistics(joined, "_text", "s").select("_id", "label", *[F.col(f"s.{n}").alias(n) for n in STATISTICS])
        .dropDuplicates(["_id"]).coalesce(1).sortWithinPartitions("_id"),
        "labelled",
    )
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        scratch.drop("labelled")
        share = next(iter(counts), 0.5)
        return RuleModel({0.0: -50.0, 0.5: 0.0, 1.0: 50.0}[share], [])
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="onethird").fit(vectors)
    rules = tree_rules(forest)
    packed = sample.select("label", F.struct(*STATISTICS).alias("s"))
    tested = packed.select("label", F.array(*[holds(r, F.col("s")).cast("double") for r in rules]).alias("holds"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=100, standardization=True)
    fitted = lasso.fit(tested.select("label", array_to_vector("holds").alias("features")))
    scratch.drop("labelled")
    weights = fitted.coefficients.toArray()
    return RuleModel(float(fitted.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w])


def scored(docs: DataFrame, model: RuleModel, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; one pass, nothing is shuffled."""
    docs = without(docs, *RESULTS)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    found = with_statistics(rows, "_text", "_statistics").withColumn("score", model.score(F.col("_statistics")))
    return found.select(
        "_row.*", held_out(f"_row.{id_column}").alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
