"""Classifier evaluation for any number of models at once.

Input rows carry ``y`` (0/1 truth), ``yhat`` (0/1 prediction) and ``score`` (probability), plus
the columns named in ``by`` (for instance ``model``). Confusion counts are one aggregation;
ranking metrics fold equal scores first and use running totals, never a window over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import ratio
from stayrate.functions.ranks import running_totals

CLIP = 2.220446049250313e-16  # double epsilon


def _cell(y: int, yhat: int) -> Column:
    return F.count_if((F.col("y") == y) & (F.col("yhat") == yhat))


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        _cell(0, 0).alias("tn"), _cell(0, 1).alias("fp"), _cell(1, 0).alias("fn"), _cell(1, 1).alias("tp")
    )


def f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(precision * recall * 2, precision + recall), F.lit(0.0))


def basic_metrics(cells: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Accuracy, precision, recall, F1 and specificity from confusion counts; 0 for 0/0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return cells.select(
        *by,
        F.round(ratio(tp + tn, tp + tn + fp + fn), digits).alias("accuracy"),
        F.round(precision, digits).alias("precision"),
        F.round(recall, digits).alias("recall"),
        F.round(f1(precision, recall), digits).alias("f1_score"),
        F.round(ratio(tn, tn + fp), digits).alias("specificity"),
    )


def score_steps(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, highest first, with cumulative true and false positives."""
    return running_totals(
        df.where(F.col("score").isNotNull() & F.col("y").isNotNull()),
        by,
        "score",
        {"pos": F.sum(F.col("y").cast("long")), "neg": F.sum(1 - F.col("y").cast("long"))},
        descending=True,
    )


def cumulative_scores(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return score_steps(df, by).select(
        *by, "score", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp")
    )


def with_end(points: DataFrame, by: Sequence[str], end: dict[str, float]) -> DataFrame:
    """``points`` and, per curve, the point at which no row is predicted positive. Its threshold is
    infinite: no score reaches it."""
    values = {"threshold": float("inf"), **end}
    ends = points.select(*by).distinct() if by else points.groupBy().agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return points.unionByName(ends.select(*by, *[F.lit(v).alias(n) for n, v in values.items()]))


def roc_points(df: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """A point per distinct score, and the start of the curve at (0, 0)."""
    points = score_steps(df, by).select(
        *by,
        F.col("score").alias("threshold"),
        F.round(ratio(F.col("cum_neg"), F.col("all_neg")), digits).alias("fpr"),
        F.round(ratio(F.col("cum_pos"), F.col("all_pos")), digits).alias("tpr"),
    )
    return with_end(points, by, {"fpr": 0.0, "tpr": 0.0})


def pr_points(df: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """A point per distinct score, and the end of the curve at recall 0 and precision 1."""
    points = score_steps(df, by).select(
        *by,
        F.col("score").alias("threshold"),
        F.round(ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")), digits).alias("precision"),
        F.round(ratio(F.col("cum_pos"), F.col("all_pos")), digits).alias("recall"),
    )
    return with_end(points, by, {"precision": 1.0, "recall": 0.0})


def ranking_metrics(df: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """ROC-AUC with half credit for ties, and average precision as a step sum.

    AUC is NULL when only one class is present.
    """
    steps = score_steps(df, by)
    pairs = F.col("all_pos").cast("double") * F.col("all_neg")
    # Positives of this score beat every negative of a lower score and tie with their own.
    won = F.col("pos") * (F.col("all_neg") - F.col("cum_neg") + F.col("neg") * 0.5)
    precision = ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return steps.groupBy(*by).agg(
        F.round(F.try_divide(F.sum(won), F.max(pairs)), digits).alias("roc_auc"),
        F.round(F.sum(ratio(F.col("pos"), F.col("all_pos")) * precision), digits).alias("average_precision"),
    )


def log_loss(df: DataFrame, by: Sequence[str] = (), clip: float = CLIP, digits: int = 6) -> DataFrame:
    p = F.greatest(F.least(F.col("score"), F.lit(1.0 - clip)), F.lit(clip))
    loss = -F.when(F.col("y") == 1, F.ln(p)).otherwise(F.ln(1.0 - p))
    return df.groupBy(*by).agg(F.round(F.avg(loss), digits).alias("log_loss"))


def class_report(df: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Per-class precision, recall, F1 and support, with macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            F.round(p, digits).alias("precision"),
            F.round(r, digits).alias("recall"),
            F.round(f, digits).alias("f1_score"),
            n.alias("support"),
        )

    p0, r0, p1, r1 = ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(tp, tp + fp), ratio(tp, tp + fn)
    f0, f1_ = f1(p0, r0), f1(p1, r1)
    n0, n1 = tn + fp, tp + fn

    def weighted(a: Column, b: Column) -> Column:
        return ratio(a * n0 + b * n1, n0 + n1)

    lines = F.array(
        entry("0", p0, r0, f0, n0),
        entry("1", p1, r1, f1_, n1),
        entry("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, n0 + n1),
        entry("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1_), n0 + n1),
    )
    return confusion(df, by).select(*by, F.inline(lines))


def summary(df: DataFrame) -> DataFrame:
    """Rows ``(Metric, Value)``."""
    row = basic_metrics(confusion(df))
    names = {
        "accuracy": "Accuracy", "precision": "Precision", "recall": "Recall",
        "f1_score": "F1-Score", "specificity": "Specificity",
    }
    basic = row.withColumnsRenamed(names).unpivot([], list(names.values()), "Metric", "Value")
    auc = ranking_metrics(df).select(F.lit("ROC-AUC").alias("Metric"), F.col("roc_auc").alias("Value"))
    return basic.unionByName(auc)


def compare(df: DataFrame, model: str = "model") -> DataFrame:
    """Comparison table, best F1 first."""
    basic = basic_metrics(confusion(df, [model]), [model])
    ranked = ranking_metrics(df, [model]).drop("average_precision")
    return basic.join(ranked, model).orderBy(F.desc("f1_score"), model)


def compare_long(table: DataFrame, model: str = "model") -> DataFrame:
    metrics = [c for c in table.columns if c != model]
    return table.unpivot([model], metrics, "metric", "value")


def best_model(table: DataFrame, metric: str = "f1_score", model: str = "model") -> DataFrame:
    """The model of highest metric; among equals the first by name. Failed models have no metric."""
    return table.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), model).limit(1)
