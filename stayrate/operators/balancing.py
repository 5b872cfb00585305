"""Synthetic minority rows (SMOTE) for a training set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.ranks import running_totals
from stayrate.operators.neighbours import nearest_neighbours
from stayrate.session import cut_lineage


def unit(seed: int, *columns: Column | str) -> Column:
    """A repeatable uniform number in [0, 1) per row, from a hash of the given columns."""
    text = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in columns]))
    # 13 hexadecimal digits are 52 bits, which a double holds exactly.
    return F.conv(F.substring(text, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def smote(df: DataFrame, k: int = 5, seed: int = 42, id_column: str = "id", label: str = "y") -> DataFrame:
    """Raise the minority class to the size of the majority.

    ``df`` has a text id, an array ``x`` of numbers and a 0/1 label. Every minority row yields
    the same number of synthetic rows, and the rows of lowest id one more where the difference
    does not divide evenly. A synthetic row lies between its row and one of its k nearest
    minority neighbours, at a place that a hash of its id decides.
    """
    rows = cut_lineage(df.select(id_column, "x", label))
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    original = rows.withColumn("synthetic", F.lit(False))
    # A third class is enough to refuse.
    sizes = {r[label]: r["n"] for r in counts.limit(3).collect()}
    if len(sizes) != 2:
        raise ValueError(f"two classes are needed, found {len(sizes)} or more")
    minority = min(sizes, key=lambda c: (sizes[c], c))
    have, wanted = sizes[minority], max(sizes.values())
    if have == wanted:
        return original
    if have < 2:
        raise ValueError("the minority class needs two rows or more")

    small = rows.where(F.col(label) == minority).select(F.col(id_column).alias("rid"), "x")
    found = nearest_neighbours(small.withColumnRenamed("rid", "qid"), small, k)
    # At most k neighbours per row.
    near = (
        found.join(small.withColumnRenamed("x", "nx"), "rid")
        .groupBy("qid")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "nx"))).alias("near"))
    )
    each, extra = divmod(wanted - have, have)
    order = running_totals(small, [], "rid", {"n": F.count(F.lit(1))})
    copies = F.lit(each) + F.when(F.col("cum_n") <= extra, 1).otherwise(0)
    planned = order.select(F.col("rid").alias("qid"), copies.cast("int").alias("copies")).where("copies > 0")
    grown = (
        small.withColumnRenamed("rid", "qid")
        .join(planned, "qid")
        .join(near, "qid")
        .select("qid", "x", "near", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    pick = F.floor(unit(seed, "qid", "copy") * F.size("near")).cast("int")
    gap = unit(seed + 1, "qid", "copy")
    drawn = grown.select(
        "qid", "copy", "x", F.get("near", pick)["nx"].alias("nx"), gap.alias("gap")
    )
    synthetic = drawn.select(
        F.concat_ws("+", "qid", F.col("copy").cast("string")).alias(id_column),
        F.zip_with("x", "nx", lambda a, b: a + (b - a) * F.col("gap")).alias("x"),
        F.lit(minority).cast(rows.schema[label].dataType).alias(label),
        F.lit(True).alias("synthetic"),
    )
    return original.unionByName(synthetic)
