"""Exact k nearest neighbours between two large sets, without emitting pairs.

Reference vectors lie in cells, in two levels: coarse cells, whose number grows with the square root of
the references, and inside each coarse cell cells of its own, which stay a table. Cells are made by cuts
of one coordinate, chosen on a sample; every reference is assigned, and a cell's box (least and greatest
value of each coordinate) and size come from all its rows. A query first searches its own cell; the
distance of its k-th candidate there is a bound (and so is the reach of the nearest cells that hold
enough rows), and only cells whose box begins within that bound are searched after it: coarse cells
first, then the inner cells of those. Cuts at the two values of an indicator leave boxes without width
there, so in one-hot vectors few boxes are near. Cells and the queries sent to them are cut
into blocks of bounded size, so a cell that holds a third of all rows is spread over many tasks. A
block comparison runs in numpy and emits at most k rows per query. Tables of any size take this
path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.session import cut_lineage

BLOCK = 8192  # rows of either side in one block comparison, about
CELL = 2048  # reference rows per cell, about: small cells prune better
# Sampled rows from which cuts are chosen: per coarse cell, and per inner cell.
COARSE_SAMPLE, SAMPLE = 64, 16
# Slack on pruning bounds, so that rounding never excludes a true neighbour.
SLACK = 1e-9
MARGIN = 1e-10
PAIRS = 200_000
STEP = 512  # rows that are compared with all pivots at a time


def box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of every row of ``x`` to the points of every box."""
    near, far = np.zeros((len(x), len(low))), np.zeros((len(x), len(low)))
    for j in range(x.shape[1]):
        below, above = low[None, :, j] - x[:, j, None], x[:, j, None] - high[None, :, j]
        gap, reach = np.maximum(np.maximum(below, above), 0), np.minimum(below, above)
        near += gap * gap
        far += reach * reach
    return np.sqrt(near), np.sqrt(far)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float)


def nearest_in_block(queries: pd.DataFrame, refs: pd.DataFrame, k: int, step: int = 512) -> Iterator[pd.DataFrame]:
    """The k nearest reference rows of each query row, ties by reference id.

    Squared distances from one matrix product choose the candidates, with a margin far above
    their rounding error; the distances that rank them are then computed from differences.
    """
    refs = refs.sort_values("rid", kind="stable").reset_index(drop=True)
    b = _matrix(refs["rx"])
    b_norm = (b * b).sum(axis=1)
    rids = refs["rid"].to_numpy()
    for start in range(0, len(queries), step):
        part = queries.iloc[start : start + step]
        a = _matrix(part["qx"])
        a_norm = (a * a).sum(axis=1)
        d = a_norm[:, None] + b_norm[None, :] - 2 * (a @ b.T)
        own = pd.Index(rids).get_indexer(part["qid"])
        d[np.flatnonzero(own >= 0), own[own >= 0]] = np.inf  # a row is not its own neighbour
        last = min(k, d.shape[1]) - 1
        limit = np.partition(d, last, axis=1)[:, last] + MARGIN * (a_norm + b_norm.max())
        rows, cols = np.nonzero((d <= limit[:, None]) & np.isfinite(d))
        dist = np.empty(len(rows))
        for i in range(0, len(rows), PAIRS):  # many ties at the limit must not fill the memory
            gap = a[rows[i : i + PAIRS]] - b[cols[i : i + PAIRS]]
            dist[i : i + PAIRS] = np.sqrt((gap * gap).sum(axis=1))
        # Columns stand in id order, so ties at the limit go to the lowest ids.
        order = np.lexsort((cols, dist, rows))
        rows, cols, dist = rows[order], cols[order], dist[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < k
        yield pd.DataFrame(
            {"qid": part["qid"].to_numpy()[rows[kept]], "rid": rids[cols[kept]], "dist": dist[kept]}
        )


def best_cut(rows: np.ndarray) -> tuple[int, float] | None:
    """The coordinate and value that part ``rows`` (below it, or not) best: by the variance between the
    parts, times the share of the smaller part. None if all rows are equal."""
    n = len(rows)
    middle = np.sort(rows, axis=0)[n // 2]
    above = np.where(rows > middle, rows, np.inf).min(axis=0)
    best, found = 0.0, None
    for cut in (middle, above):
        right = rows >= cut
        held = right.sum(axis=0)
        held_left = n - held
        gap = np.where(right, rows, 0).sum(axis=0) / np.maximum(held, 1) - np.where(right, 0, rows).sum(axis=0) / np.maximum(held_left, 1)
        gain = held * held_left * gap * gap * np.minimum(held, held_left)
        j = int(gain.argmax())
        if gain[j] > best:
            best, found = gain[j], (j, float(cut[j]))
    return found


@dataclass
class Tree:
    """Cuts: node ``i`` sends rows below ``cut`` in ``feature`` to node ``left``, others to the one after it. A leaf
    has feature -1, and the number of its cell in ``left``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        at, every = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            j = self.feature[at]
            if (j < 0).all():
                return self.left[at]
            at = np.where(j < 0, at, self.left[at] + (x[every, j] >= self.cut[at]))


def cut_into(rows: np.ndarray, cells: int) -> tuple[Tree, np.ndarray]:
    """At most ``cells`` cells of about as many ``rows`` each, and the first row of every cell."""
    nodes, first = [(-1, 0.0, 0)], []
    todo = [(0, np.arange(len(rows)), cells)]
    while todo:
        node, at, wanted = todo.pop()
        split = best_cut(rows[at]) if wanted > 1 and len(at) > 1 else None
        if split is None:
            nodes[node] = (-1, 0.0, len(first))
            first.append(at[0])
            continue
        right = rows[at, split[0]] >= split[1]
        share = min(max(round(wanted * (1 - right.mean())), 1), wanted - 1)
        nodes[node] = (*split, len(nodes))
        todo += [(len(nodes), at[~right], share), (len(nodes) + 1, at[right], wanted - share)]
        nodes += [(-1, 0.0, 0)] * 2
    types = (np.int64, np.float64, np.int64)
    return Tree(*[np.array([n[i] for n in nodes], t) for i, t in enumerate(types)]), np.array(first)


@dataclass
class Coarse:
    """Coarse cells: the cuts that lead to them, a sampled reference in each, their boxes and sizes; arrays as
    long as the square root of the number of cells."""

    tree: Tree
    pivots: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray


def enough(reach: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Per row, the least reach within which cells hold ``k`` rows or more; infinite without any."""
    order = np.argsort(reach, axis=1, kind="stable")
    held = np.cumsum(size[order], axis=1)
    at = (held < k).sum(axis=1)
    found = at < held.shape[1]
    rows = np.arange(len(reach))
    last = order[rows, np.minimum(at, held.shape[1] - 1)]
    return np.where(found, reach[rows, last], np.inf)


def pick_rows(refs: DataFrame, count: int) -> np.ndarray:
    """A fixed pseudo-random choice of ``count`` reference vectors, brought to the driver."""
    rows = refs.select("rid", "x").orderBy(F.md5(F.concat(F.lit("pivot:"), "rid")), "rid").limit(count).collect()
    return np.array([r["x"] for r in rows], dtype=float)


def assign_coarse(df: DataFrame, tree: Tree, pivots: np.ndarray) -> DataFrame:
    """The coarse cell of every row, and whether the row equals the cell's pivot."""

    @F.pandas_udf("coarse int, first boolean")
    def assigned(x: pd.Series) -> pd.DataFrame:
        rows = _matrix(x)
        at = tree.cells(rows)
        return pd.DataFrame({"coarse": at.astype("int32"), "first": (rows == pivots[at]).all(axis=1)})

    return df.withColumn("_c", assigned("x")).select(*df.columns, "_c.coarse", "_c.first")


def together(left: DataFrame, right: DataFrame, keys: list[str], search: Callable, schema: str) -> DataFrame:
    """``search`` over the rows of both sides that share ``keys``. Groups take much time for their bytes, so their
    number of tasks goes by the cores and not by the bytes."""
    spark = left.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)


def meet_cells(rows: DataFrame, cells: DataFrame, id_column: str, block: int, compare: Callable, schema: str) -> DataFrame:
    """``compare(cells)(rows)`` for all rows of each coarse cell, in blocks, with all that ``cells`` has of it."""
    n = F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int")
    plan = rows.groupBy("coarse").agg(n.alias("n"))
    left = rows.join(plan, "coarse").withColumn("part", F.pmod(F.xxhash64(id_column), F.col("n")).cast("int"))
    right = cells.join(plan, "coarse").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    names = [field.split()[0] for field in schema.split(", ")]

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame(columns=names)
        compared = compare(b.sort_values("cell", kind="stable"))
        return pd.concat([compared(a.iloc[i : i + STEP]) for i in range(0, len(a), STEP)], ignore_index=True)[names]

    # Both sides may stem from one frame: columns of their own keep them apart.
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns if c != "n"]) for df in (left, right))
    return together(left, right, ["coarse", "part"], search, schema)


def reference_cells(refs: DataFrame, cell: int, block: int) -> tuple[DataFrame, DataFrame, Coarse]:
    """References with their ``cell``, the inner cells ``(coarse, cell, low, high, size)``, and the
    coarse level. A cell is named after a reference in it."""
    wanted = max(1, int(np.ceil(np.sqrt(refs.count() / cell))))
    sample = pick_rows(refs, COARSE_SAMPLE * wanted)
    tree, first = cut_into(sample, wanted)
    refs = cut_lineage(assign_coarse(refs, tree, sample[first]))
    # A hash chooses the rows that inner cuts are made from; a coarse cell's pivot is always one.
    step = max(1, cell // SAMPLE)
    chosen = (F.pmod(F.xxhash64("rid"), F.lit(step)) == 0) | F.col("first")
    chosen = cut_lineage(refs.where(chosen).select("coarse", F.col("rid").alias("cell"), F.col("x").alias("px")))

    def inner(b: pd.DataFrame) -> Callable:
        inside, named = cut_into(_matrix(b["px"]), int(np.ceil(len(b) * step / cell)))
        names = b["cell"].to_numpy()[named]
        return lambda a: a.assign(cell=names[inside.cells(_matrix(a["x"]))])

    refs = cut_lineage(meet_cells(refs, chosen, "rid", block, inner, "rid string, x array<double>, coarse int, cell string"))
    every = range(sample.shape[1])

    def box(low: str, high: str) -> list:
        return [F.array(*[f(F.col(c)[i]) for i in every]).alias(n) for c, n, f in ((low, "low", F.min), (high, "high", F.max))]

    cells = cut_lineage(refs.groupBy("coarse", "cell").agg(*box("x", "x"), F.count(F.lit(1)).alias("size")))
    whole = cells.groupBy("coarse").agg(*box("low", "high"), F.sum("size").alias("size")).orderBy("coarse").collect()
    return refs.select("rid", "x", "cell"), cells, Coarse(tree, sample[first], *[np.array([r[c] for r in whole], dtype=float) for c in ("low", "high", "size")])


def home_cells(queries: DataFrame, cells: DataFrame, coarse: Coarse, k: int, block: int) -> DataFrame:
    """Queries ``(qid, x, coarse, cell, bound)`` with their own cell, and a bound on the distance of
    the k-th neighbour from the reach of cells that hold enough rows."""

    def home(b: pd.DataFrame) -> Callable:
        low, high, size, names = _matrix(b["low"]), _matrix(b["high"]), b["size"].to_numpy(), b["cell"].to_numpy()

        def find(a: pd.DataFrame) -> pd.DataFrame:
            x = _matrix(a["x"])
            near, far = box_distances(x, low, high)
            # One row more, as a query may be a reference itself.
            inner = enough(far, size, k + 1)
            outer = enough(box_distances(x, coarse.low, coarse.high)[1], coarse.size, k + 1)
            return a.assign(cell=names[near.argmin(axis=1)], bound=np.minimum(inner, outer))

        return find

    rows = cut_lineage(assign_coarse(queries.select("qid", "x"), coarse.tree, coarse.pivots).drop("first"))
    return meet_cells(rows, cells, "qid", block, home, "qid string, x array<double>, coarse int, cell string, bound double")


def reached_cells(queries: DataFrame, cells: DataFrame, coarse: Coarse, block: int) -> DataFrame:
    """``(qid, x, cell)``: the cells, other than its own, that begin within a query's ``bound``."""

    @F.pandas_udf("array<int>")
    def reach(x: pd.Series, limit: pd.Series) -> pd.Series:
        rows, most, out = _matrix(x), limit.to_numpy() * (1 + SLACK) + SLACK, []
        for i in range(0, len(rows), STEP):
            near = box_distances(rows[i : i + STEP], coarse.low, coarse.high)[0] <= most[i : i + STEP, None]
            out += [np.flatnonzero(row).astype("int32").tolist() for row in near]
        return pd.Series(out)

    def inside(b: pd.DataFrame) -> Callable:
        low, high, names = _matrix(b["low"]), _matrix(b["high"]), b["cell"].to_numpy()

        def find(a: pd.DataFrame) -> pd.DataFrame:
            near = box_distances(_matrix(a["x"]), low, high)[0] <= a["bound"].to_numpy()[:, None] * (1 + SLACK) + SLACK
            near &= a["cell"].to_numpy()[:, None] != names[None, :]
            return a[["qid", "x"]].assign(cells=[names[row].tolist() for row in near])

        return find

    spread = cut_lineage(queries.withColumn("coarse", F.explode(reach("x", "bound"))))
    # A list per query leaves the task, not a copy of the vector per cell.
    found = meet_cells(spread, cells, "qid", block, inside, "qid string, x array<double>, cells array<string>")
    return found.select("qid", "x", F.explode("cells").alias("cell"))


def compare_blocks(queries: DataFrame, refs: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """Candidates ``(qid, rid, dist)`` of queries against the references of the same cell.

    Both sides of a cell are cut by hash into blocks; every query block meets every reference
    block of its cell in a group of its own.
    """

    def blocks(df: DataFrame) -> DataFrame:
        n = F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int")
        return df.groupBy("cell").agg(n.alias("n"))

    # One row per cell: the planner decides by its size how it is joined.
    plan = blocks(queries).withColumnRenamed("n", "nq").join(blocks(refs).withColumnRenamed("n", "nr"), "cell")
    plan = cut_lineage(plan)
    q = queries.join(plan, "cell").select(
        F.col("cell").alias("cell"),
        F.pmod(F.xxhash64("qid"), F.col("nq")).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("rb"),
        "qid",
        F.col("x").alias("qx"),
    )
    r = refs.join(plan, "cell").select(
        F.col("cell").alias("cell"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"),
        F.pmod(F.xxhash64("rid"), F.col("nr")).cast("int").alias("rb"),
        "rid",
        F.col("x").alias("rx"),
    )
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": pd.Series(dtype=str), "rid": pd.Series(dtype=str), "dist": pd.Series(dtype=float)})
        if left.empty or right.empty:
            return empty
        return pd.concat([empty, *nearest_in_block(left, right, k)], ignore_index=True)

    return together(q, r, ["cell", "qb", "rb"], search, "qid string, rid string, dist double")


def keep_nearest(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest candidates of every query, ranked from 1, ties by reference id."""
    order = Window.partitionBy("qid").orderBy("dist", "rid")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    queries: DataFrame, refs: DataFrame, k: int, block: int = BLOCK, cell: int = CELL
) -> DataFrame:
    """Rows ``(qid, rid, dist, rank)`` with the exact k nearest references of every query.

    ``queries`` has ``(qid, x)`` and ``refs`` ``(rid, x)``: text ids and arrays of doubles. A row
    is never its own neighbour. One with a NULL or NaN in its vector is none of any, and has none.
    """
    unknown = F.exists("x", lambda v: v.isNull() | F.isnan(v))
    queries, refs = (df.where(F.col("x").isNotNull() & ~unknown) for df in (queries, refs))
    # Equal vectors tie, and ties go by id: of any number of copies only k + 1 can be chosen by
    # anyone. The rank filter is applied before the shuffle as well as after it.
    copies = Window.partitionBy("x").orderBy("rid")
    distinct = refs.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1).drop("_n")
    refs = cut_lineage(distinct.select("rid", "x"))
    if refs.isEmpty():
        return queries.sparkSession.createDataFrame([], "qid string, rid string, dist double, rank int")
    refs, cells, coarse = reference_cells(refs, cell, block)
    queries = cut_lineage(home_cells(queries, cells, coarse, k, block))
    home = cut_lineage(keep_nearest(compare_blocks(queries, refs, k, block), k))
    found = home.groupBy("qid").agg(F.max("dist").alias("_far"), F.count(F.lit(1)).alias("_n"))
    closer = F.when(F.col("_n") >= k, F.least("bound", "_far")).otherwise(F.col("bound"))
    bounded = queries.join(found, "qid", "left").withColumn("bound", closer).drop("_far", "_n")
    others = cut_lineage(reached_cells(bounded, cells, coarse, block))
    return keep_nearest(home.drop("rank").unionByName(compare_blocks(others, refs, k, block)), k)


def knn_vote(queries: DataFrame, refs: DataFrame, k: int = 5) -> DataFrame:
    """Distance-weighted vote ``(qid, score)``: the weighted share of 1-labels among the k nearest.

    ``refs`` also has a 0/1 ``y``. A neighbour at distance 0 outweighs all others.
    """
    found = nearest_neighbours(queries, refs, k).join(refs.select("rid", "y"), "rid")
    at_zero = F.count_if(F.col("dist") == 0)
    zero_vote = F.try_divide(F.sum(F.when(F.col("dist") == 0, F.col("y"))).cast("double"), at_zero)
    weight = F.when(F.col("dist") > 0, F.try_divide(F.lit(1.0), F.col("dist")))
    vote = F.try_divide(F.sum(weight * F.col("y")), F.sum(weight))
    return found.groupBy("qid").agg(F.when(at_zero > 0, zero_vote).otherwise(vote).alias("score"))
