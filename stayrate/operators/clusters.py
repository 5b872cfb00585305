"""Customer clusters on scaled numeric columns.

All runs of a clustering, be they restarts or several numbers of clusters, share their passes: a
pass reads every row once, compares it with the centres of every run, and sends one row of sums
per run, centre and task. The number of jobs is that of the longest run, not of all runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.columns import is_yes, mean
from stayrate.operators.encoding import scale_standard
from stayrate.operators.vectors import assembler
from stayrate.schema import ID, NUMERIC, TARGET
from stayrate.session import cut_lineage

SEED = 42
REFINEMENTS = 30  # steps over the candidates of a run, before any pass over the rows


def scaled_vectors(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC), sample: bool = False) -> DataFrame:
    """The input with a vector ``features`` of its scaled columns; checkpointed, as every
    restart of the clustering reads it again."""
    names = {c: f"_{c}" for c in columns}
    doubled = df.withColumns({n: F.col(c).cast("double") for c, n in names.items()})
    scaled = scale_standard(doubled, list(names.values()), sample)
    return cut_lineage(assembler(list(names.values())).transform(scaled).drop(*names.values()))


@dataclass(frozen=True)
class Clusters:
    """Centres of one run, a row each, and the sum of squared distances to the nearest of them."""

    centres: np.ndarray
    cost: float

    def nearest(self, x: Column) -> Column:
        """Number of the nearest centre of an array column, from 0; the lower one on a tie."""
        def gap(centre: np.ndarray) -> Column:
            squares = F.zip_with(x, F.lit(centre.tolist()), lambda a, b: (a - b) * (a - b))
            return F.aggregate(squares, F.lit(0.0), lambda total, v: total + v)

        gaps = [F.struct(gap(c).alias("gap"), F.lit(i).alias("number")) for i, c in enumerate(self.centres)]
        return F.array_min(F.array(*gaps))["number"]


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of all rows to all centres, one coordinate at a time."""
    total = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        gap = x[:, j, None] - centres[None, :, j]
        total += gap * gap
    return total


def matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float)


def nearest_sums(points: DataFrame, runs: dict[int, np.ndarray], size: int) -> dict[int, pd.DataFrame]:
    """One pass for all runs: rows, cost and coordinate sums of each centre that has any row.

    What is shuffled is a row per run, centre and task; what comes back a row per run and centre.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {run: np.zeros((len(centres), size + 2)) for run, centres in runs.items()}
        for batch in batches:
            x = matrix(batch["x"])
            for run, centres in runs.items():
                gaps = squared_distances(x, centres)
                near = gaps.argmin(axis=1)
                parts = [np.ones(len(x)), gaps[np.arange(len(x)), near], *x.T]
                found[run] += np.stack([np.bincount(near, p, len(centres)) for p in parts], axis=1)
        for run, table in found.items():
            used = np.flatnonzero(table[:, 0])
            yield pd.DataFrame({"run": run, "centre": used, "sums": pd.Series(list(table[used]), dtype=object)})

    sums = points.mapInPandas(partial, "run int, centre int, sums array<double>")
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size + 2)]
    table = sums.groupBy("run", "centre").agg(*totals).orderBy("run", "centre").toPandas()
    return {run: part.reset_index(drop=True) for run, part in table.groupby("run")}


def row_chance(places: pd.Series, seed: int, run: int) -> np.ndarray:
    """Uniform numbers in [0, 1) that depend on a row's hash, the seed and the run alone."""
    # The usual 64-bit finisher, on the row's hash moved by seed and run.
    start = 0x9E3779B97F4A7C15 * ((seed << 20) + run + 1) % (1 << 64)
    z = places.to_numpy().astype(np.uint64) + np.uint64(start)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def draw_far(points: DataFrame, runs: dict[int, np.ndarray], costs: dict[int, float], wanted: dict[int, int], seed: int) -> dict[int, np.ndarray]:
    """One pass for all runs: each draws about ``wanted`` rows, a row by its share of the run's cost."""

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = matrix(batch["x"])
            for run, centres in runs.items():
                share = squared_distances(x, centres).min(axis=1) * (wanted[run] / costs[run])
                hit = row_chance(batch["place"], seed, run) < share
                yield pd.DataFrame({"run": run, "x": pd.Series(list(x[hit]), dtype=object)})

    # About ``wanted`` rows per run, however many rows there are.
    table = points.mapInPandas(drawn, "run int, x array<double>").toPandas()
    return {run: np.unique(matrix(part["x"]), axis=0) for run, part in table.groupby("run")}


def spread_seeds(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ and its refinement over the few weighted candidates of one run; fewer centres if no
    more differ."""
    chosen = [rng.choice(len(candidates), p=weights / weights.sum())]
    while len(chosen) < k:
        pull = weights * squared_distances(candidates, candidates[chosen]).min(axis=1)
        if not pull.sum():
            break
        chosen.append(rng.choice(len(candidates), p=pull / pull.sum()))
    centres = candidates[chosen]
    for _ in range(REFINEMENTS):
        near = squared_distances(candidates, centres).argmin(axis=1)
        mass = np.bincount(near, weights, len(centres))
        sums = np.stack([np.bincount(near, weights * x, len(centres)) for x in candidates.T], axis=1)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1)[:, None], centres)
    return centres


def first_centres(points: DataFrame, ks: dict[int, int], size: int, seed: int, rounds: int) -> dict[int, np.ndarray]:
    """Scalable k-means++ for all runs at once: a row each, then rounds of far rows, then k of these."""
    start = points.orderBy("place", "x").select("x").limit(len(ks)).toPandas()
    if start.empty:
        raise ValueError("no rows to cluster")
    first = matrix(start["x"])
    found = {run: first[[i % len(first)]] for i, run in enumerate(ks)}
    for step in range(rounds):
        costs = {run: float(t["s1"].sum()) for run, t in nearest_sums(points, found, size).items()}
        # A run of one cluster needs no seeds, and one of cost 0 has a centre on every row.
        going = {run: c for run, c in found.items() if costs[run] > 0 and ks[run] > 1}
        if not going:
            break
        wanted = {run: 2 * ks[run] for run in going}
        for run, rows in draw_far(points, going, costs, wanted, seed + step).items():
            found[run] = np.unique(np.vstack([found[run], rows]), axis=0)
    seeds = {}
    for run, table in nearest_sums(points, found, size).items():
        held = found[run][table["centre"]]
        seeds[run] = spread_seeds(held, table["s0"].to_numpy(), ks[run], np.random.default_rng([seed, run]))
    return seeds


def fit_runs(
    vectors: DataFrame, ks: Sequence[int], seed: int = SEED, steps: int = 20, tolerance: float = 1e-4, rounds: int = 2
) -> list[Clusters]:
    """One clustering per entry of ``ks``, all in the same passes over ``vectors``.

    A run rests once no centre moves by more than ``tolerance``. A centre that loses all its rows
    stays where it is. Rows are told apart by a hash, so a second fit gives the same clusters.
    """
    names = [f.name for f in vectors.schema if f.name != "features"]
    x = vector_to_array("features")
    points = vectors.select(x.alias("x"), F.xxhash64(x, *names).alias("place"))
    shape = points.select(F.size("x")).head()
    if shape is None:
        raise ValueError("no rows to cluster")
    size = shape[0]
    runs = first_centres(points, dict(enumerate(ks)), size, seed, rounds)
    moving = dict(runs)
    for _ in range(steps):
        if not moving:
            break
        still = {}
        for run, table in nearest_sums(points, moving, size).items():
            centres = runs[run].copy()
            sums = table[[f"s{i + 2}" for i in range(size)]].to_numpy()
            centres[table["centre"]] = sums / table["s0"].to_numpy()[:, None]
            moved = ((centres - runs[run]) ** 2).sum(axis=1).max()
            runs[run] = centres
            if moved > tolerance**2:
                still[run] = centres
        moving = still
    costs = nearest_sums(points, runs, size)
    return [Clusters(runs[run], float(costs[run]["s1"].sum())) for run in range(len(ks))]


def fit_clusters(vectors: DataFrame, k: int = 4, restarts: int = 25, seed: int = SEED) -> Clusters:
    """The run of lowest cost out of ``restarts``."""
    return min(fit_runs(vectors, [k] * restarts, seed), key=lambda run: run.cost)


def assign_clusters(model: Clusters, vectors: DataFrame, order_by: str = "tenure") -> DataFrame:
    """Cluster numbers from 1 in order of mean tenure, so that equal clusters get equal numbers."""
    found = vectors.withColumn("prediction", model.nearest(vector_to_array("features")))
    # One row per cluster: the window runs over k rows.
    rank = Window.partitionBy(F.lit(0)).orderBy("m", "prediction")
    numbered = (
        found.groupBy("prediction")
        .agg(F.avg(order_by).alias("m"))
        .select("prediction", F.row_number().over(rank).alias("cluster"))
    )
    return found.join(F.broadcast(numbered), "prediction").drop("prediction")


def cluster_profile(clustered: DataFrame) -> DataFrame:
    return (
        clustered.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("tenure"), 2).alias("avg_tenure"),
            mean("MonthlyCharges").alias("avg_monthly"),
            mean("TotalCharges").alias("avg_total"),
            F.sum(is_yes(TARGET)).alias("churned"),
            F.round(F.avg(is_yes(TARGET)) * 100, 2).alias("churn_rate"),
        )
        .orderBy("cluster")
    )


def elbow(vectors: DataFrame, ks: Sequence[int] = tuple(range(1, 11)), seed: int = SEED) -> DataFrame:
    """Within-cluster sum of squares per k, all k in the same passes."""
    rows = [(k, run.cost) for k, run in zip(ks, fit_runs(vectors, ks, seed), strict=True)]
    return vectors.sparkSession.createDataFrame(rows, "k int, wss double")


def plane(vectors: DataFrame, id_column: str = ID) -> DataFrame:
    """Two principal components per row, for a cluster picture."""
    projected = PCA(k=2, inputCol="features", outputCol="pc").fit(vectors).transform(vectors)
    pc = vector_to_array("pc")
    return projected.select(id_column, pc[0].alias("pc1"), pc[1].alias("pc2"))
