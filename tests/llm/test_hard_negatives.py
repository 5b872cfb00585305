import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.llm import hard_negatives as hard

ROWS = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=5, positives=5, negatives=3, low=50, high=95):
    """By brute force, in whole numbers."""
    took = []
    for i, x, y in rows:
        if i is None or x is None or y is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        v = [math.floor(256 * float(np.float32(c))) for c in x]
        if sum(c * c for c in v) < 2**55:
            took.append((i, v, y))
    out = []
    for a, (i, v, y) in enumerate(took):
        if i % every:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, z) for b, (j, w, z) in enumerate(took) if b != a]
        for s, j, _ in sorted(x for x in scored if x[2] == y)[:positives]:
            fits = sorted(x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s)
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def clustered(n, size=6, seed=0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(7, size))
    return [(i, (centres[i % 7] + 0.3 * random.normal(size=size)).astype(np.float32).tolist(), int(random.integers(3))) for i in range(n)]


EDGES = [
    (None, [1.0] * 6, 1), (5, None, 1), (10, [1.0] * 6, None), (15, [1.0, None] * 3, 1), (20, [float("nan")] * 6, 1), (25, [float("inf")] * 6, 1),
    (30, [], 1), (35, [0.5, 0.25], 1), (40, [0.0] * 6, 2), (40, [0.3] * 6, 2), (40, [0.3] * 6, 2), (40, [0.3] * 6, 0), (45, [3e38] * 6, 0), (50, [1e4] * 6, 0),
    (-5, [-1.0] * 6, 0), (-10, [-1.0] * 6, 1), (55, [1.0] * 6, 77), (60, [2e5] * 6, 1), (61, [2e5] * 6, 1), (62, [1.5e5] * 6, 2),
]


@pytest.fixture(scope="module")
def rows():
    return EDGES + [(i + 100, x, y) for i, x, y in clustered(150)]


@pytest.mark.parametrize("cell, first", [(1024, 8), (8, 1), (20, 3)])
def test_equals_brute_force(spark, rows, monkeypatch, cell, first):
    monkeypatch.setattr(hard, "CELL_ROWS", cell)
    monkeypatch.setattr(hard, "FIRST_CELLS", first)
    monkeypatch.setattr(hard, "MORE", 2)
    docs = spark.createDataFrame(rows, ROWS).withColumns({"row": F.lit("x"), "cell": F.lit(1), "Vec": F.lit(2), "score": F.lit(3)}).repartition(3)
    assert got(hard.mine(docs, "id % 5 = 0")) == plain(rows)


def test_other_windows(spark, rows):
    docs = spark.createDataFrame(rows, ROWS)
    assert got(hard.mine(docs, "id % 3 = 0", positives=2, negatives=6, low=10, high=120)) == plain(rows, 3, 2, 6, 10, 120)


def test_hot_vector(spark, monkeypatch):
    """A third of all rows hold one vector and label: few of them are indexed, all may be anchors."""
    monkeypatch.setattr(hard, "CELL_ROWS", 32)
    rows = [(i, [0.5, 0.5, 0.1], 1) for i in range(200)] + [(i + 200, x[:3], y) for i, x, y in clustered(400)]
    docs = spark.createDataFrame(rows, ROWS)
    assert got(hard.mine(docs, "id % 50 = 0")) == plain(rows, 50)
    from stayrate.llm.scratch import Scratch

    taken = hard.prepared(docs, "vec_id", "embedding", "label", 256.0)
    _, blocks = hard.indexed(taken, Scratch(spark), 6)
    sizes = [hard.unpacked(r["rows"]).num_rows for r in blocks.collect()]
    assert sum(sizes) == 406 and max(sizes) < 64


def test_cells_come_by_falling_bounds_and_stop():
    random = np.random.default_rng(2)
    codes = hard.Codes([random.normal(size=(5, 2)), random.normal(size=(4, 2))], [random.random(5), random.random(4)], 4)
    anchors = random.normal(size=(3, 4))
    upper = [p @ b.T + np.linalg.norm(p, axis=1)[:, None] * r for p, b, r in zip(codes.halves(anchors), codes.books, codes.radii)]
    every = dict(codes.cells(anchors, np.full(3, -1e18), np.full(3, 1e18), np.zeros(3, int), 10**6))
    for i, cells in every.items():
        bounds = upper[0][i][cells // 4] + upper[1][i][cells % 4]
        assert sorted(cells) == list(range(20)) and (np.diff(bounds) <= 1e-12).all()
    third = every[0][7]
    least = upper[0][0][third // 4] + upper[1][0][third % 4] + 1.5
    stopped = dict(codes.cells(anchors[:1], np.array([least]), np.array([1e18]), np.zeros(1, int), 10**6))
    assert len(stopped.get(0, ())) <= 8
    later = dict(codes.cells(anchors, np.full(3, -1e18), np.full(3, 1e18), np.full(3, 15), 3))
    assert all((later[i] == every[i][15:18]).all() for i in range(3))


def test_empty_tables(spark):
    assert hard.mine(spark.createDataFrame([], ROWS), "id % 50 = 0").collect() == []
    assert hard.mine(spark.createDataFrame([(50, [1.0], 1), (50, None, 1)], ROWS), "id % 50 = 0").collect() == []
