"""Exact neighbours against brute force, over several cells and blocks and with many copies."""

import numpy as np
import pytest

from stayrate.operators.neighbours import enough, home_cells, knn_vote, nearest_neighbours, reached_cells, reference_cells


def brute(queries, refs, k):
    out = {}
    for qid, x in queries:
        found = sorted((float(np.sqrt(((np.array(x) - np.array(r)) ** 2).sum())), rid) for rid, r in refs if rid != qid)
        out[qid] = [rid for _, rid in found[:k]]
    return out


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["qid"], r["rank"])):
        out.setdefault(r["qid"], []).append(r["rid"])
    return out


@pytest.mark.parametrize("block, cell", [(16, 20), (16, 8192), (8192, 8192), (8192, 10)])
def test_matches_brute_force(spark, block, cell):
    rng = np.random.default_rng(5)
    refs = [(f"r{i:03}", rng.integers(0, 12, 2).astype(float).tolist()) for i in range(150)]
    refs += [(f"h{i:03}", [3.0, 3.0]) for i in range(75)]  # a third of all rows at one place
    rdf = spark.createDataFrame(refs, "rid string, x array<double>")
    queries = [(f"q{i:03}", rng.integers(0, 12, 2).astype(float).tolist()) for i in range(40)] + refs[:20] + refs[-20:]
    qdf = spark.createDataFrame(queries, "qid string, x array<double>")
    assert ranked(nearest_neighbours(qdf, rdf, 4, block, cell)) == brute(queries, refs, 4)


def test_fewer_references_than_neighbours(spark):
    rdf = spark.createDataFrame([("a", [0.0]), ("b", [1.0])], "rid string, x array<double>")
    qdf = spark.createDataFrame([("a", [0.0]), ("z", [5.0])], "qid string, x array<double>")
    assert ranked(nearest_neighbours(qdf, rdf, 5)) == {"a": ["b"], "z": ["b", "a"]}
    assert nearest_neighbours(qdf, rdf.limit(0), 5).count() == 0


def test_votes(spark):
    refs = [("a", [0.0], 1), ("b", [1.0], 0), ("c", [3.0], 0)]
    rdf = spark.createDataFrame(refs, "rid string, x array<double>, y int")
    qdf = spark.createDataFrame([("on", [0.0]), ("near", [0.5]), ("far", [2.0])], "qid string, x array<double>")
    got = {r["qid"]: r["score"] for r in knn_vote(qdf, rdf, 3).collect()}
    assert got["on"] == 1.0
    assert got["near"] == pytest.approx(2 / (2 + 2 + 0.4))
    assert got["far"] == pytest.approx(0.5 / (0.5 + 1 + 1))


def test_one_hot_vectors_with_many_ties(spark):
    rng = np.random.default_rng(9)
    refs = [(f"r{i:03}", rng.integers(0, 2, 6).astype(float).tolist()) for i in range(120)]
    rdf = spark.createDataFrame(refs, "rid string, x array<double>")
    found = nearest_neighbours(rdf.withColumnRenamed("rid", "qid"), rdf, 5, 32, 25)
    assert ranked(found) == brute(refs, refs, 5)


def test_far_from_the_origin(spark):
    """Large norms make the matrix product inexact; the chosen neighbours stay exact."""
    rng = np.random.default_rng(2)
    refs = [(f"r{i:03}", (1e6 + rng.normal(0, 1e-2, 3)).tolist()) for i in range(80)]
    rdf = spark.createDataFrame(refs, "rid string, x array<double>")
    assert ranked(nearest_neighbours(rdf.withColumnRenamed("rid", "qid"), rdf, 3)) == brute(refs, refs, 3)


def test_work_per_query_does_not_grow(spark):
    """In few dimensions a query meets about as many references in a table ten times as large."""
    rng = np.random.default_rng(4)
    met = {}
    for n in (2000, 20000):
        points = [(f"p{i:05}", rng.uniform(0, 1, 2).tolist()) for i in range(n)]
        refs = spark.createDataFrame(points, "rid string, x array<double>")
        queries = spark.createDataFrame(points[:400], "qid string, x array<double>")
        cells, pivots, coarse = reference_cells(refs, 50, 8192)
        assert len(coarse.pivots) <= np.ceil(np.sqrt(n / 50))
        own = home_cells(queries, pivots, coarse, 3, 8192)
        sizes = {r["cell"]: r["size"] for r in pivots.collect()}
        assert sum(sizes.values()) == n == cells.count()
        visits = own.select("cell").union(reached_cells(own, pivots, coarse, 8192).select("cell")).collect()
        met[n] = sum(sizes[r["cell"]] for r in visits) / 400
    assert met[20000] < 1.5 * met[2000]
    assert met[20000] < 2000


def test_cells_that_hold_enough():
    reach = np.array([[3.0, 1.0, 2.0], [1.0, 5.0, 9.0]])
    size = np.array([4, 1, 2])
    assert enough(reach, size, 1).tolist() == [1.0, 1.0]
    assert enough(reach, size, 3).tolist() == [2.0, 1.0]
    assert enough(reach, size, 7).tolist() == [3.0, 9.0]
    assert enough(reach, size, 8).tolist() == [np.inf, np.inf]


def test_equal_vectors_and_no_queries(spark):
    rdf = spark.createDataFrame([(f"r{i}", [1.0, 1.0]) for i in range(40)], "rid string, x array<double>")
    found = ranked(nearest_neighbours(rdf.withColumnRenamed("rid", "qid"), rdf, 3, 8, 4))
    assert found["r0"] == ["r1", "r10", "r11"] and found["r39"] == ["r0", "r1", "r10"] and len(found) == 40
    assert nearest_neighbours(rdf.withColumnRenamed("rid", "qid").limit(0), rdf, 3).count() == 0


def test_few_cells_are_near_in_one_hot_vectors(spark):
    """Indicators part the rows without a remainder: of many cells a query meets few."""
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 2, (6000, 7)) * 2.0
    points = [(f"p{i:04}", [*b.tolist(), *(2 - b).tolist(), float(v)]) for i, (b, v) in enumerate(zip(bits, rng.uniform(0, 1, 6000)))]
    refs = spark.createDataFrame(points, "rid string, x array<double>")
    queries = spark.createDataFrame(points[:300], "qid string, x array<double>")
    cells, inner, coarse = reference_cells(refs, 40, 8192)
    own = home_cells(queries, inner, coarse, 3, 8192)
    near = own.select("cell").union(reached_cells(own, inner, coarse, 8192).select("cell"))
    met = near.join(inner.select("cell", "size"), "cell").agg({"size": "sum"}).head()[0] / 300
    assert met < 600
    found = nearest_neighbours(queries, refs, 3, 8192, 40)
    assert ranked(found) == brute(points[:300], points, 3)


def test_unknown_coordinates_take_no_part(spark):
    refs = [("a", [0.0, 0.0]), ("b", [None, 1.0]), ("c", [float("nan"), 0.0]), ("d", [1.0, 0.0]), ("e", [0.0, 2.0]), ("f", None)]
    rdf = spark.createDataFrame(refs, "rid string, x array<double>")
    found = ranked(nearest_neighbours(rdf.withColumnRenamed("rid", "qid"), rdf, 2, 8, 2))
    assert found == {"a": ["d", "e"], "d": ["a", "e"], "e": ["a", "d"]}
