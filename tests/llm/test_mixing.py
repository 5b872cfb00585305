import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stayrate.llm import mixing
from tests.llm.conftest import DOCS, edge_rows, phrase


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Shares by weight; what is above a limit is shared again by those below, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_sources, budget = {}, set(order), 1.5 * sum(sizes.values())
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if budget * weight[s] / total >= 2 * sizes[s]}
        if not above:
            return target | {s: budget * weight[s] / total for s in open_sources}
        for s in above:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        open_sources -= above
    return target


def corpus(n=900):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else None if i % 17 == 0 else "é" if i % 5 == 0 else f"s{i % 7}"
        rows.append((i, phrase(i, 3 + (i * 37) % 90 + (900 if i % 97 == 0 else 0)), "en", source, 1))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


def check(rows, found, exact):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    want = plain_targets(sizes)
    source = {str((r[0], size_of(r[1]))): r[3] for r in rows}
    taken = defaultdict(int)
    for r in found:
        s = source[str((r["doc_id"], r["size"]))]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= exact(s)


def test_targets_and_takings(docs):
    found = mixing.takings(docs).collect()
    assert len(found) == 900
    longest = defaultdict(int)
    for r in corpus():
        longest[r[3]] = max(longest[r[3]], size_of(r[1]))
    check(corpus(), found, lambda s: longest[s])


def test_reruns_and_partitions_agree(docs):
    first = sorted(map(str, mixing.takings(docs).collect()))
    assert sorted(map(str, mixing.takings(docs.repartition(5)).collect())) == first
    assert sorted(map(str, mixing.takings(docs, seed=2).drop("shards").collect())) != sorted(map(str, mixing.takings(docs).drop("shards").collect()))


def test_edge_rows(edges):
    found = mixing.takings(edges).collect()
    assert len(found) == len(edge_rows())
    check(edge_rows(), found, lambda s: 31000)


def test_mixed_rows_are_the_takings(docs):
    clash = docs.withColumns({"shard": F.lit("x"), "parts": F.lit(1), "Size": F.lit(2)})
    mixed = mixing.mix(clash, shards=8)
    assert mixed.columns == [*[c for c in clash.columns if c not in ("shard", "Size")], "shard", "order_key"]
    copies = Counter(r["doc_id"] for r in mixed.collect())
    taken = {r["doc_id"]: len(r["shards"]) for r in mixing.takings(docs, shards=8).collect()}
    assert dict(copies) == {i: n for i, n in taken.items() if n}
    assert {r["shard"] for r in mixed.collect()} == set(range(8))


def test_tree_splits_quotas_exactly(spark):
    quotas = {0: 301, 1: 7, 2: 0, 3: 92}
    frame = spark.createDataFrame(list(quotas.items()), "s long, n long")
    tables = []
    for seed in range(30):
        rows = mixing.split_quotas(frame, 8, seed).collect()
        per_source, per_shard = Counter(), Counter()
        for r in rows:
            per_source[r["s"]] += r["n"]
            per_shard[r["shard"]] += r["n"]
        assert dict(per_source) == {s: n for s, n in quotas.items() if n}
        assert set(per_shard.values()) == {50}
        tables.append(next((r["n"] for r in rows if r["shard"] == 0 and r["s"] == 3), 0))
    # Hypergeometric: 50 drawn of 400 of which 92 are of the source; mean 11.5, variance 7.8.
    mean = sum(tables) / 30
    assert abs(mean - 11.5) < 2
    assert 2 < sum((x - mean) ** 2 for x in tables) / 29 < 20


def test_empty_table(none):
    assert mixing.takings(none).collect() == []
    assert mixing.mix(none).collect() == []
