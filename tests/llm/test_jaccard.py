import pytest
from pyspark.sql import functions as F

from stayrate.llm import jaccard
from tests.llm.conftest import DOCS, edge_rows, phrase


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def groups_of(rows, n, percent):
    """The sets, and for each the number of a set that stands for its group, by all pairs."""
    sets = [shingles(r[1], n) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    return sets, [top(i) for i in range(len(rows))]


def plain(rows, n, percent):
    """(id, set size, smallest id reachable)."""
    sets, group = groups_of(rows, n, percent)
    out = []
    for i, row in enumerate(rows):
        if not sets[i]:
            out.append((row[0], 0, row[0]))
            continue
        ids = [r[0] for k, r in enumerate(rows) if sets[k] and group[k] == group[i] and r[0] is not None]
        out.append((row[0], len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


def edited(text, places, word):
    words = text.split()
    for p in places:
        words[p % len(words)] = f"{word}{p}"
    return " ".join(words)


def copies(n, size, edits):
    """Copies of one text, each with a few words changed: some link, some do not."""
    base = phrase(77, size)
    return [(i, edited(base, [(i * 13 + k * 29) % size for k in range(i % edits)], f"e{i}x"), "en", "s", 1) for i in range(n)]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_equals_all_pairs(edges, n, percent):
    assert got(jaccard.group_documents(edges, words=n, percent=percent)) == plain(edge_rows(), n, percent)


@pytest.mark.parametrize(("n", "percent", "size", "edits"), [(3, 90, 150, 6), (5, 80, 60, 5), (3, 90, 30, 3)])
def test_borderline_copies(spark, n, percent, size, edits):
    rows = copies(150, size, edits) + [(1000 + r[0], r[1] + " tail", *r[2:]) for r in copies(40, size, edits)]
    rows += [(2000 + i, phrase(500 + i, 40) + " " + phrase(78, 30), "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    assert got(jaccard.group_documents(docs, words=n, percent=percent)) == plain(rows, n, percent)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SLOT_ROWS", 50)
    monkeypatch.setattr(jaccard, "CENTRES", 1)
    rows = copies(150, 100, 5)
    assert got(jaccard.group_documents(spark.createDataFrame(rows, DOCS), words=3, percent=90)) == plain(rows, 3, 90)


def test_calls_of_a_hot_bucket_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SLOT_ROWS", 100)
    rows = [(1, i, i, 9, b"") for i in range(400)] + [(k, i, i, 9, b"") for k in range(2, 60) for i in range(5)]
    out = jaccard.dealt(spark.createDataFrame(rows, "key long, node long, comp long, n long, parity binary")).collect()
    calls = {}
    for r in out:
        calls.setdefault(r["slot"], []).append((r["key"], r["node"]))
    assert max(map(len, calls.values())) <= 250
    assert max(len(c) for c in calls.values() if c[0][0] == 1) <= 5 * 16
    met = {(a, b) for c in calls.values() for k, a in c for j, b in c if k == j == 1 and a < b}
    assert len(met) == 400 * 399 // 2


def test_one_of_each_stays(edges):
    clash = edges.withColumns({"node": F.lit(1), "component_id": F.lit("x"), "_own_id": F.lit(2)})
    kept = jaccard.keep_one_of_each(clash)
    assert kept.columns == clash.columns
    rows = kept.collect()
    with_words = sorted(str(r["doc_id"]) for r in rows if shingles(r["text"], 5))
    sets, group = groups_of(edge_rows(), 5, 80)
    want = {}
    for row, own, g in zip(edge_rows(), sets, group):
        if own:
            want[g] = min(want.get(g, row), row, key=lambda r: (r[0] is None, r[0]))
    assert with_words == sorted(str(r[0]) for r in want.values())
    assert len(rows) - len(with_words) == sum(not shingles(r[1], 5) for r in edge_rows())


def test_empty_table(none):
    assert jaccard.group_documents(none).collect() == []
    assert jaccard.keep_one_of_each(none).collect() == []
