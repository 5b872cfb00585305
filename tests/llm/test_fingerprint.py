import hashlib

import pytest
from pyspark.sql import functions as F

from stayrate.llm import fingerprint
from tests.llm.conftest import DOCS, edge_rows, phrase


def phrases(text):
    """LZ78 by its definition."""
    seen, now = set(), ""
    for c in text:
        now += c
        if now not in seen:
            seen.add(now)
            now = ""
    return seen


def hash_of(phrase_text):
    h = 0
    for c in phrase_text:
        h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
    return h


def of(text):
    return fingerprint.signature(fingerprint.np.array(sorted(hash_of(p) for p in phrases(text)), fingerprint.np.uint64))


def plain(rows):
    spark_hash = {r[1]: i for i, r in enumerate(rows)}
    assert spark_hash
    ordered = sorted(rows, key=lambda r: r[0])
    out = []
    for i, row in enumerate(ordered):
        text, following = row[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        a, b, c = of(text), of(edited), of(following)
        out.append((row[0], n, hashlib.sha256(edited.encode()).hexdigest(), a, b, fingerprint.likeness(a, b), fingerprint.likeness(a, c)))
    return out


def some_rows():
    rows = [r for r in {r[0]: r for r in edge_rows() if r[0] is not None and len(r[1] or "") < 4000}.values()]
    return rows + [(1000 + 7 * i, phrase(i, 30 + i % 50) + " 🙂é", "en", "s", 1) for i in range(60)]


@pytest.mark.parametrize("range_rows", [2000, 7])
def test_equals_the_definition(spark, monkeypatch, range_rows):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", range_rows)
    docs = spark.createDataFrame(some_rows(), DOCS).repartition(4).withColumns({"range": F.lit("x"), "id": F.lit(1)})
    assert sorted(tuple(r) for r in fingerprint.fingerprints(docs).collect()) == plain(some_rows())


def test_edge_rows(edges):
    rows = fingerprint.fingerprints(edges).collect()
    assert len(rows) == len(edge_rows())
    empty = [r for r in rows if r["n_chars"] == 0]
    assert {r["fingerprint"] for r in empty} == {fingerprint.EMPTY}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_one_row_and_none(spark, none):
    (row,) = fingerprint.fingerprints(spark.createDataFrame([(5, "abcdabcd", "", "", 8)], DOCS)).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdabab").hexdigest() and row["near_next"] == 1.0
    assert fingerprint.fingerprints(none).collect() == []


def test_likeness_orders_texts():
    base, other = phrase(1, 800), phrase(2, 800)
    cut = base[: len(base) * 3 // 4] + other[: len(base) // 4]
    same, near, far = (fingerprint.likeness(fingerprint.whole(base), fingerprint.whole(x)) for x in (base, cut, other))
    assert same == 1.0 > near > far
