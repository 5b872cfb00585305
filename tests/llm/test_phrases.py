import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stayrate.llm import phrases
from tests.llm.conftest import edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest=4, least=30, inside=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by brute force from (text, lang)."""
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for s in range(len(words)):
                for k in range(1, min(longest, len(words) - s) + 1):
                    f[lang][tuple(words[s : s + k])] += 1
    out = []
    for lang, counts in f.items():
        some = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        longer = Counter()
        for w, a in some.items():
            for size in range(2, len(w)):
                for s in range(len(w) - size + 1):
                    longer[w[s : s + size]] = max(longer[w[s : s + size]], a)
        rows = []
        for w, a in some.items():
            if w in longer and 100 * longer[w] >= inside * a:
                continue
            score, k = min((2_000_000 * a // (counts[w[:k]] + counts[w[k:]]), k) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


REPEATED = [
    ("New York is big, new york is New York!", "en"), ("la la la la la la", None), ("la la\tla.la la", "und"), ("é è É,é è é", "fr"),
    (None, "en"), ("", "en"), (" \t .,;", None), ("one two three four five six", "en"), ("one two three four\x0bfive six", "en"), ("ONE two three", ""),
]


@pytest.fixture(scope="module")
def rows():
    return REPEATED * 4 + [(r[1], r[2]) for r in edge_rows()] * 2


@pytest.mark.parametrize("least, longest, top", [(2, 4, 2000), (3, 3, 5), (8, 4, 2000), (1, 2, 30)])
def test_equals_brute_force(spark, rows, least, longest, top):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert got(phrases.mine(docs, least=least, longest=longest, top=top)) == plain(rows, longest, least, top=top)


def test_small_chunks_and_clashing_columns(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 300)
    docs = spark.createDataFrame(rows, "text string, lang string")
    docs = docs.withColumns({"w1": F.lit("x"), "C": F.lit(1), "k": F.lit(2), "a": F.lit(3), "Rank": F.lit(None).cast("int")}).repartition(5)
    assert got(phrases.mine(docs, least=4)) == plain(rows, least=4)


def test_products_beyond_64_bits(spark):
    """Counts near the end of 64 bits: sums and products are exact."""
    many = 2**61
    counted = spark.createDataFrame([("en", "a", "b", many), ("en", "b", "", many + 1), ("en", "a", "", 7), ("en", "", "", 2**62)], "lang string, w1 string, w2 string, c long")
    got = {tuple(r["words"]): r["f"] for r in phrases.marginals(counted, 2).collect()}
    assert got == {("a",): many + 7, ("a", "b"): many, ("b",): many + 1, (): 2**62}


@pytest.mark.parametrize("hot", [0, 1, 3, 5])
def test_dealt_by_longer_prefixes(spark, rows, monkeypatch, hot):
    """Windows of frequent words meet by two, three or all words; several slices then share a prefix."""
    for name, value in {"HOT_BITS": hot, "TOGETHER_BITS": 9, "CHUNK_BYTES": 300, "WORD_SLICE_BYTES": 100, "WINDOW_SLICE_BYTES": 100}.items():
        monkeypatch.setattr(phrases, name, value)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert got(phrases.mine(docs, least=3)) == plain(rows, least=3)


def test_rollup_gets_as_many_rows_as_there_are_frequent_phrases(spark, monkeypatch):
    """All pairs are frequent and most longer windows are not: these must not be moved one by one."""
    draw = random.Random(1)
    rows = [(" ".join(draw.choice("abcdefghij") for _ in range(100)), "en") for _ in range(60)]
    seen, whole = [], phrases.marginals

    def watched(counted, longest):
        seen.append(counted.count())
        return whole(counted, longest)

    monkeypatch.setattr(phrases, "marginals", watched)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert got(phrases.mine(docs)) == plain(rows)
    often = Counter(tuple(words[s : s + k]) for words in (r[0].split() for r in rows) for k in (1, 2, 3, 4) for s in range(len(words) - k + 1))
    assert seen[0] <= sum(f >= 30 for f in often.values()) < 150


def test_hot_phrase(spark):
    """A third of all rows hold one passage: it arrives once per chunk."""
    rows = [("the same passage again", "en")] * 400 + [(f"word{i} of its own", "en") for i in range(800)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert got(phrases.mine(docs)) == plain(rows)


def test_empty_table(none, spark):
    assert phrases.mine(none).collect() == []
    assert phrases.mine(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []
