import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.llm import hidden_markov as hmm
from stayrate.llm import queries
from tests.conftest import SMALL
from tests.llm.conftest import edge_rows

LEARN = queries.LEARNED


def words(text):
    return [w.lower() for w in (text or "").encode().split()] + [hmm.END]


def base(rows, learned):
    c = Counter(w for r, y in zip(rows, learned) if y for w in words(r[1]))
    total = sum(c.values())
    return c, [sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in words(r[1])) for r in rows]


def test_forward_equals_the_sum_over_all_paths():
    random = np.random.default_rng(3)
    chain = hmm.Chain(hmm.shares(random.random((3, 3)) * 9), hmm.shares(random.random(3) * 9), np.ones(3), 10, 5)
    emitted = random.random((5, 3))
    lengths = np.array([3, 1, 6, 2])
    tokens = random.integers(0, 5, lengths.sum())
    got = hmm.likelihoods(tokens, lengths, emitted, chain)
    ends = np.cumsum(lengths)
    for i, (a, b) in enumerate(zip(ends - lengths, ends)):
        document, total = tokens[a:b], 0.0
        for path in itertools.product(range(3), repeat=len(document)):
            p = chain.first[path[0]] * emitted[document[0], path[0]]
            for t in range(1, len(document)):
                p *= chain.follow[path[t - 1], path[t]] * emitted[document[t], path[t]]
            total += p
        assert got[i] == pytest.approx(math.log10(total))


def test_expected_counts_equal_the_sum_over_all_paths(monkeypatch):
    monkeypatch.setattr(hmm, "CELLS", 5)
    random = np.random.default_rng(4)
    chain = hmm.Chain(hmm.shares(random.random((2, 2)) * 9), hmm.shares(random.random(2) * 9), np.ones(2), 10, 5)
    emitted, lengths = random.random((4, 2)), np.array([4, 2, 1, 5])
    tokens = random.integers(0, 4, lengths.sum())
    counts, steps, first = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2)
    ends = np.cumsum(lengths)
    for a, b in zip(ends - lengths, ends):
        document = tokens[a:b]
        chances = {}
        for path in itertools.product(range(2), repeat=len(document)):
            p = chain.first[path[0]] * emitted[document[0], path[0]]
            for t in range(1, len(document)):
                p *= chain.follow[path[t - 1], path[t]] * emitted[document[t], path[t]]
            chances[path] = p
        total = sum(chances.values())
        for path, p in chances.items():
            first[path[0]] += p / total
            for t, s in enumerate(path):
                counts[document[t], s] += p / total
                if t:
                    steps[path[t - 1], s] += p / total
    for got, want in zip(hmm.expected(tokens, lengths, emitted, chain), (counts, steps, first)):
        assert np.allclose(got, want)


@pytest.mark.parametrize("states", [1, 3, 8, 11])
def test_packed_shares(spark, states):
    random = np.random.default_rng(9)
    n = random.integers(1, 50, 40)
    parts = random.dirichlet(np.full(states, 0.2), 40) * n[:, None]
    rows = [(hmm.TOKEN, i, int(n[i]), *map(float, parts[i])) for i in range(40)] + [(hmm.FIRST, 0, 0, *[1.0] * states)]
    tokens, chain = hmm.summed(spark.createDataFrame(rows, hmm.count_ddl(states)), states, hmm.Scratch(spark), "x")
    got = tokens.orderBy("key").collect()
    counts = hmm.counts_of(n, [np.array([r[c] for r in got]) for c in hmm.share_columns(states)], states)
    assert np.abs(counts - parts).max() <= 50 / 510 + 1e-9
    assert np.allclose(chain.totals, counts.sum(axis=0)) and (chain.tokens, chain.distinct) == (n.sum(), 40)


def test_passes_never_lower_the_likelihood():
    random = np.random.default_rng(5)
    lengths = random.integers(1, 40, 60)
    tokens = random.integers(0, 30, lengths.sum())
    tokens[: len(tokens) // 2] //= 2
    counts, before = random.random((30, 3)) + 0.1, -np.inf
    chain = hmm.Chain(np.full((3, 3), 1 / 3), np.full(3, 1 / 3), counts.sum(axis=0), 0, 30)
    for _ in range(8):
        emitted = counts / counts.sum(axis=0)
        now = hmm.likelihoods(tokens, lengths, emitted, chain).sum()
        assert now >= before - 0.05  # transitions are smoothed by one count
        before = now
        counts, steps, first = hmm.expected(tokens, lengths, emitted, chain)
        chain = hmm.Chain(hmm.shares(steps), hmm.shares(first), counts.sum(axis=0), 0, 30)


@pytest.mark.parametrize("chunk", [600, hmm.CHUNK_BYTES])
def test_counts_and_base_scores(edges, monkeypatch, chunk):
    monkeypatch.setattr(hmm, "CHUNK_BYTES", chunk)
    clash = edges.withColumns({"Score": F.lit("x"), "chunk": F.lit(1), "n": F.lit(2), "s0": F.lit(b"y"), "_tokens": F.lit(3)})
    out = hmm.scored(clash, LEARN, states=3)
    assert out.columns == [c for c in edges.columns if c != "text"] + ["chunk", "n", "s0", "_tokens", *hmm.RESULTS]
    rows = edges.withColumn("learn", F.expr(LEARN)).collect()
    c, scores = base([(r[0], r["text"]) for r in rows], [r["learn"] for r in rows])
    want = Counter((r["doc_id"], r["source"], not r["learn"], len(words(r["text"])), sum(w in c for w in words(r["text"])), sum(c.values()), round(s, 6)) for r, s in zip(rows, scores))
    found = out.collect()
    assert Counter((r["doc_id"], r["source"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in found)


def test_scores_are_those_of_one_model(spark, monkeypatch):
    """Chunks of any size give one model's scores: plain passes over all documents, one by one."""
    rows = [(r[0], r[1]) for r in edge_rows() if len(r[1] or "") < 5000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learn = "doc_id IS NULL OR doc_id % 3 != 0"
    learned = [i is None or i % 3 != 0 for i, _ in rows]
    known, counts, chain = hmm.sample_model(docs.withColumn("_learn", F.expr(learn)), "text", "_learn", 3)
    table, all_ = dict(zip(known.tolist(), counts)), [words(t) for _, t in rows]
    hashes = hmm.WordHashes()
    number = {w: i for i, w in enumerate(dict.fromkeys(w for d in all_ for w in d))}
    key = [int(np.uint64(hashes[w]).view(np.int64)) for w in number]
    own = np.array([chain.emission(table[k][None])[0] if k in table else np.ones(3) for k in key])
    seen = {w for d, y in zip(all_, learned) if y for w in d}
    for _ in range(2):
        counts, steps, first = np.zeros((len(number), 3)), np.zeros((3, 3)), np.zeros(3)
        for d, y in zip(all_, learned):
            if y:
                a, b, c = hmm.expected(np.array([number[w] for w in d]), np.array([len(d)]), own, chain)
                counts, steps, first = counts + a, steps + b, first + c
        total = sum(len(d) for d, y in zip(all_, learned) if y)
        chain = hmm.Chain(hmm.shares(steps), hmm.shares(first), counts.sum(axis=0), total, len(seen))
        own = chain.emission(counts)
    want = sorted((-1 if i is None else i, len(d), hmm.likelihoods(np.array([number[w] for w in d]), np.array([len(d)]), own, chain)[0]) for (i, _), d in zip(rows, all_))
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 3000)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["score"]) for r in hmm.scored(docs, learn, states=3).collect())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    # Counts are rounded between passes.
    assert max(abs(x[2] - y[2]) / y[1] for x, y in zip(got, want)) < 0.02


def test_held_out_documents_gain(spark):
    """Latent states tell more about unseen documents than word counts alone."""
    rows = queries.QUERIES["op13_lm_scoring"](spark, SMALL.replace("0.001", "0.01")).where("held_out").collect()
    assert len(rows) > 50
    tokens = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.1 * tokens


def test_empty_tables(none, spark):
    assert hmm.scored(none, LEARN).collect() == []
    only = hmm.scored(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), "false").collect()
    assert [(r["n_known"], r["base_score"], r["train_tokens"]) for r in only] == [(0, 0.0, 0)] * 2
    assert all(r["score"] == pytest.approx(0) for r in only)
