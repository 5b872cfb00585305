import hashlib

from pyspark.sql import functions as F

from stayrate.llm import substring
from tests.llm.conftest import edge_rows


def plain(rows, size):
    """Every window in order of (id, text), by brute force."""
    seen, out = set(), []
    for row in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, substring.xxhash.xxh3_64_intdigest((r[1] or "").encode()))):
        words = (row[1] or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - size + 1):
            window = tuple(words[s : s + size])
            if window in seen:
                gone[s : s + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        text = kept.decode() if any(gone) else row[1]
        out.append((row[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest(), text))
    return sorted(out, key=str)


def got(df):
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["text"]) for r in df.collect()], key=str)


def test_equals_brute_force(edges):
    for size in (20, 3, 9):
        assert got(substring.remove_repeats(edges, size=size)) == plain(edge_rows(), size)


def test_small_chunks_give_the_same(edges, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 700)
    assert got(substring.remove_repeats(edges)) == plain(edge_rows(), 20)


def test_many_slices_give_the_same(spark, monkeypatch):
    """Slices without claims, which hand on choices only, and slices that no choice passes."""
    rows = [(i, " ".join(f"w{i % 7}x{k}" for k in range(25)) + f" end{i}") for i in range(30)] + [(None, "few words"), (40, None)]
    monkeypatch.setattr(substring, "CHUNK_BYTES", 300)
    monkeypatch.setattr(substring, "SLICE_BYTES", 100)
    assert got(substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows, 20)


def test_claims_are_not_stored(spark, monkeypatch):
    """Claims are many; between passes only the chunks and the answers are written to disk."""
    stored, store = [], substring.Scratch.store

    def watched(self, df, name):
        stored.append((name, store(self, df, name)))
        return stored[-1][1]

    monkeypatch.setattr(substring.Scratch, "store", watched)
    rows = [(i, " ".join(f"w{k}" for k in range(2000))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(substring.remove_repeats(docs)) == plain(rows, 20)
    sizes = {name: df.agg(F.sum(F.length("payload"))).first()[0] for name, df in stored}
    assert [*sizes] == ["windows", "replies"] and sizes["replies"] < 2000


def test_extra_and_clashing_columns(edges):
    clash = edges.withColumns({"N_Words": F.lit("x"), "chunk": F.lit(1), "payload": F.lit(b"x"), "kind": F.lit(3)})
    out = substring.remove_repeats(clash)
    assert out.columns == [*edges.columns, "chunk", "payload", "kind", "n_words", "n_removed", "kept_sha256"]
    assert got(out) == plain(edge_rows(), 20)


def test_empty_table(none):
    assert substring.remove_repeats(none).collect() == []
