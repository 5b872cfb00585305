import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayrate.llm import bpe
from stayrate.llm.queries import bpe_digests
from tests.llm.conftest import edge_rows, phrase

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "it's  don't\tstop   \n\n  now", "a\u00a0b\u2003c\u0085d \u3000 e", " lead", "trail  ", "<|endoftext|> x<|endoftext|>y  <|endoftext|>",
    "日本語のテキスト" * 200, "é" * 5000, "naïve café déjà vu " * 100, "\x1c \x1f a", "🙂 👍🏽 test", "x" * 3000, "1234 5678" * 50,
]


def new_encoder(**more):
    shared = bpe.Shared(PATH)
    return bpe.Encoder(shared.json, shared.vocabulary, **more)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def digest(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return digest


def test_equals_the_tokenizer(edges, spark, plain):
    docs = edges.select("doc_id", "text").unionAll(spark.createDataFrame([(100 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string"))
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe_digests(docs, PATH).collect())
    rows = [(r[0], r[1]) for r in edge_rows()] + [(100 + i, t) for i, t in enumerate(HARD)]
    assert got == Counter((i, *plain(t)) for i, t in rows)


def test_small_chunks_and_tables(plain, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BITS", 4)
    encoder = new_encoder(limit=2000)
    texts = [t.encode() for t in HARD] + [(r[1] or "").encode() for r in edge_rows()]
    for ids, text in zip(encoder.encode(texts), texts):
        assert hashlib.sha256(ids).hexdigest() == plain(text.decode())[1]


def test_shared_chunks_are_encoded_once():
    encoder = new_encoder()
    passage = phrase(5, 4000)
    first = encoder.encode([("begin " + passage).encode()])
    used = encoder.encoded_bytes
    again = encoder.encode([("another start " + passage + " and end").encode()])
    assert encoder.encoded_bytes - used < len(passage) / 20
    assert again[0][-4000:-40] and first[0][400:800] in again[0]


def test_disagreeing_joins_grow(monkeypatch, plain):
    """With seams that are none, inside of words, the repair grows to the whole text."""
    monkeypatch.setattr(bpe, "CHUNK_BITS", 5)
    monkeypatch.setattr(bpe, "seams", lambda body: np.array([m.start() for m in re.finditer(rb"(?<=[a-m])(?=[n-z])", body)], np.int64))
    encoder = new_encoder()
    texts = [phrase(i, 300).replace("b", "then ").replace("c", "unto") for i in range(5)]
    assert encoder.disagreeing([(b"lo", b"hel", b"w", b"")])
    for ids, text in zip(encoder.encode([t.encode() for t in texts]), texts):
        assert hashlib.sha256(ids).hexdigest() == plain(text)[1]


def test_columns_and_empty_table(edges, none):
    out = bpe.decode(bpe.encode(edges.withColumns({"IDS": F.lit(1), "decoded": F.lit(2)}), PATH), PATH)
    assert out.columns == [*edges.columns, "ids", "n_tokens", "decoded"]
    assert all(r["decoded"] == (r["text"] or "") for r in out.collect())
    assert bpe.decode(bpe.encode(none, PATH), PATH).collect() == []
