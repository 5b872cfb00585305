"""Each stage against a plain version of it, on what the stage before it kept."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stayrate.llm import mixing, quality_rules
from stayrate.llm.queries import bpe_path
from stayrate.sources.subscribers import read_table
from tests.conftest import SMALL
from tests.llm import test_jaccard, test_quality, test_substring
from tests.llm.conftest import edge_rows

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The rows before and after each stage."""
    docs, found = read_table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        found.append((docs, spark.read.parquet(path)))
        docs = found[-1][1]
    return found


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_order_and_columns(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "substring_dedup", "source_mix", "bpe_codec"]
    names = tables[0][0].columns
    assert all(after.columns == names for _, after in tables[:4])
    assert all(after.count() for _, after in tables)


def test_quality_rules(tables, spark):
    before, after = tables[0]
    forest = quality_rules.fit(before, read_table(spark, SMALL, "labels"))
    kept = {r["doc_id"] for r in quality_rules.judged(before, forest).collect() if r["kept"]}
    want = [r for r in rows(before) if r[0] in kept]
    assert sorted(rows(after)) == sorted(want)
    for r in rows(before):
        n = test_quality.plain(r[1])
        assert r[0] not in kept or (n[0] >= 20 and 100 * n[4] <= 30 * n[0])


def test_jaccard_join(tables):
    before, after = tables[1]
    stay = {g for _, _, g in test_jaccard.plain(rows(before), 5, 80)}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in stay)


def test_substring_dedup(tables):
    before, after = tables[2]
    want = [(i, text, len(text)) for i, _, _, _, text in test_substring.plain(rows(before), 20)]
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in after.collect()) == sorted(want)


def test_source_mix(tables):
    before, after = tables[3]
    copies = {r["doc_id"]: len(r["shards"]) for r in mixing.takings(before).collect()}
    assert Counter(rows(after)) == Counter({r: copies[r[0]] for r in rows(before) if copies[r[0]]})


def test_bpe_codec(tables):
    before, after = tables[4]
    tokenizer = Tokenizer.from_file(bpe_path())
    tokenizer.no_truncation()
    want = Counter((r[0], np.array(tokenizer.encode(r[1], add_special_tokens=False).ids, "<u4").tobytes(), r[1]) for r in rows(before))
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in after.collect()) == want


def test_run_is_the_chain_of_stages(tables, spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, rows(out))) == sorted(map(str, rows(tables[-1][1])))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_edge_rows_and_empty_tables(name, spark, edges, none):
    more = edges.withColumns({"kept": F.lit(1), "shard": F.lit("x"), "Taken": F.lit(None).cast("int"), "node": F.lit(2.5)})
    out = STAGES[name](spark, more, SMALL)
    if name != "bpe_codec":
        assert out.columns == more.columns
    assert 0 < out.count() <= 2 * len(edge_rows())
    assert STAGES[name](spark, none, SMALL).collect() == []
