"""Training-data pipeline over ``documents``: each stage works on all that the one before it kept.

1. Quality rules reject documents (``labels`` beside ``documents`` calibrate them).
2. Of documents alike (5-word shingles, Jaccard similarity 0.8 or more), one stays.
3. Words covered by 20-word windows that occurred earlier are cut; ``n_chars`` follows the text.
4. Sources are mixed to their target weights: rows are repeated or left out, and lie in shards.
5. Texts are encoded, and decoded again; the result has the ids and the decoded text.

Each stage's result is a Parquet table in the shared folder, which the next one reads; a lost
executor costs the running stage's tasks only. SQL cannot express the stages (``ORACLE_SQL`` is
None); ``tests/llm/test_pipeline.py`` holds them against plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm import bpe, jaccard, mixing, quality_rules, substring
from stayrate.llm.queries import bpe_path
from stayrate.llm.scratch import Scratch
from stayrate.sources.subscribers import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_of_each(docs, words=5, percent=80)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = substring.remove_repeats(docs, size=20)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, bpe_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("jaccard_join", keep_one_of_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("source_mix", mix_sources),
    ("bpe_codec", encode_texts),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            scratch.drop(f"pipeline-{STAGES[i - 1][0]}")
    return docs
