"""The queries ``opN_<name>``: each applies its operator to its whole table, as its contract says."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm import (
    bpe, fingerprint, hard_negatives, hidden_markov, html_text, jaccard, licenses, mixing, phrases, quality_model, quality_rules, substring, url_filter,
)
from stayrate.sources.subscribers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


@query("op1_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.takings(docs)


@query("op2_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, read_table(spark, folder, "labels"))
    return quality_model.scored(docs, model).drop("text")


RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]

OP3 = r"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f USING (page_id)
"""


@query("op3_url_filter", OP3)
def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(read_table(spark, folder, "pages").select("page_id", "url"), RULES).drop("url")


@query("op4_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.group_documents(read_table(spark, folder, "documents").select("doc_id", "text"), words=3, percent=90)


@query("op5_fingerprint")
def phrase_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(read_table(spark, folder, "documents").select("doc_id", "text"))


OP6 = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM texts)),
repeats AS (
  SELECT doc_id, s FROM windows
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, s) > 1),
covered AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM repeats) GROUP BY doc_id)
SELECT t.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words
    ELSE list_select(words, list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(gone, p))) END, ' ')) AS kept_sha256
FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id
"""


@query("op6_substring_dedup", OP6)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, size=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op7_html_text")
def page_text(spark: SparkSession, folder: str) -> DataFrame:
    model = html_text.train(html_text.labelled_examples(spark))
    return html_text.extracted(read_table(spark, folder, "pages").select("page_id", "url", "html"), model).drop("html")


@query("op8_quality_rules")
def rule_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    forest = quality_rules.fit(docs, read_table(spark, folder, "labels"))
    return quality_rules.judged(docs, forest).drop("text")


@query("op9_bpe_codec")
def bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return bpe_digests(docs, bpe_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` encoded and decoded again, with the digests of ids and text in place of both."""
    both = bpe.round_trip(docs, path)
    return both.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2(F.encode("decoded", "utf-8"), 256)}).drop("ids", "decoded")


@query("op10_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scanned(docs, licenses.fit(docs))
    probability = F.round(F.array_max(F.transform("notices", lambda x: x["probability"])), 6)
    return found.select(
        "doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_notices"), F.array_join("licenses", ",").alias("licenses"),
        "has_unknown", probability.alias("top_probability"),
    )


OP11 = """
WITH parts AS (
  SELECT row_number() OVER () AS id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT id, vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM parts),
scored AS (
  SELECT a.id AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.id, b.vec_id,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor, anchor_id, id AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor = s.anchor AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""


@query("op11_hard_negatives", OP11)
def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(moved, "id % 50 = 0")


OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
texts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM texts GROUP BY lang),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS s FROM texts),
phrases AS (
  SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (VALUES (1), (2), (3), (4)) sizes(k) WHERE s + k - 1 <= len(words)
  GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM phrases WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, array_to_string(words[1:cut], ' ') AS first_part, array_to_string(words[cut + 1:], ' ') AS rest
  FROM candidates c, (VALUES (1), (2), (3)) cuts(cut) WHERE cut < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = first_part JOIN phrases y ON y.lang = c.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, array_to_string(words[s:s + size - 1], ' ') AS phrase, max(a) AS a
  FROM candidates, (VALUES (2), (3)) sizes(size), (VALUES (1), (2), (3)) starts(s) WHERE size < k AND s + size - 1 <= k GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer x USING (lang, phrase) WHERE x.a IS NULL OR 100 * x.a::HUGEINT < 80 * b.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_mining", OP12)
def phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine(read_table(spark, folder, "documents").select("text", "lang"))


#: Documents that the language model learns from; a NULL id is not held out.
LEARNED = "coalesce(crc32(CAST(doc_id AS STRING)) % 10 != 0, true)"


@query("op13_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return hidden_markov.scored(docs, LEARNED)
