"""Quality rules: fixed limits, and an isolation forest on rule statistics.

The forest takes all labelled documents and all their rates (``measures.RATES``).
Each tree splits the space that all labelled ones span at random, and counts all documents labelled
good in its parts; documents that few splits part from the
good ones are anomalies. (Were the bad ones counted, too, their clusters would look usual.) The path length below which a
document is rejected is calibrated on the labelled rows: of all cuts that keep at least
``KEEP_GOOD`` of the rows labelled good, the one that tells the labels apart best (share of bad
rows rejected less share of good rows rejected). Without rows of both labels nothing is rejected by
the forest. Rates, spans, counts and lengths of the labelled rows are computed in tasks; the driver gets the
counts of the parts, whose number has a fixed bound.

Every whole text is measured. A NULL text counts as empty; it has no words and fails the base rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from stayrate.functions.ranks import running_totals
from stayrate.llm.measures import COUNTS, RATES, measure
from stayrate.llm.scratch import Scratch, without
from stayrate.llm.text import WordHashes, give_back, pieces, utf8

TREES = 200
DEPTH = 12
#: Rows whose way through a tree is followed at a time.
STEP = 4096
KEEP_GOOD = 0.998
MIN_WORDS = 20
MOST_REPEATED = 30
#: Bytes of text that are measured together.
BATCH_BYTES = 4 << 20
RESULTS = (*COUNTS, "base_failed", "kept")


@dataclass
class Forest:
    """Trees as arrays of nodes: a node splits ``feature`` at ``cut`` into the nodes ``left`` and
    ``left + 1``; a leaf has feature -1 and the ``length`` of its path."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    length: np.ndarray
    threshold: float = -np.inf

    def path_lengths(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, length in zip(self.feature, self.cut, self.left, self.length):
            at = np.zeros(len(rows), np.int64)
            while True:
                split = feature[at]
                inner = split >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(split, 0)] >= cut[at]
                at = np.where(inner, left[at] + right, at)
            total += length[at]
        return total / len(self.feature)

    def rejects(self, rows: np.ndarray) -> np.ndarray:
        return self.path_lengths(rows) < self.threshold


def expected_length(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return np.where(n < 2, 0.0, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1))


def random_cuts(low: np.ndarray, high: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(feature, cut) of the inner nodes of whole trees: node ``i`` splits into ``2i + 1`` and ``2i + 2``. Cuts
    are uniform between ``low`` and ``high``, and then between the cuts made before."""
    random = np.random.default_rng(seed)
    open_features = np.flatnonzero(high > low)
    feature, cut = np.zeros((TREES, 2**DEPTH - 1), np.int32), np.full((TREES, 2**DEPTH - 1), np.inf)
    if not len(open_features):
        return feature, cut
    for tree in range(TREES):
        lowest, highest = low[None, :], high[None, :]
        for level in range(DEPTH):
            every = np.arange(2**level)
            k = random.choice(open_features, 2**level)
            at = random.uniform(lowest[every, k], highest[every, k])
            feature[tree, 2**level - 1 : 2 ** (level + 1) - 1] = k
            cut[tree, 2**level - 1 : 2 ** (level + 1) - 1] = at
            lowest, highest = lowest.repeat(2, axis=0), highest.repeat(2, axis=0)
            highest[2 * every, k] = lowest[2 * every + 1, k] = at
    return feature, cut


def count_parts(rows: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Rows in each of the parts that the last cuts of every tree make."""
    counts = np.zeros((TREES, 2**DEPTH), np.int64)
    for start in range(0, len(rows), STEP):
        some = rows[start : start + STEP]
        every = np.arange(len(some))
        for tree in range(TREES):
            at = np.zeros(len(some), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (some[every, feature[tree, at]] >= cut[tree, at])
            counts[tree] += np.bincount(at - (2**DEPTH - 1), minlength=2**DEPTH)
    return counts


def pruned(feature: np.ndarray, cut: np.ndarray, counts: np.ndarray) -> Forest:
    """The trees down to the nodes that hold fewer than two of the counted rows."""
    levels = [counts]
    while levels[0].shape[1] > 1:
        levels.insert(0, levels[0].reshape(TREES, -1, 2).sum(axis=2))
    held = np.concatenate(levels, axis=1)
    level = np.repeat(np.arange(DEPTH + 1), 2 ** np.arange(DEPTH + 1))
    inner = (held >= 2) & (level < DEPTH)
    node = np.arange(1, held.shape[1])
    there = np.ones(held.shape, bool)
    there[:, 1:] = inner[:, (node - 1) // 2]
    longest = int(there.sum(axis=1).max())
    forest = Forest(*[np.zeros((TREES, longest), t) for t in (np.int32, np.float64, np.int32, np.float32)])
    forest.feature -= 1
    for tree in range(TREES):
        kept = np.flatnonzero(there[tree])
        number = np.cumsum(there[tree]) - 1
        splits = kept[inner[tree, kept]]
        forest.feature[tree, number[splits]] = feature[tree, splits]
        forest.cut[tree, number[splits]] = cut[tree, splits]
        forest.left[tree, number[splits]] = number[2 * splits + 1]
        forest.length[tree, : len(kept)] = level[kept] + expected_length(held[tree, kept])
    return forest


def grow(usual: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 7) -> Forest:
    """Trees over ``usual`` rows, all of which are counted."""
    cuts = random_cuts(low, high, seed)
    return pruned(*cuts, count_parts(usual, *cuts))


def labelled_rates(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str) -> DataFrame:
    """``(good, rates)`` of every labelled document of ``MIN_WORDS`` words or more. Texts are measured where they
    lie; what is joined is small."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id")).agg(F.min(label).alias("_label"))
    )

    def rates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches, "_text", BATCH_BYTES):
            counts = [measure(b, hashes) for b in utf8(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([c[0] for c, _ in counts], pa.int64()), pa.array([r for _, r in counts], pa.list_(pa.float64()))],
                names=["_id", "n_words", "rates"],
            )
        give_back()

    some = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    measured = some.mapInArrow(rates, f"_id {some.schema['_id'].dataType.simpleString()}, n_words long, rates array<double>")
    found = measured.join(known, "_id").groupBy("_id").agg(F.min("_label").alias("_label"), F.min(F.struct("n_words", "rates")).alias("_m"))
    return found.where(F.col("_m.n_words") >= MIN_WORDS).select((F.col("_label") == 1).alias("good"), F.col("_m.rates").alias("rates"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(RATES))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality") -> Forest | None:
    """A forest over all labelled documents, calibrated on all of them; None without any good one."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.store(labelled_rates(docs, labels, id_column, text, label), "rates")
    span = [f(F.col("rates")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(len(RATES))]
    totals = rows.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"), *span).head()
    forest = None
    if totals["good"]:
        forest = counted(rows.where("good"), *[np.array([totals[f"{n}{i}"] for i in range(len(RATES))]) for n in ("low", "high")])
        if totals["bad"]:
            forest.threshold = threshold(rows, forest)
    scratch.drop("rates")
    return forest


def counted(good: DataFrame, low: np.ndarray, high: np.ndarray) -> Forest:
    """``grow`` over the rows of a frame: tasks count, and their counts are added up."""
    cuts = random_cuts(low, high)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((TREES, 2**DEPTH), np.int64)
        for batch in batches:
            counts += count_parts(matrix(batch.column("rates")), *cuts)
        trees, parts = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(trees.astype(np.int32)), pa.array(parts.astype(np.int32)), pa.array(counts[trees, parts])], names=["tree", "part", "n"])

    found = good.select("rates").mapInArrow(count, "tree int, part int, n long").groupBy("tree", "part").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((TREES, 2**DEPTH), np.int64)
    counts[found["tree"].to_numpy(), found["part"].to_numpy()] = found["n"].to_numpy()
    return pruned(*cuts, counts)


def threshold(rows: DataFrame, forest: Forest) -> float:
    """Halfway between the best path length to reject below and the next shorter one; rejects nothing
    where that is best."""

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(forest.path_lengths(matrix(batch.column("rates"))))], names=["good", "length"])

    found = rows.mapInArrow(lengths, "good boolean, length double")
    steps = running_totals(found, [], "length", {"good": F.count_if("good"), "bad": F.count_if(~F.col("good"))})
    lost = {n: (F.col(f"cum_{n}") - F.col(n)) / F.col(f"all_{n}") for n in ("good", "bad")}
    best = steps.where(1 - lost["good"] >= KEEP_GOOD).select("length", (lost["bad"] - lost["good"]).alias("gain")).orderBy(F.desc("gain"), "length").head()
    shorter = found.where(F.col("length") < best["length"]).agg(F.max("length")).head()[0]
    return -np.inf if shorter is None else (shorter + best["length"]) / 2


def verdicts(texts: list[bytes], forest: Forest | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, base_failed, kept) of each text."""
    found = [measure(b, hashes) for b in texts]
    counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
    failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
    odd = forest.rejects(np.array([r for _, r in found]).reshape(-1, len(RATES))) if forest else np.zeros(len(found), bool)
    return counts, failed, ~failed & ~odd


def judged(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``; one pass, nothing is shuffled."""
    docs = without(docs, *RESULTS)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches, text, BATCH_BYTES):
            counts, failed, kept = verdicts(utf8(batch.column(text)), forest, hashes)
            arrays = [pa.array(counts[:, i]) for i in range(len(COUNTS))] + [pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *RESULTS])
        give_back()

    added = [StructField(n, LongType()) for n in COUNTS] + [StructField(n, BooleanType()) for n in RESULTS[len(COUNTS):]]
    return docs.mapInArrow(judge, StructType([*docs.schema.fields, *added]))


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep; each text is sent once."""
    forest = fit(docs, labels, id_column, text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        hashes = WordHashes()
        for batch in pieces(batches, text, BATCH_BYTES):
            yield batch.filter(pa.array(verdicts(utf8(batch.column(text)), forest, hashes)[2]))
        give_back()

    return docs.mapInArrow(keep, docs.schema)
