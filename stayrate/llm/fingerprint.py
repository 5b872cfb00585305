"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases as LZ78 does: each phrase is the longest one seen before in the text,
and one more character. Texts that compress each other well share many phrases. The distinct
phrases are hashed, and one-permutation minimum hashing makes a signature of ``BINS`` minima; an
empty bin takes the value of the next filled one to its right. The likeness of two signatures is the
share of equal bins, an estimate of the Jaccard similarity of the phrase sets. Equal texts have equal
fingerprints; the empty text's is all zeros, like itself (1) and nothing else (0).

Every document is also compared with its *edited* text, in which the last quarter of its code points
is replaced by the beginning of the next document, and with that next document. Documents are
ordered by id (NULL last), then by a hash of the text; the last one is followed by the first. Rows
are dealt to ranges of ids, each range also gets the first row of the next, and a task goes through
its ranges row by row, holding two at a time.

A NULL text counts as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayrate.llm.text import mixed

BINS = 64
BIN_BITS = 6
RANGE_ROWS = 2000
MOST_RANGES = 20_000
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EMPTY = "0" * (4 * BINS)


class Parse:
    """An LZ78 parse that can go on in two ways from where it stands.

    Phrases are numbered in the order met; ``steps`` maps (phrase * 2^21 + character) to the longer
    phrase, and ``hashes`` holds each phrase's hash, made from its prefix's hash and last character.
    """

    def __init__(self, codes: list[int]) -> None:
        self.steps: dict[int, int] = {}
        self.hashes = [0]
        self.at = self.feed(codes, 0)

    def feed(self, codes: list[int], at: int) -> int:
        steps, hashes = self.steps, self.hashes
        find = steps.get
        for code in codes:
            key = at << 21 | code
            at = find(key, 0)
            if not at:
                steps[key] = len(hashes)
                hashes.append((hashes[key >> 21] * 0x9E3779B97F4A7C15 + code + 1) & 0xFFFFFFFFFFFFFFFF)
        return at

    def ended(self, codes: list[int]) -> np.ndarray:
        """Hashes of the phrases if the text ended with ``codes``; what it adds is undone."""
        size = len(self.hashes)
        at = self.feed(codes, self.at)
        # A phrase that the end of the text cuts short was met before, unless the text is empty.
        found = np.array(self.hashes[1:], np.uint64)
        if len(self.hashes) > size:
            for key in list(self.steps)[-(len(self.hashes) - size):]:
                del self.steps[key]
            del self.hashes[size:]
        return found


def signature(phrases: np.ndarray) -> str:
    """The minimum hash of each bin, 16 bits each, as hexadecimal digits."""
    if not len(phrases):
        return EMPTY
    spread = np.sort(mixed(phrases))
    bins = (spread >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    filled, first = np.unique(bins, return_index=True)
    low = (mixed(spread[first], 1) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
    # The next filled bin to the right, round the end.
    at = np.searchsorted(filled, np.arange(BINS)) % len(filled)
    return low[at].astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    if EMPTY in (a, b):
        return float(a == b)
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / BINS


def codes(text: str) -> list[int]:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").tolist()


def described(text: str, following: str) -> tuple[int, str, str, str]:
    """(n_chars, hash of the edited text, fingerprint, edited fingerprint)."""
    n = len(text)
    cut = n - n // 4
    inserted = following[: n // 4]
    parse = Parse(codes(text[:cut]))
    return n, hashlib.sha256((text[:cut] + inserted).encode()).hexdigest(), signature(parse.ended(codes(text[cut:]))), signature(parse.ended(codes(inserted)))


def whole(text: str) -> str:
    return signature(Parse(codes(text)).ended([]))


def in_ranges(docs: DataFrame) -> DataFrame:
    """Rows (id, tie, text) with ``range`` and ``guard``: a range's rows, and at its end, marked,
    the first row of the range that follows (the first of all behind the last)."""
    count, = docs.agg(F.count(F.lit(1))).first()
    ranges = max(1, min(MOST_RANGES, count // RANGE_ROWS))
    found = docs.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges)).first()[0] or []
    splits = [-float("inf"), *(sorted({float(x) for x in found}) or [0.0]), float("inf")]
    # NULL ids come last, in a range of their own.
    bucketizer = Bucketizer(splits=splits, inputCol="_as_double", outputCol="_bucket", handleInvalid="keep")
    dealt = bucketizer.transform(docs.withColumn("_as_double", F.col("id").cast("double")))
    dealt = dealt.withColumn("range", F.coalesce(F.col("_bucket"), F.lit(float(len(splits)))).cast("int")).drop("_as_double", "_bucket")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "tie")
    firsts = sorted((r["range"], r["first"]) for r in dealt.groupBy("range").agg(F.min(order).alias("first")).collect())
    if not firsts:
        return dealt.withColumn("guard", F.lit(False))
    # A row per range, at most ``MOST_RANGES``.
    before = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}
    heads = docs.sparkSession.createDataFrame(
        [(r, f["id"], f["tie"], before[r]) for r, f in firsts], "_range int, _id long, _tie long, _before int"
    )
    is_head = (F.col("range") == F.col("_range")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    marked = dealt.join(F.broadcast(heads), is_head, "left")
    places = F.array(F.struct("range", F.lit(False).alias("guard")), F.struct(F.col("_before").alias("range"), F.lit(True).alias("guard")))
    places = F.when(F.col("_before").isNull(), F.slice(places, 1, 1)).otherwise(places)
    return marked.select("id", "tie", "text", F.inline(places))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``; see ``SCHEMA`` and the module's text."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = in_ranges(rows)
    # Of several equal first rows one is the guard.
    order = [F.col("range"), F.col("guard"), F.col("id").isNull(), F.col("id"), F.col("tie")]
    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))
    sorted_rows = dealt.repartition("range").sortWithinPartitions(*order).select("range", "guard", "id", "text")

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row read last: (range, id, text)
        waiting = None  # the result before it, which lacks its likeness to the next document
        done: list[list] = []
        for batch in batches:
            for span, guard, i, text in zip(*[batch.column(c).to_pylist() for c in ("range", "guard", "id", "text")]):
                if held is not None and held[0] == span:
                    n, edited, first, second = described(held[2], text)
                    if waiting is not None:
                        done.append([*waiting, likeness(waiting[3], first)])
                    waiting = [held[1], n, edited, first, second, likeness(first, second)]
                if guard and waiting is not None:
                    done.append([*waiting, likeness(waiting[3], whole(text))])
                held, waiting = (None, None) if guard else ((span, i, text), waiting)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []

    return sorted_rows.mapInArrow(describe, SCHEMA)
