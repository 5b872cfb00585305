"""Phrase collocation mining by top-order marginalisation.

A piece of text is what stands between breaks (``. , ; : ! ?`` and line ends); its words are runs of
bytes other than space and tab, with A-Z lower-cased. Everything is counted per language.

1. Each word leads one window: itself and the next words of its piece in columns ``w1`` to ``wN``,
   padded with empty strings behind the end. Only these longest windows are counted.
2. ROLLUP sums windows over ever shorter prefixes. A phrase of k words is the prefix of exactly the
   windows that start where it occurs, so the sums are the counts of all phrases of 1 to N words.
3. Words are numbered first: those that occur often enough, by exact counts, most frequent first. A
   window ends before any other word. Chunks send each distinct window once, as numbers in sorted
   columns of bytes with its count, so what is moved is in proportion to the words.
4. Windows that share a prefix meet in one task, which sums them and pads each one behind its longest
   frequent prefix; about as many rows as frequent phrases are left for ROLLUP. By which prefix a
   window is dealt follows from the counts of its words: the first word, or more words where that
   prefix may stand for too many windows. Sums of shorter prefixes are then parts of a whole, are
   never dropped, and are added up by ROLLUP.
5. Frequent phrases, of which there are at most (words * N / least), are joined with their parts.

Scores are integers; products are computed as decimals, as they may pass 64 bits. A NULL text
counts as empty, a NULL language as ``und``; repeated rows count each time. An empty table has no
phrases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayrate.llm import sketch
from stayrate.llm.scratch import Scratch
from stayrate.llm.substring import slices_of, table
from stayrate.llm.text import WordHashes, give_back, mixed, packed, pieces, unpacked, utf8

CHUNK_BYTES = 4 << 20
#: Text whose words, or windows, one task takes together; decides nothing else.
WORD_SLICE_BYTES, WINDOW_SLICE_BYTES = 32 << 20, 16 << 20
#: A prefix that may stand for more than 2 ** HOT_BITS windows is dealt by one more word. Words are
#: taken to follow each other up to 2 ** TOGETHER_BITS times as often as by chance.
HOT_BITS, TOGETHER_BITS = 20, 5
UNKNOWN = "und"
# The characters that part pieces, besides those that part words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
FOLD = bytes.maketrans(UPPER + BREAKS + b"\t", UPPER.lower() + b"\n" * len(BREAKS) + b" ")
BREAK = b"\n"
PASS = "kind int, chunk long, slice long, payload binary"
# Kinds: 0 windows of a slice, 1 a numbered word, 2 the words of a language.
COUNTED = "kind int, slice long, payload binary, id long, lang string, word string, n long"
COUNTED_ARROW = pa.schema([
    ("kind", pa.int32()), ("slice", pa.int64()), ("payload", pa.binary()), ("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()),
])


class Tokens:
    """Words of a chunk's documents end to end. ``keys`` tell (language, word) apart; a break stands
    behind each piece."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, hashes: WordHashes) -> None:
        self.langs = [UNKNOWN if x is None else x for x in rows.column("lang").to_pylist()]
        flat: list[bytes] = []
        sizes = []
        for body in utf8(rows.column("text")):
            before = len(flat)
            flat += [w for w in body.translate(FOLD).replace(BREAK, b" \n ").split(b" ") if w]
            flat.append(BREAK)
            sizes.append(len(flat) - before)
        self.words = flat
        self.documents = np.repeat(np.arange(len(sizes)), sizes)
        own = hashes.of(flat)
        self.inside = own != np.uint64(hashes[BREAK])
        language = np.array([xxhash.xxh3_64_intdigest(x.encode(), 5) for x in self.langs], np.uint64)
        self.keys = mixed(own + language[self.documents]) if flat else own

        kinds, self.first, self.local = np.unique(self.keys, return_index=True, return_inverse=True)
        many = np.bincount(self.local[self.inside], minlength=len(kinds))
        #: Distinct words (breaks are none), their keys in order, and how often they occur.
        self.real = np.flatnonzero(many)
        self.asked, self.many = kinds[self.real], many[self.real]

    def questions(self, chunk: int, bits: int) -> Iterator[tuple]:
        """(1, chunk, slice, payload) with the distinct words of a slice and their counts."""
        for number, i, j in runs(slices_of(self.asked, bits)):
            steps = np.diff(self.asked[i:j], prepend=np.uint64(0))
            yield 1, chunk, number, squeezed(planes(steps, "<u8"), planes(self.many[i:j], "<u4"))

    def numbered(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct word its number (0: too rare), the bits of its count, and whether this chunk names it."""
        numbers, marks = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint8)]
        for _, payload in sorted(zip(answers.column("slice").to_pylist(), answers.column("payload").to_pylist())):
            raw = zstandard.decompress(payload)
            numbers.append(plain(raw, 0, len(raw) // 5, "<u4"))
            marks.append(plain(raw, 4 * (len(raw) // 5), len(raw) // 5, "u1"))
        marks = np.concatenate(marks)
        return np.concatenate(numbers), marks & 127, marks > 127

    def named(self, numbers: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        """The words that this chunk names, each with its number."""
        at = self.first[self.real[own]]
        return counted(
            1, len(at), id=pa.array(numbers[own].astype(np.int64)),
            lang=pa.array([self.langs[i] for i in self.documents[at]], pa.string()), word=pa.array([self.words[i].decode() for i in at], pa.string()),
        )

    def windows(self, numbers: np.ndarray, weights: np.ndarray, longest: int, bits: int, total_bits: int) -> pa.RecordBatch:
        """Distinct windows of numbered words with their counts, slice by slice."""
        by_kind, heavy = np.zeros(len(self.first), np.uint32), np.zeros(len(self.first), np.int16)
        by_kind[self.real], heavy[self.real] = numbers, weights
        words = np.r_[by_kind[self.local], np.zeros(longest, np.uint32)]
        weight = np.r_[heavy[self.local], np.zeros(longest, np.int16)]
        lead = np.flatnonzero(words)
        columns, weighs = [words[lead]], [weight[lead]]
        for k in range(1, longest):
            columns.append(np.where(columns[-1] > 0, words[lead + k], np.uint32(0)))
            weighs.append(weight[lead + k])
        order, new = sorted_windows(columns)
        starts = np.flatnonzero(new)
        n = np.diff(np.r_[starts, len(order)])
        columns, weighs = [c[order[starts]] for c in columns], [w[order[starts]] for w in weighs]
        depth, home = dealt(columns, weighs, total_bits)
        home = slices_of(home, bits)
        order = np.argsort(home, kind="stable")
        columns, n, depth = [c[order] for c in columns], n[order], depth[order]
        out = []
        for number, i, j in runs(home[order]):
            first = np.diff(columns[0][i:j], prepend=np.uint32(0))
            out.append((number, squeezed(*[planes(c, "<u4") for c in (first, *[c[i:j] for c in columns[1:]], n[i:j])], planes(depth[i:j], "u1"))))
        return counted(0, len(out), slice=pa.array([x for x, _ in out], pa.int64()), payload=pa.array([x for _, x in out], pa.binary()))

    def totals(self) -> pa.RecordBatch:
        """Words per language."""
        names = sorted(set(self.langs))
        codes = np.array([names.index(x) for x in self.langs], np.int64)
        n = np.bincount(codes[self.documents[self.inside]], minlength=len(names))
        return counted(2, len(names), lang=pa.array(names, pa.string()), n=pa.array(n.astype(np.int64)))


def counted(kind: int, rows: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of one kind; columns that it does not have are NULL."""
    columns["kind"] = pa.array([kind] * rows, pa.int32())
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in COUNTED_ARROW], schema=COUNTED_ARROW)


def planes(values: np.ndarray, type_: str) -> bytes:
    """Numbers as columns of bytes, which compress better than whole numbers."""
    return np.ascontiguousarray(values.astype(type_)).view(np.uint8).reshape(len(values), -1).T.tobytes()


def plain(raw: bytes, start: int, n: int, type_: str) -> np.ndarray:
    """``n`` numbers from their ``planes``."""
    width = np.dtype(type_).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, start).reshape(width, n).T).view(type_).ravel()


def squeezed(*parts: bytes) -> bytes:
    return zstandard.compress(b"".join(parts), 3)


def runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, stop) of each run of equal values."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else []
    for i, j in zip(starts, [*starts[1:], len(values)]):
        yield int(values[i]), int(i), int(j)


def sorted_windows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the windows, and where in it another one begins."""
    wide = [*columns, *[np.zeros_like(columns[0])] * (len(columns) % 2)]
    keys = [a.astype(np.uint64) << np.uint64(32) | b for a, b in zip(wide[::2], wide[1::2])]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    return order, new


def dealt(columns: list[np.ndarray], weights: list[np.ndarray], total_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window by how many of its first words it is dealt, and their hash. The same prefix always
    gives the same answer, whatever the chunk and the words behind it."""
    depth, home, size = np.ones(len(columns[0]), np.uint8), mixed(columns[0].astype(np.uint64), 11), weights[0].copy()
    for k in range(1, len(columns)):
        hot = size > HOT_BITS
        depth[hot] = k + 1
        home = np.where(hot, mixed(home + columns[k], 11 + k), home)
        size = np.where(hot & (columns[k] > 0), size + np.minimum(weights[k] + (TOGETHER_BITS - total_bits), 0), 0)
    return depth, home


def number_words(rows: pa.Table, bits: int, least: int) -> pa.Table:
    """For one slice of words: per word asked for its number and a mark: the bits of its count, and 128
    for the first chunk that asked. Both follow from keys, counts and chunks, not from the order of rows."""
    payloads = [zstandard.decompress(p) for p in rows.column("payload").to_pylist()]
    sizes = [len(p) // 12 for p in payloads]
    keys = np.concatenate([np.cumsum(plain(p, 0, n, "<u8"), dtype=np.uint64) for p, n in zip(payloads, sizes)])
    many = np.concatenate([plain(p, 8 * n, n, "<u4") for p, n in zip(payloads, sizes)]).astype(np.int64)
    order = np.lexsort((np.repeat(np.array(rows.column("chunk").to_pylist(), np.int64), sizes), keys))
    keys, many = keys[order], many[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    sums = np.add.reduceat(many, np.flatnonzero(new))
    rank = np.empty(len(sums), np.int64)
    rank[np.lexsort((keys[new], -sums))] = np.arange(len(sums))
    numbers = np.where(sums >= least, 1 + rows.column("slice")[0].as_py() + (rank << bits), 0)
    if numbers.max() >= 1 << 32:
        raise OverflowError("more frequent words than numbers of 32 bits")
    group = np.cumsum(new) - 1
    back_numbers, back_marks = np.empty(len(order), np.uint32), np.empty(len(order), np.uint8)
    back_numbers[order] = numbers[group]
    back_marks[order] = np.frexp(sums.astype(float))[1][group] | np.where(new & (numbers[group] > 0), 128, 0)
    ends = np.cumsum(sizes)
    replies = [squeezed(planes(back_numbers[e - n : e], "<u4"), planes(back_marks[e - n : e], "u1")) for e, n in zip(ends, sizes)]
    return rows.set_column(rows.schema.get_field_index("payload"), "payload", pa.array(replies, pa.binary()))


def fold(rows: pa.Table, longest: int, least: int) -> pa.Table:
    """For one slice of windows: (w1, ..., c), each window padded behind its longest frequent prefix, or
    behind the longest prefix that other slices may have, too."""
    payloads = [zstandard.decompress(p) for p in rows.column("payload").to_pylist()]
    width = 4 * longest + 5
    sizes = [len(p) // width for p in payloads]
    columns = [np.concatenate([plain(p, 4 * k * n, n, "<u4") for p, n in zip(payloads, sizes)]) for k in range(1, longest)]
    columns.insert(0, np.concatenate([np.cumsum(plain(p, 0, n, "<u4"), dtype=np.uint32) for p, n in zip(payloads, sizes)]))
    many = np.concatenate([plain(p, 4 * longest * n, n, "<u4") for p, n in zip(payloads, sizes)])
    kept = np.concatenate([plain(p, (4 * longest + 4) * n, n, "u1") for p, n in zip(payloads, sizes)]) - np.uint8(1)
    del payloads
    order, _ = sorted_windows(columns)
    columns, many, kept = [c[order] for c in columns], many[order].astype(np.int64), kept[order]
    new, starts = np.zeros(len(order), bool), []
    new[:1] = True
    for k, column in enumerate(columns, 1):
        new[1:] |= column[1:] != column[:-1]
        starts.append(np.flatnonzero(new))
        often = np.add.reduceat(many, starts[-1]) >= least
        deeper = np.repeat(often, np.diff(np.r_[starts[-1], len(many)])) & (column > 0) & (kept < k)
        kept[deeper] = k
    out = []
    for k, at in enumerate(starts, 1):
        sums = np.add.reduceat(np.where(kept == k, many, 0), at)
        at, sums = at[sums > 0], sums[sums > 0]
        out.append([*[pa.array(c[at].astype(np.int64) if i < k else np.zeros(len(at), np.int64)) for i, c in enumerate(columns)], pa.array(sums)])
    return pa.concat_tables([pa.Table.from_arrays(arrays, names=[*window_columns(longest), "c"]) for arrays in out])


def window_columns(longest: int) -> list[str]:
    return [f"w{k}" for k in range(1, longest + 1)]


def windows(docs: DataFrame, scratch: Scratch, least: int, longest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(w1, ..., c): windows of word numbers, padded with 0 and summed as far as they were dealt together;
    (id, lang, word): what the numbers stand for; (lang, n): words per language."""
    schema = to_arrow_schema(StructType.fromDDL(PASS))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_bits, window_bits = (int(total // x).bit_length() for x in (WORD_SLICE_BYTES, WINDOW_SLICE_BYTES))
    # Six bytes or so make a word; this decides by which prefix windows are dealt, and nothing else.
    total_bits = int(total // 6).bit_length()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, base = WordHashes(), TaskContext.get().partitionId() << 32
        for i, rows in enumerate(pieces(batches, "text", CHUNK_BYTES)):
            asked = Tokens(rows, hashes).questions(base + i, word_bits)
            yield table(schema, [(0, base + i, None, packed(rows)), *asked])
        give_back()

    def count(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, found = WordHashes(), []
        for body in rows.column("payload").to_pylist():
            tokens = Tokens(unpacked(body), hashes)
            numbers, weights, own = tokens.numbered(answers)
            found += [tokens.totals(), tokens.named(numbers, own), tokens.windows(numbers, weights, longest, window_bits, total_bits)]
        return pa.Table.from_batches(found)

    first = scratch.store(docs.mapInArrow(scan, PASS), "phrase-chunks")
    asked = sketch.only(first, 1)
    answers = asked.groupBy("slice").applyInArrow(lambda rows: number_words(rows, word_bits, least), asked.schema)
    bodies = sketch.only(first, 0).select("chunk", "payload")
    found = scratch.store(bodies.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(count, COUNTED), "phrase-windows")
    scratch.drop("phrase-chunks")
    scratch.release()
    ddl = ", ".join([*[f"{w} long" for w in window_columns(longest)], "c long"])
    folded = sketch.only(found, 0).select("slice", "payload").groupBy("slice").applyInArrow(lambda rows: fold(rows, longest, least), ddl)
    words = sketch.only(found, 1).select("id", "lang", "word")
    return folded, words, sketch.only(found, 2).groupBy("lang").agg(F.sum("n").alias("n"))


def marginals(counted: DataFrame, longest: int) -> DataFrame:
    """(lang, k, words, f): counts of all prefixes of the windows, by ROLLUP; k = 0 counts all words."""
    names = window_columns(longest)
    # Each level drops one more column from the right: 0, 1, 3, 7, ... as bits.
    level = F.grouping_id()
    summed = counted.rollup("lang", *names).agg(F.sum("c").alias("f"), level.alias("level"))
    k = F.lit(None)
    for i, name in enumerate(names, 1):
        k = F.when((F.col("level") == (1 << (longest - i)) - 1) & (F.col(name) != ""), F.lit(i)).otherwise(k)
    k = F.when((F.col("level") == (1 << (longest - 1)) - 1) & (F.col(names[0]) == ""), F.lit(0)).otherwise(k)
    words = F.filter(F.array(*names), lambda w: w.isNotNull() & (w != ""))
    return summed.withColumn("k", k.cast("int")).where(F.col("k").isNotNull()).select("lang", "k", words.alias("words"), "f")


def spelled(counts: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, k, words, f) with words in place of their numbers."""
    each = counts.select("k", "f", "words", F.posexplode("words").alias("at", "number"))
    each = each.join(words.select(F.col("id").cast("string").alias("number"), "lang", "word"), "number")
    whole = each.groupBy("words", "k", "f").agg(F.max("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("_parts"))
    return whole.select("lang", "k", F.col("_parts.word").alias("words"), "f")


def big(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def mine(
    docs: DataFrame, text: str = "text", lang: str = "lang",
    longest: int = 4, least: int = 30, inside_percent: int = 80, top: int = 2000, scale: int = 2_000_000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language.

    Candidates are phrases of 2 to ``longest`` words that occur ``least`` times. Of all cuts in two
    the one of least ``floor(scale * a / (l + r))`` counts (then the earliest); candidates inside of
    a longer one that is ``inside_percent`` as frequent are dropped.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    folded, words, totals = windows(rows, scratch, least, longest)
    # A number tells the language, too.
    numbers = [F.when(F.col(w) > 0, F.col(w).cast("string")).otherwise("").alias(w) for w in window_columns(longest)]
    counts = marginals(folded.select(F.lit("").alias("lang"), *numbers, "c"), longest).where((F.col("k") > 0) & (F.col("f") >= least))
    counts = spelled(counts, words).unionByName(totals.select("lang", F.lit(0).alias("k"), F.array().cast("array<string>").alias("words"), F.col("n").alias("f")))
    counts = scratch.store(counts.withColumn("phrase", F.array_join("words", " ")), "phrase-counts")
    scratch.drop("phrase-windows")
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.where("k > 0").select("lang", "phrase", "f")
    candidates = counts.where("k > 1").select("lang", "phrase", "words", "k", F.col("f").alias("a"))

    def part(first: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("_left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("_right"))
    for name, count in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)), ["lang", name])
    score = F.expr(f"(CAST({scale} AS DECIMAL(15,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("_best"))

    spans = F.expr("flatten(transform(sequence(2, k - 1), size -> transform(sequence(1, k - size + 1), s -> array_join(slice(words, s, size), ' '))))")
    within = candidates.where("k > 2").select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = best.join(within, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (big(F.col("_longer")) * 100 < big(F.col("a")) * inside_percent)
    ).select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
