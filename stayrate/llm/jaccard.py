"""N-gram Jaccard join: groups of documents whose sets of word shingles are alike, found exactly.

A document's set holds its distinct shingles of ``words`` consecutive lower-cased words; with fewer
words, the whole sequence as one; without words it is empty and linked with nothing. Two documents
link when ``100 * |A and B| >= percent * |A or B|``.

Parity sketches: every shingle flips bits of its set's sketch, so the sketches of two sets differ in
at most as many places as the sets have elements not in common.

1. Sets of similar size share a size band, which bounds the elements that linked sets may differ in
   by some ``d``. The sketch has more than ``d`` bands, each the XOR of its shingles' hashes, so
   linked sets agree in a non-empty band (pigeonhole). A set also uses the sketch of a lower size
   band if a smaller partner may lie there. Sets with too few non-empty bands use the empty ones too.
2. A count-min sketch of all band values tells rare from common ones, the same for every document.
   Any ``d + 1`` bands must hold a shared one, so the ``d + 1`` rarest are joined on, and of these
   only those that are not unique. Passages that many documents share thus cause few candidates.
3. Sets that share a band value are verified on their shingles against a few centres of the bucket,
   which joins most groups. What remains in a bucket in different components is compared in blocks
   by 512-bit parity sketches (their Hamming distance is a lower bound, too), and the pairs that
   pass are verified. No pair is left out, and no group is expanded into all its pairs.

Equal sets are one node, so exact copies cost nothing. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayrate.llm import sketch
from stayrate.llm.scratch import Scratch, without
from stayrate.llm.text import WordHashes, give_back, gram_hashes, mixed, pieces, utf8

CHUNK_BYTES = 2 << 20
SIZE_RATIO = 1.5
SPARE_BANDS = 1.25
CENTRES = 4
BLOCK = 1024
#: Rows of buckets of one block that are gathered into one call.
SLOT_ROWS = 50_000
SCAN = "kind int, chunk long, place int, id long, n long, node long, tkey long, depth int, slice long, payload binary"
TEXTS = "node long, n long, parity binary, body binary"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"


class Bands:
    """Size bands and the sketches that belong to them."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * SIZE_RATIO)))
        self.edges = np.array(edges, np.int64)

    def targets(self, n: int) -> list[tuple[int, int, int]]:
        """(size band, d, bands) of every sketch that a set of ``n`` shingles takes part in."""
        found = []
        own = int(np.searchsorted(self.edges, n, "right")) - 1
        for band in range(own, -1, -1):
            most = int(self.edges[band + 1]) - 1
            if most * 100 // self.percent < n and band < own:
                break
            differ = most * (100 - self.percent) // self.percent
            if differ:
                found.append((band, differ, int(SPARE_BANDS * (differ + 1)) + 3))
        return found

    def values(self, shingles: np.ndarray) -> np.ndarray:
        """The XOR of the hashes in each band, 32 bits each, sketch after sketch."""
        parts = []
        for band, _, count in self.targets(len(shingles)):
            spread = mixed(shingles, 11 + band)
            out = np.zeros(count, np.uint32)
            np.bitwise_xor.at(out, (spread % np.uint64(count)).astype(np.int64), (spread >> np.uint64(32)).astype(np.uint32) | np.uint32(1 << 31))
            parts.append(out)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def keys(self, n: int, values: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Per sketch: d + 1, and the keys of the bands to choose from."""
        found, at = [], 0
        for band, differ, count in self.targets(n):
            own = values[at : at + count].astype(np.uint64)
            at += count
            keys = mixed(own | np.arange(count, dtype=np.uint64) << np.uint64(32) | np.uint64(band << 54), 5)
            used = own != 0
            found.append((count, keys) if used.sum() <= differ else (differ + 1, keys[used]))
        return found

    def most_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Elements that linked sets of these sizes may have not in common."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)


def shingle_set(text: bytes, words: int, hashes: WordHashes) -> np.ndarray:
    tokens = hashes.of(text.lower().split())
    return np.unique(gram_hashes(tokens, min(words, len(tokens)))) if len(tokens) else np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def parity(shingles: np.ndarray) -> bytes:
    """512 bits; each shingle flips one."""
    odd = np.bincount((mixed(shingles, 3) >> np.uint64(55)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signed(keys: np.ndarray) -> list[int]:
    return keys.view(np.int64).tolist()


def record(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def bucket_rows(scan: DataFrame, shape: sketch.Shape, bands: Bands) -> DataFrame:
    """(key, node) for each of a set's rarest bands that some other row may share."""
    answers = sketch.merge(sketch.only(scan, 1).select("chunk", "depth", "slice", "payload"), shape)
    sets = sketch.only(scan, 0).where("payload IS NOT NULL").select("chunk", "place", "n", "node", "payload")
    schema = to_arrow_schema(StructType.fromDDL("key long, node long"))

    def choose(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = rows.sort_by("place").to_pydict()
        lists = [bands.keys(n, np.frombuffer(v, "<u4")) for n, v in zip(rows["n"], rows["payload"])]
        flat = [keys for each in lists for _, keys in each]
        estimate = sketch.estimates(np.concatenate(flat), found, shape) if flat else []
        at, out_keys, out_nodes = 0, [], []
        for node, each in zip(rows["node"], lists):
            for need, keys in each:
                counts = estimate[at : at + len(keys)]
                at += len(keys)
                first = np.lexsort((keys, counts))[:need]
                shared = keys[first[counts[first] > 1]]
                out_keys += signed(shared)
                out_nodes += [node] * len(shared)
        return pa.table([pa.array(out_keys, pa.int64()), pa.array(out_nodes, pa.int64())], schema=schema)

    return sets.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(choose, "key long, node long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) for nodes with an edge (a, b); comp is the smallest node that can be reached.

    Labels spread to neighbours and then jump to their label's label, so long chains shorten by
    half each round. Each round is a stored table.
    """
    both = scratch.store(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    old, label = None, scratch.store(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "labels0"
    )
    step = 0
    while True:
        step += 1
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("low"))
        spread = label.join(near, F.col("node") == F.col("a")).select("node", "comp", F.least("comp", "low").alias("low"))
        up = label.select(F.col("node").alias("at"), F.col("comp").alias("top"))
        fresh = scratch.store(
            spread.join(up, F.col("low") == F.col("at")).select(
                "node", F.least("low", "top").alias("comp"), (F.least("low", "top") != F.col("comp")).alias("moved")
            ),
            f"labels{step}",
        )
        moved = fresh.where("moved").limit(1).count()
        scratch.drop(f"labels{step - 1}")
        label = fresh.select("node", "comp")
        if not moved:
            scratch.drop("edges")
            return label


def verified(pairs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``; their shingles are taken from the texts in ``sets``."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), {}

        def of(node: int, body: bytes) -> np.ndarray:
            if node not in known:
                if len(known) > 500:
                    known.clear()
                known[node] = shingle_set(zstandard.decompress(body), words, hashes)
            return known[node]

        for batch in batches:
            linked = []
            for a, b, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "x", "y")]):
                left, right = of(a, x), of(b, y)
                both = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * both >= percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    x = sets.select(F.col("node").alias("a"), F.col("body").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("body").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, linked boolean")


def dealt(open_rows: DataFrame) -> DataFrame:
    """``open_rows`` once for each two blocks (p, q) they are compared in, with the ``slot`` of the call.

    Buckets are cut into blocks of about ``BLOCK`` rows, and blocks compared two by two. Of a bucket
    of several blocks, each two are a call of their own; a call gathers many buckets of one block.
    """
    sizes = open_rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).select("key", "rows", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    total = sizes.where("blocks = 1").agg(F.sum("rows")).first()[0] or 0
    slots = max(1, total // SLOT_ROWS)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    slot = F.when(F.col("blocks") > 1, F.xxhash64("key", "p", "q")).otherwise(F.pmod(F.xxhash64("key"), F.lit(slots)))
    return (
        open_rows.join(sizes, "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("p", F.least("block", "other"))
        .withColumn("q", F.greatest("block", "other"))
        .withColumn("slot", slot)
        .select("slot", "key", "p", "q", "block", "node", "comp", "n", "parity")
    )


def pairs_left(open_rows: DataFrame, bands: Bands) -> DataFrame:
    """Distinct pairs of one bucket, of different components, that their parity sketches allow."""
    schema = to_arrow_schema(StructType.fromDDL("a long, b long"))

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("p", "ascending"), ("q", "ascending")])
        part = {c: rows.column(c).to_numpy() for c in ("key", "p", "q", "block", "node", "comp", "n")}
        bits = np.frombuffer(b"".join(rows.column("parity").to_pylist()), np.uint64).reshape(-1, 8)
        changed = (np.diff(part["key"]) != 0) | (np.diff(part["p"]) != 0) | (np.diff(part["q"]) != 0)
        starts = np.r_[0, np.flatnonzero(changed) + 1, len(bits)]
        found = []
        for start, stop in zip(starts[:-1], starts[1:]):
            node, comp, n, block = (part[c][start:stop] for c in ("node", "comp", "n", "block"))
            across = part["p"][start] != part["q"][start]
            for i in range(stop - start):
                later = np.arange(i + 1, stop - start)
                fits = comp[later] != comp[i]
                if across:
                    fits &= block[later] != block[i]
                later = later[fits]
                if len(later):
                    apart = np.bitwise_count(bits[start + later] ^ bits[start + i]).sum(axis=1)
                    for j in later[apart <= bands.most_apart(n[later], n[i])]:
                        found.append((min(node[i], node[j]), max(node[i], node[j])))
        found = list(set(found))
        return pa.table([pa.array([int(x[k]) for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    return dealt(open_rows).groupBy("slot").applyInArrow(compare, "a long, b long").distinct()


def centred(buckets: DataFrame) -> DataFrame:
    """Distinct pairs of each bucket's rows with its centres: the smallest under several hashes."""
    orders: list[Column] = [F.xxhash64(F.lit(i), F.col("node")) for i in range(CENTRES)]
    centres = buckets.groupBy("key").agg(F.array_distinct(F.array(*[F.min_by("node", o) for o in orders])).alias("centres"))
    joined = buckets.join(centres, "key").select("node", F.explode("centres").alias("centre")).where("node != centre")
    return joined.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def grouped(docs: DataFrame, id_column: str, text: str, words: int, percent: int) -> tuple[DataFrame, Scratch]:
    """Rows (id, n, node, tkey, grp) of all documents: ``grp`` is equal for those that links join,
    NULL without words. What the rows read stays in the scratch tables."""
    spark, scratch, bands = docs.sparkSession, Scratch(docs.sparkSession), Bands(percent)
    keyed = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tkey"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # Sizes the count-min sketch and decides nothing else: words have four bytes or more on
    # average, and a share of the shingles makes a band.
    shape = sketch.Shape(int(total / 6 * (100 - percent) / percent * 2) + 1, 4)
    schema, text_schema = (to_arrow_schema(StructType.fromDDL(x)) for x in (SCAN, TEXTS))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, base = WordHashes(), TaskContext.get().partitionId() << 32
        for i, rows in enumerate(pieces(batches, "text", CHUNK_BYTES)):
            out, keys = [], []
            ids, tkeys = rows.column("id").to_pylist(), rows.column("tkey").to_pylist()
            for place, body in enumerate(utf8(rows.column("text"))):
                shingles = shingle_set(body, words, hashes)
                n = len(shingles)
                values = bands.values(shingles)
                keys += [k for _, k in bands.keys(n, values)]
                out.append((0, base + i, place, ids[place], n, node_of(shingles) if n else None, tkeys[place], None, None, values.astype("<u4").tobytes() if len(values) else None))
            if keys:
                asked = sketch.questions(base + i, np.concatenate(keys), shape)
                out += [(1, c, None, None, None, None, None, d, s, p) for c, d, s, p in asked]
            yield record(schema, out)
        give_back()

    def bodies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, squeeze = WordHashes(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out = []
            for body in utf8(batch.column("text")):
                shingles = shingle_set(body, words, hashes)
                out.append((node_of(shingles), len(shingles), parity(shingles), squeeze(body)))
            yield record(text_schema, out)
        give_back()

    first = scratch.store(keyed.mapInArrow(scan, SCAN), "sets")
    rows = sketch.only(first, 0).select("id", "n", "node", "tkey")
    sets = scratch.store(rows, "documents")
    shared = scratch.store(bucket_rows(first, shape, bands), "bands")
    scratch.drop("sets")
    several = shared.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    buckets = scratch.store(shared.join(several, "key").distinct(), "buckets")
    scratch.drop("bands")
    # One text for each node that shares a bucket.
    wanted = sets.join(buckets.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("tkey").alias("tkey"))
    texts = scratch.store(
        keyed.select("text", "tkey").join(wanted.select("tkey").distinct(), "tkey", "left_semi")
        .select("text").mapInArrow(bodies, TEXTS).dropDuplicates(["node"]),
        "texts",
    )
    tried = scratch.store(verified(centred(buckets), texts, words, percent), "tried")
    label = components(tried.where("linked"), scratch)
    named = buckets.join(label, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    mixed_keys = named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("rows"))
    # A bucket of two was settled with its centre.
    unsettled = mixed_keys.where("low < high AND rows > 2").select("key")
    open_rows = scratch.store(named.join(unsettled, "key").join(texts.select("node", "n", "parity"), "node"), "open")
    left = pairs_left(open_rows, bands).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    later = scratch.store(verified(left, texts, words, percent), "later")
    links = tried.where("linked").select("a", "b").union(later.where("linked").select("a", "b"))
    final = scratch.store(components(links, scratch), "components")
    scratch.drop("buckets", "texts", "tried", "open", "later")
    grp = F.when(F.col("n") > 0, F.coalesce("comp", "node"))
    return sets.join(final, "node", "left").select("id", "n", "node", "tkey", grp.alias("grp")), scratch


def group_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``; ``component_id`` is the smallest id that
    links reach. NULL ids are never the smallest unless no other is there."""
    rows, _ = grouped(docs, id_column, text, words, percent)
    lowest = rows.where("grp IS NOT NULL").groupBy("grp").agg(F.min("id").alias("component_id"))
    return rows.join(lowest, "grp", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("grp").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs``, of each group only one: the smallest id, then the smallest text hash.

    All documents without words stay. Of rows with equal id and text, one stays.
    """
    rows, _ = grouped(docs, id_column, text, words, percent)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("tkey"))
    kept = rows.where("grp IS NOT NULL").groupBy("grp").agg(F.min(order).alias("first"))
    kept = kept.select(F.col("first.id").alias("_kept_id"), F.col("first.tkey").alias("_kept_text"))
    has_words = F.coalesce(F.col(text).rlike(WORD_CHARACTER), F.lit(False))
    at = without(docs, "_own_id", "_own_text").withColumns({"_own_id": F.col(id_column).cast("long"), "_own_text": F.xxhash64(text)})
    same = F.col("_own_id").eqNullSafe(F.col("_kept_id")) & (F.col("_own_text") == F.col("_kept_text"))
    chosen = at.where(has_words).join(kept, same, "left_semi").dropDuplicates(["_own_id", "_own_text"])
    return reduce(DataFrame.unionByName, [chosen.select(*docs.columns), docs.where(~has_words)])
