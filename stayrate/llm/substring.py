"""Substring dedup: removes words covered by windows that already occurred earlier.

A window is ``size`` consecutive words of one document. Every word covered by a window whose word
sequence also starts earlier (smaller id, or same document and earlier start) is removed; windows
are judged on the input.

1. Rows are packed into chunks of about ``CHUNK_BYTES`` of text. A chunk adds the anchors of its
   windows to its count-min sketch: a window's anchor is the last of its word 8-grams of least hash,
   so equal windows have equal anchors at equal offsets, and an anchor counts at least as often as
   any window it stands for.
2. Sketches are merged (``sketch``). Windows whose anchor is estimated to occur once cannot repeat;
   no repeated window is lost.
3. The others are grouped exactly, by a 96-bit hash of all their words. A chunk sends each distinct
   window once, with its first place, so a passage in a third of all documents arrives as one row
   per chunk; the answer is a bit: does the window start earlier in another chunk? Claims are only
   shuffled; what is stored are the answers, and each chunk's choice of windows, which comes along.
4. Each chunk removes the covered words.

NULL ids sort last; rows of equal id and text are ordered by where they lie, which cannot be seen
in the result. A NULL text has no words and stays NULL. A text that loses nothing stays as it is;
otherwise it becomes the kept words, joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayrate.llm import sketch
from stayrate.llm.scratch import Scratch, without
from stayrate.llm.text import WordHashes, give_back, gram_hashes, mixed, packed, pieces, unpacked, utf8

CHUNK_BYTES = 2 << 20
#: Text whose windows one task groups together; decides nothing else.
SLICE_BYTES = 32 << 20
ANCHOR_WORDS = 8
LAST = np.iinfo(np.int64).max
PASS = "kind int, chunk long, n long, depth int, slice long, payload binary"
REPLIES = f"kind int, {sketch.FIELDS}"
#: The columns that ``remove_repeats`` adds.
RESULTS = ("n_words", "n_removed", "kept_sha256")


class Words:
    """Words of a chunk's documents end to end, and the windows that lie within one document."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, id_column: str, text: str, size: int, hashes: WordHashes) -> None:
        texts = utf8(rows.column(text))
        self.words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        flat = [w for ws in self.words for w in ws]
        self.hashes = hashes.of(flat)
        self.size = size
        documents = np.repeat(np.arange(len(texts)), self.counts)
        places = np.arange(len(flat))
        fits = places + size <= self.ends[documents]
        self.windows = places[fits]
        self.documents = documents
        ids = [LAST if x is None else int(x) for x in rows.column(id_column).to_pylist()]
        self.ids = np.array(ids, np.int64)
        self.texts = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)
        self.rank = np.empty(len(texts), np.int64)
        self.rank[np.lexsort((self.texts, self.ids))] = np.arange(len(texts))

    def anchors(self) -> np.ndarray:
        """Per window the place of its anchor."""
        grams = gram_hashes(self.hashes, min(ANCHOR_WORDS, self.size))
        span = self.size - min(ANCHOR_WORDS, self.size) + 1
        if not len(self.windows):
            return np.zeros(0, np.int64)
        views = np.lib.stride_tricks.sliding_window_view(grams, span)
        last = span - 1 - np.argmin(views[:, ::-1], axis=1)
        return self.windows + last[self.windows]

    def anchor_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct anchor places, and per window the index of its own."""
        places, at = np.unique(self.anchors(), return_inverse=True)
        return gram_hashes(self.hashes, min(ANCHOR_WORDS, self.size))[places] if len(places) else np.zeros(0, np.uint64), at

    def distinct(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen windows: those that are first of their kind here, by hash; for every
        chosen window whether it is such a first, and the index of its kind."""
        starts = self.windows[chosen]
        first, second = gram_hashes(self.hashes, self.size)[starts], gram_hashes(self.hashes, self.size, 7)[starts] >> np.uint64(32)
        order = np.lexsort((starts, self.rank[self.documents[starts]], second, first))
        a, b = first[order], second[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        kind, leads = np.empty(len(a), np.int64), np.empty(len(a), bool)
        kind[order], leads[order] = np.cumsum(new) - 1, new
        return starts[order[new]], a[new], b[new].astype(np.uint32), leads, kind


def slices_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def claims(chunk: int, words: Words, chosen: np.ndarray, bits: int) -> Iterator[tuple]:
    """(chunk, 0, slice, payload) with the distinct chosen windows and where they first start."""
    starts, a, b, _, _ = words.distinct(chosen)
    slices = slices_of(a, bits)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    cuts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]) if len(a) else []
    for i, j in zip(cuts, [*cuts[1:], len(a)]):
        documents, at = np.unique(words.documents[starts[i:j]], return_inverse=True)
        head = np.array([j - i, len(documents)], "<i8").tobytes()
        within = (starts[i:j] - words.starts[words.documents[starts[i:j]]]).astype("<u4")
        parts = [head, a[i:j].tobytes(), b[i:j].tobytes(), at.astype("<u4").tobytes(), within.tobytes(),
                 words.ids[documents].tobytes(), words.texts[documents].tobytes()]
        yield chunk, 0, int(slices[i]), squeeze(b"".join(parts))


def claimed(payload: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.decompress(payload)
    n, m = np.frombuffer(raw, "<i8", 2)
    a, b, at, within = (np.frombuffer(raw, t, n, 16 + n * o) for t, o in (("<u8", 0), ("<u4", 8), ("<u4", 12), ("<u4", 16)))
    ids, texts = np.frombuffer(raw, "<i8", m, 16 + 20 * n), np.frombuffer(raw, "<u8", m, 16 + 20 * n + 8 * m)
    return a, b, ids[at], texts[at], within


def settle(rows: pa.Table) -> pa.Table:
    """For one slice of windows: per claim a bit, 1 where the window starts earlier in another chunk.
    Rows of kind 0 are handed on as they are."""
    choices, rows = (rows.filter(pc.equal(rows.column("kind"), k)) for k in (0, 1))
    if not rows.num_rows:
        return choices
    chunks = np.array(rows.column("chunk").to_pylist(), np.int64)
    parts = [claimed(p) for p in rows.column("payload").to_pylist()]
    sizes = [len(p[0]) for p in parts]
    a, b, ids, texts, within = (np.concatenate(x) for x in zip(*parts))
    home = np.repeat(chunks, sizes)
    order = np.lexsort((ids, a))
    new = np.r_[True, (a[order][1:] != a[order][:-1])]
    group = np.cumsum(new) - 1
    # The first of a group is its owner if no other row has its id and all rows hold one window;
    # the few other groups are ordered in full.
    tied = np.r_[False, (ids[order][1:] == ids[order][:-1]) | (b[order][1:] != b[order][:-1])] & ~new
    odd = np.zeros(group[-1] + 1, bool)
    odd[group[tied]] = True
    late = np.empty(len(a), bool)
    late[order] = ~new
    left = order[odd[group]]
    if len(left):
        left = left[np.lexsort((home[left], within[left], texts[left], ids[left], b[left], a[left]))]
        late[left] = ~np.r_[True, (a[left][1:] != a[left][:-1]) | (b[left][1:] != b[left][:-1])]
    bits = [zstandard.compress(np.packbits(x).tobytes()) for x in np.split(late, np.cumsum(sizes)[:-1])]
    rows = rows.set_column(rows.schema.get_field_index("payload"), "payload", pa.array(bits, pa.binary()))
    return pa.concat_tables([choices, rows.cast(choices.schema)])


def removed_words(words: Words, mask: np.ndarray, answers: pa.Table, bits: int) -> np.ndarray:
    """Per word of the chunk, whether a window covers it that starts earlier elsewhere or here."""
    chosen = np.flatnonzero(mask)
    gone = np.zeros(len(words.hashes), bool)
    if not len(chosen):
        return gone
    _, a, _, leads, kind = words.distinct(chosen)
    late = []
    for _, payload in sorted(zip(answers.column("slice").to_pylist(), answers.column("payload").to_pylist())):
        late.append(np.unpackbits(np.frombuffer(zstandard.decompress(payload), np.uint8)))
    # Bits are packed slice by slice; cut each to the number of its claims.
    sizes = np.unique(slices_of(a, bits), return_counts=True)[1]
    late = np.concatenate([x[:n] for x, n in zip(late, sizes)]).astype(bool)
    repeated = words.windows[chosen[~leads | late[kind]]]
    change = np.zeros(len(words.hashes) + 1, np.int32)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + words.size, -1)
    return np.cumsum(change)[:-1] > 0


def table(schema: pa.Schema, rows: Iterable[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 20) -> DataFrame:
    """The rows of ``docs`` with the text that is left, ``n_words`` and ``n_removed`` (words before,
    words removed) and ``kept_sha256`` (of the kept words joined by one space)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs = without(docs, *RESULTS)
    ids = id_column
    schema = to_arrow_schema(StructType.fromDDL(PASS))
    result = to_arrow_schema(StructType.fromDDL(", ".join(f"{n} {'string' if n.endswith('256') else 'long'}" for n in RESULTS)))
    # About a seventh of all places are anchors, and words have four bytes or more on average;
    # the estimate sizes the sketch and decides nothing else.
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shape = sketch.Shape(total // 30 + 1, 16)
    bits = max(0, int(total // SLICE_BYTES).bit_length())

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, base = WordHashes(), TaskContext.get().partitionId() << 32
        for i, rows in enumerate(pieces(batches, text, CHUNK_BYTES)):
            words = Words(rows, ids, text, size, hashes)
            asked = sketch.questions(base + i, words.anchor_keys()[0], shape)
            yield table(schema, [(0, base + i, len(words.hashes), None, None, packed(rows)), *[(1, c, None, d, s, p) for c, d, s, p in asked]])
        give_back()

    def choose(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, out = WordHashes(), []
        for body in rows.column("payload").to_pylist():
            words = Words(unpacked(body), ids, text, size, hashes)
            keys, at = words.anchor_keys()
            chosen = sketch.estimates(keys, answers, shape)[at] > 1 if len(keys) else np.zeros(0, bool)
            chunk = rows.column("chunk")[0].as_py()
            home = int(mixed(np.array([chunk], np.uint64))[0] >> np.uint64(32)) % (1 << bits)
            out.append((0, chunk, None, None, home, zstandard.compress(np.packbits(chosen).tobytes())))
            out += [(1, c, None, d, s, p) for c, d, s, p in claims(chunk, words, np.flatnonzero(chosen), bits)]
        return pa.Table.from_batches([table(schema, out)], schema)

    def finish(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        body = unpacked(rows.column("payload")[0].as_py())
        words = Words(body, ids, text, size, WordHashes())
        masks, late = (answers.filter(pc.equal(answers.column("kind"), k)) for k in (0, 1))
        mask = np.unpackbits(np.frombuffer(zstandard.decompress(masks.column("payload")[0].as_py()), np.uint8))
        gone = removed_words(words, mask[: len(words.windows)], late, bits)
        lost, texts, digests = [], body.column(text).to_pylist(), []
        for i, (start, stop) in enumerate(zip(words.starts, words.ends)):
            out = gone[start:stop]
            lost.append(int(out.sum()))
            kept = b" ".join([w for w, g in zip(words.words[i], out) if not g] if lost[-1] else words.words[i])
            digests.append(hashlib.sha256(kept).hexdigest())
            if lost[-1]:
                texts[i] = kept.decode()
        at = body.schema.get_field_index(text)
        body = body.set_column(at, body.schema.field(at), pa.array(texts, body.schema.field(at).type))
        for field, values in zip(result, (words.counts, lost, digests)):
            body = body.append_column(field, pa.array(values, field.type))
        return body

    first = scratch.store(docs.mapInArrow(scan, PASS), "windows")
    answers = sketch.merge(sketch.only(first, 1).select("chunk", "depth", "slice", "payload"), shape)
    bodies = sketch.only(first, 0).select("chunk", "payload")
    # A chunk without windows has asked nothing: the cogroup still brings it.
    asked = bodies.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(choose, PASS)
    settled = asked.select("kind", "chunk", "depth", "slice", "payload").groupBy("slice").applyInArrow(settle, REPLIES)
    replies = scratch.store(settled, "replies")
    # What the passes so far have shuffled is not read again.
    scratch.release()
    out = StructType([*docs.schema.fields, *StructType.fromDDL(", ".join(f"{n} {'string' if n.endswith('256') else 'long'}" for n in RESULTS)).fields])
    return bodies.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(finish, out)
