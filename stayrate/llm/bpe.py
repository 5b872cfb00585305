"""BPE encoding and decoding with content-defined chunk reuse.

A byte-level BPE tokenizer first splits a text into pretokens, and none goes on from a character
that is not white space to one that is. A text may therefore be cut in front of such white space
(a *seam*); the parts, encoded apart, give the tokens of the whole.

1. A rolling hash of the last 48 bytes cuts a text into chunks of about a kilobyte wherever its
   top bits are zero: equal passages are cut alike, whatever stands before them.
2. A chunk is encoded once: in the Python worker, a chunk met before in any document is taken from a table.
   Its inside, from its first seam to its last, is encoded part by part, seam to seam; parts met
   before come from a table, too. Only new parts go through the tokenizer, many end to end.
3. Chunk ends are no seams. The stretch from the last seam of one chunk to the first seam of the next
   is encoded anew at each join (a chunk without a seam lies in the stretch as a whole). To see that
   both sides agree, the stretch is also encoded together with the part before and the part behind;
   if their tokens are not the same, the repair grows to the whole document.

Both tables have a byte limit and are emptied when they reach it: reuse depends on them, results do
not. Decoding joins the bytes of the ids' tokens and replaces invalid UTF-8. A NULL text counts as
empty and has no tokens.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, DataType, LongType, StringType, StructField, StructType

from stayrate.llm.scratch import without
from stayrate.llm.text import give_back, pieces, utf8

CHUNK_BITS = 10
WINDOW = 48
BATCH_BYTES = 1 << 20
TABLE_BYTES = 32 << 20
#: Bytes of parts that go through the tokenizer as one text.
RUN_BYTES = 4096
# A seam lies in front of a space or a line feed that follows a printable ASCII character or a
# Latin-1 letter (C3 xx): those are never white space. Other seams exist, but these are enough.
BLANK = np.isin(np.arange(256), [10, 32])
SAFE = (np.arange(256) > 32) & (np.arange(256) < 127)


def seams(body: bytes) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8)
    if len(raw) < 2:
        return np.zeros(0, np.int64)
    safe = SAFE[raw[:-1]]
    safe[1:] |= raw[:-2] == 0xC3
    return np.flatnonzero(BLANK[raw[1:]] & safe) + 1


def joinable(part: bytes) -> bool:
    """Whether parts like this one may stand end to end, with seams between them."""
    return part[:1] in (b" ", b"\n") and (33 <= part[-1] < 127 or part[-2:-1] == b"\xc3")


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves,
    the others, in order, from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Table(dict):
    """Values by text bytes, of bounded size."""

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit, self.used = limit, 0

    def add(self, key: bytes, value: object, size: int) -> None:
        self.used += len(key) + size + 200
        if self.used > self.limit:
            self.clear()
            self.used = len(key) + size + 200
        self[key] = value


class Encoder:
    """Encodes texts with reuse of chunks and parts; one per Python worker."""

    def __init__(self, tokenizer_json: str, vocabulary: Sequence[bytes], limit: int = TABLE_BYTES) -> None:
        # Spark's tasks are the parallelism; more threads only cost memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lengths = np.array([len(b) for b in vocabulary], np.int64)
        self.gear = np.random.default_rng(48).integers(0, 1 << 63, 256, dtype=np.uint64)
        self.parts, self.chunks, self.agreed = Table(limit), Table(limit), Table(limit // 4)
        self.encoded_bytes = 0

    def cut(self, body: bytes) -> list[bytes]:
        if len(body) <= WINDOW:
            return [body]
        total = np.cumsum(self.gear[np.frombuffer(body, np.uint8)], dtype=np.uint64)
        rolled = (total[WINDOW:] - total[:-WINDOW]) * np.uint64(0x9E3779B97F4A7C15)
        ends = (np.flatnonzero((rolled >> np.uint64(64 - CHUNK_BITS)) == 0) + WINDOW + 1).tolist()
        return [c for c in (body[i:j] for i, j in zip([0, *ends], [*ends, len(body)])) if c]

    def through(self, texts: list[bytes]) -> list[np.ndarray]:
        self.encoded_bytes += sum(map(len, texts))
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def tokens(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. Those that may stand end to end go through the tokenizer in runs, which
        are taken apart by the lengths of their tokens."""
        out: list[bytes] = [b""] * len(texts)
        runs, alone, size = [[]], [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if not joinable(text):
                alone.append(i)
                continue
            if size > RUN_BYTES:
                runs.append([])
                size = 0
            runs[-1].append(i)
            size += len(text)
        if runs[0]:
            for run, ids in zip(runs, self.through([b"".join([texts[i] for i in run]) for run in runs])):
                ends = np.cumsum([len(texts[i]) for i in run])
                after = np.cumsum(self.lengths[ids])
                at = np.searchsorted(after, ends)
                if len(after) and at[-1] < len(after) and (after[at] == ends).all():
                    raw, stops = ids.tobytes(), (4 * (at + 1)).tolist()
                    for i, a, b in zip(run, [0, *stops], stops):
                        out[i] = raw[a:b]
                else:
                    alone += run
        for i, ids in zip(alone, self.through([texts[i] for i in alone]) if alone else ()):
            out[i] = ids.tobytes()
        return out

    def learn(self, wanted: Iterable[bytes]) -> None:
        """Puts the ids of all these parts into the table; new ones are encoded once each."""
        table = self.parts
        fresh = list(dict.fromkeys([p for p in wanted if p not in table]))
        if fresh:
            encoded = self.tokens(fresh)
            for part, ids in zip(fresh, encoded):
                table.used += len(part) + len(ids) + 200
                table[part] = ids

    def encode(self, bodies: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if self.parts.used > self.parts.limit:
            self.parts.clear()
            self.parts.used = 0
        chunked = [self.cut(b) for b in bodies]
        known, fresh = {}, {}
        for chunks in chunked:
            for chunk in chunks:
                if chunk not in known and chunk not in fresh:
                    found = self.chunks.get(chunk)
                    if found:
                        known[chunk] = found
                    else:
                        ends = [0, *seams(chunk).tolist(), len(chunk)]
                        fresh[chunk] = [chunk[i:j] for i, j in zip(ends, ends[1:])]
        self.learn(p for each in fresh.values() for p in each[1:-1])
        ids_of = self.parts.__getitem__
        for chunk, (head, *rest) in fresh.items():
            # Bytes before the first seam, ids from there to the last one, bytes behind it (None
            # without a seam), and the outermost parts of the inside.
            inside = rest[:-1]
            ids = b"".join(map(ids_of, inside))
            known[chunk] = found = (head, ids, rest[-1] if rest else None, inside[0] if inside else b"", inside[-1] if inside else b"")
            self.chunks.add(chunk, found, len(ids) + 300)
        planned = [self.joined(chunks, known) for chunks in chunked]
        self.learn(s for plan in planned for s, *_ in plan)
        differ = self.disagreeing([s for plan in planned for s in plan])
        whole = [i for i, plan in enumerate(planned) if differ and any(s[:3] in differ for s in plan)]
        out = [b"".join([x for s, _, _, ids in plan for x in (ids_of(s), ids)]) for plan in planned]
        for i, ids in zip(whole, self.through([bodies[i] for i in whole]) if whole else ()):
            out[i] = ids.tobytes()
        return out

    def joined(self, chunks: list[bytes], known: dict) -> list[tuple[bytes, bytes, bytes, bytes]]:
        """(stretch, part before, part behind, ids that follow) from join to join."""
        plan, pending, before = [], b"", b""
        for chunk in chunks:
            head, ids, tail, first, last = known[chunk]
            if tail is None:
                pending += head
                continue
            plan.append((pending + head, before, first, ids))
            pending, before = tail, last
        plan.append((pending, before, b"", b""))
        return plan

    def disagreeing(self, joins: list[tuple]) -> set[tuple]:
        """Joins whose neighbours are encoded otherwise together with the stretch than apart."""
        fresh = list({s[:3] for s in joins if (s[1] or s[2]) and s[:3] not in self.agreed})
        if not fresh:
            return set()
        self.learn(p for join in fresh for p in join)
        together = self.tokens([before + stretch + behind for stretch, before, behind in fresh])
        differ = set()
        for join, ids in zip(fresh, together):
            stretch, before, behind = join
            if ids == self.parts[before] + self.parts[stretch] + self.parts[behind]:
                self.agreed.add(join, True, len(stretch) + 200)
            else:
                differ.add(join)
        return differ


def vocabulary_bytes(tokenizer_json: str) -> list[bytes]:
    """The bytes that each id stands for."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    letters, added = byte_letters(), tokenizer.get_added_tokens_decoder()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        found[i] = token.encode() if i in added else bytes(letters[c] for c in token)
    return found


class Shared:
    """A tokenizer's file and what it is made into. Sent to each executor once, a few MB; the encoder
    is made where it is first used and then serves all tasks of that worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            self.json = f.read()
        self.vocabulary = vocabulary_bytes(self.json)
        self.made: list[Encoder] = []

    def encoder(self) -> Encoder:
        if not self.made:
            self.made.append(Encoder(self.json, self.vocabulary))
        return self.made[0]


def passed(docs: DataFrame, run: Callable, drop: Sequence[str], added: Sequence[tuple[str, DataType]]) -> DataFrame:
    """``docs`` without the columns ``drop``, and with the arrays that ``run`` yields per piece."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, arrays in run(batches):
            kept = [i for i, n in enumerate(rows.schema.names) if n not in drop]
            names = [*[rows.schema.names[i] for i in kept], *[n for n, _ in added]]
            yield pa.RecordBatch.from_arrays([*[rows.column(i) for i in kept], *arrays], names=names)
        give_back()

    fields = [f for f in docs.schema.fields if f.name not in drop]
    return docs.mapInArrow(step, StructType([*fields, *[StructField(n, t) for n, t in added]]))


ENCODED = (("ids", BinaryType()), ("n_tokens", LongType()))
DECODED = (("decoded", StringType()),)


def id_arrays(encoder: Encoder, texts: list[bytes]) -> list[pa.Array]:
    ids = encoder.encode(texts)
    return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]


def texts_of(ids: pa.Array, vocabulary: list[bytes]) -> pa.Array:
    of = vocabulary.__getitem__
    texts = (b"".join(map(of, np.frombuffer(x or b"", "<u4").tolist())) for x in ids.to_pylist())
    return pa.array([t.decode(errors="replace") for t in texts], pa.string())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``.

    ``path`` names a byte-level BPE tokenizer's JSON file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Shared(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = shared.value.encoder()
        for rows in pieces(batches, text, BATCH_BYTES):
            yield rows, id_arrays(encoder, utf8(rows.column(text)))

    return passed(without(docs, "ids", "n_tokens"), run, (), ENCODED)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids; special tokens are not skipped."""
    shared = encoded.sparkSession.sparkContext.broadcast(Shared(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        vocabulary = shared.value.vocabulary
        for rows in pieces(batches, ids, BATCH_BYTES):
            yield rows, [texts_of(rows.column(ids), vocabulary)]

    return passed(without(encoded, "decoded"), run, (), DECODED)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded`` in place of the text: encoding and then
    decoding in one pass, so that the ids need not go to another process in between."""
    shared = docs.sparkSession.sparkContext.broadcast(Shared(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        encoder, vocabulary = shared.value.encoder(), shared.value.vocabulary
        for rows in pieces(batches, text, BATCH_BYTES):
            arrays = id_arrays(encoder, utf8(rows.column(text)))
            yield rows, [*arrays, texts_of(arrays[0], vocabulary)]

    return passed(without(docs, "ids", "n_tokens", "decoded"), run, (text,), (*ENCODED, *DECODED))
