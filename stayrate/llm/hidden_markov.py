"""LM scoring with a hidden Markov language model.

A document is its words (A-Z lower-cased) and one end token. Tokens are emitted by latent states;
a state follows the one before with fixed probabilities.

1. Documents are turned into token numbers, chunk by chunk, each chunk with the hashes of its own
   distinct tokens; chunks are stored once.
2. Baum-Welch starts from a model of a bounded sample (``SAMPLE_DOCUMENTS`` distinct training
   documents, of whose tokens the ``SAMPLE_WORDS`` most frequent ones have weights of their own).
3. A pass computes in each chunk the expected counts of (token, state), of transitions and of
   first states by scaled forward and backward recursions over all training documents. They are
   summed by Spark over all chunks; the table of token counts grows with the corpus and stays a
   table. Each chunk asks for the rows of its own tokens by a join.
4. Scoring is the scaled forward recursion over whole documents: the sum over all paths of states.

A state emits a token with probability (c + a) / (C + a * (V + 1)), where c are the token's expected
counts in the state, C all of the state's, V the distinct training tokens and a = ``SMOOTH`` over
the number of states: what is left to tokens unseen in training is the same as in the base score.
Counts of a chunk are kept to 1 / ``STEPS``, a token's share of a state to 1 / 255.

A NULL text counts as empty: its only token is the end. A NULL id is not held out. Rows of equal
id or text are scored each for itself. Without training documents every probability is 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from stayrate.llm.scratch import Scratch, without
from stayrate.llm.text import WordHashes, give_back, packed, pieces, unpacked, utf8

STATES = 8
PASSES = 2
CHUNK_BYTES = 16 << 20
SAMPLE_DOCUMENTS = 512
SAMPLE_WORDS = 50_000
SAMPLE_STEPS = 20
STICKY = 0.95
SMOOTH = 0.1
STEPS = 256
#: Token places, padding included, that one recursion works on.
CELLS = 100_000
#: Not a word: it holds a space.
END = b"end of text "
CHUNK = "chunk long, body binary, tokens binary, words array<long>"
TOKEN, STEP, FIRST = 0, 1, 2
#: A token's expected counts are kept as shares of its count, a byte per state.
SHARE_BITS, SHARES_PER_LONG = 8, 8
LENGTH = "_length"
RESULTS = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@dataclass
class Chain:
    """States' transitions and first states, the counts of states, and the training corpus' size."""

    follow: np.ndarray
    first: np.ndarray
    totals: np.ndarray
    tokens: int
    distinct: int

    def emission(self, counts: np.ndarray) -> np.ndarray:
        """Per token the probability that each state emits it, from its expected counts."""
        a = SMOOTH / len(self.first)
        return (counts + a) / (self.totals + a * (self.distinct + 1))

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))


def batches_of(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Documents by length, the longest first, in groups of about ``CELLS`` padded places."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        size = max(1, CELLS // max(1, int(lengths[order[at]])))
        yield order[at : at + size]
        at += size


def recursion(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, emitted: np.ndarray, chain: Chain, learn: bool):
    """Of documents by falling length: log10 likelihoods; with ``learn`` also (tokens, states'
    probabilities at each) and expected transitions and first states."""
    size, longest, states = len(lengths), int(lengths[0]), len(chain.first)
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    places = np.minimum(np.arange(longest)[:, None], lengths[None, :] - 1) + starts[None, :]
    words = tokens[places]
    out = emitted[words]
    scale = np.ones((longest, size))
    ahead = np.zeros((longest, size, states)) if learn else None
    now = np.empty((size, states))
    for t, k in enumerate(active.tolist()):
        now = (now[:k] @ chain.follow if t else np.broadcast_to(chain.first, (k, states))) * out[t, :k]
        total = now.sum(axis=1)
        now /= total[:, None]
        scale[t, :k] = total
        if learn:
            ahead[t, :k] = now
    likelihood = np.log10(scale).sum(axis=0)
    if not learn:
        return likelihood, None
    behind, steps = np.ones((size, states)), np.zeros((states, states))
    for t in range(longest - 1, 0, -1):
        k = active[t]
        q = out[t, :k] * behind[:k]
        q /= scale[t, :k, None]
        steps += ahead[t - 1, :k].T @ q
        ahead[t, :k] *= behind[:k]
        behind[:k] = q @ chain.follow.T
    ahead[0] *= behind
    inside = np.arange(longest)[:, None] < lengths[None, :]
    return likelihood, (words[inside], ahead[inside], steps * chain.follow, ahead[0].sum(axis=0))


def expected(tokens: np.ndarray, lengths: np.ndarray, emitted: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of (token, state), transitions and first states over all documents."""
    states = len(chain.first)
    counts, steps, first = np.zeros(emitted.shape), np.zeros((states, states)), np.zeros(states)
    starts = np.cumsum(lengths) - lengths
    for some in batches_of(lengths):
        words, chances, a, b = recursion(tokens, starts[some], lengths[some], emitted, chain, True)[1]
        for s in range(states):
            counts[:, s] += np.bincount(words, chances[:, s], len(emitted))
        steps += a
        first += b
    return counts, steps, first


def likelihoods(tokens: np.ndarray, lengths: np.ndarray, emitted: np.ndarray, chain: Chain) -> np.ndarray:
    out, starts = np.zeros(len(lengths)), np.cumsum(lengths) - lengths
    for some in batches_of(lengths):
        out[some] = recursion(tokens, starts[some], lengths[some], emitted, chain, False)[0]
    return out


def shares(counts: np.ndarray) -> np.ndarray:
    """Rows of counts as probabilities, with one more count spread over each row."""
    return (counts + 1 / counts.shape[-1]) / (counts.sum(axis=-1, keepdims=True) + 1)


def token_numbers(texts: Iterable[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, the most frequent first, token numbers of all documents end to end, lengths)."""
    end = np.array([hashes[END]], np.uint64)
    # Bytes: only A-Z are lowered, and only 0x09 to 0x0D and the space part words.
    parts = [np.append(hashes.of(body.lower().split()), end) for body in texts]
    distinct, numbers, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    return distinct[order], place[numbers], np.array([len(p) for p in parts], np.int64)


def tokenised(docs: DataFrame, text: str) -> DataFrame:
    """Chunks (chunk, body, tokens, words) of about ``CHUNK_BYTES`` of text: the other columns, and the
    tokens as numbers that point into the hashes of ``words``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, base = WordHashes(), TaskContext.get().partitionId() << 32

        def chunk(count: int, rows: pa.Table) -> pa.RecordBatch:
            words, numbers, lengths = token_numbers(utf8(rows.column(text)), hashes)
            rows = rows.drop_columns([text]).append_column(LENGTH, pa.array(lengths)).combine_chunks()
            # Byte by byte: numbers are small, so the upper bytes are nearly all zero.
            planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T).tobytes()
            words = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words.view(np.int64)))
            bodies = [pa.array([packed(rows.to_batches()[0])], pa.binary()), pa.array([zstandard.compress(planes)], pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([base + count]), *bodies, words], names=["chunk", "body", "tokens", "words"])

        waiting: list[pa.RecordBatch] = []
        count = size = 0
        for rows in pieces(batches, text, CHUNK_BYTES):
            more = rows.column(text).nbytes
            if waiting and size + more > CHUNK_BYTES:
                yield chunk(count, pa.Table.from_batches(waiting))
                waiting, size, count = [], 0, count + 1
            waiting.append(rows)
            size += more
        if waiting:
            yield chunk(count, pa.Table.from_batches(waiting))
            waiting = []
        give_back()

    return docs.mapInArrow(run, CHUNK)


def opened(body: bytes, tokens: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(rows, token numbers end to end, lengths) of a chunk."""
    rows = unpacked(body).combine_chunks()
    planes = np.frombuffer(zstandard.decompress(tokens), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return rows.drop_columns([LENGTH]), numbers, rows.column(LENGTH).to_numpy()


def training_part(body: bytes, tokens: bytes, learn: str) -> tuple[np.ndarray, np.ndarray]:
    rows, tokens, lengths = opened(body, tokens)
    taken = rows.column(learn).to_numpy(zero_copy_only=False).astype(bool)
    return tokens[np.repeat(taken, lengths)], lengths[taken]


def state_columns(states: int) -> list[str]:
    return [f"s{i}" for i in range(states)]


def count_ddl(states: int) -> str:
    return ", ".join(["kind int", "key long", "n long", *[f"{c} double" for c in state_columns(states)]])


def count_rows(words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, emitted: np.ndarray, chain: Chain) -> pa.RecordBatch | None:
    """A chunk's expected counts, as rows of ``count_ddl``."""
    if not len(lengths):
        return None
    counts, steps, first = expected(tokens, lengths, emitted, chain)
    n = np.bincount(tokens, minlength=len(words))
    met = np.flatnonzero(n)
    states = len(chain.first)
    rows = np.concatenate([np.round(counts[met] * STEPS) / STEPS, steps, first[None, :]])
    kind = np.r_[np.full(len(met), TOKEN), np.full(states, STEP), FIRST].astype(np.int32)
    key = np.r_[words[met], np.arange(states), 0].astype(np.int64)
    every = np.r_[n[met], np.zeros(states + 1, np.int64)].astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(every), *[pa.array(rows[:, s]) for s in range(states)]], names=["kind", "key", "n", *state_columns(states)])


def share_columns(states: int) -> list[str]:
    return [f"p{i}" for i in range(-(-states // SHARES_PER_LONG))]


def counts_of(n: np.ndarray, shares: list[np.ndarray], states: int) -> np.ndarray:
    """Expected counts per state, from a token's count and its packed shares."""
    top = (1 << SHARE_BITS) - 1
    out = np.empty((len(n), states))
    for s in range(states):
        out[:, s] = (shares[s // SHARES_PER_LONG] >> (SHARE_BITS * (s % SHARES_PER_LONG))) & top
    return out * (n / top)[:, None]


def summed(counts: DataFrame, states: int, scratch: Scratch, name: str) -> tuple[DataFrame, Chain]:
    """Counts over all chunks: the table (key, n, packed shares) of tokens, and the chain, of which a few
    rows come to the driver."""
    columns, top = state_columns(states), (1 << SHARE_BITS) - 1
    total = counts.groupBy("kind", "key").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns])
    share = [F.round(F.col(c) * top / F.greatest("n", F.lit(1))).cast("long") for c in columns]
    packed_ = []
    for i, p in enumerate(share_columns(states)):
        part = share[i * SHARES_PER_LONG : (i + 1) * SHARES_PER_LONG]
        packed_.append(reduce(Column.bitwiseOR, [F.shiftleft(x, SHARE_BITS * j) for j, x in enumerate(part)]).alias(p))
    rest = F.when(F.col("kind") != TOKEN, F.array(*columns)).alias("rest")
    table = scratch.store(total.select("kind", "key", "n", *packed_, rest), name)
    few = {(r["kind"], r["key"]): np.array(r["rest"]) for r in table.where(F.col("kind") != TOKEN).select("kind", "key", "rest").collect()}
    tokens = table.where(F.col("kind") == TOKEN).select("key", "n", *share_columns(states))
    kept = [F.shiftrightunsigned(F.col(f"p{s // SHARES_PER_LONG}"), SHARE_BITS * (s % SHARES_PER_LONG)).bitwiseAND(top) for s in range(states)]
    sums = tokens.agg(F.sum("n"), F.count("n"), *[F.sum(F.col("n") * k / top) for k in kept]).first()
    none = np.zeros(states)
    steps = np.array([few.get((STEP, s), none) for s in range(states)])
    return tokens, Chain(shares(steps), shares(few.get((FIRST, 0), none)), np.array([x or 0.0 for x in sums[2:]]), sums[0] or 0, sums[1])


def sample_model(docs: DataFrame, text: str, learn: str, states: int) -> tuple[np.ndarray, np.ndarray, Chain]:
    """(sorted hashes, counts, chain) fitted on a bounded sample in one task: where Baum-Welch starts."""
    texts = docs.where(F.col(learn) & F.col(text).isNotNull()).select(F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    # Copies count once; only hashes are moved to choose.
    chosen = texts.select("_hash").distinct().orderBy("_hash").limit(SAMPLE_DOCUMENTS)
    sample = texts.join(F.broadcast(chosen), "_hash").groupBy("_hash").agg(F.min("_text").alias("_text"))

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_hash")
        words, tokens, lengths = token_numbers(utf8(rows.column("_text")), WordHashes())
        random = np.random.default_rng(13)
        owner = np.repeat(random.integers(0, states, len(lengths)), lengths)
        n = np.bincount(tokens)
        known = np.flatnonzero(n > 1)
        known = np.sort(known[np.argsort(-n[known], kind="stable")][:SAMPLE_WORDS])
        at = np.full(len(words), len(known), np.int64)
        at[known] = np.arange(len(known))
        tokens = at[tokens]  # the last number stands for all other words
        counts = np.stack([np.bincount(tokens, owner == s, len(known) + 1) for s in range(states)], axis=1)
        follow = np.full((states, states), (1 - STICKY) / max(1, states - 1))
        np.fill_diagonal(follow, STICKY if states > 1 else 1.0)
        chain = Chain(follow, np.full(states, 1 / states), counts.sum(axis=0), int(n.sum()), len(words))
        for _ in range(SAMPLE_STEPS):
            emitted = chain.emission(counts)
            emitted[-1] = 1.0  # says nothing about the state
            counts, steps, first = expected(tokens, lengths, emitted, chain)
            chain = Chain(shares(steps), shares(first), counts[:-1].sum(axis=0), chain.tokens, chain.distinct)
        values = [words[known].view(np.int64).tobytes(), counts[:-1].tobytes(), chain.follow.tobytes(), chain.first.tobytes()]
        return pa.table({"part": pa.array(values, pa.binary())})

    found = sample.groupBy(F.lit("all").alias("_all")).applyInArrow(fit, "part binary").collect()
    if not found:
        flat = np.full(states, 1 / states)
        return np.zeros(0, np.int64), np.zeros((0, states)), Chain(np.tile(flat, (states, 1)), flat, np.zeros(states), 0, 0)
    words, counts, follow, first = (np.frombuffer(r["part"]) for r in found)
    words, counts = words.view(np.int64), counts.reshape(-1, states)
    order = np.argsort(words)
    return words[order], counts[order], Chain(follow.reshape(states, states), first, counts.sum(axis=0), int(counts.sum()), len(words))


def first_pass(chunks: DataFrame, start: tuple[np.ndarray, np.ndarray, Chain], learn: str) -> DataFrame:
    """Expected counts of all training documents under the sample's model, which has a fixed bound."""
    known, counts, chain = start
    emission = chain.emission(counts)
    states = len(chain.first)
    shared = chunks.sparkSession.sparkContext.broadcast((known, emission))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, emission = shared.value
        for batch in batches:
            for body, tokens, words in zip(batch.column("body").to_pylist(), batch.column("tokens").to_pylist(), batch.column("words")):
                words = words.values.to_numpy()
                emitted = np.ones((len(words), states))
                if len(known):
                    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                    hit = known[at] == words
                    emitted[hit] = emission[at[hit]]
                found = count_rows(words, *training_part(body, tokens, learn), emitted, chain)
                if found:
                    yield found
        give_back()

    return chunks.mapInArrow(run, count_ddl(states))


def answered(chunks: DataFrame, tokens: DataFrame, states: int, run: Callable, schema, with_words: bool) -> DataFrame:
    """``run(chunk, counts of its words, their states' counts)`` for every chunk."""
    columns = share_columns(states)
    asked = chunks.select(F.col("chunk").alias("by"), F.posexplode("words").alias("at", "key"))
    answers = asked.join(tokens, "key").select("by", "at", "n", *columns)

    def each(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        size = rows.column("size")[0].as_py()
        at = answers.column("at").to_numpy()
        n, packed_ = np.zeros(size, np.int64), [np.zeros(size, np.int64) for _ in columns]
        n[at] = answers.column("n").to_numpy()
        for values, name in zip(packed_, columns):
            values[at] = answers.column(name).to_numpy()
        return run(rows, n, counts_of(n, packed_, states))

    sides = chunks.select("chunk", "body", "tokens", F.size("words").alias("size"), *["words"] * with_words)
    return sides.groupBy("chunk").cogroup(answers.groupBy("by")).applyInArrow(each, schema)


def chunk_part(rows: pa.Table) -> tuple[bytes, bytes]:
    return rows.column("body")[0].as_py(), rows.column("tokens")[0].as_py()


def next_pass(chunks: DataFrame, tokens: DataFrame, chain: Chain, learn: str) -> DataFrame:
    states = len(chain.first)
    names = ["kind", "key", "n", *state_columns(states)]
    empty = pa.schema([pa.field(c, pa.int32() if c == "kind" else pa.int64() if c in ("key", "n") else pa.float64()) for c in names])

    def run(rows: pa.Table, n: np.ndarray, counts: np.ndarray) -> pa.Table:
        words = rows.column("words").combine_chunks().values.to_numpy()
        found = count_rows(words, *training_part(*chunk_part(rows), learn), chain.emission(counts), chain)
        return pa.Table.from_batches([found] if found else [], empty if not found else None)

    return answered(chunks, tokens, states, run, count_ddl(states), True)


def score(chunks: DataFrame, tokens: DataFrame, chain: Chain, learn: str, fields: list[StructField]) -> DataFrame:
    """The rows in the chunks with ``RESULTS``."""
    schema = StructType([
        *fields, StructField("held_out", BooleanType()), *[StructField(c, LongType()) for c in RESULTS[1:4]], *[StructField(c, DoubleType()) for c in RESULTS[4:]],
    ])

    def run(rows: pa.Table, n: np.ndarray, counts: np.ndarray) -> pa.Table:
        rows, numbers, lengths = opened(*chunk_part(rows))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        base = np.bincount(owner, chain.base(n)[numbers], len(lengths))
        known = np.bincount(owner, n[numbers] > 0, len(lengths)).astype(np.int64)
        learned = rows.column(learn).to_numpy(zero_copy_only=False).astype(bool)
        values = [~learned, lengths, known, np.full(len(lengths), chain.tokens, np.int64), base, likelihoods(numbers, lengths, chain.emission(counts), chain)]
        rows = rows.drop_columns([learn])
        for name, value in zip(RESULTS, values):
            rows = rows.append_column(name, pa.array(value))
        return rows

    return answered(chunks, tokens, len(chain.first), run, schema, False)


def scored(
    docs: DataFrame, learn: str, text: str = "text", states: int = STATES, passes: int = PASSES,
) -> DataFrame:
    """``docs`` without the text, with ``held_out`` (not ``learn``), ``n_tokens``, ``n_known`` (seen in
    training), ``train_tokens``, ``base_score`` (unigram) and ``score`` (log10 of the probability).

    ``learn`` is a SQL condition on rows; the model learns from those for which it is true.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    if passes < 1:
        raise ValueError("at least one pass over the training documents is needed")
    names = [c for c in without(docs, *RESULTS).columns if c != text]
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(*columns, F.col(text).cast("string").alias("_text"), F.coalesce(F.expr(learn), F.lit(False)).alias("_learn"))
    chunks = scratch.store(tokenised(rows, "_text"), "hmm-chunks")
    tokens, chain = summed(first_pass(chunks, sample_model(rows, "_text", "_learn", states), "_learn"), states, scratch, "hmm-counts-1")
    for i in range(2, passes + 1):
        scratch.release()
        tokens, chain = summed(next_pass(chunks, tokens, chain, "_learn"), states, scratch, f"hmm-counts-{i}")
        scratch.drop(f"hmm-counts-{i - 1}")
    scratch.release()
    found = score(chunks, tokens, chain, "_learn", [f for f in rows.schema.fields if f.name not in ("_text", "_learn")])
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *RESULTS)
