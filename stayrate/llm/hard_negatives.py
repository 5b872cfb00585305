"""Hard-negative mining over an inverted multi-index, exact.

Vectors are whole numbers, so scores (inner products) are exact. An *anchor* is searched twice:
first for its positives, the best rows of its label; then, for each positive, for the best rows of
other labels whose score lies in a window below the positive's.

1. Vectors are cut in two halves, and each half has a codebook, fitted on a bounded sample
   (``SAMPLE_ROWS``). The two nearest codes of a row name its cell. The number of codes grows with
   the square root of the rows, so that cells hold about ``CELL_ROWS``; a codebook of the largest
   table is a few MB. Every row is indexed; a cell is stored in blocks of ``CELL_ROWS`` rows or so,
   each a row of arrays, so no cell is too large for a task.
2. A half's score is at most that of its code plus the length of the anchor's half times the code's
   radius, the largest distance of a row's half to its code. A heap goes through the cells of an
   anchor by falling sum of both bounds (multi-sequence); cells that hold too high scores only, by
   the sum of the lower bounds, are passed over.
3. A round visits the next cells of each anchor, ``FIRST_CELLS`` in the first one and
   ``MORE`` times as many in each later one; anchors travel to the cells, grouped by cell, and only
   the best rows come back. An anchor is done once no cell that is left can hold a row better than,
   or equal to, the last of those it wants: its window is certified. No row that belongs in the result is lost.

Of rows equal in label and vector only the first ones by id can be chosen by any anchor; no more of
them are indexed, so a vector that a third of all rows hold fills no cell. All of them may be anchors.

Rows take no part that have a NULL id, label or vector, a NULL or non-finite component, or a squared
length of 2**55 or more, where scores times 100 need more than 64 bits. Shorter vectors count as
padded by zeros. Rows of equal id stay rows of their own; each is an anchor if its id is one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayrate.llm.scratch import Scratch
from stayrate.llm.text import packed, unpacked

CELL_ROWS = 1024
SAMPLE_ROWS = 16_384
LLOYD_STEPS = 8
#: Anchors that travel together.
TOGETHER = 1024
FIRST_CELLS, MORE = 8, 8
#: Blocks and anchors that meet in one Arrow batch: either is a few hundred KB.
MEETINGS = 8
LEAST_SCORE = -(2**62)
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
FOUND = "anchor long, slot int, row long, id long, score long"


@contextmanager
def few_per_batch(spark: SparkSession) -> Iterator[None]:
    """While it lasts, rows that hold whole blocks go to Python a few at a time."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(MEETINGS))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def prepared(rows: DataFrame, id_column: str, vector: str, label: str, scale: float) -> DataFrame:
    """(row, id, label, vec): the rows that take part, their components floor(scale * x) as integers."""
    x = F.col("_x")
    whole = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("_x"))
    whole = whole.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
    whole = whole.where(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    floors = whole.withColumn("_x", F.transform(x, lambda v: F.floor(F.when(F.abs(v) < 1e12, v).otherwise(1e12) * scale).cast("double")))
    fits = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v * v) < 2.0**55
    return floors.where(fits).select(F.monotonically_increasing_id().alias("row"), "id", "label", x.cast("array<int>").alias("vec"))


def codebook(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` centres by Lloyd's steps, from distinct points in a fixed random order."""
    centres = np.unique(points, axis=0)
    centres = centres[np.random.default_rng(11).permutation(len(centres))[:count]].copy()
    for _ in range(LLOYD_STEPS):
        own = nearest(points, centres)[0]
        n = np.bincount(own, minlength=len(centres))
        for j in range(points.shape[1]):
            sums = np.bincount(own, points[:, j], len(centres))
            centres[n > 0, j] = sums[n > 0] / n[n > 0]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Of each point the nearest centre, and the distance to it."""
    own, away = np.empty(len(points), np.int64), np.empty(len(points))
    lengths = (centres * centres).sum(axis=1)
    for i in range(0, len(points), step):
        part = points[i : i + step]
        own[i : i + step] = (lengths - 2 * part @ centres.T).argmin(axis=1)
        away[i : i + step] = np.sqrt(((part - centres[own[i : i + step]]) ** 2).sum(axis=1))
    return own, away


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``size`` doubles, padded by zeros."""
    out = np.zeros((len(column), size))
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    inside = np.arange(size)[None, :] < offsets[:, None]
    out[inside] = flat
    return out


@dataclass
class Codes:
    """Codebooks of the two halves of a vector, and how far a row's half lies from its code at most."""

    books: list[np.ndarray]
    radii: list[np.ndarray]
    size: int

    def halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = (self.size + 1) // 2
        return points[:, :cut], points[:, cut:]

    def cells(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray, done: np.ndarray, more: int) -> Iterator[tuple[int, np.ndarray]]:
        """(anchor, cells): the next cells of each anchor, by falling upper bound. Of its sequence,
        the first ``done`` were passed before; at most ``more`` follow, as long as the upper bound
        reaches ``least``. Those whose lower bound is above ``most`` are left out."""
        upper, lower = [], []
        for part, book, radius in zip(self.halves(anchors), self.books, self.radii):
            scores, reach = part @ book.T, np.sqrt((part * part).sum(axis=1))[:, None] * radius[None, :]
            upper.append(scores + reach)
            lower.append(scores - reach)
        # Rounding must never leave out a row.
        slack = 1 + 1e-9 * sum(np.abs(x).max(axis=1, initial=0) for x in upper + lower)
        width = len(self.books[1])
        for i in range(len(anchors)):
            orders = [np.argsort(-u[i], kind="stable") for u in upper]
            x, y = (u[i][o].tolist() for u, o in zip(upper, orders))
            heap, passed, taken = [(-(x[0] + y[0]), 0, 0)] if x and y else [], 0, []
            while heap and passed < done[i] + more:
                bound, p, q = heapq.heappop(heap)
                if -bound + slack[i] < least[i]:
                    break
                # Each cell is reached once: along its row, whose start comes down the first column.
                if q + 1 < len(y):
                    heapq.heappush(heap, (-(x[p] + y[q + 1]), p, q + 1))
                if q == 0 and p + 1 < len(x):
                    heapq.heappush(heap, (-(x[p + 1] + y[0]), p + 1, 0))
                passed += 1
                if passed > done[i]:
                    a, b = orders[0][p], orders[1][q]
                    if lower[0][i, a] + lower[1][i, b] - slack[i] <= most[i]:
                        taken.append(a * width + b)
            if passed > done[i]:
                yield i, np.array(taken, np.int64)


def fitted(rows: DataFrame) -> Codes:
    """Codebooks from a bounded sample of the rows; radii are still unknown."""
    total, longest = rows.agg(F.count("row"), F.max(F.size("vec"))).first()
    sample = rows.select("id", "row", "vec").orderBy(F.xxhash64("id", "row")).limit(SAMPLE_ROWS).select("vec").toArrow()
    codes = Codes([], [], longest or 0)
    count = max(1, round((total / CELL_ROWS) ** 0.5))
    codes.books = [codebook(p, count) for p in codes.halves(matrix(sample.column("vec"), codes.size))]
    return codes


def coded(rows: DataFrame, codes: Codes) -> DataFrame:
    """``rows`` with their cell, and per half the code and the distance to it."""
    books, size = codes.books, codes.size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, away_a), (b, away_b) = (nearest(p, c) for p, c in zip(Codes([], [], size).halves(matrix(batch.column("vec"), size)), books))
            more = [a * len(books[1]) + b, a, b, away_a, away_b]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more)], names=[*batch.schema.names, "cell", "first", "second", "away_first", "away_second"])

    return rows.mapInArrow(run, "row long, id long, label long, vec array<int>, cell long, first long, second long, away_first double, away_second double")


def pack(rows: pa.Table) -> pa.Table:
    body = rows.select(["row", "id", "label", "vec"]).sort_by([("id", "ascending"), ("row", "ascending")])
    return pa.table({"cell": rows.column("cell")[:1], "rows": pa.array([packed(body.combine_chunks().to_batches()[0])], pa.binary())})


def indexed(rows: DataFrame, scratch: Scratch, copies: int) -> tuple[Codes, DataFrame]:
    """Codes, and the blocks (cell, rows) of all rows; of equal rows the first ``copies`` by id."""
    first = Window.partitionBy("label", "vec").orderBy("id", "row")
    few = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= copies).drop("_n")
    rows = scratch.store(few, "index-rows")
    codes = fitted(rows)
    placed = scratch.store(coded(rows, codes), "index-coded")
    for half, book in zip(("first", "second"), codes.books):
        radius = np.zeros(len(book))
        for r in placed.groupBy(half).agg(F.max(f"away_{half}").alias("far")).collect():
            radius[r[half]] = r["far"]
        codes.radii.append(radius * (1 + 1e-9) + 1e-6)
    cells = placed.groupBy("cell").agg(F.ceil(F.count("row") / F.lit(CELL_ROWS)).alias("_blocks"))
    dealt = placed.join(cells, "cell").select("cell", F.pmod(F.xxhash64("row"), "_blocks").alias("block"), "row", "id", "label", "vec")
    blocks = scratch.store(dealt.groupBy("cell", "block").applyInArrow(pack, "cell long, rows binary"), "index-blocks")
    scratch.drop("index-rows", "index-coded")
    return codes, blocks


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point as far as whole numbers are exact there."""
    most = np.sqrt((anchors * anchors).sum(axis=1).max(initial=0) * (rows * rows).sum(axis=1).max(initial=0))
    if most < 2**23:
        return anchors.astype(np.float32) @ rows.astype(np.float32).T
    if most < 2**52:
        return anchors @ rows.T
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def best_rows(anchors: pa.Table, block: pa.Table, size: int, same: bool, count: int) -> dict[str, np.ndarray] | None:
    """Of a block, the best rows for each window of each anchor. ``low`` and ``high`` list an anchor's
    windows; ``same`` asks for its label, else for other ones."""
    score = scores_of(matrix(anchors.column("vec"), size), matrix(block.column("vec"), size))
    low, high = (np.array(anchors.column(c).to_pylist(), np.int64) for c in ("low", "high"))
    labels, rows = block.column("label").to_numpy(), block.column("row").to_numpy()
    wanted = (anchors.column("label").to_numpy()[:, None] == labels[None, :]) == same
    wanted &= (score >= low.min(axis=1)[:, None]) & (score <= high.max(axis=1)[:, None])
    wanted &= anchors.column("row").to_numpy()[:, None] != rows[None, :]
    who, what = np.nonzero(wanted)
    got = score[who, what].astype(np.int64)
    # Rows of a block stand by id: a stable order leaves ties so.
    order = np.lexsort((what, -got, who))
    who, what, got = who[order], what[order], got[order]
    found = []
    for slot in range(low.shape[1]):
        at = np.flatnonzero((got >= low[who, slot]) & (got <= high[who, slot]))
        mine = who[at]
        at = at[np.arange(len(at)) - np.searchsorted(mine, mine) < count]
        found.append((who[at], np.full(len(at), slot, np.int32), what[at], got[at]))
    who, slot, what, got = (np.concatenate(x) for x in zip(*found))
    if not len(who):
        return None
    return {"anchor": anchors.column("row").to_numpy()[who], "slot": slot, "row": rows[what], "id": block.column("id").to_numpy()[what], "score": got}


def search(codes: Codes, blocks: DataFrame, anchors: DataFrame, scratch: Scratch, name: str, same: bool, count: int) -> DataFrame:
    """The best ``count`` rows of each window: (anchor, slot, row, id, score, rank). ``anchors`` has (row, label,
    vec, low, high), the latter two as arrays of the windows' inclusive bounds."""
    spark, size = anchors.sparkSession, codes.size
    shared = spark.sparkContext.broadcast(codes)
    found = spark.createDataFrame([], FOUND + ", rank int")
    state = anchors.withColumns({"least": F.col("low"), "done": F.lit(0).cast("long")})
    start, more = 0, FIRST_CELLS
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")

    def plan(more: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for i in range(0, batch.num_rows, TOGETHER):
                    part = pa.Table.from_batches([batch.slice(i, TOGETHER)])
                    low, high, least = (np.array(part.column(c).to_pylist(), np.int64) for c in ("low", "high", "least"))
                    # A window below its own lower bound is empty; the others need what reaches their last row.
                    open_ = low <= high
                    needed = np.where(open_, np.maximum(low, least), 2**62).min(axis=1)
                    most = np.where(open_, high, LEAST_SCORE).max(axis=1)
                    visits: dict[int, list[int]] = {}
                    going = open_.any(axis=1)
                    for j, cells in own.cells(matrix(part.column("vec"), own.size), np.where(going, needed, 2.0**63), most, part.column("done").to_numpy(), more):
                        visits.setdefault(-1, []).append(j)
                        for c in cells.tolist():
                            visits.setdefault(c, []).append(j)
                    if visits:
                        # Full windows are narrowed to what may still come in.
                        for column, values in (("low", np.where(open_, np.maximum(low, least), -LEAST_SCORE)), ("high", np.where(open_, high, LEAST_SCORE))):
                            part = part.set_column(part.schema.get_field_index(column), column, pa.array(values.tolist(), pa.list_(pa.int64())))
                        part = part.select(["row", "label", "vec", "low", "high"])
                        bodies = [packed(part.take(pa.array(who)).combine_chunks().to_batches()[0]) if c >= 0 else None for c, who in visits.items()]
                        going_on = [part.column("row").take(pa.array(who)).to_pylist() if c < 0 else None for c, who in visits.items()]
                        yield pa.RecordBatch.from_arrays([pa.array(list(visits), pa.int64()), pa.array(bodies, pa.binary()), pa.array(going_on, pa.list_(pa.int64()))], names=["cell", "anchors", "open"])

        return run

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("anchors").to_pylist(), batch.column("rows").to_pylist()):
                got = best_rows(unpacked(a), unpacked(b), size, same, count)
                if got:
                    yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in got.items()})

    turn = 0
    while True:
        # Names of this turn's and the last turn's tables: a table goes once the next one is written.
        names = [f"{name}-{x}-{turn}" for x in ("visits", "found", "state")]
        visits = scratch.store(state.mapInArrow(plan(more), "cell long, anchors binary, open array<long>"), names[0])
        going_on = visits.where("cell = -1").select(F.explode("open").alias("_open"))
        if going_on.isEmpty():
            scratch.drop(names[0])
            return found
        with few_per_batch(spark):
            met = visits.where("cell >= 0").select("cell", "anchors").join(blocks, "cell").select("anchors", "rows").mapInArrow(meet, FOUND)
            ranked = found.drop("rank").unionByName(met).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
            found = scratch.store(ranked, names[1])
        # The last row of a full window bounds what may still come in.
        last = found.where(F.col("rank") == count).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("_last"))
        kept = state.join(going_on, state["row"] == F.col("_open"), "left_semi").drop("least", "done")
        kept = kept.join(last, kept["row"] == last["anchor"], "left").drop("anchor")
        least = F.transform("low", lambda v, i: F.coalesce(F.try_element_at("_last", i.cast("int")), v))
        start += more
        next_state = kept.withColumns({"least": least, "done": F.lit(start).cast("long")}).drop("_last")
        next_state = scratch.store(next_state.select(*anchors.columns, "least", "done"), names[2])
        if turn:
            scratch.drop(f"{name}-visits-{turn - 1}", f"{name}-found-{turn - 1}", f"{name}-state-{turn - 1}")
        state, turn, more = next_state, turn + 1, more * MORE


def mine(
    rows: DataFrame, anchors: str, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor (a row whose ``id`` meets the SQL condition) and each of its best ``positives`` rows
    of the same label: the best ``negatives`` rows of other labels with ``low * positive score <= 100
    * score <= high * positive score``. Ties go to the smaller id.
    """
    scratch = Scratch(rows.sparkSession)
    rows = scratch.store(prepared(rows, id_column, vector, label, scale), "vectors")
    codes, blocks = indexed(rows, scratch, max(positives + 1, negatives))
    chosen = scratch.store(rows.where(anchors), "anchors")
    every = chosen.withColumns({"low": F.array(F.lit(LEAST_SCORE)), "high": F.array(F.lit(-LEAST_SCORE))}).drop("id")
    first = search(codes, blocks, every, scratch, "positives", True, positives)
    # Where the bounds of a window are no whole numbers, the scores within them are.
    bound = {"low": F.expr(f"-((-{low} * score - pmod(-{low} * score, 100)) div 100)"), "high": F.expr(f"({high} * score - pmod({high} * score, 100)) div 100")}
    slots = first.withColumns(bound).groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("_slots"))
    missing = F.expr(f"named_struct('rank', 0, 'low', {-LEAST_SCORE}L, 'high', {LEAST_SCORE}L)")
    slot = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.try_element_at("_slots", i), missing))
    wanted = chosen.drop("id").join(slots, chosen["row"] == slots["anchor"]).withColumn("_slots", slot)
    wanted = wanted.select("row", "label", "vec", F.col("_slots.low").alias("low"), F.col("_slots.high").alias("high"))
    second = search(codes, blocks, wanted, scratch, "negatives", False, negatives)
    positive = first.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    negative = second.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positive.join(negative, ["anchor", "slot"]).join(chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
