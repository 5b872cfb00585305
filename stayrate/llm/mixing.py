"""Mixing sources to target weights, with DataFrame functions only.

Sizes are words. Sources, ordered by code point with NULL last, weigh 3, 1, 2, repeating; they share
150% of all words, no source more than twice its own; what a source cannot take is shared by the
others by weight. A document is taken once more for every full pass over its source, and once more
if it belongs to the part that the last pass still needs.

* **Blocks.** A hash of id and text deals a source's documents into at most 4096 blocks. The last pass
  takes blocks in a permuted order as long as they fit whole. The block in which the target is
  reached is cut into at most 4096 parts in the same way, and the documents of the part in which it
  is reached are taken one after another if they fit. So a source misses its target by less than
  one document, and no task sees more than 4096 blocks or parts of a source, or the documents
  of one part (a 16-millionth of the source).
* **Splitting tree.** The quotas (blocks per source) are split between two halves of the output
  shards, again and again: going through a node's blocks, each goes left with the chance that the
  places left on that side have among all places left. That draws the counts of the left half from
  the multivariate hypergeometric distribution, exactly, and leaf sizes differ by one block at most.
* **Shards.** A shard takes the next blocks of each source's permuted order, as many as its quota says,
  so shards are disjoint; rows of a shard are ordered by a hash.

A NULL text has no words; documents without words are drawn with their blocks. Rows that agree in
id and text are drawn together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.scratch import Scratch, without

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BITS = 12
SHARDS = 64
SLOTS = 64
RESULTS = ("size", "source_size", "target", "shard", "order_key")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def dealt(docs: DataFrame, id_column: str, text: str, source: str, seed: int) -> dict[str, Column]:
    """The columns that decide a row's lot: source key, hash, block and part."""
    lot = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text))
    return {
        "_key": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
        "_lot": lot,
        "_block": F.shiftrightunsigned(lot, 64 - BITS).cast("int"),
        "_part": F.shiftrightunsigned(F.shiftleft(lot, BITS), 64 - BITS).cast("int"),
    }


def source_targets(rows: DataFrame) -> DataFrame:
    """(_key, s, source_size, target): one row per source.

    Shares rise with a common level: a source's target is level * weight, or its limit where that
    is lower. Going through the sources by limit per weight, the level that the rest would have
    without those before tells where limits end to hold.
    """
    sizes = rows.groupBy("_key").agg(F.sum("size").alias("source_size"))
    # NULL has the empty key, which is to come last.
    place = F.row_number().over(Window.orderBy(F.col("_key") == "", "_key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("s") % len(WEIGHTS) + 1).cast("int"))
    whole = Window.partitionBy(F.lit(0))
    rising = whole.orderBy("per", "s")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    weighed = (
        sizes.withColumn("s", place).withColumn("w", weight)
        .withColumn("most", F.lit(MOST) * F.col("source_size")).withColumn("per", F.col("most") / F.col("w"))
    )
    budget = F.lit(SHARE) * F.sum("source_size").over(whole)
    levels = weighed.withColumn(
        "level",
        (budget - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
    ).withColumn("free", F.col("level") < F.col("per"))
    common = F.min(F.when(F.col("free"), F.struct("per", "s", "level"))).over(whole)
    target = F.when(F.col("free"), F.least("most", common["level"] * F.col("w"))).otherwise(F.col("most"))
    return levels.select("_key", "s", "source_size", target.alias("target"))


def full_passes() -> Column:
    """NULL for a source without words."""
    return F.floor(F.try_divide(F.col("target"), F.col("source_size")))


def last_pass(rows: DataFrame, targets: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """What the pass that is not full takes: whole blocks (_key, _block), and of one more block per
    source (_key, _block) some parts and documents (``parts``, ``lots``)."""

    def reached(cells: DataFrame, cell: str, salt: int) -> DataFrame:
        order = Window.partitionBy("_key").orderBy(F.xxhash64(F.lit(seed + salt), "_key", cell), cell)
        total = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        return cells.withColumn("total", total).withColumn("left", F.col("rest") - (F.col("total") - F.col("size")))

    def edge(cells: DataFrame, cell: str) -> DataFrame:
        """The cell in which what is left runs out, with what is left before it. Cells without words
        that come after it have its total, too, but less left."""
        over = cells.where("total > rest").groupBy("_key")
        first = F.min(F.struct("total", (-F.col("left")).alias("low"), cell))
        return over.agg(first.alias("e")).select("_key", f"e.{cell}", (-F.col("e.low")).alias("rest"))

    rest = targets.select("_key", (F.col("target") - full_passes() * F.col("source_size")).alias("rest"))
    rest = rest.where("rest > 0")
    blocks = reached(rows.groupBy("_key", "_block").agg(F.sum("size").alias("size")).join(rest, "_key"), "_block", 1)
    block_edge = edge(blocks, "_block")
    inside = rows.join(block_edge, ["_key", "_block"])
    parts = reached(inside.groupBy("_key", "_block", "_part").agg(F.sum("size").alias("size"), F.first("rest").alias("rest")), "_part", 2)
    part_edge = edge(parts, "_part")
    last = inside.drop("rest").join(part_edge, ["_key", "_part"])
    # Equal rows share a lot and are taken together.
    units = last.groupBy("_key", "_block", "_lot").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    listed = units.groupBy("_key", "_block").agg(
        F.first("rest").alias("rest"), F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed + 3), "_lot").alias("o"), "_lot", "size"))).alias("units")
    )
    fits = F.aggregate(
        "units",
        F.struct(F.col("rest").cast("double").alias("left"), F.array().cast("array<bigint>").alias("lots")),
        lambda a, u: F.when(
            u["size"] <= a["left"],
            F.struct((a["left"] - u["size"]).alias("left"), F.concat(a["lots"], F.array(u["_lot"])).alias("lots")),
        ).otherwise(a),
    )["lots"]
    greedy = listed.select("_key", "_block", fits.alias("lots"))
    whole_parts = parts.where("total <= rest").groupBy("_key", "_block").agg(F.collect_list("_part").alias("parts"))
    cut = block_edge.select("_key", "_block").join(whole_parts, ["_key", "_block"], "left").join(greedy, ["_key", "_block"], "left")
    return blocks.where("total <= rest").select("_key", "_block"), cut


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, s, n) from (s, n): the tree of exact splits, each node one row with its quotas."""
    zero = F.lit(0).cast("long")
    node = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col("s").cast("long").alias("s"), F.col("n").cast("long").alias("n")))).alias("q"))
    node = node.select(F.lit(0).cast("long").alias("node"), "q")
    for level in range(max(1, shards).bit_length() - 1):
        total = F.aggregate("q", zero, lambda a, x: a + x["n"])
        # An odd block goes to either side.
        node = node.withColumn("total", total).withColumn(
            "half", F.expr("total div 2") + F.when(F.col("total") % 2 == 1, F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("node")), F.lit(2))).otherwise(zero)
        )

        def draw(acc: Column, x: Column) -> Column:
            def one(places: Column, i: Column) -> Column:
                chance = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("node"), x["s"], i), places["all"])
                left = F.when(chance < places["left"], places["left"] - 1).otherwise(places["left"])
                return F.struct(left.alias("left"), (places["all"] - 1).alias("all"))

            steps = F.when(x["n"] > 0, F.sequence(F.lit(1).cast("long"), x["n"])).otherwise(F.array().cast("array<bigint>"))
            places = F.aggregate(steps, F.struct(acc["left"].alias("left"), acc["all"].alias("all")), one)
            return F.struct(
                places["left"].alias("left"), places["all"].alias("all"), F.concat(acc["out"], F.array(acc["left"] - places["left"])).alias("out")
            )

        start = F.struct(F.col("half").alias("left"), F.col("total").alias("all"), F.array().cast("array<bigint>").alias("out"))
        node = node.withColumn("drawn", F.aggregate("q", start, draw)["out"])
        sides = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.zip_with("q", "drawn", lambda x, d: F.struct(x["s"].alias("s"), d.alias("n"))).alias("q")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("q", "drawn", lambda x, d: F.struct(x["s"].alias("s"), (x["n"] - d).alias("n"))).alias("q")),
        )
        node = node.select(F.inline(sides))
    return node.select(F.col("node").alias("shard"), F.inline("q")).where("n > 0")


def block_shards(rows: DataFrame, targets: DataFrame, whole: DataFrame, cut: DataFrame, shards: int, seed: int, scratch: Scratch) -> DataFrame:
    """(_key, _block, shards, cut_shard, parts, lots): the shards that take a block whole, once per
    pass, and the one that takes some of its documents."""
    blocks = rows.select("_key", "_block").distinct().join(targets, "_key")
    passes = blocks.withColumn("full", full_passes().cast("int"))
    full = passes.where("full > 0").select("_key", "_block", "s", F.explode(F.sequence(F.lit(1), F.col("full"))).alias("round"), F.lit(False).alias("is_cut"))
    named = targets.select("_key", "s")
    part = whole.join(named, "_key").select("_key", "_block", "s", F.lit(9).alias("round"), F.lit(False).alias("is_cut"))
    edge = cut.join(named, "_key").select("_key", "_block", "s", F.lit(9).alias("round"), F.lit(True).alias("is_cut"))
    order = Window.partitionBy("s").orderBy("round", F.xxhash64(F.lit(seed + 1), "_key", "_block"), "_block")
    draws = scratch.store(full.unionAll(part).unionAll(edge).withColumn("t", F.row_number().over(order)), "draws")
    quotas = split_quotas(draws.groupBy("s").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    ends = quotas.withColumn("last", F.sum("n").over(Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)))
    places = ends.select("s", "shard", F.explode(F.sequence(F.col("last") - F.col("n") + 1, F.col("last"))).alias("t"))
    taken = draws.join(places, ["s", "t"]).groupBy("_key", "_block").agg(
        F.sort_array(F.collect_list(F.when(~F.col("is_cut"), F.col("shard")))).alias("shards"),
        F.max(F.when(F.col("is_cut"), F.col("shard"))).alias("cut_shard"),
    )
    return taken.join(cut, ["_key", "_block"], "left")


def plan(docs: DataFrame, id_column: str, text: str, source: str, shards: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(narrow rows, targets, blocks with their shards), all stored."""
    scratch = Scratch(docs.sparkSession)
    lots = dealt(docs, id_column, text, source, seed)
    narrow = docs.select(F.col(id_column).alias("_id"), word_count(F.col(text)).alias("size"), *[c.alias(n) for n, c in lots.items()])
    rows = scratch.store(narrow, "rows")
    targets = scratch.store(source_targets(rows), "targets")
    whole, cut = last_pass(rows, targets, seed)
    whole, cut = scratch.store(whole, "whole"), scratch.store(cut, "cut")
    blocks = scratch.store(block_shards(rows, targets, whole, cut, shards, seed, scratch), "blocks")
    scratch.drop("whole", "cut", "draws")
    return rows, targets, blocks


def copies() -> Column:
    """Of a row joined with its block: the shards that take it."""
    inside = F.coalesce(F.array_contains("parts", F.col("_part")), F.lit(False)) | F.coalesce(F.array_contains("lots", F.col("_lot")), F.lit(False))
    extra = F.when(F.col("cut_shard").isNotNull() & inside, F.array("cut_shard")).otherwise(F.array().cast("array<bigint>"))
    return F.concat(F.coalesce("shards", F.array().cast("array<bigint>")), extra)


def takings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """(id, size, source_size, target, taken, shards) per row of ``docs``: the words the mix takes of
    it, and the shards that it goes to."""
    rows, targets, blocks = plan(docs, id_column, text, source, shards, seed)
    # Blocks are joined with the sources first: they spread a hot source over the cluster.
    sized = rows.select("_key", "_block").distinct().join(targets, "_key").join(blocks, ["_key", "_block"], "left")
    found = rows.join(sized, ["_key", "_block"]).withColumn("_shards", copies())
    return found.select(
        F.col("_id").alias(id_column), "size", "source_size", "target",
        (F.col("size") * F.size("_shards")).cast("long").alias("taken"), F.col("_shards").alias("shards"),
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """The mixed rows: ``docs`` with every row as often as it is taken, and ``shard`` and ``order_key``.

    Rows of a shard lie together, in up to ``SLOTS`` partitions, ordered by ``order_key``.
    """
    docs = without(docs, *RESULTS)
    _, _, blocks = plan(docs, id_column, text, source, shards, seed)
    lots = dealt(docs, id_column, text, source, seed)
    # The document's own columns stay in one, so that no name of theirs meets one of the plan.
    joined = docs.select(F.struct(*docs.columns).alias("_row"), *[c.alias(n) for n, c in lots.items()]).join(blocks, ["_key", "_block"])
    drawn = joined.select("_row", "_lot", F.posexplode(copies()).alias("_nth", "shard"))
    drawn = drawn.withColumn("order_key", F.xxhash64(F.lit(seed + 4), "_lot", "_nth"))
    drawn = drawn.withColumn("slot", F.pmod("order_key", F.lit(SLOTS)))
    return drawn.repartition("shard", "slot").sortWithinPartitions("shard", "slot", "order_key").select("_row.*", "shard", "order_key")
