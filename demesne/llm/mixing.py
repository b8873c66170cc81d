"""Mixing sources to target weights by Pfair scheduling (operator 3), in DataFrame functions only.

The documents of a source, in a hashed order, fill blocks of `block_chars` characters; a document
belongs to the block in which it starts. Sources flow at their weights; when one is used up, the
weights of the rest are scaled to one, so by the virtual time v a source with weight w and b blocks
has b or w v of them, and the slots passed are the sum of these over all sources. Block k of a source
is released at the slot in which its flow reaches k and due when it reaches k + 1; weights are taken
as they are. In each slot the released block with the earliest deadline goes next (ties: the source
that comes first by name). That keeps every source less than one block from its share at every slot,
whatever the number of sources; nothing is dropped or repeated.

The slots are dealt one after the other, in one task, from a row of numbers for each source, and
meet the documents as arrays of numbers: one number for `block_chars` characters.
Running sums inside a source are taken per hash bucket and then over buckets, so a source with a
third of all rows is spread like any other.

Defined results: a null source is a source of its own, named ''; sources without a target weight
share the least weight given (or 1); null and empty texts count as one character; equal keys order
by a hash of the text; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demesne.session import cut

#: Characters in a block, blocks dealt at a time, and slots of a source in a row.
BLOCK_CHARS, FRAME, STRETCH = 20_000, 200, 256
#: Rows of STRETCH numbers that are sent to every task at most (4 MB).
SENT_STRETCHES = 2_000
#: What sums of weights may be off by, in slots; and the deadline of a source without blocks.
SLACK, NEVER = 1e-6, 1 << 62
#: Leading hex digits of the hashed order that make a bucket inside a source.
BUCKET_DIGITS = 3
#: A power that flattens the shares of sources when no weights are given.
TEMPERATURE = 0.5


def edf_order(counts: Column) -> Column:
    """The indices of the sources in slot order, from the array of their block counts in a frame."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)

    def key(k, c, i, t):
        m = total
        due = F.floor(((k + 1) * m + c - 1) / c)
        free = (k < c) & (F.floor(k * m / c) <= t)
        return F.when(free, due * F.lit(1 << 20) + i).otherwise(F.lit(1 << 62))

    def step(state, t):
        keys = F.transform(counts, lambda c, i: key(F.element_at(state["done"], i + 1), c, i, t))
        pick = F.array_min(keys).bitwiseAND(F.lit((1 << 20) - 1))
        return F.struct(
            F.transform(state["done"], lambda x, i: F.when(i == pick, x + 1).otherwise(x)).alias("done"),
            F.concat(state["order"], F.array(pick)).alias("order"),
        )

    start = F.struct(F.transform(counts, lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast("array<bigint>").alias("order"))
    slots = F.when(total > 0, F.sequence(F.lit(0).cast("long"), total - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(slots, start, step)["order"]


def _sized(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The columns to carry of each row as _row, so no name can clash, with its source, size, hashed order and bucket."""
    h = F.md5(F.coalesce(docs["doc_id"].cast("string"), F.lit("")))
    size = F.greatest(F.coalesce(F.length(docs["text"]), F.lit(0)), F.lit(1)).cast("long")
    row = F.struct(*[docs[c] for c in (docs.columns if carry is None else carry)])
    return docs.select(
        row.alias("_row"), F.coalesce(docs["source"], F.lit("")).alias("_s"), size.alias("_n"), h.alias("_h"), F.substring(h, 1, BUCKET_DIGITS).alias("_b"),
        docs["doc_id"].alias("_id"), F.xxhash64(docs["text"]).alias("_t"),
    )


def blocks(docs: DataFrame, block_chars: int = BLOCK_CHARS, carry: list[str] | None = None) -> DataFrame:
    """Each document with its source name, block number in the source and first character there: _row, _s, _block, _at."""
    rows = _sized(docs, carry)
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "_id", "_t").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_s", "_b").agg(F.sum("_n").alias("_n"))
    sums = sums.select("_s", "_b", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(sums, ["_s", "_b"])
    at = F.col("_before") + F.col("_in")
    return placed.select("_row", "_s", "_id", F.floor(at / block_chars).alias("_block"), at.alias("_at"))


def block_counts(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of each source: _s, _blocks (from its characters, so no document need be placed first)."""
    return _sized(docs).groupBy("_s").agg(F.ceil(F.sum("_n") / block_chars).alias("_blocks"))


def _weighted(counts: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Sources with their blocks and weights: _s, _blocks, _w."""
    if weights is None:
        return counts.select("_s", "_blocks", F.pow("_blocks", F.lit(TEMPERATURE)).alias("_w"))
    given = weights.select(F.coalesce("source", F.lit("")).alias("_s"), F.col("weight").cast("double").alias("_w")).where("_w > 0")
    given = given.groupBy("_s").agg(F.max("_w").alias("_w"))
    return counts.join(given, "_s", "left").select("_s", "_blocks", F.coalesce("_w", F.min("_w").over(Window.partitionBy()), F.lit(1.0)).alias("_w"))


def dealt(sources: Column, at_a_time: int = FRAME) -> Column:
    """The slots in order, as arrays of at most at_a_time structs (i, k): block k of the i-th of sources (_s, _blocks, _w), from 0."""
    zero = F.lit(0).cast("long")
    total = F.aggregate(sources, zero, lambda a, x: a + x["_blocks"])
    passed = lambda v: F.aggregate(sources, F.lit(0.0), lambda a, x: a + F.least(x["_blocks"].cast("double"), x["_w"] * v))

    def block(i, k, x, begin):
        """Block k of a source x; the flow reaches it at the slot `begin`."""
        some = k < x["_blocks"]
        return F.transform(
            F.array(F.when(some, passed((k + 1) / x["_w"])).otherwise(0.0)),
            lambda end: F.struct(
                F.when(some, F.ceil(end - SLACK)).otherwise(F.lit(NEVER)).alias("due"), i.cast("long").alias("i"), k.cast("long").alias("k"),
                F.when(some, F.floor(begin + SLACK)).otherwise(F.lit(NEVER)).alias("free"), end.alias("end"),
            ),
        )[0]

    def step(state, t):
        # An array of one binds the pick, so that it is found once a slot.
        pick = F.array(F.array_min(F.filter(state["next"], lambda x: x["free"] <= t)))
        after = lambda p: F.array(block(p["i"], p["k"] + 1, F.element_at(sources, (p["i"] + 1).cast("int")), p["end"]))
        put = lambda p: F.transform(after(p), lambda new: F.transform(state["next"], lambda x: F.when(x["i"] == p["i"], new).otherwise(x)))[0]
        return F.transform(pick, lambda p: F.struct(put(p).alias("next"), F.concat(state["order"], F.array(F.struct(p["i"], p["k"]))).alias("order")))[0]

    def lot(state, f):
        none = F.array().cast("array<struct<i:bigint,k:bigint>>")
        slots = F.sequence(f * at_a_time, F.least((f + 1) * at_a_time, total) - 1)
        done = F.array(F.aggregate(slots, F.struct(state["next"].alias("next"), none.alias("order")), step))
        return F.transform(done, lambda d: F.struct(d["next"].alias("next"), F.concat(state["lots"], F.array(d["order"])).alias("lots")))[0]

    none = F.array().cast("array<array<struct<i:bigint,k:bigint>>>")
    start = F.struct(F.transform(sources, lambda x, i: block(i, zero, x, F.lit(0.0))).alias("next"), none.alias("lots"))
    lots = F.sequence(zero, F.floor((total - 1) / at_a_time))
    return F.when(total > 0, F.aggregate(lots, start, lot)["lots"]).otherwise(none)


def slots(counts: DataFrame, weights: DataFrame | None = None, at_a_time: int = FRAME) -> DataFrame:
    """The slot of each block, STRETCH blocks of a source in a row: _s, _stretch, _slots."""
    packed = _weighted(counts, weights).agg(F.sort_array(F.collect_list(F.struct("_s", "_blocks", F.col("_w").cast("double").alias("_w")))).alias("_all"))
    lots = packed.select(F.col("_all._s").alias("_names"), F.posexplode(dealt(F.col("_all"), at_a_time)).alias("_lot", "_order"))
    each = lots.select("_names", "_lot", F.posexplode("_order").alias("_at", "_x"))
    k, slot = F.col("_x.k"), F.col("_lot").cast("long") * at_a_time + F.col("_at")
    each = each.select(F.element_at("_names", (F.col("_x.i") + 1).cast("int")).alias("_s"), F.floor(k / STRETCH).alias("_stretch"), F.struct(k.alias("k"), slot.alias("slot")).alias("_x"))
    return each.groupBy("_s", "_stretch").agg(F.sort_array(F.collect_list("_x")).alias("_x")).select("_s", "_stretch", F.col("_x.slot").alias("_slots"))


def _placed(docs: DataFrame, weights: DataFrame | None, block_chars: int, frame: int, carry: list[str]) -> DataFrame:
    """The columns to carry of each row as _row, with the global slot of its block and its place inside it."""
    plan = cut(slots(block_counts(docs, block_chars), weights, frame))
    placed = blocks(docs, block_chars, carry).withColumn("_stretch", F.floor(F.col("_block") / STRETCH))
    # While the numbers, one for each block, are few, they are sent to every task, and texts are not dealt again; else both sides
    # meet by stretch, of which a source with a third of all rows has many.
    few = plan.limit(SENT_STRETCHES + 1).count() <= SENT_STRETCHES
    placed = placed.join(F.broadcast(plan) if few else plan.hint("shuffle_merge"), ["_s", "_stretch"])
    slot = F.element_at("_slots", (F.col("_block") % STRETCH + 1).cast("int"))
    return placed.select("_row", "_id", slot.alias("slot"), (F.col("_at") % block_chars).alias("place"))


def schedule(docs: DataFrame, weights: DataFrame | None = None, block_chars: int = BLOCK_CHARS, frame: int = FRAME, columns: list[str] | None = None) -> DataFrame:
    """Each document with the global slot of its block and its place inside it: the columns asked for (all), slot, place."""
    carry = [c for c in columns or docs.columns if c.lower() not in ("slot", "place")]
    return _placed(docs, weights, block_chars, frame, carry).select("_row.*", "slot", "place")


def mix_in_order(docs: DataFrame, weights: DataFrame | None = None, block_chars: int = BLOCK_CHARS, frame: int = FRAME) -> DataFrame:
    """The columns of docs, with the rows dealt out and sorted in the order of the schedule."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["slot", "place", "_id"]
    placed = _placed(docs, weights, block_chars, frame, docs.columns)
    return placed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("_row.*")
