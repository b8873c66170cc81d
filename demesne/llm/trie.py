"""Prefix trie of conversations, with subtree totals by parallel tree contraction (operator 12).

1. Turns are range-partitioned by conversation and turn and numbered where they stand: a conversation
   that runs over several partitions takes up the count of those before, of which one row a partition
   is known. So a conversation with a third of all turns is dealt over tasks.
2. A conversation may be rebuilt: a head of few turns taken from another one, then its own.
   Its prefixes get 128-bit names from two running polynomials over hashes of the turns, carried over partitions alike.
3. A node is a distinct name: its members, smallest member and last text's size are one aggregate.
4. Subtree totals: a round rakes all leaves into their parents and compresses chains by splicing out every
   node that has a single child and stands lower than both its neighbours by the trailing zeros of its depth.
   Half of a chain goes in each round, so rounds grow with the logarithm of the depth, and a round is two aggregates
   by whole-number keys in one job. What was spliced out keeps what it adds to the node it points to; these pointers
   are doubled until they end at raked nodes, whose totals are known, and so every node has its total.
5. The members that end at a node are written in order as pieces of text within range partitions, and the
   digest runs over the pieces, so nothing holds all of them.

Defined results: rows with a null conversation key belong to none and are left out; null role or text is empty; a null
turn comes first, equal turns follow in order of role, then of the MD5 of the text; repeated rows are turns
of their own; other columns are not read; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import mix
from demesne.session import cut, dealt

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_WRAP = (1 << 64) - 1
#: Characters of a piece of a list of keys.
PIECE = 1 << 20


def _in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Range-partitioned and sorted, each row with its partition; written, as later passes rely on these partitions."""
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))


def _runs(c: np.ndarray, key: int | None) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key: the row at which the run of each row begins, and which rows carry on the run of `key`."""
    first = np.concatenate([[True], c[1:] != c[:-1]])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(c)), 0))
    return begin, (begin == 0) & (key is not None and c[0] == key)


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2^64."""
    out, square, left = np.ones(len(exponents), np.uint64), base, exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(square), out)
        square, left = square * square & _WRAP, left >> np.uint64(1)
    return out


def _walk(batch: pa.RecordBatch, state: tuple) -> tuple[np.ndarray, list, list, tuple]:
    """Places in their conversation, running polynomials and the terms added of a batch of rows (part, c, a, b, ...), and the state after it."""
    key, rows, sums = state
    c = batch.column(1).to_numpy()
    begin, carried = _runs(c, key)
    place = np.arange(len(c)) - begin + np.where(carried, rows, 0)
    running, terms = [], []
    for k, base in enumerate(BASES):
        term = batch.column(2 + k).to_numpy().view(np.uint64) * _powers(base, place)
        total = np.cumsum(term, dtype=np.uint64)
        running.append(total - (total[begin] - term[begin]) + np.where(carried, np.uint64(sums[k]), np.uint64(0)))
        terms.append(term)
    return place, running, terms, (int(c[-1]), int(place[-1]) + 1, [int(r[-1]) for r in running])


_NONE = (None, 0, [0, 0])


def _carried(rows: DataFrame) -> dict[int, tuple]:
    """For each partition of rows (part, c, a, b): the state of the conversation that it may carry on, and the first key of the next one.

    One row a partition comes to the driver.
    """

    def last(batches):
        part = first = None
        state = _NONE
        for batch in batches:
            if batch.num_rows:
                if part is None:
                    part, first = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
                state = _walk(batch, state)[3]
        if part is not None:
            cols = [part, first, state[0], state[1], *(s - (1 << 64) if s >> 63 else s for s in state[2])]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in cols], ["part", "first", "last", "rows", "a", "b"])

    found = sorted(rows.select("part", "c", "a", "b").mapInArrow(last, "part bigint, first bigint, last bigint, rows bigint, a bigint, b bigint").collect())
    out, before = {}, _NONE
    for i, s in enumerate(found):
        given = before if before[0] == s.first else _NONE
        out[s.part] = (given, found[i + 1].first if i + 1 < len(found) else None)
        rows_, sums = s.rows, [s.a & _WRAP, s.b & _WRAP]
        if s.first == s.last:  # one conversation throughout: it goes on from what was carried
            rows_ += given[1]
            sums = [(t + v * pow(base, given[1], 1 << 64)) & _WRAP for t, v, base in zip(given[2], sums, BASES, strict=True)]
        before = (s.last, rows_, sums)
    return out


def numbered(turns: DataFrame) -> DataFrame:
    """c, p (place from 1), a, b (hashes of the turn), size (code points of its text), from conv_id, turn, role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.xxhash64(role, text).alias("a"), F.xxhash64(text, role).alias("b"), F.char_length(text).cast("long").alias("size"),
        "turn", role.alias("role"), F.unhex(F.md5(text)).alias("tie"),
    )
    rows = _in_order(slim, F.col("c"), F.asc_nulls_first("turn"), F.col("role"), F.col("tie")).select("part", "c", "a", "b", "size")
    carried = _carried(rows)

    def place(batches):
        state = None
        for batch in batches:
            if batch.num_rows:
                state = state or carried[batch.column(0)[0].as_py()][0]
                at, _, _, state = _walk(batch, state)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(at + 1, pa.int64()), *batch.columns[2:]], ["c", "p", "a", "b", "size"])

    return rows.mapInArrow(place, "c bigint, p bigint, a bigint, b bigint, size bigint")


def rebuilt(own: DataFrame, of: Column, head: Column, most: int) -> DataFrame:
    """The turns of every conversation after its first `head` replaced those by as many of conversation `of`; rows (c, step, p, a, b, size) in order of step, p.

    `of` and `head` are expressions of c, and `head` is at most `most`. Every conversation has a row of step 0, its root.
    """
    own = cut(own.withColumn("of", of))
    every = own.select("c", "of").distinct()
    heads = every.select("of").distinct().join(own.where(F.col("p") <= most).select(F.col("c").alias("of"), "p", "a", "b", "size"), "of")
    zero = F.lit(0).cast("long")
    roots = every.select("c", F.lit(0).alias("step"), zero.alias("p"), zero.alias("a"), zero.alias("b"), zero.alias("size"))
    given = every.join(heads, "of").where(F.col("p") <= head).select("c", F.lit(1).alias("step"), "p", "a", "b", "size")
    return roots.union(given).union(own.where(F.col("p") > head).select("c", F.lit(2).alias("step"), "p", "a", "b", "size"))


def _names(sums: list[np.ndarray], depth: np.ndarray) -> pa.Array:
    flat = np.stack([mix(s + depth.astype(np.uint64)) for s in sums], 1).tobytes()
    return pa.Array.from_buffers(pa.binary(16), len(depth), [None, pa.py_buffer(flat)]).cast(pa.binary())


def prefixes(turns: DataFrame) -> DataFrame:
    """c, depth, name, parent (name), size, ends (the conversation has no more turns), from rows of `rebuilt`."""
    rows = _in_order(turns, F.col("c"), F.col("step"), F.col("p")).select("part", "c", "a", "b", "size")
    carried = _carried(rows)

    def name(batches):
        state, held, part = None, None, None

        def out(batch, after):
            place, running, terms, new = _walk(batch, state)
            c = batch.column(1).to_numpy()
            ends = np.append(c[1:] != c[:-1], after is None or after != c[-1])
            parent = _names([r - t for r, t in zip(running, terms, strict=True)], place - 1)
            parent = pc.if_else(pa.array(place > 0), parent, pa.scalar(None, pa.binary()))
            cols = [batch.column(1), pa.array(place, pa.int64()), _names(running, place), parent, batch.column(4), pa.array(ends)]
            return pa.RecordBatch.from_arrays(cols, ["c", "depth", "name", "parent", "size", "ends"]), new

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                part = batch.column(0)[0].as_py()
                state = carried[part][0]
            else:
                result, state = out(held, batch.column(1)[0].as_py())
                yield result
            held = batch
        if held is not None:
            yield out(held, carried[part][1])[0]

    return rows.mapInArrow(name, "c bigint, depth bigint, name binary, parent binary, size bigint, ends boolean")


def _height(depth: str) -> Column:
    """Order of nodes along a chain: trailing zeros of the depth, then the depth; the root (0) is highest."""
    d = F.col(depth)
    return F.bit_count(d.bitwiseAND(-d) - 1) * F.lit(1 << 48) + d


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """name and, for each of `values`, its sum over the subtree; from name, parent (null: root), depth, n_children and the values.

    Names may be of any type; long ones are the cheapest. Nodes and what they tell others meet in aggregates by name, two a round and
    one job, so the driver plans few jobs and holds no side of a join.
    """
    zero, name = F.lit(0).cast("long"), tree.schema["name"].dataType
    none, nil = F.lit(None).cast("long"), F.lit(None).cast(name)
    alive = cut(tree.select("name", "parent", "depth", (F.col("depth") - 1).alias("above"), F.col("n_children").alias("m"), *values, *(zero.alias(f"{v}_edge") for v in values)))
    raked, spliced = [], []
    while not alive.isEmpty():
        leaf = F.col("m") == 0
        raked.append(alive.where(leaf).select("name", *values))
        own = [F.when(~leaf, F.col("name")).alias("name"), F.col("parent"), F.col("depth"), F.col("above"), zero.alias("left"), nil.alias("only"), none.alias("below")]
        own += [c for v in values for c in (F.col(v), F.col(f"{v}_edge"), zero.alias(f"{v}_down"))]
        told = [F.col("parent").alias("name"), nil.alias("parent"), none.alias("depth"), none.alias("above"), F.when(leaf, 0).otherwise(1).cast("long").alias("left")]
        told += [F.when(~leaf, F.col("name")).alias("only"), F.when(~leaf, F.col("depth")).alias("below")]
        for v in values:
            told += [F.when(leaf, F.col(v) + F.col(f"{v}_edge")).otherwise(zero).alias(v), zero.alias(f"{v}_edge"), F.when(leaf, zero).otherwise(F.col(f"{v}_edge")).alias(f"{v}_down")]
        rest = _told(alive, own, told).groupBy("name").agg(
            *(F.max(c).alias(c) for c in ("parent", "depth", "above", "only", "below")), F.sum("left").alias("left"),
            *(F.sum(f"{v}{k}").alias(f"{v}{k}") for v in values for k in ("", "_edge", "_down")),
        )
        goes = (F.col("left") == 1) & F.col("parent").isNotNull() & (_height("depth") < _height("above")) & (_height("depth") < _height("below"))
        rest = rest.withColumn("goes", F.coalesce(goes, F.lit(False)))
        # What goes keeps the node it points to. Its child hangs below its parent from now on, and carries its values along.
        own = [F.col("name"), F.col("parent"), F.col("depth"), F.col("above"), F.col("left").alias("m"), F.when(F.col("goes"), F.col("only")).alias("to"), nil.alias("new_parent"), none.alias("new_above")]
        own += [c for v in values for c in ((F.col(v) + F.when(F.col("goes"), F.col(f"{v}_down")).otherwise(zero)).alias(v), F.col(f"{v}_edge"))]
        told = [F.when(F.col("goes"), F.col("only")).alias("name"), nil.alias("parent"), none.alias("depth"), none.alias("above"), zero.alias("m"), nil.alias("to"), F.col("parent").alias("new_parent"), F.col("above").alias("new_above")]
        told += [c for v in values for c in (zero.alias(v), (F.col(v) + F.col(f"{v}_edge")).alias(f"{v}_edge"))]
        after = _told(rest, own, told).groupBy("name").agg(
            F.coalesce(F.max("new_parent"), F.max("parent")).alias("parent"), F.max("depth").alias("depth"), F.coalesce(F.max("new_above"), F.max("above")).alias("above"),
            F.sum("m").alias("m"), F.max("to").alias("to"), *(F.sum(f"{v}{k}").alias(f"{v}{k}") for v in values for k in ("", "_edge")),
        )
        after = cut(after)
        spliced.append(after.where("to is not null").select("name", "to", *values))
        alive = after.where("to is null").drop("to")
    if not raked:
        return tree.select("name", *values)
    known, links = _all(raked), _all(spliced)
    # What was spliced out points to a node that goes in a later round, so no way is longer than there are rounds.
    for _ in range((len(spliced) - 1).bit_length()):
        links = cut(links)
        far = links.select(F.col("name").alias("to"), F.col("to").alias("next"), *(F.col(v).alias(f"{v}_next") for v in values))
        links = links.join(dealt(far), "to", "left").select("name", F.coalesce("next", "to").alias("to"), *((F.col(v) + F.coalesce(f"{v}_next", zero)).alias(v) for v in values))
    ends = known.select(F.col("name").alias("to"), *(F.col(v).alias(f"{v}_end") for v in values))
    return known.union(links.join(dealt(ends), "to").select("name", *((F.col(v) + F.col(f"{v}_end")).alias(v) for v in values)))


def _told(rows: DataFrame, own: list[Column], told: list[Column]) -> DataFrame:
    """Each row as it goes on itself and as what it tells another; either is left out where its name is null."""
    return rows.select(F.inline(F.array(F.struct(*own), F.struct(*told)))).where("name is not null")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def list_digests(rows: DataFrame) -> DataFrame:
    """name and the SHA-256 of the decimal keys c of its rows, ascending and joined by commas."""
    ordered = rows.select("name", "c").repartitionByRange("name", "c").sortWithinPartitions("name", "c").withColumn("part", F.spark_partition_id())

    def write(batches):
        name, part, held, size, k = None, 0, [], 0, 0
        one = lambda: pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([",".join(held)])], ["name", "part", "k", "keys"])
        for batch in batches:
            names, parts, ks, texts = [], [], [], []
            for n, c, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if held and (n != name or size > PIECE):
                    names.append(name)
                    parts.append(part)
                    ks.append(k)
                    texts.append(",".join(held))
                    held, size, k = [], 0, k + 1
                text = str(c)
                name, part, size = n, p, size + len(text) + 1
                held.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(parts, pa.int32()), pa.array(ks, pa.int64()), pa.array(texts, pa.string())], ["name", "part", "k", "keys"])
        if held:
            yield one()

    def digest(batches):
        name, run = None, None
        for batch in batches:
            names, shas = [], []
            for n, keys in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if run is not None and n == name:
                    run.update(b"," + keys.encode())
                    continue
                if run is not None:
                    names.append(name)
                    shas.append(run.hexdigest())
                name, run = n, hashlib.sha256(keys.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(shas, pa.string())], ["name", "sha"])
        if run is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([run.hexdigest()])], ["name", "sha"])

    pieces = ordered.mapInArrow(write, "name binary, part int, k bigint, keys string")
    return pieces.repartition("name").sortWithinPartitions("name", "part", "k").mapInArrow(digest, "name binary, sha string")


def conversation_trie(turns: DataFrame, of: Column | None = None, head: Column | None = None, most: int = 0) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Conversations are rebuilt if `of`, `head` (expressions of c) and `most` are given, see `rebuilt`.
    """
    own = numbered(turns)
    rows = cut(prefixes(rebuilt(own, of if of is not None else F.col("c"), head if head is not None else F.lit(0), most)))
    nodes = rows.groupBy("name").agg(F.min("c").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n_convs"))
    nodes = cut(nodes.withColumn("id", F.monotonically_increasing_id()))
    top = nodes.where("depth = 0").select("id", "conv_id").first()  # the root, one row
    above = nodes.where("depth > 0").select(F.col("name").alias("parent"), F.col("id").alias("up"), F.col("conv_id").alias("over"))
    first = F.col("depth") == 1
    nodes = nodes.join(above, "parent", "left").select(
        "id", "name", "conv_id", "depth", "size", "n_convs", F.when(first, F.lit(top.id if top else None).cast("long")).otherwise(F.col("up")).alias("up"),
        F.when(first, F.lit(top.conv_id if top else None).cast("long")).otherwise(F.col("over")).alias("parent_conv_id"),
    )
    nodes = cut(nodes)
    kids = nodes.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(dealt(kids), "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    valued = nodes.select(F.col("id").alias("name"), F.col("up").alias("parent"), "depth", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    totals = subtree_totals(valued, ["n_leaves", "saved_tokens"]).withColumnRenamed("name", "id")
    out = nodes.join(dealt(totals), "id").join(dealt(list_digests(rows.where("ends"))), "name", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))
