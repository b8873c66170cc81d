"""Shared parts: reading texts in bounded pieces, word and shingle hashes, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.session import cut

#: Bytes of text handled at once inside a task; a longer document is a piece of its own.
PIECE_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

_WS = np.zeros(256, bool)
_WS[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column as large strings without nulls (null: empty)."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    return pc.fill_null(col, "") if col.null_count else col


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large-string array and the offsets of its rows, starting at 0."""
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset)
    data = col.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of consecutive rows of about `limit` bytes of text, each with its texts."""
    if not batch.num_rows:
        return
    col = texts(batch, column)
    _, offsets = raw(col)
    at = 0
    while at < len(col):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at), col.slice(at, end - at)
        at = end


def per_piece(fn: Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch | None], column: str = "text"):
    """A mapInArrow function from one on pieces."""

    def run(batches):
        for batch in batches:
            for part, col in pieces(batch, column):
                if (out := fn(part, col)) is not None and out.num_rows:
                    yield out

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (_BASE, inverse))
    return _powers


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside `space`, cut at row ends, and the first word of each row (and the end)."""
    if not len(data):
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~space[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes wherever they stand."""
    n = len(data)
    power, inverse = _power(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its n-word shingles; the whole sequence where a row has fewer words."""
    m = len(hashes)
    whole = np.zeros(m, np.uint64)
    if m >= n:
        for k in range(n):
            whole[: m - n + 1] += hashes[k : m - n + 1 + k] * np.uint64(2 * k + 0x632BE59BD9B4E019)
            whole[: m - n + 1] ^= whole[: m - n + 1] >> np.uint64(29)
        whole = mix(whole)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(whole[a : b - n + 1]))
        elif b > a:
            seed = np.array([b - a], np.uint64)
            for k in range(a, b):
                seed = mix(seed * _BASE ^ hashes[k : k + 1])
            out.append(seed)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array a row."""
    sizes = np.fromiter((len(a) for a in arrays), np.int64, len(arrays))
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, kind))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of an undirected graph given as rows (a, b): root is the least node reachable.

    Each round hooks every neighbour of a node to the least one near it, by turns from the larger
    and the smaller side, so rounds grow with the logarithm of the longest path. Every round is an
    aggregate and a join, is written to the shared folder, and no component is ever gathered.
    """
    links = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    while True:
        both = links.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(links.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("r"))
        up = both.join(least, "n").where("m > n").select(F.col("m").alias("hi"), F.col("r").alias("lo"))
        up = up.union(least.where("r < n").select(F.col("n").alias("hi"), F.col("r").alias("lo"))).distinct()
        low = up.groupBy("hi").agg(F.min("lo").alias("r"))
        down = up.join(low, "hi").where("lo > r").select(F.col("lo").alias("hi"), F.col("r").alias("lo"))
        after = cut(down.union(low.select("hi", F.col("r").alias("lo"))).distinct())
        if not _changed(links, after):
            return after.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        links = after


def _changed(before: DataFrame, after: DataFrame) -> bool:
    """Whether two sets of links differ, by their number and an order-free sum of their hashes."""
    tell = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")]
    return before.agg(*tell).first() != after.agg(*tell).first()


def dense_counts(df: DataFrame, count: Callable[[pa.RecordBatch, pa.Array, np.ndarray], None], size: int, column: str = "text") -> np.ndarray:
    """The sum over all rows of what `count(part, texts, totals)` adds to an array of `size` counters.

    Every task adds into one array of its own and sends only that; the arrays are summed by some
    tasks and then by one, always one array at a time. `size` is fixed, whatever the input.
    """

    def tally(batches):
        totals = np.zeros(size, np.int64)
        for batch in batches:
            for part, col in pieces(batch, column):
                count(part, col, totals)
        yield _one(totals)

    def add(batches):
        totals = np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column(0):
                totals += np.frombuffer(data.as_buffer(), np.int64)
        yield _one(totals)

    def _one(totals):
        return pa.RecordBatch.from_arrays([pa.array([totals.tobytes()], pa.binary())], ["counts"])

    parts = df.mapInArrow(tally, "counts binary").repartition(24).mapInArrow(add, "counts binary")
    return np.frombuffer(bytes(parts.repartition(1).mapInArrow(add, "counts binary").first().counts), np.int64)
