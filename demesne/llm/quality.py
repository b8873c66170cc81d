"""Quality scores by histogram gradient-boosted trees over document statistics (operator 1).

Statistics of whole texts are computed once for all documents in bounded pieces, with array
arithmetic over bytes, words and lines. Trees are grown level by level on binned statistics of a
bounded sample of the labelled rows (`train_rows`, the least by a hash of the key), from histograms
of gradients; all trees are flattened into arrays of features, cuts and leaves, and a batch of
documents walks them level by level with array look-ups.

Defined results: null is the empty text, and an empty text has a score like any other; of several
labels of a document the mean decides (0.5 and more: 1), null labels are left out; with no usable
label of one of the two kinds every score is the smoothed share of the other; repeated keys are
scored row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import lower, per_piece, raw, shingles, span_hashes, words
from demesne.session import cut

#: Most labelled rows that trees are grown on.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, L2, LEAST = 80, 4, 48, 0.15, 1.0, 8.0

_LINES = np.zeros(256, bool)
_LINES[10] = True
# Classes of bytes: lower, upper, digit, space, line end, sentence mark, other ASCII mark, table bar, control, beyond ASCII.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[:32], _CLASS[127] = 8, 8
_CLASS[33:127] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[[46, 44, 63, 59, 58, 39, 34]], _CLASS[124] = 3, 4, 5, 7
CLASSES = 10
FEATURES = CLASSES + 17


def statistics(col: pa.Array) -> np.ndarray:
    """A row of FEATURES statistics for each text."""
    data, offsets = raw(col)
    n = len(col)
    size = np.diff(offsets)
    out = np.zeros((n, FEATURES), np.float32)
    row = np.repeat(np.arange(n, dtype=np.int32), size)
    kind = _CLASS[data]
    by_class = np.bincount(row * np.int32(CLASSES) + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    some = np.maximum(size, 1)
    out[:, :CLASSES] = by_class / some[:, None]
    starts, ends, first = words(data, offsets)
    hashes = span_hashes(lower(data), starts, ends)
    count = np.diff(first)
    many = np.maximum(count, 1)
    length = (ends - starts).astype(np.float64)
    at = np.repeat(np.arange(n), count)
    sums = lambda w: np.bincount(at, w, n)
    mean = sums(length) / many
    kinds = np.zeros(len(kind) + 1, np.int64)
    marks = kinds.copy()
    np.cumsum((kind == 6) | (kind == 7), out=marks[1:])
    np.cumsum(kind == 1, out=kinds[1:])
    marked = (marks[ends] - marks[starts]) > 0
    shouted = (kinds[ends] - kinds[starts]) > 1
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])
    l_starts, l_ends, l_first = words(data, offsets, _LINES)
    lines = span_hashes(data, l_starts, l_ends)
    l_count = np.diff(l_first)
    more = [
        np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(sums(length**2) / many - mean**2, 0)), sums(marked) / many, sums(shouted) / many,
        sums(same) / many, np.log1p(l_count), np.log1p(count / np.maximum(l_count, 1)), sums(length > 14) / many, sums(length < 3) / many,
    ]
    for k, x in enumerate(more):
        out[:, CLASSES + k] = x
    at = CLASSES + len(more)
    triples = shingles(hashes, first, 3)
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b > a:
            _, c = np.unique(hashes[a:b], return_counts=True)
            p = c / (b - a)
            out[i, at] = len(c) / (b - a)
            out[i, at + 1] = c.max() / (b - a)
            out[i, at + 2] = -(p * np.log(p)).sum() / max(np.log(b - a), 1e-9) if b - a > 1 else 1
            out[i, at + 3] = len(triples[i]) / max(b - a - 2, 1)
            _, c = np.unique(lines[l_first[i] : l_first[i + 1]], return_counts=True)
            out[i, at + 4] = len(c) / max(l_count[i], 1)
            out[i, at + 5] = np.log1p(c.max()) if len(c) else 0
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats binary of float32) of every document."""

    def run(part, col):
        rows = statistics(col)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(per_piece(run), "doc_id bigint, stats binary")


class Trees:
    """Boosted trees of one depth in flat arrays: node k of a level has children 2k and 2k + 1."""

    def __init__(self, bias: float, features: np.ndarray, cuts: np.ndarray, leaves: np.ndarray):
        self.bias, self.features, self.cuts, self.leaves = bias, features, cuts, leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                k = (1 << level) - 1 + node
                node = 2 * node + (x[rows, f[k]] > c[k])
            out += leaf[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Grow trees for label 1 on a bounded sample: rows of statistics and their labels."""
    n, m = x.shape
    p = (y.sum() + 1) / (n + 2)
    bias = float(np.log(p / (1 - p)))
    empty = np.zeros((0, (1 << DEPTH) - 1))
    if n == 0 or y.min() == y.max():
        return Trees(bias, empty.astype(np.int64), empty, np.zeros((0, 1 << DEPTH)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    bins = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    margin = np.full(n, bias)
    features = np.zeros((TREES, (1 << DEPTH) - 1), np.int64)
    cuts = np.full(features.shape, np.inf)
    leaves = np.zeros((TREES, 1 << DEPTH))
    for t in range(TREES):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, q * (1 - q)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            wide = 1 << level
            best = np.full(wide, 1e-6)
            for j in range(m):
                if not len(edges[j]):
                    continue
                cell = node * BINS + bins[:, j]
                sg = np.bincount(cell, g, wide * BINS).reshape(wide, BINS).cumsum(1)
                sh = np.bincount(cell, h, wide * BINS).reshape(wide, BINS).cumsum(1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + L2) + (tg - sg) ** 2 / (th - sh + L2) - tg**2 / (th + L2)
                gain[(sh < LEAST / 4) | (th - sh < LEAST / 4)] = 0
                gain[:, len(edges[j]) :] = 0
                pick = gain.argmax(1)
                won = gain[np.arange(wide), pick]
                better = np.flatnonzero(won > best)
                at = wide - 1 + better
                best[better], features[t, at], cuts[t, at] = won[better], j, edges[j][pick[better]]
            k = wide - 1 + node
            node = 2 * node + (x[np.arange(n), features[t, k]] > cuts[t, k])
        leaves[t] = -RATE * np.bincount(node, g, 1 << DEPTH) / (np.bincount(node, h, 1 << DEPTH) + L2)
        margin += leaves[t][node]
    return Trees(bias, features, cuts, leaves)


def training_rows(rows: DataFrame, labels: DataFrame, label: str, held_out: Column, limit: int) -> DataFrame:
    """The labelled rows outside the held-out ones, with label y: the `limit` least by a hash of the key."""
    key = F.col("doc_id").cast("long")
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(key.alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    return rows.join(marked.where(~held_out), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column, cut_at: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of held-out rows are not learnt."""
    stats = cut(document_statistics(docs))
    held = F.coalesce(held_out, F.lit(False))
    got = training_rows(stats, labels, "quality", held, train_rows).select("stats", "y").toPandas()
    x = np.frombuffer(b"".join(bytes(s) for s in got.stats), np.float32).reshape(len(got), FEATURES)
    trees = fit(x, got.y.to_numpy(np.float64))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(s.as_py() for s in batch.column(1)), np.float32).reshape(-1, FEATURES)
                s = trees.score(x)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= cut_at).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = stats.mapInArrow(run, "doc_id bigint, score double, predicted int")
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
