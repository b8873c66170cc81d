"""Toxicity scores by a factorization machine over hashed terms (operator 10).

The terms of a text are its words in lower case and their leading 3 to 7 bytes, so invented or
inflected forms share a term with their stem; each is hashed to one of 2^18 terms. The machine is
fitted on a bounded sample of the labelled rows (`train_rows`, the least by a hash of the key): the
terms that tell its toxic documents from the others best (by the G statistic) become the inputs, and
adaptive gradient steps fit a weight for each term present and, through `RANK` latent factors, a weight
for each pair of terms present together, such as an insult with the name of a group, which
additive weights cannot express. Only the sample of labels is sent to tasks; texts are never shuffled.

Defined results: null is the empty text, which has no terms and gets the machine's constant; of
several labels of a document the mean decides (0.5 and more: 1), null labels are left out; with no
usable label of one of the two kinds every score is the smoothed share; repeated keys are scored
row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import dense_counts, lower, per_piece, raw, span_hashes, words

#: Most labelled rows that the machine is fitted on, hashed terms, terms kept, latent factors.
TRAIN_ROWS, TERMS, KEPT, RANK = 20_000, 1 << 18, 2048, 6
STEMS = (3, 4, 5, 6, 7)
EPOCHS, LOT, RATE, L2 = 6, 128, 0.08, 2e-4

# Word characters: letters and digits of ASCII and everything beyond it.
_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all texts, distinct in each, and the offsets of the texts."""
    data, offsets = raw(col)
    data = lower(data)
    starts, ends, first = words(data, offsets, _BREAK)
    row = np.repeat(np.arange(len(col), dtype=np.int64), np.diff(first))
    shift = np.uint64(64 - TERMS.bit_length() + 1)
    keys = [(row << 20) | (span_hashes(data, starts, ends) >> shift).astype(np.int64)]
    for k, n in enumerate(STEMS):
        long_ = np.flatnonzero(ends - starts > n)
        stem = span_hashes(data, starts[long_], starts[long_] + n) + np.uint64((k + 1) * 0x2545F4914F6CDD1D % 2**64)
        keys.append((row[long_] << 20) | (stem >> shift).astype(np.int64))
    own = np.sort(np.concatenate(keys))
    own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own
    return own & (TERMS - 1), np.searchsorted(own >> 20, np.arange(len(col) + 1))


class Machine:
    """A factorization machine over the kept terms; place[t] is the input of term t, or -1."""

    def __init__(self, place: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.place, self.bias, self.weights, self.factors = place, bias, weights, factors

    def inputs(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Inputs present in each text and the offsets of the texts."""
        found, offsets = terms(col)
        at = self.place[found]
        kept = np.flatnonzero(at >= 0)
        return at[kept], np.searchsorted(kept, offsets)

    def margin(self, inputs: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        n = len(offsets) - 1
        out = self.bias + np.bincount(row, self.weights[inputs], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[inputs, f]
            out += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return out

    def score(self, col: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*self.inputs(col)), -40, 40)))


def telling(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of each hashed term among the KEPT that tell the two kinds apart best, or -1.

    counts: documents of each kind that have the term, n: documents of each kind.
    """
    have = counts.astype(np.float64)
    total = have.sum(0)
    expected = total * (n / max(n.sum(), 1))[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(have > 0, have * np.log(have / expected), 0).sum(0)
        lack = n[:, None] - have
        g += np.where(lack > 0, lack * np.log(lack / np.maximum(n[:, None] - expected, 1e-9)), 0).sum(0)
    g[total < 5] = 0
    best = np.argsort(-g, kind="stable")[:KEPT]
    best = np.sort(best[g[best] > 8])
    place = np.full(TERMS, -1, np.int32)
    place[best] = np.arange(len(best))
    return place


def fit(place: np.ndarray, rows: list[np.ndarray], y: np.ndarray) -> Machine:
    """Fit on a bounded sample: the inputs present in each row and its label."""
    n, m = len(rows), int(place.max()) + 1 if len(place) else 0
    p = (y.sum() + 1) / (n + 2)
    bias = float(np.log(p / (1 - p)))
    rng = np.random.default_rng(3)
    w, v = np.zeros(m), rng.normal(0, 0.02, (m, RANK))
    if n == 0 or m == 0 or y.min() == y.max():
        return Machine(place, bias, w, v * 0)
    gw, gv, gb = np.full(m, 1e-3), np.full((m, RANK), 1e-3), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for a in range(0, n, LOT):
            lot = order[a : a + LOT]
            flat = np.concatenate([rows[i] for i in lot])
            row = np.repeat(np.arange(len(lot)), [len(rows[i]) for i in lot])
            sums = np.zeros((len(lot), RANK))
            np.add.at(sums, row, v[flat])
            margin = bias + np.bincount(row, w[flat], len(lot)) + 0.5 * (sums**2).sum(1) - 0.5 * np.bincount(row, (v[flat] ** 2).sum(1), len(lot))
            e = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[lot]) / len(lot)
            used, back = np.unique(flat, return_inverse=True)
            dw = np.bincount(back, e[row], len(used)) + L2 * w[used]
            dv = np.zeros((len(used), RANK))
            np.add.at(dv, back, e[row][:, None] * (sums[row] - v[flat]))
            dv += L2 * v[used]
            gw[used] += dw**2
            gv[used] += dv**2
            gb += e.sum() ** 2
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
            bias -= RATE * e.sum() / np.sqrt(gb)
    return Machine(place, float(bias), w, v)


def settle(machine: Machine, rows: list[np.ndarray], y: np.ndarray, cut_at: float) -> Machine:
    """Shift the constant so that the margin which parts the sample with the fewest errors scores `cut_at`."""
    if not len(y) or y.min() == y.max():
        return machine
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    margin = machine.margin(np.concatenate(rows), offsets)
    order = np.argsort(margin, kind="stable")
    m, toxic = margin[order], y[order] > 0
    wrong = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(~toxic[::-1])[::-1], [0]])
    at = np.flatnonzero(wrong[1:-1] == wrong[1:-1].min()) + 1
    # Among equally good places, the widest gap.
    best = at[np.argmax(m[at] - m[at - 1])]
    machine.bias += float(np.log(cut_at / (1 - cut_at)) - (m[best] + m[best - 1]) / 2)
    return machine


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column, cut_at: float = 0.7, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of held-out rows are not learnt."""
    held = F.coalesce(held_out, F.lit(False))
    key = F.col("doc_id").cast("long").alias("doc_id")
    own = docs.select(key, "text")
    marked = labels.where("toxic is not null and doc_id is not null").groupBy(key).agg((F.avg("toxic") >= 0.5).cast("int").alias("y")).where(~held)
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).collect()
    sample = docs.sparkSession.createDataFrame([tuple(r) for r in sample], "doc_id bigint, y int")
    learn = own.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")

    def tally(part, col, totals):
        y = part.column(2).to_numpy()
        found, offsets = terms(col)
        row = np.repeat(y, np.diff(offsets)).astype(np.int64)
        totals[: 2 * TERMS] += np.bincount(row * TERMS + found, minlength=2 * TERMS)
        totals[2 * TERMS :] += np.bincount(y, minlength=2)

    totals = dense_counts(learn, tally, 2 * TERMS + 2)
    place = telling(totals[:-2].reshape(2, TERMS), totals[-2:].astype(np.float64))
    blank = Machine(place, 0.0, np.zeros(0), np.zeros((0, 0)))

    def inputs(part, col):
        found, offsets = blank.inputs(col)
        flat = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()))
        return pa.RecordBatch.from_arrays([part.column(0), flat, part.column(2)], ["doc_id", "inputs", "y"])

    got = learn.mapInArrow(per_piece(inputs), "doc_id bigint, inputs array<int>, y int").toPandas()
    rows = sorted(zip(got.doc_id, map(list, got.inputs), got.y, strict=True))
    inputs_, y = [np.array(x, np.int64) for _, x, _ in rows], np.array([y for _, _, y in rows], np.float64)
    machine = settle(fit(place, inputs_, y), inputs_, y, cut_at)

    def score(part, col):
        s = machine.score(col)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= cut_at).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = own.mapInArrow(per_piece(score), "doc_id bigint, score double, predicted int")
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
