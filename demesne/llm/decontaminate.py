"""Benchmark decontamination by a BM25 index of test items with block-max pruning (operator 5).

The index holds the test items: for each word its postings (item, BM25 weight), where an item's
weights are scaled to sum to one, and for each word and block of items the largest weight. Every
passage of every document is a query: windows of twice the longest item, each starting half a
window after the last, so that an item copied anywhere lies whole inside a window. As in block-max
WAND, a passage is left as soon as the bounds of its words cannot reach the threshold, first over
all items, then block by block; only blocks that can reach it are scored, and every item at
`least_score` or more is retrieved, without a limit on their number. A retrieved item leaks if the passage has at least `overlap` of
the five-word shingles of its question and at least `overlap` of those of its answer (its words,
where it has fewer than five).

An item's answer is what follows its last question mark or, without one, its last sentence (its
last quarter, if it is one sentence); the question is the rest. Words are runs of letters and
digits, in lower case. Items are indexed in lots of `LOT_ITEMS`, each lot one pass over the documents, so the
index sent to tasks is bounded whatever the number of items.

Defined results: null and empty texts and items without a word match nothing; equal items each match;
a repeated key has a row for each of its rows; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import lower, per_piece, raw, shingles, span_hashes, words

K1, B = 1.2, 0.75
LOT_ITEMS, BLOCKS = 20_000, 64
LEAST_SCORE, OVERLAP, SHINGLE = 0.5, 0.8, 5

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the first word of each text."""
    data, offsets = raw(col)
    starts, ends, first = words(data, offsets, _BREAK)
    return span_hashes(lower(data), starts, ends), first


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of a test item."""
    head, mark, tail = text.rpartition("?")
    if mark and tail.strip():
        return head, tail
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if s]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    tokens = text.split()
    k = max(1, len(tokens) // 4)
    return " ".join(tokens[:-k]), " ".join(tokens[-k:])


def parts_of(hashes: np.ndarray) -> np.ndarray:
    """What of a question or an answer is looked for: its shingles, or its words if it has too few."""
    if len(hashes) < SHINGLE:
        return np.unique(hashes)
    return shingles(hashes, np.array([0, len(hashes)]), SHINGLE)[0]


class Index:
    """An inverted index of one lot of test items."""

    def __init__(self, items: list[tuple[int, str]]):
        found, first = word_hashes(pa.array([t for _, t in items], pa.large_string()))
        kept = np.flatnonzero(np.diff(first) > 0)
        self.ids = [items[i][0] for i in kept]
        n = len(kept)
        halves = [split_item(items[i][1]) for i in kept]
        self.parts = []
        for k in (0, 1):
            h, f = word_hashes(pa.array([x[k] for x in halves], pa.large_string()))
            self.parts.append([parts_of(h[a:b]) for a, b in zip(f[:-1], f[1:], strict=True)])
        row = np.repeat(np.arange(n), np.diff(first)[kept])
        flat = np.concatenate([found[first[i] : first[i + 1]] for i in kept]) if n else found[:0]
        self.words, term = np.unique(flat, return_inverse=True)
        pair, tf = np.unique(term.astype(np.int64) * max(n, 1) + row, return_counts=True)
        term, item = pair // max(n, 1), pair % max(n, 1)
        length = np.bincount(row, minlength=n).astype(np.float64)
        df = np.bincount(term, minlength=len(self.words))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / max(length.mean(), 1) if n else 1))
        self.weight = weight / np.bincount(item, weight, n)[item] if n else weight
        self.item = item
        self.at = np.concatenate([[0], np.cumsum(df)]).astype(np.int64)
        self.block_size = max(1, -(-n // BLOCKS))
        self.bound = np.zeros((len(self.words), -(-n // self.block_size) if n else 0), np.float32)
        np.maximum.at(self.bound, (term, item // self.block_size), self.weight)
        self.top = self.bound.max(1) if self.bound.size else np.zeros(len(self.words), np.float32)
        self.half = int(length.max()) if n else 1

    def retrieve(self, hashes: np.ndarray, first: np.ndarray, least: float):
        """(text, first word, end word, item, score) of every passage and item with a score of `least` or more."""
        if not len(hashes) or not len(self.words):
            return
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        hit = np.flatnonzero(self.words[at] == hashes)
        text = np.searchsorted(first, hit, "right") - 1
        # A word is in the two windows that its half-window belongs to.
        count = np.maximum(1, -(-np.diff(first) // self.half))
        base = np.concatenate([[0], np.cumsum(count)])
        own = base[text] + (hit - first[text]) // self.half
        before = (hit - first[text]) // self.half > 0
        window = np.concatenate([own, own[before] - 1])
        term = np.concatenate([at[hit], at[hit][before]])
        key = np.unique(window * len(self.words) + term)
        window, term = key // len(self.words), key % len(self.words)
        # Bounds over all items, then bounds of the blocks.
        reach = np.bincount(window, self.top[term])
        go = reach[window] >= least
        window, term = window[go], term[go]
        if not len(window):
            return
        new = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        rank = np.cumsum(np.concatenate([[0], (window[1:] != window[:-1]).astype(np.int64)]))
        live = np.add.reduceat(self.bound[term], new, axis=0) >= least - 1e-5
        go = live.any(1)[rank]
        rank, term = rank[go], term[go]
        size = self.at[term + 1] - self.at[term]
        each = np.repeat(self.at[term] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        item, at_rank = self.item[each], np.repeat(rank, size)
        go = live[at_rank, item // self.block_size]
        pair, back = np.unique(at_rank[go] * len(self.ids) + item[go], return_inverse=True)
        score = np.bincount(back, self.weight[each[go]], len(pair))
        for k in np.flatnonzero(score >= least):
            w = int(window[new[pair[k] // len(self.ids)]])
            i = int(np.searchsorted(base, w, "right") - 1)
            a = int(first[i]) + (w - int(base[i])) * self.half
            yield i, a, min(a + 2 * self.half, int(first[i + 1])), int(pair[k] % len(self.ids)), float(score[k])

    def overlaps(self, passage: np.ndarray, item: int) -> tuple[float, float]:
        """Shares of the question and of the answer of an item that a passage has; 1 for an empty question."""
        grams = parts_of(passage)
        out = []
        for k in (0, 1):
            want = self.parts[k][item]
            have = grams if len(passage) >= SHINGLE and self.shingled(k, item) else np.unique(passage)
            out.append(float(np.isin(want, have).mean()) if len(want) else 1.0)
        return out[0], out[1]

    def shingled(self, k: int, item: int) -> bool:
        """Whether a part is looked for by shingles: its entries are then not words of the index."""
        want = self.parts[k][item]
        return bool(len(want)) and not np.isin(want, self.words).all()


SCHEMA = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def leaks(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE, overlap: float = OVERLAP) -> DataFrame:
    """One row for each document and test item that it leaks, with the best passage's score and overlaps."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def scan(index: Index) -> DataFrame:
        def run(part, col):
            hashes, first = word_hashes(col)
            best: dict[tuple[int, int], tuple] = {}
            for i, a, b, item, score in index.retrieve(hashes, first, least):
                q, r = index.overlaps(hashes[a:b], item)
                if q >= overlap and r >= overlap:
                    best[i, item] = max(best.get((i, item), (0.0, 0.0, 0.0)), (score, q, r))
            ids = part.column(0)
            rows = [(ids[i].as_py(), index.ids[item], *v) for (i, item), v in sorted(best.items())]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], SCHEMA.replace(",", "").split()[::2])

        return own.mapInArrow(per_piece(run), SCHEMA)

    found, lot = [], []
    for row in items.where("text is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator():
        lot.append((row[0], row[1]))
        if len(lot) == LOT_ITEMS:
            found.append(scan(Index(lot)))
            lot = []
    found.append(scan(Index(lot)))
    return reduce(DataFrame.union, found)


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that leak no test item, all columns kept; rows are judged by key and text, so a clean text stays where another one of its key leaks."""
    # Each row whole in one column, so that no name can clash.
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = whole.select("row", F.xxhash64("row.doc_id", "row.text").alias("key"))
    bad = leaks(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), items).select(F.col("doc_id").alias("leaking")).distinct()
    kept = keyed.join(bad, keyed["key"] == bad["leaking"], "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
