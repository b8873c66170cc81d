"""Spelling variants by k-d trees over letter counts (operator 13).

One edit changes the letter counts of a word little: a replaced letter makes one count larger and one smaller
by one, an inserted letter makes one larger. So near words are found among those whose counts differ that much.

1. Runs of letters are counted per task and summed; words of some length and number stay.
2. A k-d tree for each length is fitted on a bounded sample of the words (`SAMPLE`); its leaves are cells.
   Every word goes, as a point, to its cell, and as a query to the cells of its own length and of the next
   one that a single edit can reach, told by their boxes. A cell with more than `BLOCK` words, such as many
   anagrams, is cut into blocks, and queries go to all of them: points are held a block at a time, queries stream.
3. In a block, a k-d tree with tight boxes over all its points answers the queries; points left are
   verified by the order of their letters. Of every word a block gives one row: near words found, and the best one.
4. Forms (the most frequent near word, if so many times as frequent) are followed to their end by pointer doubling.

Counts are kept for the letters a to z and, folded by remainder, for all others, up to 255 each: both only make
distances smaller, so no near word is lost. Lengths from `LONG` on share one tree. Each pair is met once: within a
length only in the cell of the later one.

Defined results: null and empty texts have no words; a null key is written as the empty text in what is
hashed; repeated rows count each; ties go to the word that is smaller in code-point order; other columns are not
read; an empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import pieces
from demesne.session import cut

#: Words that a tree of cells is fitted on (as expected, and at most twice as many), points of a block, most cells, points of a leaf within a block.
SAMPLE, BLOCK, CELLS, LEAF = 50_000, 20_000, 4096, 32
#: Words from this length on share a tree.
LONG = 64
#: Distinct words that a task counts before it hands them on.
HELD = 300_000
DIMS = 32


def letter_runs(least: int) -> re.Pattern:
    """Maximal runs of at least `least` letters; a shorter run has no part that is as long."""
    return re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")


def count_words(docs: DataFrame, least: int, every: int | None) -> DataFrame:
    """word, n: lower-cased (A-Z) runs of `least` letters or more.

    If `every` divides the CRC-32 of '<doc_id>:<run>', that letter of the run is left out which the CRC-32 names.
    """
    find = letter_runs(least).findall

    def run(batches):
        held: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part, col in pieces(batch):
                for key, text in zip(part.column(0).to_pylist(), col.to_pylist(), strict=True):
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, k in Counter(find(text.encode().lower().decode())).items():  # bytes: A-Z alone
                        if every is not None:
                            h = zlib.crc32(word.encode(), start)
                            if h % every == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < least:
                                    continue
                        held[word] += k
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, and their lengths."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), np.fromiter(map(len, words), np.int64, len(words))


def letter_counts(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A vector of counts for each word."""
    slot = np.where((codes >= 97) & (codes <= 122), codes.astype(np.int64) - 97, 26 + codes.astype(np.int64) % (DIMS - 26))
    row = np.repeat(np.arange(len(lengths)), lengths)
    return np.minimum(np.bincount(row * DIMS + slot, minlength=len(lengths) * DIMS), 255).reshape(-1, DIMS).astype(np.int16)


class Tree:
    """A k-d tree: inner nodes halve their points along the coordinate of widest spread; leaves hold points, or are cells."""

    def __init__(self, points: np.ndarray, leaf: int, tight: bool):
        self.lo, self.hi, self.split, self.leaves = [], [], [], []
        if tight:
            self._grow(points, np.arange(len(points)), leaf, None, None)
        else:  # boxes that together cover all space
            self._grow(points, np.arange(len(points)), leaf, np.zeros(DIMS, np.int16), np.full(DIMS, 255, np.int16))

    def _grow(self, points, own, leaf, lo, hi) -> int:
        at, mine = len(self.split), points[own]
        self.lo.append(mine.min(0) if lo is None else lo)
        self.hi.append(mine.max(0) if hi is None else hi)
        self.split.append(None)
        best = None
        if len(own) > leaf:
            for d in np.argsort(-mine.var(0), kind="stable")[:4].tolist():
                middle = int(np.median(mine[:, d]))
                for t in (middle - 1, middle):
                    low = int((mine[:, d] <= t).sum())
                    if 0 < low < len(own) and (best is None or abs(2 * low - len(own)) < best[0]):
                        best = abs(2 * low - len(own)), d, t
        if best is None:
            self.split[at] = len(self.leaves)
            self.leaves.append(own)
            return at
        _, d, t = best
        below = mine[:, d] <= t
        sides = []
        for keep, bound in ((below, "hi"), (~below, "lo")):
            box = [lo, hi]
            if lo is not None:
                k = bound == "hi"
                box[k] = box[k].copy()
                box[k][d] = t if k else t + 1
            sides.append(self._grow(points, own[keep], leaf, *box))
        self.split[at] = (d, t, *sides)
        return at

    def home(self, q: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls in."""
        out, todo = np.zeros(len(q), np.int64), [(0, np.arange(len(q)))]
        while todo:
            at, own = todo.pop()
            node = self.split[at]
            if isinstance(node, int):
                out[own] = node
            else:
                below = q[own, node[0]] <= node[1]
                todo += [(node[2], own[below]), (node[3], own[~below])]
        return out

    def reach(self, q: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the vectors that can get into their box by one count more and `down` counts less."""
        todo = [(0, np.arange(len(q)))]
        while todo:
            at, own = todo.pop()
            v = q[own]
            own = own[(np.maximum(self.lo[at] - v, 0).sum(1) <= 1) & (np.maximum(v - self.hi[at], 0).sum(1) <= down)]
            if not len(own):
                continue
            node = self.split[at]
            if isinstance(node, int):
                yield node, own
            else:
                todo += [(node[2], own), (node[3], own)]


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes a different b of a."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k, n = 0, min(len(a), len(b))
    while k < n and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def _verified(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of letters x become y by one edit; y is as long as x, or longer by one."""
    n = x.shape[1]
    if y.shape[1] == n:
        return (x != y).sum(1) == 1
    rows = np.ones((len(x), 1), bool)
    front = np.hstack([x != y[:, :-1], rows]).argmax(1)
    back = np.hstack([(x != y[:, 1:])[:, ::-1], rows]).argmax(1)
    return front + back >= n


def _class(length):
    return np.minimum(length, LONG)


def _fit(words: DataFrame) -> dict[int, Tree]:
    """For each length a tree of cells, from a bounded sample of its words; cells are meant to hold BLOCK words."""
    size = F.least(F.char_length("word"), F.lit(LONG))
    total = {r.size: r.n for r in words.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    all_ = sum(total.values())
    sample: dict[int, list[str]] = {k: [] for k in total}
    # Told by a hash, so that no more than the sample leaves the tasks.
    share = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(all_, 1)))
    for r in words.where(share).select("word").limit(2 * SAMPLE).collect():
        sample[min(len(r.word), LONG)].append(r.word)
    trees = {}
    for k, chosen in sample.items():
        cells = max(1, min(-(-total[k] // BLOCK), max(1, CELLS * total[k] // all_)))
        points = letter_counts(*codes_of(chosen)) if chosen else np.zeros((1, DIMS), np.int16)
        trees[k] = Tree(points, max(1, len(points) // cells), False)
    return trees


def _cell(trees: dict[int, Tree]):
    """word -> length class and cell."""

    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            codes, lengths = codes_of(words)
            q, kind = letter_counts(codes, lengths), _class(lengths)
            cell = np.zeros(len(words), np.int64)
            for k in np.unique(kind).tolist():
                own = np.flatnonzero(kind == k)
                cell[own] = trees[k].home(q[own])
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(cell, pa.int32())], ["kind", "cell"])

    return run


def _route(trees: dict[int, Tree], blocks: dict[tuple[int, int], tuple[int, int]]):
    """(word, n) -> rows (block, query, home, word, n): one as a point, and one for each block that it asks; home: within its own cell."""

    def run(batches):
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            codes, lengths = codes_of(words)
            q, kind = letter_counts(codes, lengths), _class(lengths)
            place = np.array([zlib.crc32(w.encode()) for w in words], np.int64)
            block, query, home, row = [], [], [], []

            def add(first, rows, asks, own):
                block.append(first)
                row.append(rows)
                query.append(np.full(len(rows), asks))
                home.append(np.full(len(rows), own))

            for k in np.unique(kind).tolist():
                mine = np.flatnonzero(kind == k)
                cell = trees[k].home(q[mine])
                for c in np.unique(cell).tolist():
                    rows = mine[cell == c]
                    first, many = blocks[k, c]
                    add(first + place[rows] % many, rows, False, True)
                for at, down in ((k, 1), (k + 1, 0)):
                    if at not in trees:
                        continue
                    for c, found in trees[at].reach(q[mine], down):
                        if (at, c) not in blocks:
                            continue
                        first, many = blocks[at, c]
                        if at == k:
                            found = found[cell[found] <= c]
                        own = cell[found] == c if at == k else np.zeros(len(found), bool)
                        for b in range(many):
                            for is_own in (True, False):
                                rows = mine[found[own == is_own]]
                                if len(rows):
                                    add(np.full(len(rows), first + b), rows, True, is_own)
            if row:
                at = np.concatenate(row)
                cols = [pa.array(np.concatenate(block), pa.int32()), pa.array(np.concatenate(query)), pa.array(np.concatenate(home)), batch.column(0).take(pa.array(at)), pa.array(n[at], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["block", "query", "home", "word", "n"])

    return run


class Block:
    """The points of one block and what is found near them."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.codes, self.lengths = codes_of(words)
        self.tree = Tree(letter_counts(self.codes, self.lengths), LEAF, True)
        self.counts = letter_counts(self.codes, self.lengths)
        self.rank = _ranks(words, n)
        self.matrix = self.codes.reshape(len(words), -1) if self.lengths.min() == self.lengths.max() < LONG else None

    def near(self, words: list[str], home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) that are one edit apart; within the own cell only where the query is the smaller word."""
        codes, lengths = codes_of(words)
        q = letter_counts(codes, lengths)
        begin = np.cumsum(lengths) - lengths
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for leaf, own in self.tree.reach(q, 1):
            points = self.tree.leaves[leaf]
            p = self.counts[points].astype(np.int8) if self.matrix is not None else self.counts[points]
            for at in range(0, len(own), 8192):
                some = own[at : at + 8192]
                apart = np.abs(q[some].astype(p.dtype)[:, None, :] - p[None]).sum(2, dtype=np.int16)
                i, j = np.nonzero(apart <= 2)
                i, j = some[i], points[j]
                if self.matrix is None:
                    ok = np.fromiter((one_edit(words[a], self.words[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
                else:
                    ok = np.zeros(len(i), bool)
                    for size in np.unique(lengths[i]).tolist():
                        rows = np.flatnonzero(lengths[i] == size)
                        x = codes[begin[i[rows]][:, None] + np.arange(size)]
                        ok[rows] = _verified(x, self.matrix[j[rows]])
                found.append((i[ok], j[ok]))
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        keep = np.fromiter((not h or words[a] < self.words[b] for h, a, b in zip(home[i].tolist(), i.tolist(), j.tolist(), strict=True)), bool, len(i))
        return i[keep], j[keep]


def _ranks(words: list[str], n: np.ndarray) -> np.ndarray:
    """Place of each word when the most frequent come first, equals in code-point order."""
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda k: (-n[k], words[k]))] = np.arange(len(words))
    return rank


def _best(of: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct value of `of`: the value, how often it stands, and its pair of least rank."""
    order = np.lexsort((rank, of))
    own = of[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    return own[first], np.diff(np.append(first, len(own))), order[first]


def _search(batches):
    """Rows sorted by (block, query): points first, then queries -> (word, n_near, best_n, best) of words with near ones."""
    block, at, words, n = None, None, [], []

    def rows(owner, of, other, other_n, i, j, rank):
        value, count, pick = _best(i, rank)
        to = j[pick]
        return [owner[v] for v in value.tolist()], count, other_n[to], [other[k] for k in to.tolist()], of

    for batch in batches:
        blocks, query = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        home, size = batch.column(2).to_numpy(zero_copy_only=False), batch.column(4).to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (query[1:] != query[:-1])])) if len(blocks) else []
        for a, b in zip(cuts, [*cuts[1:], len(blocks)], strict=True):
            part = batch.column(3).slice(a, b - a).to_pylist()
            if block != blocks[a]:
                block, at, words, n = int(blocks[a]), None, [], []
            if not query[a]:
                words += part
                n.append(size[a:b])
                continue
            if not words:
                continue
            if at is None:
                at = Block(words, np.concatenate(n))
            i, j = at.near(part, home[a:b])
            if not len(i):
                continue
            own_rank = _ranks(part, size[a:b])
            for owner, other, other_n, own, to, rank in ((part, at.words, at.n, i, j, at.rank[j]), (at.words, part, size[a:b], j, i, own_rank[i])):
                value, count, pick = _best(own, rank)
                best = to[pick]
                cols = [[owner[v] for v in value.tolist()], count, other_n[best], [other[k] for k in best.tolist()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: how many of the distinct `words` (word, n) are one edit away, and the most frequent of them."""
    trees = _fit(words)
    sizes = words.select("word").mapInArrow(_cell(trees), "kind int, cell int").groupBy("kind", "cell").agg(F.count(F.lit(1)).alias("n"))
    blocks, number = {}, 0
    for r in sorted(sizes.collect()):  # at most one row a cell
        many = -(-r.n // (4 * BLOCK))
        blocks[r.kind, r.cell] = number, many
        number += many
    routed = words.select("word", "n").mapInArrow(_route(trees, blocks), "block int, query boolean, home boolean, word string, n bigint")
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), number)
    found = routed.repartition(parts, "block").sortWithinPartitions("block", "query").mapInArrow(_search, "word string, n_near bigint, best_n bigint, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): where the forms lead in the end. No form leads back."""
    links = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        after = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut(links.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")))
        if links.where("open").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = 6, often: int = 5, times: int = 5, every: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words of at least `least` letters that stand at least `often` times.

    The form of a word is its most frequent near word, if that is at least `times` as frequent; its root is where forms lead.
    """
    words = cut(count_words(docs, least, every).where(F.col("n") >= often))
    is_form = F.col("best_n") >= times * F.col("n")
    known = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
    )
    known = cut(known)
    roots = followed(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
