"""Removal of repeated byte strings with suffix arrays (operator 8).

A byte goes if it lies in a string of `LENGTH` bytes that also starts earlier: in a document with a
smaller key, or earlier in its own. Strings are judged on the input.

Equal strings must meet, without sending every string. A string of 100 bytes has 69 grams of 32
bytes; the least by a hash is its anchor, so equal strings have equal anchors, and neighbouring
strings mostly share one. A run is a stretch of strings with one anchor (35 on average).

1. In each piece of a split, runs are cut; of equal runs only the earliest is kept, the others are
   repeats (so a passage in a third of all documents leaves one run a piece). Runs travel as four
   numbers: hash of the anchor, hash of the run, key, place.
2. Runs with the same anchor meet. Equal runs: all but the earliest are repeats. Anchors with
   different runs are contenders: their strings may be equal in part; so are runs that repeat in
   themselves. All others are settled.
3. The bytes of contenders are fetched by key, and cut at the anchor into strings that reach far to
   its left and strings that reach far to its right; each goes to the shard of its anchor and 34
   bytes of that context, which parts documents that share a line only.
4. Shards are packed into blocks of about `BLOCK_BYTES`. For each block a suffix array is induced and
   the permuted common prefixes are computed; neighbours with a common prefix of 100 and more are
   equal strings, and all but the earliest of them are repeats.
5. Repeats are merged per document, and the rest of its bytes is digested. Both uses of the texts
   share one exchange.

Hashes only bring strings together, and equality of whole runs is taken from 128 bits (anchor and
run); the rest is compared byte by byte.

Defined results: null is the empty text and has no bytes; texts shorter than a string keep all bytes;
rows with equal key and text are the same document, so neither repeats the other; rows with equal
keys and different texts follow each other in the order of a hash (of 24 bits: up to some thousand
texts with one key are told apart); rows with a null key are told apart by 62 bits and come first (keys
below -2^62 among them); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import mix, per_piece, raw, span_hashes, texts
from demesne.llm.suffixes import permuted_lcp, suffix_array
from demesne.session import cut

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1
REACH = WINDOW // 2
#: Bytes of a block whose suffix array is built at once; a larger shard is a block of its own.
BLOCK_BYTES = 1 << 20
NULL_KEY = -(1 << 63)
# A place is the tie-breaking hash of the document (24 bits), the position (31), whether the run repeats in itself (1), its strings (7).
_TIE, _POS = 39, 8
TIES, _AT = 1 << 24, (1 << 31) - 1


def grams(data: np.ndarray) -> np.ndarray:
    """The hash of the gram at each position."""
    at = np.arange(max(len(data) - GRAM + 1, 0))
    return span_hashes(data, at, at + GRAM)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each `width` consecutive values."""
    have, out = 1, h
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(h) - width + 1], out[width - have :]) if have < width else out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of all texts: text, first string, number of strings, anchor hash, run hash, whether it may repeat in itself."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    if len(data) < LENGTH:
        return none
    h = grams(data)
    low = _least(h, WINDOW)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(low)]
    valid = np.arange(len(low)) + LENGTH <= offsets[text + 1]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    new |= ~valid
    start = np.flatnonzero(new)
    begun = start[np.cumsum(new) - 1]
    new |= (np.arange(len(low)) - begun) % WINDOW == 0
    start = np.flatnonzero(new & valid)
    if not len(start):
        return none
    edge = np.append(np.flatnonzero(new | ~valid), len(low))
    end = edge[np.searchsorted(edge, start, "right")]
    m = low[start]
    # Positions that are the anchor of some string; equal ones at most a window apart may lie in one run, and make strings that may repeat.
    wide = np.concatenate([np.zeros(WINDOW - 1, np.uint64), np.where(valid, low, np.uint64(0)), np.zeros(WINDOW - 1, np.uint64)])
    high = ~_least(~wide, WINDOW)
    anchors = np.flatnonzero(high == h)
    twin = np.flatnonzero((h[anchors[1:]] == h[anchors[:-1]]) & (anchors[1:] - anchors[:-1] <= WINDOW))
    marks = np.zeros(len(h) + 1, np.int64)
    marks[anchors[twin] + 1] = 1
    marks = np.cumsum(marks)
    last = np.minimum(end - 1 + WINDOW, len(h))
    periodic = marks[last] > marks[start]
    return text[start], start, end - start, m, span_hashes(data, start, end + LENGTH - 1), periodic


def _rows(columns, names, kinds):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _earliest(groups: list[np.ndarray], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by group, document and place; where groups begin in it; and which rows are later than the first of their group."""
    order = np.lexsort((at, doc, *groups[::-1]))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for g in groups:
            new[1:] |= g[order[1:]] != g[order[:-1]]
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    later = (doc[order] != doc[lead]) | ((at[order] >> _POS) != (at[lead] >> _POS))
    return order, new, later & ~new


RUNS = "a bigint, r bigint, doc bigint, at bigint, late boolean"
_RUN_NAMES = ["a", "r", "doc", "at", "late"]
_RUN_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]


def _cut_runs(part: pa.RecordBatch, col: pa.Array) -> pa.RecordBatch:
    """Step 1: (doc_id, tie, text) -> runs, the later ones of equal runs marked late and keyed apart."""
    data, offsets = raw(col)
    text, start, n, a, r, periodic = runs(data, offsets)
    doc = part.column(0).to_numpy()[text]
    at = (part.column(1).to_numpy().astype(np.int64)[text] << _TIE) | ((start - offsets[text]) << _POS) | (periodic.astype(np.int64) << 7) | n
    order, _, late = _earliest([a, r], doc, at)
    a = np.where(late, mix(a[order] ^ at[order].astype(np.uint64)), a[order])  # late rows are only passed on: spread them
    return _rows([a.view(np.int64), r[order].view(np.int64), doc[order], at[order], late], _RUN_NAMES, _RUN_KINDS)


SETTLED = "a bigint, doc bigint, at bigint, late boolean"


def _settle(batches):
    """Step 2, over rows sorted by (a, r, doc, at): late runs, and contenders (one for each different run of an anchor)."""
    names, kinds = ["a", "doc", "at", "late"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    held = None  # the first row of the latest run, not known yet to be a contender
    shown = False  # whether it has been given out
    for batch in batches:
        a, r, doc, at, late = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        out = [[a[late], doc[late], at[late], late[late]]]
        a, r, doc, at = (x[~late] for x in (a, r, doc, at))
        if held is not None:
            a, r, doc, at = (np.concatenate([[h], x]) for h, x in zip(held, (a, r, doc, at), strict=True))
        if not len(a):
            yield _rows([np.concatenate(x) for x in zip(*out, strict=True)], names, kinds)
            continue
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = ((doc != doc[lead]) | ((at >> _POS) != (at[lead] >> _POS))) & ~new
        out.append([a[again], doc[again], at[again], np.ones(again.sum(), bool)])
        f = np.flatnonzero(new)
        near = np.zeros(len(f), bool)
        same = a[f[1:]] == a[f[:-1]]
        near[1:] |= same
        near[:-1] |= same
        near |= (at[f] >> 7) & 1 > 0
        skip = shown and held is not None
        k = f[near]
        last_shown = bool(near[-1]) or (len(f) == 1 and skip)
        if skip and len(k) and k[0] == 0:
            k = k[1:]
        out.append([a[k], doc[k], at[k], np.zeros(len(k), bool)])
        held, shown = (a[f[-1]], r[f[-1]], doc[f[-1]], at[f[-1]]), last_shown
        yield _rows([np.concatenate(x) for x in zip(*out, strict=True)], names, kinds)


PARTS = "k bigint, doc bigint, at bigint, self boolean, bytes binary"


def _cut_parts(batches):
    """Step 3: (doc_id, text, contenders) -> strings on one side of their anchor, with the key of their shard."""
    names, kinds = ["k", "doc", "at", "self", "bytes"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    for batch in batches:
        out: list[list] = [[], [], [], [], []]

        def add(key, doc, tie, first, n, own, data):
            for c, v in zip(out, (key, doc, (tie << _TIE) | (first << _POS) | n, own, data), strict=True):  # noqa: B023
                c.append(v)

        for doc, text, found in zip(batch.column(0), texts(batch), batch.column(2), strict=True):
            data = text.as_py().encode("utf-8", "surrogatepass")
            view = np.frombuffer(data, np.uint8)
            found = np.array([(x["a"], x["at"]) for x in found.as_py()], np.int64).reshape(-1, 2)
            doc = doc.as_py()
            tie = int(found[0, 1] >> _TIE)
            first = (found[:, 1] >> _POS) & _AT
            n = found[:, 1] & 127
            own = (found[:, 1] >> 7) & 1 > 0
            anchor = found[:, 0].view(np.uint64)
            span = n + WINDOW - 1
            at = np.repeat(first - np.concatenate([[0], np.cumsum(span)[:-1]]), span) + np.arange(span.sum())
            which = np.repeat(np.arange(len(n)), span)
            is_anchor = span_hashes(view, at, at + GRAM) == anchor[which]
            places = at[is_anchor]
            bound = np.searchsorted(which[is_anchor], np.arange(len(n) + 1))
            lefts, rights, metas = [], [], []
            for i in range(len(n)):
                a, b = int(first[i]), int(first[i] + n[i])
                g = places[bound[i] : bound[i + 1]]
                if own[i] and len(g) > 1:
                    # Strings with several anchors go by the anchor alone, those with one like all others.
                    p = np.arange(a, b)
                    several = np.searchsorted(g, p + WINDOW) - np.searchsorted(g, p) > 1
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], several, [0]])))
                    for x, y in zip(a + edges[::2], a + edges[1::2], strict=True):
                        add(int(mix(anchor[i : i + 1] + np.uint64(3)).view(np.int64)[0]), doc, tie, int(x), int(y - x), True, data[x : y + LENGTH - 1])
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], ~several, [0]])))
                    singles = [(a + int(x), a + int(y), int(g[np.searchsorted(g, a + x)])) for x, y in zip(edges[::2], edges[1::2], strict=True)]
                    # A stretch of single strings may pass from one anchor to the next.
                    singles = [(max(x, int(q) - WINDOW + 1), min(y, int(q) + 1), int(q)) for x, y, _ in singles for q in g if q - WINDOW + 1 < y and q >= x]
                else:
                    singles = [(a, b, int(g[0]))]
                for x, y, q in singles:
                    left, right = min(y, q - REACH + 1), max(x, q - REACH + 1)
                    if x < left:
                        lefts.append((q - REACH, q))
                        metas.append((i, x, left, 0))
                    if right < y:
                        rights.append((q + GRAM, q + GRAM + WINDOW - REACH - 1))
                        metas.append((i, right, y, 1))
            if metas:
                spans = _in_order(metas, lefts, rights)
                ctx = span_hashes(view, spans[:, 0], spans[:, 1])
                idx = np.array([m[0] for m in metas])
                side = np.array([m[3] for m in metas], np.uint64)
                keys = mix(anchor[idx] ^ mix(ctx + side + np.uint64(1))).view(np.int64).tolist()
                for key, (_, x, y, _) in zip(keys, metas, strict=True):
                    add(key, doc, tie, x, y - x, False, data[x : y + LENGTH - 1])
            if len(out[0]) > 20_000:
                yield _rows(out, names, kinds)
                out = [[], [], [], [], []]
        yield _rows(out, names, kinds)


def _in_order(metas: list, lefts: list, rights: list) -> np.ndarray:
    """The context spans of both sides, in the order of metas."""
    sides = np.array([m[3] for m in metas])
    out = np.zeros((len(metas), 2), np.int64)
    out[sides == 0] = np.array(lefts, np.int64).reshape(-1, 2)
    out[sides == 1] = np.array(rights, np.int64).reshape(-1, 2)
    return out


LATE = "doc bigint, at bigint"


def repeats_in_block(strings: list[bytes], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step 4 for one block: (string, offset) of every window of LENGTH bytes that stands earlier elsewhere in the block.

    The strings are those of some shards; `at` is the place of each string's first window.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    t = np.zeros(begin[-1] + 1, np.int32)
    body = np.ones(len(t), bool)
    body[begin[1:] - 1] = body[-1] = False
    t[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int32) + 2
    t[begin[1:] - 1] = 1
    sa = suffix_array(t)
    lcp = permuted_lcp(t, sa)[sa]
    group = np.cumsum(lcp < LENGTH)
    which = np.searchsorted(begin, sa, "right") - 1
    which = np.minimum(which, len(strings) - 1)
    offset = sa - begin[which]
    size = np.bincount(group)
    good = np.flatnonzero((offset + LENGTH <= sizes[which]) & (size[group] > 1))
    group, which, offset = group[good], which[good], offset[good]
    place = at[which] + (offset.astype(np.int64) << _POS)
    order, _, late = _earliest([group], doc[which], place)
    return which[order[late]], offset[order[late]]


def _match(batches):
    """Step 4, over parts sorted by (k, doc, at): blocks of whole shards, late windows out as runs of windows."""
    names, kinds = ["doc", "at"], [pa.int64(), pa.int64()]
    block: list[tuple] = []
    shard: list[tuple] = []
    size, key = 0, None

    def close():
        """Settle equal parts of the shard that has ended; keep what is left in the block if it can have repeats."""
        nonlocal size
        seen: dict[bytes, tuple] = {}
        late = []
        for doc, at, own, data in shard:
            first = seen.setdefault(data, (doc, at, own, data))
            if (first[0], first[1] >> _POS) != (doc, at >> _POS):
                late.append((doc, at))
        rest = list(seen.values())
        if len(rest) > 1 or any(x[2] for x in rest):
            block.extend(rest)
            size += sum(len(x[3]) for x in rest)
        return late

    def flush():
        doc, at = np.array([b[0] for b in block], np.int64), np.array([b[1] for b in block], np.int64)
        which, offset = repeats_in_block([b[3] for b in block], doc, at)
        order = np.lexsort((offset, which))
        which, offset = which[order], offset[order]
        new = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1)])) if len(which) else np.zeros(0, np.int64)
        n = np.diff(np.append(new, len(which)))
        place = (at[which[new]] >> _POS) + offset[new]
        return _rows([doc[which[new]], (place << _POS) | n], names, kinds)

    for batch in batches:
        late: list[tuple] = []
        for k, doc, at, own, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if k != key:
                late += close()
                shard, key = [], k
                if size >= BLOCK_BYTES:
                    yield flush()
                    block, size = [], 0
            shard.append((doc, at, own, data))
        yield _rows([[x[0] for x in late], [x[1] for x in late]], names, kinds)
    late = close()
    yield _rows([[x[0] for x in late], [x[1] for x in late]], names, kinds)
    if block:
        yield flush()


def _keep(batches):
    """Step 5: (doc_id, text, late) -> digests of what is kept."""
    names = [x.split()[0] for x in KEPT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for doc, text, found in zip(batch.column(0), texts(batch), batch.column(2), strict=True):
            data = text.as_py().encode("utf-8", "surrogatepass")
            spans = removed_spans(found.as_py() or [])
            kept, at = [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            sha = hashlib.sha256(b"".join(kept)).hexdigest()
            for c, v in zip(out, (doc.as_py(), len(data), sum(b - a for a, b in spans), len(spans), sha), strict=True):
                c.append(v)
        yield _rows(out, names, kinds)


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def removed_spans(places: list[int]) -> list[tuple[int, int]]:
    """Maximal removed runs of bytes of one document, from the places of its late runs."""
    if not places:
        return []
    at = np.array(places, np.int64)
    start = (at >> _POS) & _AT
    end = start + (at & 127) - 1 + LENGTH
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return list(zip(start[new].tolist(), reach[last].tolist(), strict=True))


def late_runs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows dealt by key, late): documents as (doc_id, key, tie, text), and the places of all repeats (doc, tie, at)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Each text with a null key is a document of its own, told by 62 bits of its hash below all keys there are.
    own = F.lit(NULL_KEY) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    rows = rows.select("doc_id", F.coalesce("doc_id", own).alias("key"), F.pmod(F.xxhash64("text"), F.lit(TIES)).cast("int").alias("tie"), "text")
    found = rows.select("key", "tie", "text").mapInArrow(per_piece(_cut_runs), RUNS)
    settled = cut(found.repartition(n, "a").sortWithinPartitions("a", "r", "doc", "at").mapInArrow(_settle, SETTLED))
    tie = F.shiftright("at", _TIE).cast("int").alias("tie")
    contenders = settled.where("not late").groupBy(F.col("doc").alias("key"), tie).agg(F.collect_list(F.struct("a", "at")).alias("found"))
    fetched = rows.join(contenders.hint("shuffle_merge"), ["key", "tie"]).dropDuplicates(["key", "tie"])
    parts = fetched.select("key", "text", "found").mapInArrow(_cut_parts, PARTS)
    matched = parts.repartition(n, "k").sortWithinPartitions("k", "doc", "at").mapInArrow(_match, LATE)
    late = settled.where("late").select("doc", "at").union(matched)
    return rows, late.select(F.col("doc").alias("key"), tie, "at")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows, late = late_runs(docs)
    per = late.groupBy("key", "tie").agg(F.collect_list("at").alias("late"))
    joined = rows.join(per.hint("shuffle_merge"), ["key", "tie"], "left")
    return joined.select("doc_id", "text", "late").mapInArrow(_keep, KEPT)
