"""Document fingerprints by randomised edit embedding (operator 2).

A text is read by a shared random walk: at time t the walk stands on one character and shows it;
a coin that depends only on t and the character says whether it moves on. Two texts that differ by
k edits fall into step again soon after each edit, so what the walks show differs in O(k^2) places:
edit distance becomes Hamming distance. The coin's next success is a table over (character class,
time mod 2^16), so the walk costs one step a character, for many documents at once.

A fingerprint samples what the walk shows. The times 2^k .. 2^(k+1) form stratum k; each has the
same `SAMPLES` sampled times for all texts, and each sample is kept as `BITS` hashed bits. A text
has the strata its walk reaches, so short and long texts are compared alike, and the likeness of two
fingerprints is the agreement of their samples, chance agreement removed, weighted by the length
of the strata (the last by the part that the walk reaches).

Written out, a fingerprint is the end of the walk in hex, a colon, and the samples in hex.

Defined results: null is the empty text; two empty texts are alike (1), an empty and another are
not (0); equal texts have equal fingerprints; repeated keys are ordered by their texts; a null key
comes last in descending order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import components, mix, texts
from demesne.session import cut

SAMPLES, BITS = 64, 4
PERIOD, CLASSES = 1 << 16, 64
#: Characters walked at once, and documents, whichever is less.
LOT_CHARS, LOT_DOCS = 4 << 20, 4096
#: Sampled values in a band of the candidate search, and bands.
BAND_SAMPLES, BANDS = 7, 24
#: Classes of a band that meet as many others in one cell.
SUB_BLOCK = 1000

_rng = np.random.default_rng(77)


def _coins() -> np.ndarray:
    """Steps from each time to just after the next success, for each character class."""
    heads = _rng.random((CLASSES, PERIOD)) < 0.5
    wait = np.zeros((CLASSES, 2 * PERIOD), np.uint8)
    twice = np.concatenate([heads, heads], 1)
    at = np.full(CLASSES, 0)
    for t in range(2 * PERIOD - 1, -1, -1):
        at = np.where(twice[:, t], 1, np.minimum(at + 1, 200))
        wait[:, t] = at
    return wait[:, :PERIOD].reshape(-1).copy()


_wait: np.ndarray | None = None
_times: list[np.ndarray] = [np.sort(_rng.integers(1 << k, 2 << k, SAMPLES)) - 1 for k in range(48)]


def walk(codes: list[np.ndarray], start: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Walks from the given times: for each text, the time at which the walk leaves each character; and the ends."""
    global _wait
    if _wait is None:
        _wait = _coins()
    sizes = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([codes[i] for i in order]) if len(order) else np.zeros(0, np.uint32)
    rows = (mix(flat.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.int32) * PERIOD
    first = np.concatenate([[0], np.cumsum(sizes[order])])[:-1]
    left = np.empty(len(flat), np.int32)
    t = start[order].astype(np.int32)
    longest = sizes[order]
    mask = np.int32(PERIOD - 1)
    live = len(order)
    for step in range(int(longest[0]) if live else 0):
        while longest[live - 1] <= step:
            live -= 1
        at = first[:live] + step
        now = t[:live]
        now += _wait[rows[at] + (now & mask)]
        left[at] = now
    out: list[np.ndarray] = [left] * len(order)
    for rank, i in enumerate(order.tolist()):
        out[i] = left[first[rank] : first[rank] + longest[rank]]
    ends = np.empty(len(order), np.int64)
    ends[order] = t
    return out, ends


def sample(codes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Hashed samples of what the walk shows, stratum by stratum: BITS-bit values."""
    if not len(codes):
        return np.zeros(0, np.uint8)
    end = int(left[-1])
    times = np.concatenate(_times[: end.bit_length()])
    at = np.searchsorted(left, times, "right")
    inside = at < len(codes)
    shown = codes[np.minimum(at, len(codes) - 1)].astype(np.uint64) * np.uint64(2) + np.uint64(1)
    value = (mix(shown * np.uint64(0xD1B54A32D192ED03) + times.astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.uint8)
    return np.where(inside, value, 0).astype(np.uint8)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Likeness, 0 to 1, of two fingerprints given as (end of the walk, samples)."""
    (end_a, x), (end_b, y) = a, b
    if not end_a or not end_b:
        return float(end_a == end_b)
    short, long_ = min(end_a, end_b), max(end_a, end_b)
    n = min(len(x), len(y)) // SAMPLES
    same = 0.0
    for k in range(n):
        times = _times[k]
        use = times < short
        reach = min(2 << k, short + 1) - (1 << k)
        if use.any():
            at = slice(k * SAMPLES, (k + 1) * SAMPLES)
            agree = np.count_nonzero((x[at] == y[at]) & use) / np.count_nonzero(use)
            same += max(0.0, (agree - 0.5**BITS) / (1 - 0.5**BITS)) * reach
        else:
            same += reach * (same / max(1, (1 << k) - 1))
    return min(1.0, same / long_)


def write(end: int, samples: np.ndarray) -> str:
    """A fingerprint as text."""
    packed = samples[0::2] << 4 | samples[1::2] if len(samples) else samples
    return f"{end:x}:{packed.astype(np.uint8).tobytes().hex()}"


def read(text: str) -> tuple[int, np.ndarray]:
    """A written fingerprint as (end of the walk, samples)."""
    end, _, samples = text.partition(":")
    packed = np.frombuffer(bytes.fromhex(samples), np.uint8)
    out = np.empty(2 * len(packed), np.uint8)
    out[0::2], out[1::2] = packed >> 4, packed & 15
    return int(end, 16), out


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprints(texts_: list[str]) -> list[tuple[int, np.ndarray]]:
    """Fingerprints of a bounded list of texts."""
    codes = [codes_of(t) for t in texts_]
    left, ends = walk(codes, np.zeros(len(codes), np.int64))
    return [(int(e), sample(c, x)) for c, x, e in zip(codes, left, ends, strict=True)]


def _with_edits(texts_: list[str], nexts: list[str]):
    """For each text: fingerprints of it, of its edited text, and the edited text."""
    codes, after = [codes_of(t) for t in texts_], [codes_of(t) for t in nexts]
    left, ends = walk(codes, np.zeros(len(codes), np.int64))
    keep = [len(c) - len(c) // 2 for c in codes]
    tails = [n[: len(c) // 2] for c, n in zip(codes, after, strict=True)]
    # The kept half is walked already: only what replaces the rest is walked, from where that ends.
    begun = np.array([int(x[k - 1]) if k else 0 for x, k in zip(left, keep, strict=True)], np.int64)
    more, _ = walk(tails, begun)
    out = []
    for c, x, e, k, tail, y in zip(codes, left, ends, keep, tails, more, strict=True):
        edited, gone = np.concatenate([c[:k], tail]), np.concatenate([x[:k], y])
        own = (int(e), sample(c, x))
        other = (int(gone[-1]) if len(gone) else 0, sample(edited, gone))
        out.append((own, other, edited.tobytes().decode("utf-32-le", "surrogatepass")))
    return out


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last floor(n/2) characters replaced by as many first ones of the next
    document in descending doc_id. Rows are dealt once, by ranges of doc_id; the one document that
    follows a range is dealt to it as well, so the ranges need nothing from each other.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    bounds = ids.where("doc_id is not null").agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10_000).alias("b")).first().b if n > 1 else []
    bounds = np.array(sorted(set(bounds or [])), np.int64)

    def parts_of(keys: pa.Array) -> np.ndarray:
        """The bounds at or above a key, so parts follow each other in descending order; a null comes last."""
        at = len(bounds) - np.searchsorted(bounds, pc.fill_null(keys, 0).to_numpy(zero_copy_only=False))
        return np.where(keys.is_null().to_numpy(zero_copy_only=False), len(bounds), at).astype(np.int32)

    part = F.arrow_udf(lambda keys: pa.array(parts_of(keys)), "int")
    tops = {r.part: r.top for r in ids.select(part("doc_id").alias("part"), "doc_id").groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    live = sorted(tops)
    if not live:
        return spark.createDataFrame([], SCHEMA)
    before = {p: live[i - 1] for i, p in enumerate(live)}

    def places_of(keys: pa.Array) -> pa.Array:
        """The part of a row; the first document of each part also goes to the part before it, as a guest."""
        at = parts_of(keys).tolist()
        return pa.array([[p, before[p]] if k == tops[p] else [p] for k, p in zip(keys.to_pylist(), at, strict=True)], pa.list_(pa.int32()))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.arrow_udf(places_of, "array<int>")(F.col("doc_id").cast("long")).alias("places"))
    dealt = rows.select("doc_id", "text", F.posexplode("places").alias("guest", "part")).withColumn("guest", F.col("guest") == 1)
    dealt = dealt.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("guest", F.desc_nulls_last("doc_id"), "text")

    def run(batches):
        held_ids: list = []
        held: list[str] = []
        size, ended = 0, False

        def emit(done):
            # Every held text but the last has its successor behind it.
            made = _with_edits(held[:-1], held[1:])
            tail = fingerprints(held[-1:]) if done else None
            nexts = [m[0] for m in made[1:]] + (tail or fingerprints(held[-1:]))
            cols = [[], [], [], [], [], [], []]
            for d, t, (own, other, edited), nxt in zip(held_ids, held, made, nexts, strict=False):
                sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                for c, v in zip(cols, (d, len(t), sha, write(*own), write(*other), likeness(own, other), likeness(own, nxt)), strict=True):
                    c.append(v)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, KINDS, strict=True)], NAMES)

        for batch in batches:
            for d, t, guest in zip(batch.column(0).to_pylist(), texts(batch), batch.column(2).to_pylist(), strict=True):
                if ended:
                    continue
                held_ids.append(d)
                held.append(t.as_py())
                size += len(held[-1])
                if guest:  # of equal keys at the top, the first is the successor
                    yield emit(True)
                    ended = True
                elif size >= LOT_CHARS or len(held) >= LOT_DOCS:
                    yield emit(False)
                    held_ids, held = held_ids[-1:], held[-1:]
                    size = len(held[-1])

    return dealt.select("doc_id", "text", "guest").mapInArrow(run, SCHEMA)


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def near_groups(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, group) of every document: near-copies by bit-sampled bands, with verification.

    Equal fingerprints are one class. A band is a few sampled values drawn from the strata before
    the end of a walk. In each band a class is compared, by whole fingerprints, with the least class
    of the band and with its neighbour in the order of fingerprints: two comparisons a class, which
    link most of what is alike. Then all pairs of a band that are not linked yet are compared, each
    once; they meet as keys, SUB_BLOCK by SUB_BLOCK classes, so a band is split over tasks. That is
    the square of what stays apart in a band, and no pair is left out. Classes with a likeness of
    `least` or more are linked; a group's name is its least doc_id.
    """
    prints = cut(fingerprint(docs))
    classes = prints.where("fingerprint <> '0:'").groupBy("fingerprint").agg(F.min("doc_id").alias("id")).where("id is not null")
    rng = np.random.default_rng(5)
    draws = [np.sort(rng.choice(SAMPLES * 3, BAND_SAMPLES, replace=False)) for _ in range(BANDS)]

    def bands(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                end, x = read(text)
                top = max(0, end.bit_length() - 2)
                for last in {top, max(0, top - 1)}:  # a near-copy's walk may end in the next stratum
                    part = x[max(0, last - 2) * SAMPLES : (last + 1) * SAMPLES]
                    for k, d in enumerate(draws):
                        out[0].append(f"{last}:{k}:{part[d % len(part)].tobytes().hex()}")
                        out[1].append(i)
                        out[2].append(text)
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1], pa.int64()), pa.array(out[2])], ["band", "id", "fingerprint"])

    def neighbours(batches):
        last: tuple = (None, None, None, None)
        for batch in batches:
            a, b = [], []
            for band, i, text, first, lead in zip(*[c.to_pylist() for c in batch.columns[:5]], strict=True):
                own = read(text)
                near = [(first, lead)] + ([last[1:3]] if last[0] == band else [])
                for other, print_ in near:
                    if other != i and likeness(own, read(print_)) >= least:
                        a.append(i)
                        b.append(other)
                last = (band, i, text, None)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = classes.select("id", "fingerprint").mapInArrow(bands, "band string, id bigint, fingerprint string")
    firsts = rows.groupBy("band").agg(F.min_by("fingerprint", "id").alias("lead"), F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = rows.join(firsts.where("n > 1"), "band").select("band", "id", "fingerprint", "first", "lead", "n")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = cut(shared)
    ranked = shared.repartitionByRange(n, "band", "fingerprint").sortWithinPartitions("band", "fingerprint")
    linked = components(ranked.mapInArrow(neighbours, "a bigint, b bigint"))

    def alike(batches):
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            near = [likeness(read(u), read(v)) >= least for u, v in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()).filter(pa.array(near, pa.bool_())), pa.array(b, pa.int64()).filter(pa.array(near, pa.bool_()))], ["a", "b"])

    # Pairs of different groups so far meet in the cells of their sub-blocks.
    blocks = F.ceil(F.col("n") / SUB_BLOCK).cast("int")
    cells = shared.join(linked, shared["id"] == linked["node"], "left").select("band", "id", F.coalesce("root", "id").alias("group"), blocks.alias("of"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"))
    one = cells.select("band", F.col("id").alias("a"), F.col("group").alias("p"), F.col("block").alias("lo"), F.explode(F.sequence("block", F.col("of") - 1)).alias("hi"))
    other = cells.select("band", F.col("id").alias("b"), F.col("group").alias("q"), F.col("block").alias("hi"), F.explode(F.sequence(F.lit(0), "block")).alias("lo"))
    apart = one.join(other, ["band", "lo", "hi"]).where("p <> q and (lo < hi or a < b)")
    apart = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    x, y = (classes.select(F.col("id").alias(k), F.col("fingerprint").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    more = apart.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(alike, "a bigint, b bigint")
    roots = components(more.union(linked.where("node <> root").select("node", "root")))
    named = classes.join(roots, classes.id == roots.node, "left").select("fingerprint", F.coalesce("root", "id").alias("group"))
    return prints.join(named, "fingerprint", "left").select("doc_id", F.coalesce("group", "doc_id").alias("group"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every whole text."""

    def run(batches):
        for batch in batches:
            ids, col = batch.column(0), texts(batch).to_pylist()
            at = 0
            while at < len(col):
                end, size = at, 0
                while end < len(col) and (end == at or size + len(col[end]) <= LOT_CHARS) and end - at < LOT_DOCS:
                    size += len(col[end])
                    end += 1
                yield pa.RecordBatch.from_arrays([ids.slice(at, end - at), pa.array([write(*f) for f in fingerprints(col[at:end])])], ["doc_id", "fingerprint"])
                at = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, fingerprint string")
