"""Fingerprints (2), the Jaccard join (7) and the suffix-array dedup (8) against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demesne.llm import fingerprints, jaccard, substrings, suffixes


def sets(rows, n):
    out = []
    for d, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        out.append((d, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    return out


def brute_components(rows, n, least):
    found = sets(rows, n)
    root = list(range(len(found)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, (d, s) in enumerate(found):
        for j in range(i):
            e, u = found[j]
            if s and u and None not in (d, e) and 100 * len(s & u) >= least * len(s | u):
                root[max(top(i), top(j))] = min(top(i), top(j))
    low = defaultdict(list)
    for i, (d, _) in enumerate(found):
        low[top(i)].append(d)
    return sorted(((d, len(s), None if d is None else min(low[top(i)])) for i, (d, s) in enumerate(found)), key=str)


@pytest.mark.parametrize(("n", "least"), [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, n, least):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(800)]
    base = [[rng.choice(words) for _ in range(rng.choice([0, 1, 2, 4, 30, 100, 250]))] for _ in range(25)]
    shared = [rng.choice(words) for _ in range(50)]
    rows = []
    for i in range(250):
        w = list(base[i % 4] if i % 2 else rng.choice(base))
        if i % 6 == 0:
            w = [rng.choice(words) for _ in range(rng.randrange(40))] + shared
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i * 37 % 1009, " ".join(w)))
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), n, least).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, n, least)


def test_a_large_group_is_linked_without_all_pairs(spark):
    rng = random.Random(6)
    base = [f"v{i}" for i in range(100)]
    rows = []
    for i in range(600):  # each differs from the first in one word, and from most others in two
        w = list(base)
        if i:
            w[rng.randrange(100)] = f"new{i}"
        rows.append((i, " ".join(w)))
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.component_id for r in got} == {0}


@pytest.mark.parametrize(("n", "least"), [(3, 90), (5, 80)])
def test_pairs_of_near_copies_grow_in_proportion(spark, n, least, monkeypatch):
    """Copies of one text with one word changed each: compared pairs grow like the copies, whether the text is there or not."""
    asked = []
    compare = jaccard.compare
    monkeypatch.setattr(jaccard, "compare", lambda docs, members, pairs, *a: asked.append(pairs.count()) or compare(docs, members, pairs, *a))
    per_copy = []
    for copies in (100, 400):
        rng = random.Random(copies)
        base = [f"u{i}" for i in range(60)]
        rows = []
        for i in range(copies):
            w = list(base)
            w[rng.randrange(60)] = f"other{i}"
            rows.append((i, " ".join(w)))
        asked.clear()
        got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), n, least).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, n, least)
        per_copy.append(sum(asked) / copies)
    assert per_copy[1] < 2 * per_copy[0]


def test_texts_that_share_a_key_are_judged_apart(spark):
    words = lambda k: " ".join(f"{k}w{i}" for i in range(30))
    rows = [(5, words("a")), (5, words("b")), (6, words("b")), (7, words("c")), (7, words("c")), (8, ""), (8, None)]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[1], rows[3], rows[5], rows[6]], key=str)


def test_jaccard_on_odd_rows(odd, none):
    got = sorted((tuple(r) for r in jaccard.link_documents(odd, 3, 90).collect()), key=str)
    assert got == brute_components([(r.doc_id, r.text) for r in odd.collect()], 3, 90)
    assert jaccard.link_documents(none).count() == 0
    kept = jaccard.one_of_each(odd, 5, 80)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and not {2, 3, 8} & set(ids) and ids.count(12) == 1 and ids.count(None) == 2


def brute_repeats(rows):
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = text.encode()
        gone, new = bytearray(len(data)), []
        for i in range(len(data) - 99):
            s = data[i : i + 100]
            if s in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeated_rows(rng):
    words = ["aé", "the", "of", "ñandu", "x", "lorem", "dolor"]
    base = [" ".join(rng.choice(words) + rng.choice(["", str(rng.randrange(30))]) for _ in range(rng.randrange(120))) for _ in range(20)]
    for i in range(90):
        kind = i % 5
        text = rng.choice(base)
        if kind == 1:
            text = "".join(c if rng.random() > 0.01 else rng.choice("qzé ") for c in text)
        elif kind == 2:
            text = "".join(b[rng.randrange(len(b) + 1) :][: rng.randrange(300)] for b in rng.sample(base, 4))
        elif kind == 3:
            text = rng.choice(["a" * rng.randrange(600), "abcdefghij" * rng.randrange(60), ("x" * 70 + "y") * rng.randrange(1, 9)])
        yield i * 7 % 1000, text


def test_repeats_are_those_of_all_strings(spark):
    rows = list(repeated_rows(random.Random(9)))
    got = {r.doc_id: tuple(r)[1:] for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute_repeats(rows)


def test_many_null_and_equal_keys(spark):
    """Texts that share a key are documents of their own, in the order of a hash."""
    rng = random.Random(6)
    texts = [t for _, t in repeated_rows(rng)] * 4
    texts = [t + f" {i}" for i, t in enumerate(texts)]
    rows = [(None if i % 3 else 5, t) for i, t in enumerate(texts)] + [(7, texts[0]), (7, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    h = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(set(rows), key=lambda r: (-1, h[r[1]] % (1 << 64)) if r[0] is None else (r[0], h[r[1]] % (1 << 24)))
    wanted = brute_repeats([(k, t) for k, (_, t) in enumerate(order)])
    wanted = [(d, *wanted[k]) for k, (d, _) in enumerate(order)]
    got = [tuple(r) for r in substrings.without_repeats(df).collect()]
    assert sorted(got, key=str) == sorted(wanted + [w for w in wanted if w[0] == 7], key=str)


def test_edits_at_many_partitions(spark):
    rows = [(i, f"text number {i} " * 3) for i in range(3000)]
    default = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few = fingerprints.compare_with_edits(df).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "1500")
    try:
        many = fingerprints.compare_with_edits(df)
        assert sorted(many.collect()) == sorted(few) and len(few) == 3000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", default)


def removed_of_all(rows):
    """Bytes removed of each document, by the steps of op8 in a row, without Spark."""
    part = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([0] * len(rows), pa.int32()), pa.array([t for _, t in rows], pa.large_string())], ["key", "tie", "text"])
    by = lambda batch, *names: batch.sort_by([(n, "ascending") for n in names])
    settled = list(substrings._settle([by(substrings._cut_runs(part, part.column(2)), "a", "r", "doc", "at")]))
    settled = [r for b in settled for r in b.to_pylist()]
    late, found = [(r["doc"], r["at"]) for r in settled if r["late"]], defaultdict(list)
    for r in settled:
        if not r["late"]:
            found[r["doc"]].append({"a": r["a"], "at": r["at"]})
    kind = pa.list_(pa.struct([("a", pa.int64()), ("at", pa.int64())]))
    fetched = pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([dict(rows)[d] for d in found], pa.large_string()), pa.array(list(found.values()), kind)], ["key", "text", "found"])
    parts = pa.Table.from_batches(substrings._cut_parts([fetched])).combine_chunks()
    for batch in substrings._match(by(parts, "k", "doc", "at").to_batches()):
        late += [(r["doc"], r["at"]) for r in batch.to_pylist()]
    places = defaultdict(list)
    for doc, at in late:
        places[doc].append(at)
    return {d: sum(b - a for a, b in substrings.removed_spans(places[d])) for d, _ in rows}


@pytest.mark.parametrize("size", [68, 69, 70])
def test_lines_as_long_as_a_window_meet(monkeypatch, size):
    """A line and its newline twice, in two texts: each shard is a block of its own, so only equal shard keys bring strings together."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 1)
    rng = random.Random(size)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(100):
        line = text(size - 1) + "\n"
        rows = [(k, text(rng.randrange(200)) + 2 * line + text(rng.randrange(200))) for k in (1, 2)]
        assert removed_of_all(rows) == {k: v[1] for k, v in brute_repeats(rows).items()}


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = list(repeated_rows(random.Random(10)))
    parts = [(0, d, 0, True, t.encode()) for d, t in rows if len(t.encode()) >= 100]
    which, offset = substrings.repeats_in_block([p[4] for p in parts], np.array([p[1] for p in parts]), np.zeros(len(parts), np.int64))
    want = {k: v[1] for k, v in brute_repeats(rows).items()}
    for i, p in enumerate(parts):
        gone = np.zeros(len(p[4]), bool)
        for o in offset[which == i]:
            gone[o : o + 100] = True
        assert gone.sum() == want[p[1]]


def test_dedup_on_odd_rows(odd, none):
    out = substrings.without_repeats(odd).collect()
    assert len(out) == odd.count()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    long_ = next(r.text for r in odd.collect() if r.doc_id == 7)
    assert by[7][0].n_removed == 0 and by[8][0].n_removed == by[8][0].n_bytes == len(long_[:-7].encode())
    assert by[11][0].n_removed == 700 - 100 + 99 and by[11][0].n_spans == 1
    assert [r.n_removed for r in by[12]] == [0, 0] and {r.n_bytes for r in by[4]} == {0}
    assert substrings.without_repeats(none).count() == 0


def test_suffix_arrays_are_sorted():
    rng = np.random.default_rng(1)
    for k in range(120):
        t = rng.integers(1, rng.integers(2, 6), rng.integers(1, 50))
        t = np.append(np.tile(t, 3) if k % 3 == 0 else t, 0)
        sa = suffixes.suffix_array(t)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        lcp = suffixes.permuted_lcp(t, sa)
        for a, b in zip(sa[:-1], sa[1:]):
            same = 0
            while same < len(t) - max(a, b) and t[a + same] == t[b + same]:
                same += 1
            assert lcp[b] == same


def test_edited_texts_and_likeness(odd, none):
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in odd.collect()), key=lambda r: (-r[0], r[1].encode()))
    out = fingerprints.compare_with_edits(odd).collect()
    assert len(out) == len(rows)
    got = defaultdict(list)
    for r in out:
        got[-1 if r.doc_id is None else r.doc_id].append(r)
    seen = defaultdict(int)
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        r = got[key][seen[key]] if len(got[key]) == 1 else None
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        if r is None:
            assert hashlib.sha256(edited.encode()).hexdigest() in {x.edited_sha256 for x in got[key]}
            continue
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprints.write(*fingerprints.fingerprints([text])[0])
        assert r.edited_fingerprint == fingerprints.write(*fingerprints.fingerprints([edited])[0])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert fingerprints.compare_with_edits(none).count() == 0


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    print_ = fingerprints.fingerprints([text])[0]
    last = 1.0
    for edits in (0, 5, 60, 600):
        chars = list(text)
        for _ in range(edits):
            chars[rng.randrange(len(chars))] = rng.choice(["", "z", "yy"])
        near = fingerprints.likeness(print_, fingerprints.fingerprints(["".join(chars)])[0])
        assert near <= last
        last = near
    assert last < 0.5
    assert fingerprints.likeness((0, np.zeros(0)), (0, np.zeros(0))) == 1 and fingerprints.likeness(print_, (0, np.zeros(0))) == 0
    assert fingerprints.read(fingerprints.write(*print_))[0] == print_[0]


def test_near_groups(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(600)) for _ in range(5)]
    rows = [(10 * i + k, t if k < 2 else t[:300] + "#" + t[301:]) for i, t in enumerate(base) for k in range(4)] + [(900, ""), (901, None)]
    got = {r.doc_id: r.group for r in fingerprints.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{10 * i + k: 10 * i for i in range(5) for k in range(4)}, 900: 900, 901: 901}


def test_near_groups_in_crowded_bands(spark, monkeypatch):
    """Near-copies of 12 texts with one beginning, all different: bands of one sample hold most classes; every alike pair is linked."""
    monkeypatch.setattr(fingerprints, "BAND_SAMPLES", 1)
    monkeypatch.setattr(fingerprints, "SUB_BLOCK", 5)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    head = text(150)
    base = [head + text(450) for _ in range(12)]
    rows = []
    for k in range(96):
        chars = list(base[k % 12])
        for _ in range(rng.randrange(1, 9)):
            chars[rng.randrange(150, 600)] = rng.choice("xyz")
        rows.append((k, "".join(chars)))
    prints = [fingerprints.fingerprints([t])[0] for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if root[a] != root[b] and fingerprints.likeness(prints[a], prints[b]) >= 0.8:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    assert 12 <= len(set(root)) < 60
    assert {r.doc_id: r.group for r in fingerprints.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == dict(enumerate(root))
