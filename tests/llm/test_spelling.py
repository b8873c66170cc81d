"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from demesne.llm import spelling
from demesne.llm.spelling import Tree, codes_of, letter_counts, one_edit

DOCS = "doc_id bigint, text string"


def brute_words(rows, least, every):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                total[w] += 1
    return total


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) - len(short) == 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute(rows, least, often, times, every):
    words = {w: n for w, n in brute_words(rows, least, every).items() if n >= often}
    out, form = {}, {}
    for w, n in words.items():
        found = [v for v in words if v != w and near(v, w)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= times * n else None
        out[w] = [n, len(found), form[w], words[best] if form[w] else None]
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def corpus(seed, letters, sizes, docs):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(60)]
    pool = list(base)
    for w in base:
        for _ in range(8):
            k = rng.randrange(len(w))
            pool.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :], "".join(rng.sample(w, len(w)))]))
    weight = [1 + 200 // (1 + k) for k in range(len(pool))]
    rows = [(i, " ".join(rng.choices(pool, weight, k=150)).title()) for i in range(docs)]
    return rows + [(None, "ÀÉÎõü×÷ xabcdef " + pool[0]), (3, None), (4, ""), (5, "short words no more"), (6, rows[0][1]), (6, rows[0][1])]


@pytest.mark.parametrize("letters,sizes", [("abcde", (4, 5, 6)), ("aàÀéÈü", (3, 4)), ("ab", (62, 63, 64, 65, 66)), ("thenrigs", (5, 6, 7, 300))])
def test_against_all_pairs(make, letters, sizes):
    rows = corpus(hash(letters) % 100, letters, sizes, 25)
    df = make(rows, DOCS).repartition(3)
    for c in ["word", "n", "form", "root", "best", "block", "cell", "kind"]:
        df = df.selectExpr("*", f"'{c}' AS `{c}`")
    assert got(spelling.spelling_variants(df, 3, 2, 3, 19)) == brute(rows, 3, 2, 3, 19)


def test_many_cells_and_blocks(make, monkeypatch):
    """Small cells, and blocks of cells that anagrams overfill, find the same."""
    rows = corpus(4, "abcdef", (6, 7), 30)
    monkeypatch.setattr(spelling, "BLOCK", 5)
    monkeypatch.setattr(spelling, "SAMPLE", 200)
    trees = spelling._fit(make([(w, n) for w, n in brute_words(rows, 3, 19).items()], "word string, n bigint"))
    assert max(len(t.leaves) for t in trees.values()) > 5
    assert got(spelling.spelling_variants(make(rows, DOCS), 3, 2, 3, 19)) == brute(rows, 3, 2, 3, 19)


def test_reach_misses_no_near_vector():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdef") for _ in range(6)) for _ in range(400)})
    v = letter_counts(*codes_of(words))
    for tight in (False, True):
        tree = Tree(v, 10, tight)
        assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(words)))
        home = tree.home(v)
        for leaf, own in enumerate(tree.leaves):
            assert (home[own] == leaf).all()
        met = {(i, p) for leaf, found in tree.reach(v, 1) for i in found.tolist() for p in tree.leaves[leaf].tolist()}
        near_ = {(i, p) for i in range(len(v)) for p in range(len(v)) if np.abs(v[i] - v[p]).sum() <= 2}
        assert near_ <= met and len(met) < len(v) ** 2


def test_one_edit():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(5))) for _ in range(80)]
    for a in words:
        for b in words:
            assert one_edit(a, b) == (a != b and near(a, b))


def test_chain_of_forms(make):
    """Forms lead on to a root over several steps; ties go to the smaller word."""
    rows = [(1, " ".join(["abcdefg"] * 2 + ["abcdefh"] * 10 + ["abcdeih"] * 50 + ["abckeih"] * 250 + ["qqqqqq"] * 2 + ["qqqqqb"] * 10 + ["qqqqqa"] * 10))]
    assert got(spelling.spelling_variants(make(rows, DOCS), 6, 2, 5, None)) == brute(rows, 6, 2, 5, 10**12)


def test_no_words(make):
    assert got(spelling.spelling_variants(make([], DOCS))) == {} and got(spelling.spelling_variants(make([(1, None), (2, "a b")], DOCS))) == {}
