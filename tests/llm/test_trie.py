"""The conversation trie against a plain rebuild in dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from demesne.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        made[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for seq in members:
        if seq:
            kids[seq[:-1]].append(seq)

    saved, leaves = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        saved[seq] = (len(members[seq]) - 1) * (len(seq[-1][1]) if seq else 0) + sum(saved[k] for k in kids[seq])
        leaves[seq] = sum(leaves[k] for k in kids[seq]) if kids[seq] else 1
    return sorted(
        (min(m), len(seq), min(members[seq[:-1]]) if seq else -1, len(m), len(kids[seq]), leaves[seq], saved[seq],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(seq)).encode()).hexdigest())
        for seq, m in members.items()
    )


def run(df, rebuild):
    c = F.col("c")
    out = trie.conversation_trie(df, c - c % 100, F.crc32(c.cast("string")) % 6, 5) if rebuild else trie.conversation_trie(df)
    assert out.columns == FIELDS
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def odd_rows():
    rng = random.Random(7)
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 1, "tool", "b"), (3, 1, None, "b"), (4, 0, "user", ""), (5, 7, "", None), (1000, 0, "user", "x" * 300_000)]
    for c in range(100, 180):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no é\U0001f600"])) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 240) for t in range(9)]  # one conversation many times
    rows += [(rng.choice([301, 302]), t, "user", "deep") for t in range(300)]  # chains
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_odd_rows(make, rebuild):
    rows = odd_rows()
    df = make(rows, SCHEMA).repartition(4)
    for c in ["c", "p", "a", "b", "size", "part", "name", "parent", "depth", "of", "step", "m"]:
        df = df.selectExpr("*", f"'{c}' AS `{c}`")
    assert run(df, rebuild) == brute(rows, rebuild)


def test_conversation_over_several_partitions(spark, make):
    rng = random.Random(2)
    rows = [(7, t, "user", rng.choice("ab")) for t in range(700)] + [(c, t, "user", "a") for c in (1, 9) for t in range(60)]
    default = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        df = make(rows, SCHEMA).repartition(5)
        places = trie.numbered(df).withColumn("at", F.spark_partition_id()).groupBy("c").agg(F.max("p").alias("p"), F.count_distinct("p").alias("n"), F.count_distinct("at").alias("parts")).collect()
        assert {r.c: (r.p, r.n) for r in places} == {1: (60, 60), 7: (700, 700), 9: (60, 60)}
        assert max(r.parts for r in places) >= 5  # the long one is dealt over tasks
        assert run(df, True) == brute(rows, True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", default)


def test_lists_of_keys(make):
    rows = [(bytes([n]), c) for n in (1, 2) for c in range(n * 40)]
    got = dict(trie.list_digests(make(rows, "name binary, c bigint").repartition(3)).collect())
    assert {bytes(k): v for k, v in got.items()} == {bytes([n]): hashlib.sha256(",".join(map(str, range(n * 40))).encode()).hexdigest() for n in (1, 2)}


def test_rounds_grow_with_the_logarithm_of_a_chain(monkeypatch, make):
    cuts = []
    monkeypatch.setattr(trie, "cut", lambda df: _kept(df, cuts))
    n = 600
    tree = make([(f"{d:04d}".encode(), f"{d - 1:04d}".encode() if d else None, d, int(d < n - 1), 1) for d in range(n)], "name binary, parent binary, depth bigint, n_children bigint, v bigint")
    got = {bytes(r.name): r.v for r in trie.subtree_totals(tree, ["v"]).collect()}
    assert got == {f"{d:04d}".encode(): n - d for d in range(n)}
    assert len(cuts) <= 40


def test_rounds_hold_no_joins(monkeypatch, make):
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return _kept(df, [])

    monkeypatch.setattr(trie, "cut", planned)
    n = 40  # a chain with a leaf beside every second node
    rows = [(d, d - 1 if d else None, d, int(d < n - 1) + d % 2, 1) for d in range(n)] + [(1000 + d, d, d + 1, 0, 5) for d in range(1, n, 2)]
    got = {r.name: r.v for r in trie.subtree_totals(make(rows, "name bigint, parent bigint, depth bigint, n_children bigint, v bigint"), ["v"]).collect()}
    assert got == {d: n - d + 5 * ((n - d + 1) // 2) for d in range(n)} | {1000 + d: 5 for d in range(1, n, 2)}
    joins = [p for p in plans if "Join" in p]
    assert len(joins) <= 3 and all(p.count("Join") == 1 and "strategy=merge" in p for p in joins)  # of the pointers, not of the rounds


def _kept(df, cuts):
    from demesne.session import cut

    cuts.append(1)
    return cut(df)


def test_no_conversations(make):
    assert run(make([], SCHEMA), True) == [] and run(make([(None, 1, "a", "b")], SCHEMA), False) == []
