import random

import pytest
from pyspark.sql import functions as F

from demesne.plans import warehouse as W


def test_upsert_overwrites_with_staged_nulls(make):
    target = make([(1, "a", "A"), (2, "b", "B")], "k int, v string, own string")
    staged = make([(2, None), (3, "c"), (None, "n")], "k int, v string")
    got = {r["k"]: (r["v"], r["own"]) for r in W.upsert_by_key(target, staged, "k", ["v"], {"own": F.lit("new")}).collect()}
    assert got == {1: ("a", "A"), 2: (None, "B"), 3: ("c", "new"), None: ("n", "new")}


def test_insert_update_archive(make):
    target = make([(1, 10), (2, 20)], "k int, v int")
    assert sorted(map(tuple, W.insert_new(target, make([(2, 99), (3, 30)], "k int, v int"), "k").collect())) == [(1, 10), (2, 20), (3, 30)]
    assert sorted(map(tuple, W.update_from(target, make([(2, 7)], "k int, n int"), ["k"], {"v": F.col("n")}).collect())) == [(1, 10), (2, 7)]
    parents, lines = make([(1, 5), (2, 50), (3, None)], "k int, d int"), make([(1, 1), (2, 1), (3, 1)], "o int, l int")
    archived, kept, rest = W.archive_by_cutoff(parents, lines, "k", "o", F.col("d") < 10)
    assert [r["k"] for r in archived.collect()] == [1]
    assert sorted(r["k"] for r in kept.collect()) == [2, 3] and sorted(r["o"] for r in rest.collect()) == [2, 3]


def test_totals_stats_and_touch(make):
    heads, lines = make([(1, 30), (2, 5), (3, 0)], "k int, t int"), make([(1, 10), (1, 20), (2, 4)], "k int, a int")
    assert [r["k"] for r in W.validate_totals(heads, lines, "k", F.col("t"), F.col("a")).collect()] == [2]
    summary = {r["k"]: (r["n"], r["s"]) for r in W.summary_per_parent(heads, lines, "k", "a", F.col("a"), "n", "s").collect()}
    assert summary == {1: (2, 30), 2: (1, 4), 3: (0, None)}
    touched = W.touch_changed(heads, make([(2,), (2,)], "k int"), "k", "t", F.lit(99))
    assert sorted(map(tuple, touched.collect())) == [(1, 30), (2, 99), (3, 0)]


def test_loop_over_listed_values(make):
    rows = make([("EAST", 1), ("WEST", 2), ("NORTH", 3)], "region string, i int")
    got = W.for_each_value(rows, make([("p", "EAST, WEST,")], "pkg string, list string"), "list", "value", "region")
    assert sorted((r["value"], r["i"]) for r in got.collect()) == [("EAST", 1), ("WEST", 2)]


def test_run_order_of_chains_and_cycles(make):
    nodes = make([("p", n) for n in "abcdxyz"], "p string, n string")
    links = make([("p", "a", "b"), ("p", "b", "c"), ("p", "a", "c"), ("p", "x", "y"), ("p", "y", "x"), ("p", "y", "z"), ("p", "ghost", "d")], "p string, f string, t string")
    got = {r["n"]: r["step"] for r in W.run_order(nodes, links, ["p"], "n", "f", "t").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 0, "x": None, "y": None, "z": None}


def longest(nodes, links):
    """Steps by plain recursion; None on and behind cycles."""
    before = {n: {a for a, b in links if b == n and a in nodes} for n in nodes}
    step = {}
    while ready := [n for n in nodes if n not in step and before[n] <= set(step)]:
        step.update({n: max((step[a] + 1 for a in before[n]), default=0) for n in ready})
    return {n: step.get(n) for n in nodes}


@pytest.mark.parametrize("seed", range(4))
def test_run_order_of_random_graphs(make, seed):
    rng = random.Random(seed)
    nodes, links = [], []
    for p in "pqr":
        names = [f"{p}{i}" for i in range(14)]
        nodes += names
        links += [(names[min(a, b)], names[max(a, b)]) for a, b in (rng.sample(range(14), 2) for _ in range(rng.randrange(6, 22)))]
        if p != "p":  # cycles, and tasks that run into them
            links += [(rng.choice(names), rng.choice(names)) for _ in range(3)]
    made = W.run_order(make([(n[0], n) for n in nodes], "p string, n string"), make([(a[0], a, b) for a, b in links], "p string, f string, t string"), ["p"], "n", "f", "t")
    assert {r["n"]: r["step"] for r in made.collect()} == longest(nodes, links)


def test_run_order_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    cuts = []
    cut = W.cut
    monkeypatch.setattr(W, "cut", lambda df: cuts.append(1) or cut(df))
    nodes = spark.range(10_000).selectExpr("'p' AS p", "id AS n")
    links = nodes.selectExpr("p", "n AS f", "n + 1 AS t").union(nodes.where("n % 1000 = 0 AND n > 0").selectExpr("p", "n DIV 2 AS f", "n AS t"))
    got = W.run_order(nodes, links, ["p"], "n", "f", "t").where("step = n").count()
    assert got == 10_000 and len(cuts) <= 25


def test_watermark_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "m").write.parquet(str(tmp_path / "t"))
    df = W.read_since(spark.read.parquet(str(tmp_path / "t")), "m", F.lit(5))
    assert df.count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(m,5)" in plan


def test_run_order_broadcasts_nothing(make):
    tasks = make([("p", f"t{i}") for i in range(6)], "scope string, task string")
    links = make([("p", f"t{i}", f"t{i + 1}") for i in range(4)] + [("p", "t0", "t3")], "scope string, a string, b string")
    out = W.run_order(tasks, links, ["scope"], "task", "a", "b")
    assert sorted((r["task"], r["step"]) for r in out.collect()) == [("t0", 0), ("t1", 1), ("t2", 2), ("t3", 3), ("t4", 4), ("t5", 0)]
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_run_order_of_short_chains_deals_the_nodes_twice(make, monkeypatch):
    """Where no task waits for several, nothing is done for such; nodes are dealt to find the sources and to be placed, and sorted once."""
    cuts = []
    cut = W.cut
    monkeypatch.setattr(W, "cut", lambda df: cuts.append(1) or cut(df))
    nodes = make([("p", n) for n in "abbcd"] + [("q", "b")], "p string, n string")
    links = make([("p", "a", "b"), ("p", "a", "b"), ("p", "c", "gone"), ("p", "gone", "d"), ("q", "a", "b")], "p string, f string, t string")
    out = W.run_order(nodes, links, ["p"], "n", "f", "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(cuts) == 3
    assert sorted(map(tuple, out.collect())) == [("p", "a", 0), ("p", "b", 1), ("p", "c", 0), ("p", "d", 0), ("q", "b", 0)]
