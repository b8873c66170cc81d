import random

import pytest
from pyspark.sql import functions as F

from demesne.operators import counters, keyed, lists, membership


@pytest.fixture(scope="module")
def hot(make):
    """One key with a third of all rows."""
    rnd = random.Random(7)
    rows = [("hot", i) for i in range(1000)] + [(f"k{i % 400}", i) for i in range(2000)]
    rnd.shuffle(rows)
    return make(rows, "k string, i long"), rows


def test_keyed_rows_equal_brute_force(hot):
    df, rows = hot
    want_last, want_first = {}, {}
    for k, i in rows:
        want_last[k] = max(want_last.get(k, -1), i)
        want_first[k] = min(want_first.get(k, 10**9), i)
    assert dict(map(tuple, keyed.latest_per_key(df, ["k"], ["i"]).collect())) == want_last
    assert dict(map(tuple, keyed.first_wins(df, ["k"], ["i"]).collect())) == want_first


def test_earliest_takes_columns_together(make):
    df = make([("j", 20240616, 20000), ("j", 20240617, 10000)], "job string, d int, t int")
    assert [tuple(r) for r in keyed.earliest(df, ["job"], ["d", "t"]).collect()] == [("j", 20240616, 20000)]


def test_share_and_budget(make):
    df = make([("a", 100, 1), ("a", 400, 2), ("a", 500, 3), ("b", 0, 4)], "db string, size long, id int")
    got = {r["id"]: r["pct"] for r in keyed.share_of_total(df, "size", ["db"], "pct").collect()}
    assert got == {1: 10.0, 2: 40.0, 3: 50.0, 4: None}
    marked = keyed.mark_within_budget(df, ["id"], ["size", "id"], 2).orderBy("id").collect()
    assert [(r["id"], r["place"], r["within_budget"]) for r in marked] == [(1, 2, True), (2, None, False), (3, None, False), (4, 1, True)]


def test_top_n_cuts_before_the_shuffle(hot):
    df, rows = hot
    top = keyed.top_n(df, ["k"], [F.col("i").desc()], 3)
    want = sorted((k, i) for k in {r[0] for r in rows} for i in sorted((x for y, x in rows if y == k), reverse=True)[:3])
    assert sorted((r["k"], r["i"]) for r in top.collect()) == want
    # planned afresh, the text holds one plan: a limit on either side of the exchange
    plan = keyed.top_n(df, ["k"], [F.col("i").desc()], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_lists_keep_their_order(make):
    df = make([("fk", 2, "b", "y"), ("fk", 1, "a", "x")], "name string, ord int, p string, r string")
    got = lists.ordered_list(df, ["name"], ["ord"], ["p", "r"]).collect()
    assert [tuple(r) for r in got] == [("fk", ["a", "b"], ["x", "y"])]


def test_lists_stay_whole_and_are_planned_without_a_job(hot, spark):
    df, rows = hot
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job may run")
    listed = lists.nest(df, ["k"], ["i"], ["i"], "items")
    assert not tracker.getJobIdsForGroup("planning")
    for r in listed.collect():
        want = sorted(i for k, i in rows if k == r["k"])
        assert [x["i"] for x in r["items"]] == want and r["items_count"] == len(want)


def test_split_and_nest(make):
    df = make([("ix", 1, False, "a", True), ("ix", 2, False, "b", False), ("ix", 3, True, "c", False)], "n string, o int, inc boolean, c string, d boolean")
    row = lists.split_list(df, ["n"], ["o"], "inc", "c", "d").first()
    assert (row["key_columns"], row["key_column_sort"], row["included_columns"]) == (["a", "b"], ["DESC", "ASC"], ["c"])
    row = lists.nest(df, ["n"], ["o"], ["c"], "steps").first()
    assert ([s["c"] for s in row["steps"]], row["steps_count"]) == (["a", "b", "c"], 3)


def test_null_keys_keep_their_group(make):
    df = make([(None, 1), (None, 2), ("a", 3)], "k string, i int")
    got = {r["k"]: r["i"] for r in lists.ordered_list(df, ["k"], ["i"], ["i"]).collect()}
    assert got == {None: [1, 2], "a": [3]}


def test_counts_do_not_multiply(make):
    parents = make([(1,), (2,)], "id int")
    a, b = make([(1,), (1,), (3,)], "id int"), make([(1,), (1,), (1,)], "id int")
    got = {r["id"]: (r["x"], r["y"]) for r in membership.child_counts(parents, ["id"], {"x": a, "y": b}).collect()}
    assert got == {1: (2, 3), 2: (0, 0)}
    flags = {r["id"]: r["f"] for r in membership.exists_flag(parents, a, ["id"], "f").collect()}
    assert flags == {1: True, 2: False}


def test_degrees_repeats_and_ratio(make):
    e = make([("d", "a", "b"), ("d", "a", "b"), ("d", "c", "b")], "db string, s string, t string")
    got = {r["node"]: (r["out_degree"], r["in_degree"]) for r in counters.degrees(e, ["db"], "s", "t").collect()}
    assert got == {"a": (1, 0), "b": (0, 2), "c": (1, 0)}
    assert counters.repeated_values(e, ["db"], "s", "n").first()["n"] == 1
    assert make([(1, 0)], "a int, b int").agg(counters.ratio(F.col("a"), F.col("b")).alias("r")).first()["r"] is None


def test_last_definition_wins_for_bare_names(make):
    defs = make([("a.T", 1), ("b.t", 2)], "name string, o int")
    catalog = membership.bare_catalog(defs, [], "name", ["o"], "full")
    rows = make([("T",), ("x",)], "n string")
    assert [r["full"] for r in membership.match_bare(rows, catalog, [], F.col("n")).collect()] == ["b.t"]


def test_sides_that_meet_are_those_of_left_joins(spark):
    base = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (None, 2, "d")], "k int, j int, v string")
    one = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (None, 2, 12), (3, 3, 13)], "k int, j int, x int")
    two = spark.createDataFrame([(1, 2, 20), (1, 1, None)], "k int, j int, y int")
    joined = base.join(one, ["k", "j"], "left").join(two, ["k", "j"], "left")
    met = membership.meet(["k", "j"], base.repartition("k"), {"one": one.repartition("k"), "two": two.repartition("k")})
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 3
    assert met.columns == joined.columns
    assert sorted(map(str, met.collect())) == sorted(map(str, joined.collect()))
