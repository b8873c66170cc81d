import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demesne.plans import changes as C
from demesne.plans import compare

RESULT = "engine string, object_name string, status string, referenced_tables array<string>, referenced_procs array<string>, notes string"


def test_report_and_stats(make):
    corpus = make([("a",), ("b",), ("c",)], "object_name string")
    good = make([("x", "a", "resolved", ["s.T", "s.U", "s.T"], ["p"], None), ("x", "b", "unresolved", [], [], "why"), ("x", "c", "error", [], [], None)], RESULT)
    other = make([("y", "a", "resolved", ["s.U", "s.t"], [], None), ("y", "b", "resolved", [], [], None)], RESULT)

    def boom(_):
        raise RuntimeError("y exploded")

    results, stats, report = compare.run_comparison(corpus, {"x": lambda c: good, "y": lambda c: other, "z": boom})
    got = {r["object_name"]: r for r in report.collect()}
    assert (got["a"]["tables_agree"], got["a"]["tables_only_in_x"], got["a"]["tables_only_in_y"]) == (False, ["s.T"], ["s.t"])
    assert (got["b"]["tables_agree"], got["b"]["x_notes"], got["c"]["y_status"], got["c"]["z_status"]) == (True, "why", "missing", "error")
    s = {r["engine"]: r for r in stats.collect()}
    assert (s["x"]["resolved"], s["x"]["unresolved"], s["x"]["failed"], s["x"]["success_rate_pct"]) == (1, 1, 1, 33.33)
    assert (s["z"]["available"], s["z"]["failed"], s["z"]["success_rate_pct"]) == (True, 3, 0.0)
    assert "exploded" in results.filter("engine = 'z'").first()["notes"]
    gone = compare.engine_stats(compare.failed_results(corpus, "w", compare.UNAVAILABLE, "not there"))
    assert (gone.first()["available"], gone.first()["resolved"]) == (False, 0)


def test_empty_corpus_and_single_engine(make):
    results, stats, report = compare.run_comparison(make([], "object_name string"), {"x": lambda c: make([], RESULT)})
    assert report.count() == stats.count() == results.count() == 0 and "tables_agree" not in report.columns


def test_set_comparison_equals_brute_force(make):
    rnd = random.Random(3)
    rows = [(rnd.choice("kk" + "lmn"), rnd.choice("ab"), rnd.randint(0, 30)) for _ in range(400)]
    df = make(rows, "k string, e string, i int")
    spine = make([(k,) for k in "klmno"], "k string")
    got = {r["k"]: (r["only_in_a"], r["only_in_b"], r["agree"]) for r in compare.compare_labelled_sets(spine, df, ["k"], "e", "i", "a", "b").collect()}
    diff = {tuple(r) for r in compare.set_difference(df, ["k"], "e", "i", "a", "b").collect()}
    want, wdiff = {}, set()
    for k in "klmno":
        a, b = ({i for x, e, i in rows if x == k and e == s} for s in "ab")
        want[k] = (len(a - b), len(b - a), a == b)
        wdiff |= {(k, i, "a") for i in a - b} | {(k, i, "b") for i in b - a}
    assert got == want and diff == wdiff


MARK = "object_id string, object_type string, fingerprint string"
STATE = MARK + ", last_run_id string, last_seen_at timestamp"


def test_change_detection_upsert_and_carry(make):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    state = make([("a", "t", "1", "r1", t1), ("b", "t", "1", "r1", t1), ("gone", "t", "1", "r1", t1)], STATE)
    current = make([("a", "t", "1"), ("b", "t", "2"), ("c", "t", "1")], MARK)
    change = C.detect_changes(current, state)
    assert {r["object_id"]: r["change"] for r in change.collect()} == {"a": "unchanged", "b": "changed", "c": "new"}
    after = C.upsert_fingerprints(state, C.to_process(change), "r2", F.lit(t2))
    assert {r["object_id"]: (r["fingerprint"], r["last_run_id"]) for r in after.collect()} == {"a": ("1", "r1"), "b": ("2", "r2"), "c": ("1", "r2"), "gone": ("1", "r1")}
    assert {r["change"] for r in C.detect_changes(current, after).collect()} == {"unchanged"}
    fresh, old = make([("b", "new"), ("c", "new")], "object_id string, v string"), make([("a", "old"), ("b", "old"), ("gone", "old")], "object_id string, v string")
    assert sorted(map(tuple, C.carry_forward(fresh, old, change).collect())) == [("a", "old"), ("b", "new"), ("c", "new")]


def test_ledger_counts_weights(make):
    change = make([("a", "unchanged", 5), ("b", "new", 5), ("c", "changed", 2)], "object_id string, change string, w int")
    actions = C.change_actions(change, F.lit("r"), F.col("w"))
    assert tuple(C.run_counters(actions).first()) == ("r", 7, 1, 0)


def test_review_queue_order_and_cap(make):
    procs = make([("p2", "unresolved"), ("p1", "unresolved"), ("ok", "sqlglot")], "object_id string, parse_status string")
    sql = make([("k1s", "k1", [1], 0, "unresolved"), ("k1ok", "k1", [0], 0, "sqlglot")], "object_id string, package string, path array<int>, statement_no int, parse_status string")
    scripts = make([("k1x", "k1", [0]), ("k0x", "k0", [2])], "object_id string, package string, path array<int>")
    queue = C.review_queue(C.review_items(procs, sql, scripts), ["phase", "package", "part", "path", "object_id"], 3)
    rows = {r["object_id"]: (r["place"], r["needs_human_review"]) for r in queue.collect()}
    assert rows == {"p1": (1, True), "p2": (2, True), "k0x": (3, True), "k1s": (None, True), "k1x": (None, True)}


@pytest.mark.parametrize("cap", [0, 100])
def test_review_cap_extremes_keep_all_items(make, cap):
    items = make([(f"o{i}", i) for i in range(10)], "object_id string, phase int")
    got = C.review_queue(items, ["phase", "object_id"], cap).collect()
    assert len(got) == 10 and sum(r["within_budget"] for r in got) == min(cap, 10)


def test_same_name_in_two_databases_is_two_objects(make):
    corpus = make([("d1", "s.p"), ("d2", "s.p")], "database string, object_name string")
    results = make(
        [("x", "d1", "s.p", "resolved", ["s.a"], [], None), ("y", "d1", "s.p", "resolved", ["s.a"], [], None), ("x", "d2", "s.p", "resolved", ["s.b"], [], None), ("y", "d2", "s.p", "resolved", ["s.c"], [], None)],
        "engine string, database string, object_name string, status string, referenced_tables array<string>, referenced_procs array<string>, notes string",
    )
    got = {r["database"]: (r["x_referenced_tables"], r["tables_agree"]) for r in compare.object_report(corpus, results, ["x", "y"]).collect()}
    assert got == {"d1": (["s.a"], True), "d2": (["s.b"], False)}
