"""Change detection, carried results, ledger and review queue on the given rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from demesne.functions.scalars import fingerprint
from demesne.plans import changes as C
from demesne.plans import packages as K
from demesne.plans.references import mine
from demesne.queries.mining import definitions
from demesne.queries.registry import query
from demesne.queries.shredding import BROKEN, packages
from demesne.session import cut

# the earlier snapshot: orders in process were not there yet, urgent ones had another price


def current(t):
    return t["orders"].select(
        F.concat(F.lit("o"), "o_orderkey").alias("object_id"), F.lit("order").alias("object_type"),
        fingerprint("o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)")).alias("fingerprint"),
    )


def previous(t):
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return t["orders"].filter("o_orderstatus <> 'P'").select(
        F.concat(F.lit("o"), "o_orderkey").alias("object_id"), F.lit("order").alias("object_type"),
        fingerprint("o_orderstatus", price.cast("decimal(18,2)")).alias("fingerprint"),
        F.lit("run1").alias("last_run_id"), F.col("o_orderdate").alias("last_seen_at"),
    )


_FP = "sha256(o_orderstatus || ':' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR))"
_CHANGE = "CASE WHEN o_orderstatus = 'P' THEN 'new' WHEN o_orderpriority = '1-URGENT' THEN 'changed' ELSE 'unchanged' END"


@query("change_detection", f"SELECT 'o' || o_orderkey AS object_id, 'order' AS object_type, {_FP} AS fingerprint, {_CHANGE} AS change FROM orders")
def change_detection(t):
    return C.detect_changes(current(t), previous(t))


@query(
    "carry_forward",
    f"SELECT 'o' || o_orderkey AS object_id, CASE WHEN {_CHANGE} = 'unchanged' THEN 'earlier' ELSE 'now' END AS result FROM orders",
)
def carry_forward(t):
    change = C.detect_changes(current(t), previous(t))
    fresh = C.to_process(change).select("object_id", F.lit("now").alias("result"))
    earlier = previous(t).select("object_id", F.lit("earlier").alias("result"))
    return C.carry_forward(fresh, earlier, change)


@query(
    "fingerprint_upsert",
    f"SELECT 'o' || o_orderkey AS object_id, 'order' AS object_type, {_FP} AS fingerprint, 'run2' AS last_run_id, TIMESTAMP '2030-01-01 00:00:00' AS last_seen_at FROM orders WHERE {_CHANGE} <> 'unchanged'\n"
    f"UNION ALL SELECT 'o' || o_orderkey, 'order', {_FP}, 'run1', o_orderdate FROM orders WHERE {_CHANGE} = 'unchanged'",
)
def fingerprint_upsert(t):
    todo = C.to_process(C.detect_changes(current(t), previous(t)))
    state = previous(t).withColumn("last_seen_at", F.col("last_seen_at").cast("timestamp"))
    return C.upsert_fingerprints(state, todo, "run2", F.lit("2030-01-01 00:00:00").cast("timestamp"))


@query(
    "run_ledger",
    f"""SELECT o_orderpriority AS run_id, TIMESTAMP '2030-01-01 00:00:00' AS started_at, TIMESTAMP '2030-01-01 01:00:00' AS finished_at,
  CAST(sum(CASE WHEN {_CHANGE} <> 'unchanged' THEN coalesce(n, 0) + 1 ELSE 0 END) AS BIGINT) AS objects_scanned, CAST(count_if({_CHANGE} = 'unchanged') AS BIGINT) AS objects_skipped_unchanged, CAST(count_if(n IS NULL) AS BIGINT) AS objects_failed
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""",
)
def run_ledger(t):
    change = C.detect_changes(current(t), previous(t))
    runs = t["orders"].select(F.concat(F.lit("o"), "o_orderkey").alias("object_id"), F.col("o_orderpriority").alias("run_id"))
    tasks = t["lineitem"].groupBy(F.concat(F.lit("o"), "l_orderkey").alias("object_id")).agg(F.count(F.lit(1)).alias("tasks"))
    weighed = change.join(runs, "object_id").join(tasks, "object_id", "left")
    actions = C.change_actions(weighed, F.col("run_id"), F.coalesce("tasks", F.lit(0)) + 1)
    failed = weighed.filter("tasks is null").select("run_id", F.lit("failed").alias("action"), F.lit(1).cast("bigint").alias("weight"))
    at = lambda s: F.lit(s).cast("timestamp")
    return C.ledger_row(C.run_counters(actions.unionByName(failed)), at("2030-01-01 00:00:00"), at("2030-01-01 01:00:00"))


@query(
    "review_queue",
    f"""WITH q AS (SELECT 'o' || o_orderkey AS object_id, 0 AS phase, '' AS package, 0 AS part FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'
  UNION ALL SELECT 'hint' || o_orderkey || '::script', 1, o_orderstatus || '.' || CASE WHEN o_orderstatus = 'F' THEN 'hint' ELSE 'Pkg' END || o_orderkey, 1 FROM orders WHERE o_orderpriority = '1-URGENT' AND NOT ({BROKEN})),
r AS (SELECT *, row_number() OVER (ORDER BY phase, package, part, object_id) AS rn FROM q)
SELECT object_id, CAST(phase AS INTEGER) AS phase, package, CAST(part AS INTEGER) AS part, CASE WHEN rn <= 500 THEN CAST(rn AS INTEGER) END AS place, rn <= 500 AS within_budget,
  CASE WHEN rn <= 500 THEN 'queued' ELSE 'run cap of 500 objects reached' END AS note, TRUE AS needs_human_review FROM r""",
)
def review_queue(t):
    procs = mine(definitions(t)).select(F.concat(F.lit("o"), "o_orderkey").alias("object_id"), "parse_status")
    tasks = cut(K.task_rows(packages(t), ["project", "name"]))
    package = F.concat_ws(".", "project", "package").alias("package")
    scripts = tasks.filter("unparseable_body").select(F.concat_ws("::", "name", "task_name").alias("object_id"), package, "path")
    statements = mine(K.statement_rows(tasks, ["project", "name"]).withColumn("object_type", F.lit("embedded_sql")), text="sql_text")
    sql = statements.select(F.concat_ws("::", "name", "task_name").alias("object_id"), package, "path", "statement_no", "parse_status")
    items = cut(C.review_items(procs, sql, scripts))  # ranked and joined back, so built once
    return C.review_queue(items, ["phase", "package", "part", "path", "object_id"], 500).drop("path")
