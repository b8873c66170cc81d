"""The warehouse jobs on orders, line items, customers, parts and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from demesne.functions.scalars import cents
from demesne.plans import packages as K
from demesne.plans import warehouse as W
from demesne.queries.registry import query
from demesne.queries.shredding import BROKEN, packages

C = "CAST(round({} * 100) AS BIGINT)"


@query(
    "wl_customer_summary",
    f"SELECT c_custkey, c_name, count(o_orderkey) AS order_count, CAST(sum({C.format('o_totalprice')}) AS BIGINT) AS lifetime_cents FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY 1, 2",
)
def wl_customer_summary(t):
    orders = t["orders"].filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return W.summary_per_parent(t["customer"].select("c_custkey", "c_name"), orders, "c_custkey", "o_orderkey", cents("o_totalprice"), "order_count", "lifetime_cents")


@query(
    "wl_active_products",
    "SELECT s_suppkey, s_name, n_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 1000",
)
def wl_active_products(t):
    nation = F.broadcast(t["nation"])  # 25 rows at any scale
    return t["supplier"].filter("s_acctbal > 1000").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name", "s_acctbal")


@query(
    "wl_inventory_status",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_name, s_name, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey",
)
def wl_inventory_status(t):
    items = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    parts = t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_name")
    firms = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return items.join(parts, "l_partkey").join(firms, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "s_name", "l_quantity")


# target: customers of the first five segments but one; staging: rich customers with an upper-case name


@query(
    "wl_merge",
    """WITH tg AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'), st AS (SELECT c_custkey, upper(c_name) AS c_name, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal + 1 END AS c_acctbal FROM customer WHERE c_acctbal > 5000)
SELECT coalesce(tg.c_custkey, st.c_custkey) AS c_custkey, CASE WHEN st.c_custkey IS NOT NULL THEN st.c_name ELSE tg.c_name END AS c_name, CASE WHEN tg.c_custkey IS NULL THEN 'NEW' ELSE tg.c_mktsegment END AS c_mktsegment,
  CASE WHEN st.c_custkey IS NOT NULL THEN st.c_acctbal ELSE tg.c_acctbal END AS c_acctbal FROM tg FULL JOIN st ON tg.c_custkey = st.c_custkey""",
)
def wl_merge(t):
    target = t["customer"].filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    staged = t.sql("SELECT c_custkey, upper(c_name) AS c_name, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal + 1 END AS c_acctbal FROM {customer} WHERE c_acctbal > 5000")
    return W.upsert_by_key(target, staged, "c_custkey", ["c_name", "c_acctbal"], {"c_mktsegment": F.lit("NEW")})


@query(
    "wl_insert_new",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'",
)
def wl_insert_new(t):
    target = t["orders"].filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    staged = t["orders"].filter("o_orderpriority = '1-URGENT'").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return W.insert_new(target, staged, "o_orderkey")


@query(
    "wl_update_from",
    """WITH s AS (SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), t AS (SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS on_hand FROM lineitem GROUP BY 1, 2)
SELECT t.l_partkey, t.l_suppkey, CAST(coalesce(s.q, t.on_hand) AS BIGINT) AS on_hand FROM t LEFT JOIN s ON s.l_partkey = t.l_partkey AND s.l_suppkey = t.l_suppkey""",
)
def wl_update_from(t):
    keys = ["l_partkey", "l_suppkey"]
    target = t["lineitem"].groupBy(*keys).agg(F.count(F.lit(1)).alias("on_hand"))
    source = t["lineitem"].filter("l_returnflag = 'R'").groupBy(*keys).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("counted"))
    return W.update_from(target, source, keys, {"on_hand": F.col("counted")})


_OLD = "o_orderdate < TIMESTAMP '1996-01-01 00:00:00'"


@query(
    "wl_archive",
    f"""SELECT 'archived' AS part, o_orderkey AS k, CAST(NULL AS BIGINT) AS line FROM orders WHERE {_OLD} UNION ALL SELECT 'kept', o_orderkey, NULL FROM orders WHERE NOT ({_OLD})
UNION ALL SELECT 'line', l_orderkey, CAST(l_linenumber AS BIGINT) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {_OLD})""",
)
def wl_archive(t):
    old = F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    archived, kept, lines = W.archive_by_cutoff(t["orders"].select("o_orderkey", "o_orderdate"), t["lineitem"].select("l_orderkey", "l_linenumber"), "o_orderkey", "l_orderkey", old)
    show = lambda df, part, line: df.select(F.lit(part).alias("part"), F.col(df.columns[0]).alias("k"), line.cast("bigint").alias("line"))
    return show(archived, "archived", F.lit(None)).unionByName(show(kept, "kept", F.lit(None))).unionByName(show(lines, "line", F.col("l_linenumber")))


@query(
    "wl_reason_stats",
    f"SELECT c_mktsegment, count(*) AS order_count, CAST(sum({C.format('o_totalprice')}) AS BIGINT) AS revenue_cents FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def wl_reason_stats(t):
    customers = t["customer"].withColumnRenamed("c_custkey", "o_custkey")
    return W.stats_by_dimension(t["orders"], customers, "o_custkey", "c_mktsegment", cents("o_totalprice"), "order_count", "revenue_cents")


@query(
    "wl_validate_totals",
    f"""SELECT o_orderkey, {C.format('o_totalprice')} AS stated_total, CAST(sum({C.format('l_extendedprice')}) AS BIGINT) AS computed_total FROM orders JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_totalprice HAVING stated_total <> computed_total""",
)
def wl_validate_totals(t):
    details = t["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey")
    return W.validate_totals(t["orders"].select("o_orderkey", "o_totalprice"), details, "o_orderkey", cents("o_totalprice"), cents("l_extendedprice")).drop("o_totalprice")


@query(
    "wl_touch_changed",
    "SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN TIMESTAMP '2030-01-01 00:00:00' ELSE o_orderdate END AS modified FROM orders",
)
def wl_touch_changed(t):
    changed = t["lineitem"].filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    table = t["orders"].select("o_orderkey", F.col("o_orderdate").alias("modified"))
    return W.touch_changed(table, changed, "o_orderkey", "modified", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))


@query("wl_read_since", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")
def wl_read_since(t):
    since = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return W.read_since(t["orders"], "o_orderdate", since).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "wl_lookup",
    "SELECT o_orderkey, o_custkey, c_name, c_custkey IS NOT NULL AS matched FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey",
)
def wl_lookup(t):
    reference = t["customer"].filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return W.lookup_route(t["orders"].select("o_orderkey", "o_custkey"), reference, ["o_custkey"])


@query("wl_trim", "SELECT c_custkey, trim('  ' || c_name || ' ') AS name FROM customer")
def wl_trim(t):
    return W.trimmed(t["customer"].select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("raw")), "raw", "name").drop("raw")


@query(
    "wl_for_each_value",
    """SELECT r_name AS owner, o_orderpriority AS value, o_orderkey FROM region JOIN orders ON (r_regionkey < 2 AND o_orderpriority IN ('1-URGENT', '2-HIGH')) OR (r_regionkey >= 2 AND o_orderpriority = '5-LOW')""",
)
def wl_for_each_value(t):
    listed = t.sql("SELECT r_name AS owner, CASE WHEN r_regionkey < 2 THEN '1-URGENT, 2-HIGH,' ELSE '5-LOW' END AS list FROM {region}")
    rows = t["orders"].select("o_orderkey", "o_orderpriority")
    return W.for_each_value(rows, listed, "list", "value", "o_orderpriority").select("owner", "value", "o_orderkey")


@query(
    "wl_run_order",
    f"""WITH s AS (SELECT o_orderstatus AS project, 'hint' || o_orderkey AS name, o_orderpriority = '1-URGENT' AS scr FROM orders WHERE NOT ({BROKEN}))
SELECT project, name, task_name, CASE WHEN task_name = 'child' THEN 1 ELSE 0 END AS step FROM (SELECT project, name, unnest(['seq', 'run', 'loop', 'flow', 'child', 'unnamed_Custom.Task']) AS task_name FROM s UNION ALL SELECT project, name, 'script' FROM s WHERE scr)""",
)
def wl_run_order(t):
    keys = ["project", "name"]
    tasks, order = K.control_flow(packages(t), keys)
    return W.run_order(tasks, order, keys, "task_name", "from_task", "to_task")


@query(
    "wl_run_order_chain",
    """WITH RECURSIVE e AS (SELECT DISTINCT o_orderstatus AS p, o_custkey AS a, o_custkey + 1 AS b FROM orders WHERE o_orderpriority = '1-URGENT'), n AS (SELECT p, a AS x FROM e UNION SELECT p, b FROM e),
w AS (SELECT p, x, 0 AS d FROM n UNION ALL SELECT e.p, e.b, d + 1 FROM w JOIN e ON e.p = w.p AND e.a = w.x)
SELECT p AS project, x AS task, CAST(max(d) AS INTEGER) AS step FROM w GROUP BY 1, 2""",
)
def wl_run_order_chain(t):
    links = t["orders"].filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderstatus").alias("project"), F.col("o_custkey").alias("a"), (F.col("o_custkey") + 1).alias("b"))
    nodes = links.select("project", F.explode(F.array("a", "b")).alias("task"))
    return W.run_order(nodes, links, ["project"], "task", "a", "b")
