"""Generic operators on fact, event and text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from demesne.functions import scalars as S
from demesne.operators import counters, keyed, lists, membership
from demesne.plans import edges, summary
from demesne.queries.registry import pct, query
from demesne.sources.files import split_batches

CENTS = "CAST(round({} * 100) AS BIGINT)"

# --- one row per key ---


@query(
    "latest_event_per_user",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
)
def latest_event_per_user(t):
    return keyed.latest_per_key(t["events"], ["user_id"], ["event_id"])


@query(
    "latest_error_per_user",
    """SELECT user_id AS job_id, strftime(arg_max(ts, event_id), '%Y-%m-%d') AS last_run_date, max(event_id) AS instance_id
FROM events WHERE event_type = 'error' GROUP BY 1""",
)
def latest_error_per_user(t):
    errors = t["events"].filter("event_type = 'error'").select("user_id", "event_id", "ts")
    last = keyed.latest_per_key(errors, ["user_id"], ["event_id"])
    return last.select(
        F.col("user_id").alias("job_id"), F.date_format("ts", "yyyy-MM-dd").alias("last_run_date"), F.col("event_id").alias("instance_id")
    )


@query(
    "category_max_dates",
    """SELECT user_id, max(CASE WHEN event_type = 'view' THEN ts END) AS last_view, max(CASE WHEN event_type = 'click' THEN ts END) AS last_click,
  max(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase,
  greatest(max(CASE WHEN event_type = 'view' THEN ts END), max(CASE WHEN event_type = 'click' THEN ts END), max(CASE WHEN event_type = 'purchase' THEN ts END)) AS last_any
FROM events WHERE value > 20 GROUP BY user_id""",
)
def category_max_dates(t):
    kinds = {f"last_{k}": F.col("event_type") == k for k in ("view", "click", "purchase")}
    dates = keyed.conditional_max(t["events"].filter("value > 20"), ["user_id"], "ts", kinds)
    return dates.withColumn("last_any", S.latest_of(*kinds))


@query(
    "earliest_next_run",
    """SELECT user_id AS job_id, CAST(min(p) // 1000000 AS INTEGER) AS next_run_date, CAST(min(p) % 1000000 AS INTEGER) AS next_run_time FROM (
  SELECT user_id, (year(ts) * 10000 + month(ts) * 100 + day(ts)) * CAST(1000000 AS BIGINT) + hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS p
  FROM events WHERE event_type <> 'error') GROUP BY 1""",
)
def earliest_next_run(t):
    packed = t.sql("""SELECT user_id AS job_id, CASE WHEN event_type = 'error' THEN 0 ELSE year(ts) * 10000 + month(ts) * 100 + day(ts) END AS next_run_date,
        CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS INT) AS next_run_time FROM {events}""")
    return keyed.earliest(packed.filter("next_run_date > 0"), ["job_id"], ["next_run_date", "next_run_time"])


@query(
    "first_wins_dedupe",
    """SELECT user_id, event_type, arg_min(value, event_id) AS value, min(event_id) AS event_id FROM events GROUP BY 1, 2""",
)
def first_wins_dedupe(t):
    return keyed.first_wins(t["events"].select("user_id", "event_type", "value", "event_id"), ["user_id", "event_type"], ["event_id"])


@query(
    "topn_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place
FROM orders QUALIFY place <= 10""",
)
def topn_per_group(t):
    return keyed.top_n(
        t["orders"].select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10
    )


@query(
    "topn_global",
    """SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def topn_global(t):
    return keyed.top_n(t["orders"].select("o_orderkey", "o_totalprice"), [], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query(
    "argmax_name",
    """SELECT c_nationkey, arg_min(c_name, struct_pack(a := -c_acctbal, b := c_name)) AS richest FROM customer GROUP BY 1""",
)
def argmax_name(t):
    return keyed.argmax(t["customer"], ["c_nationkey"], "c_name", "c_acctbal", "richest")


@query(
    "share_of_total",
    f"SELECT o_orderkey, o_custkey, {CENTS.format('o_totalprice')} AS cents, {pct(CENTS.format('o_totalprice'), '(sum(' + CENTS.format('o_totalprice') + ') OVER (PARTITION BY o_custkey))')} AS share_pct FROM orders",
)
def share_of_total(t):
    priced = t["orders"].select("o_orderkey", "o_custkey", S.cents("o_totalprice").alias("cents"))
    return keyed.share_of_total(priced, "cents", ["o_custkey"], "share_pct")


@query(
    "pct_of_parent",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, {CENTS.format('l_extendedprice')} AS cents,
  {pct(CENTS.format('l_extendedprice'), CENTS.format('o_totalprice'))} AS pct_of_order
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""",
)
def pct_of_parent(t):
    items = t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", S.cents("l_extendedprice").alias("cents"))
    totals = t["orders"].filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), S.cents("o_totalprice").alias("total"))
    return keyed.percent_of_total(items, totals, ["l_orderkey"], "cents", "total", "pct_of_order").drop("total")


@query(
    "budget_queue",
    """WITH q AS (SELECT d.doc_id, n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL OR quality = 0),
r AS (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM q)
SELECT doc_id, n_chars, CASE WHEN rn <= 100 THEN CAST(rn AS INTEGER) END AS place, rn <= 100 AS within_budget FROM r""",
)
def budget_queue(t):
    open_docs = t["documents"].join(t["labels"], "doc_id", "left").filter("quality is null or quality = 0")
    items = open_docs.select("doc_id", "n_chars", (-F.col("n_chars")).alias("size_rank"))
    return keyed.mark_within_budget(items, ["doc_id"], ["size_rank", "doc_id"], 100).drop("size_rank")


# --- scalar functions ---


@query(
    "packed_date_decode",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS run_date, strftime(ts, '%H:%M:%S') AS run_time,
  CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS run_at, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events""",
)
def packed_date_decode(t):
    packed = t.sql("""SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 0 ELSE year(ts) * 10000 + month(ts) * 100 + day(ts) END AS d,
        CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS INT) AS s FROM {events}""")
    day, time = S.decode_int_date("d"), S.decode_int_time("s")
    return packed.select("event_id", day.alias("run_date"), time.alias("run_time"), S.combine_date_time(day, time).alias("run_at"), S.iso_text("ts").alias("iso"))


@query(
    "code_labels",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Retry' WHEN 3 THEN 'Canceled' WHEN 4 THEN 'In Progress' END AS run_status,
  CASE l_linenumber WHEN 1 THEN 'Quit With Success' WHEN 2 THEN 'Quit With Failure' WHEN 3 THEN 'Go To Next Step' WHEN 4 THEN 'Go To Step' END AS step_action,
  CASE l_linenumber WHEN 1 THEN 'Once' WHEN 4 THEN 'Daily' ELSE 'Unknown' END || CASE WHEN l_linenumber = 4 AND l_suppkey % 3 <> 0 THEN ' (interval=' || (l_suppkey % 3) || ')' ELSE '' END AS schedule
FROM lineitem""",
)
def code_labels(t):
    n = F.col("l_linenumber")
    return t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        S.map_code(n, S.RUN_STATUS).alias("run_status"),
        S.map_code(n, S.STEP_ACTION).alias("step_action"),
        S.schedule_label(n, F.col("l_suppkey") % 3).alias("schedule"),
    )


@query(
    "tri_state_flags",
    """SELECT d.doc_id, CAST(quality AS BOOLEAN) AS is_good, NOT coalesce(CAST(toxic AS BOOLEAN), FALSE) AS is_clean, CASE WHEN lang = 'en' THEN TRUE ELSE FALSE END AS is_english,
  CASE WHEN quality = 1 THEN 'GOOD' ELSE 'OTHER' END AS label, CAST(coalesce(quality, 0) AS BIGINT) AS quality_count, nullif(n_chars, 0) AS n_chars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def tri_state_flags(t):
    return t["documents"].join(t["labels"], "doc_id", "left").select(
        "doc_id",
        S.tri_state("quality").alias("is_good"),
        S.inverted("toxic").alias("is_clean"),
        S.state_is("lang", "en").alias("is_english"),
        S.choose(F.col("quality") == 1, "GOOD", "OTHER").alias("label"),
        S.or_zero("quality").alias("quality_count"),
        S.null_if("n_chars", 0).alias("n_chars"),
    )


@query(
    "fingerprint_rows",
    "SELECT o_orderkey, sha256(o_orderkey || ':' || o_orderstatus || ':' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) || ':' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END) AS fingerprint FROM orders",
)
def fingerprint_rows(t):
    shown = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return t["orders"].select("o_orderkey", S.fingerprint("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)"), shown).alias("fingerprint"))


@query("fingerprint_texts", "SELECT doc_id, sha256(text) AS fingerprint FROM documents")
def fingerprint_texts(t):
    return t.spread("documents", "doc_id").select("doc_id", S.fingerprint("text").alias("fingerprint"))


_CONN = "'Data Source=srv' || o_custkey || ';User Id=u' || o_orderkey || ';{} = s3cret' || o_orderkey || ';Timeout=' || o_orderstatus"


@query(
    "redact_secrets",
    "SELECT o_orderkey, 'Data Source=srv' || o_custkey || ';User Id=u' || o_orderkey || ';' || CASE WHEN o_orderstatus = 'F' THEN 'PWD' ELSE 'Password' END || '=***REDACTED***;Timeout=' || o_orderstatus AS connection FROM orders",
)
def redact_secrets(t):
    text = t.sql("SELECT o_orderkey, " + f"CASE WHEN o_orderstatus = 'F' THEN {_CONN.format('PWD')} ELSE {_CONN.format('Password')} END AS c" + " FROM {orders}")
    return text.select("o_orderkey", S.redact("c").alias("connection"))


@query(
    "redact_documents",
    r"SELECT doc_id, sha256(regexp_replace(text, '(?i)(password|pwd)\s*=\s*[^;]*', '\1=***REDACTED***', 'g')) AS digest FROM documents",
)
def redact_documents(t):
    return t.spread("documents", "doc_id").select("doc_id", F.sha2(S.redact("text"), 256).alias("digest"))


@query(
    "qualified_names",
    """SELECT r_name || '.' || n_name AS qualified, CASE WHEN n_regionkey = 1 THEN n_name ELSE r_name || '.' || n_name END AS optional_schema, lower(r_name || '.' || n_name) AS name_key,
  lower(n_name) AS bare_key, n_name AS package, 'nation_' || n_nationkey AS task FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def qualified_names(t):
    df = t["nation"].join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey"))  # region: 5 rows
    bracketed = F.concat(F.lit(" ["), "r_name", F.lit("].["), "n_name", F.lit("] "))
    return df.select(
        S.qualify("r_name", "n_name").alias("qualified"),
        S.qualify(F.when(F.col("n_regionkey") != 1, F.col("r_name")), "n_name").alias("optional_schema"),
        S.name_key(bracketed).alias("name_key"),
        S.name_key(S.bare_name(S.qualify("r_name", "n_name"))).alias("bare_key"),
        S.drop_suffix(F.concat("n_name", F.lit(".DTSX")), ".dtsx").alias("package"),
        S.last_path_part(F.concat(F.lit("Package\\"), "r_name", F.lit("\\nation_"), "n_nationkey")).alias("task"),
    )


_BREAK = r"'\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]'"


@query(
    "line_counts",
    f"""WITH c AS (SELECT conv_id, turn, regexp_replace(text, {_BREAK}, chr(10), 'g') AS x FROM conversations)
SELECT conv_id, turn, CAST(length(x) - length(replace(x, chr(10), '')) + CASE WHEN length(x) > 0 AND NOT ends_with(x, chr(10)) THEN 1 ELSE 0 END AS BIGINT) AS lines FROM c""",
)
def line_counts(t):
    return t["conversations"].select("conv_id", "turn", S.line_count("text").alias("lines"))


@query(
    "line_counts_documents",
    f"""WITH c AS (SELECT doc_id, regexp_replace(text, {_BREAK}, chr(10), 'g') AS x FROM documents)
SELECT doc_id, CAST(length(x) - length(replace(x, chr(10), '')) + CASE WHEN length(x) > 0 AND NOT ends_with(x, chr(10)) THEN 1 ELSE 0 END AS BIGINT) AS lines FROM c""",
)
def line_counts_documents(t):
    return t.spread("documents", "doc_id").select("doc_id", S.line_count("text").alias("lines"))


@query(
    "script_batches",
    r"""WITH s AS (SELECT conv_id, turn, unnest([regexp_replace('SELECT ' || turn, '^\s+|\s+$', '', 'g'), regexp_replace(text, '^\s+|\s+$', '', 'g')]) AS batch, unnest([0, 1]) AS batch_no FROM conversations)
SELECT conv_id, turn, CAST(batch_no AS INTEGER) AS batch_no, batch FROM s WHERE batch <> ''""",
)
def script_batches(t):
    script = F.concat(F.lit("SELECT "), F.col("turn"), F.lit("\n  GO  \n\nGO\n"), F.col("text"), F.lit("\nGO"))
    return split_batches(t["conversations"].select("conv_id", "turn", script.alias("script")), "script")


@query(
    "pages_and_sizes",
    """SELECT p_partkey, CAST(round_even(CAST(p_size AS DOUBLE) * 0.0078125, 2) AS DOUBLE) AS size_mb, CASE WHEN p_size = 7 THEN NULL ELSE CAST(round_even(CAST(p_size AS DOUBLE) * 0.0078125, 2) AS DOUBLE) END AS max_size_mb,
  CASE WHEN p_brand = 'Brand#2' THEN CAST(p_size AS DOUBLE) ELSE CAST(round_even(CAST(p_size AS DOUBLE) * 0.0078125, 2) AS DOUBLE) END AS growth FROM part""",
)
def pages_and_sizes(t):
    return t["part"].select(
        "p_partkey",
        S.pages_to_mb("p_size").alias("size_mb"),
        S.pages_to_mb(S.null_if("p_size", 7)).alias("max_size_mb"),
        S.growth_value("p_size", F.col("p_brand") == "Brand#2").alias("growth"),
    )


# --- joins and membership ---


@query(
    "join_chain",
    """SELECT r_name, count(*) AS lines, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def join_chain(t):
    # nation and region have 25 and 5 rows whatever the scale; customer and orders are left to the optimizer
    places = t["nation"].join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    people = t["customer"].join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    per_order = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(S.cents("l_extendedprice")).alias("c"))
    return (
        per_order.join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("r_name").agg(F.sum("n").alias("lines"), F.sum("c").alias("cents"))
    )


@query(
    "left_enrich",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic, c.n AS copies, CASE WHEN l.doc_id IS NULL THEN NULL ELSE d.n_chars END AS labelled_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) c ON c.source = d.source""",
)
def left_enrich(t):
    copies = t["documents"].groupBy("source").agg(F.count(F.lit(1)).alias("copies"))
    labels = t["labels"].withColumn("_l", F.lit(True))
    joined = t["documents"].select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id", "left").join(copies, "source", "left")
    return joined.select("doc_id", "lang", "quality", "toxic", "copies", F.when(F.col("_l"), F.col("n_chars")).alias("labelled_chars"))


@query(
    "exists_flag",
    "SELECT c_custkey, c_name, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) AS has_big_order FROM customer",
)
def exists_flag(t):
    big = t["orders"].filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return membership.exists_flag(t["customer"].select("c_custkey", "c_name"), big, ["c_custkey"], "has_big_order")


@query(
    "correlated_counts",
    """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS finished,
  (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey) AS lines FROM customer""",
)
def correlated_counts(t):
    orders = t["orders"].select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("c_custkey"))
    lines = t["lineitem"].select("l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    children = {"orders": orders, "finished": orders.filter("o_orderstatus = 'F'"), "lines": lines}
    return membership.child_counts(t["customer"].select("c_custkey"), ["c_custkey"], children)


@query(
    "graph_degrees",
    """WITH e AS (SELECT DISTINCT 's' || l_suppkey AS s, 'p' || l_partkey AS t FROM lineitem)
SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (SELECT s AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT t, 0, 1 FROM e) GROUP BY 1""",
)
def graph_degrees(t):
    pairs = t["lineitem"].select(F.concat(F.lit("s"), "l_suppkey").alias("s"), F.concat(F.lit("p"), "l_partkey").alias("t"))
    return counters.degrees(pairs, [], "s", "t")


@query(
    "anti_membership",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')",
)
def anti_membership(t):
    urgent = t["orders"].filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return membership.without(t["customer"].select("c_custkey", "c_name"), urgent, ["c_custkey"])


@query(
    "name_resolution",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'DBO.x' || (o_custkey % 1000) ELSE '[dbo].[X' || (o_custkey % 1000) || ']' END AS target_object,
  CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey % 1000 AND s_acctbal > 5000) THEN 'view' WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey % 1000) THEN 'synonym'
       WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey % 1000 AND c_acctbal > 0) THEN 'stored_procedure' WHEN EXISTS (SELECT 1 FROM part WHERE p_partkey = o_custkey % 1000 AND p_size > 10) THEN 'function'
       ELSE 'table' END AS target_type FROM orders""",
)
def name_resolution(t):
    names = t.sql("SELECT o_orderkey, 'd' AS database, CASE WHEN o_orderstatus = 'F' THEN concat('DBO.x', o_custkey % 1000) ELSE concat('[dbo].[X', o_custkey % 1000, ']') END AS target_object FROM {orders}")
    own = lambda table, key, cond: t.sql(f"SELECT 'd' AS database, concat('dbo.x', {key}) AS name FROM {{{table}}} WHERE {cond}")
    catalog = edges.type_catalog(
        own("supplier", "s_suppkey", "s_acctbal > 5000"), own("supplier", "s_suppkey", "true"), own("customer", "c_custkey", "c_acctbal > 0"), own("part", "p_partkey", "p_size > 10")
    )
    return membership.resolve_type(names, catalog, ["database"], "target_object", "target_type").drop("database")


@query(
    "bare_name_match",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, full_name FROM lineitem JOIN (SELECT lower(p_type) AS k, arg_max(p_brand || '.' || p_type, struct_pack(a := p_partkey, b := p_brand || '.' || p_type)) AS full_name FROM part WHERE p_size < 40 GROUP BY 1) c
ON k = CASE l_linenumber WHEN 1 THEN 'economy' WHEN 2 THEN 'standard' WHEN 3 THEN 'promo' ELSE 'none' END""",
)
def bare_name_match(t):
    defs = t["part"].filter("p_size < 40").select("p_partkey", F.concat_ws(".", "p_brand", "p_type").alias("name"))
    catalog = membership.bare_catalog(defs, [], "name", ["p_partkey"], "full_name")
    kind = F.when(F.col("l_linenumber") == 1, "ECONOMY").when(F.col("l_linenumber") == 2, "Standard").when(F.col("l_linenumber") == 3, "promo").otherwise("none")
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return membership.match_bare(rows, catalog, [], kind)


@query(
    "restricted_backfill",
    """WITH k AS (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 'constraint' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'function' ELSE 'stored_procedure' END AS st FROM orders),
need AS (SELECT * FROM k WHERE o_orderstatus = 'F' OR o_totalprice > 400000),
r AS (SELECT DISTINCT o_orderkey, st, l_partkey, l_linenumber = 7 AS pseudo, l_returnflag = 'N' AS bare FROM need JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'
      AND CASE WHEN l_linenumber = 1 THEN FALSE ELSE TRUE END)
SELECT DISTINCT 'd' AS database, CASE WHEN st = 'constraint' THEN 's.tab.o' || o_orderkey ELSE 'S.o' || o_orderkey END AS source_object, st AS source_type,
  CASE WHEN bare THEN '' ELSE 's.' END || 't' || l_partkey AS target_object, CASE WHEN NOT bare AND l_partkey < 100 THEN 'function' ELSE 'table' END AS target_type,
  CASE WHEN NOT bare AND l_partkey < 100 THEN 'calls' ELSE 'reads' END AS relationship_type, 'direct_metadata' AS discovery_method, CAST(28 AS INTEGER) AS edge_rank
FROM r WHERE NOT pseudo""",
)
def restricted_backfill(t):
    kind = "CASE WHEN o_orderpriority = '5-LOW' THEN {} WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {} ELSE {} END"
    objects = t.sql(f"""SELECT 'd' AS database, {kind.format("'constraint'", "'function'", "'stored_procedure'")} AS source_type, 's' AS schema, concat('o', o_orderkey) AS object,
        {kind.format("concat('s.tab.o', o_orderkey)", "concat('s.o', o_orderkey)", "concat('s.o', o_orderkey)")} AS source_object,
        CASE WHEN o_orderstatus = 'F' THEN 'unresolved' ELSE 'sqlglot' END AS parse_status, CASE WHEN o_totalprice > 400000 THEN 'doubt' END AS unresolved_reason FROM {{orders}}""")
    rows = t.sql(f"""SELECT 'd' AS database, 'S' AS ref_schema, concat('o', o_orderkey) AS ref_name,
        {kind.format("'CHECK_CONSTRAINT'", "'SQL_SCALAR_FUNCTION'", "'SQL_STORED_PROCEDURE'")} AS ref_type, CASE WHEN l_returnflag = 'N' THEN NULL ELSE 's' END AS target_schema,
        CASE WHEN l_linenumber = 7 THEN 'Inserted' ELSE concat('t', l_partkey) END AS target_name, CASE WHEN l_linenumber = 1 THEN 'TYPE' ELSE 'OBJECT_OR_COLUMN' END AS target_class,
        l_linestatus = 'O' AS is_ambiguous FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""")
    known = t.sql("SELECT 'd' AS database, concat('s.t', p_partkey) AS name FROM {part} WHERE p_partkey < 100")
    none = known.filter("false")
    catalog = edges.type_catalog(none, none, none, known)
    found = edges.backfill_edges(edges.valid_dependencies(rows), edges.needs_backfill(objects))
    return edges.merge_edges([found], catalog)


@query(
    "tagged_union",
    "SELECT c_name AS name, c_nationkey AS nationkey, 'CUSTOMER' AS principal_type FROM customer WHERE c_acctbal > 0 UNION ALL SELECT s_name, s_nationkey, 'SUPPLIER' FROM supplier",
)
def tagged_union(t):
    people = t.sql("SELECT c_name AS name, c_nationkey AS nationkey FROM {customer} WHERE c_acctbal > 0")
    firms = t.sql("SELECT s_name AS name, s_nationkey AS nationkey FROM {supplier}")
    return membership.tagged_union({"CUSTOMER": people, "SUPPLIER": firms}, "principal_type")


# --- aggregates ---


@query(
    "size_totals",
    """WITH l AS (SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS c FROM lineitem GROUP BY 1)
SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS stated_cents, CAST(coalesce(sum(n), 0) AS BIGINT) AS lines, CAST(coalesce(sum(q), 0) AS BIGINT) AS quantity, CAST(coalesce(sum(c), 0) AS BIGINT) AS line_cents
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1""",
)
def size_totals(t):
    per_order = t["lineitem"].groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.sum(S.cents("l_extendedprice")).alias("c")
    )
    joined = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice").join(per_order, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(S.cents("o_totalprice")).alias("stated_cents"), zero("n").alias("lines"), zero("q").alias("quantity"), zero("c").alias("line_cents")
    )


@query(
    "distinct_partitions",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS partition_count, max(l_returnflag || l_linestatus) AS unit_type FROM lineitem GROUP BY 1",
)
def distinct_partitions(t):
    rows = t["lineitem"].select("l_suppkey", "l_partkey", F.concat("l_returnflag", "l_linestatus").alias("label"))
    return counters.distinct_and_max(rows, ["l_suppkey"], "l_partkey", "label", "partition_count", "unit_type")


_ITEM_ORDER = "l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus"


@query(
    "ordered_key_lists",
    f"""SELECT l_orderkey, coalesce(string_agg(CASE WHEN l_returnflag <> 'R' THEN 'c' || l_partkey END, '; ' ORDER BY {_ITEM_ORDER}), '') AS key_columns,
  coalesce(string_agg(CASE WHEN l_returnflag <> 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'DESC' ELSE 'ASC' END END, '; ' ORDER BY {_ITEM_ORDER}), '') AS key_column_sort,
  coalesce(string_agg(CASE WHEN l_returnflag = 'R' THEN 'c' || l_partkey END, '; ' ORDER BY {_ITEM_ORDER}), '') AS included_columns FROM lineitem GROUP BY 1""",
)
def ordered_key_lists(t):
    rows = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("inc"), F.concat(F.lit("c"), "l_partkey").alias("name"),
        (F.col("l_linestatus") == "F").alias("desc"), "l_returnflag", "l_linestatus",
    )
    out = lists.split_list(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"], "inc", "name", "desc")
    return out.select("l_orderkey", *[F.array_join(c, "; ").alias(c) for c in ("key_columns", "key_column_sort", "included_columns")])


@query(
    "paired_lists",
    """SELECT l_orderkey, l_suppkey, string_agg('c' || l_partkey, '; ' ORDER BY l_linenumber, l_partkey) AS parent_columns, string_agg('r' || l_partkey, '; ' ORDER BY l_linenumber, l_partkey) AS referenced_columns FROM lineitem GROUP BY 1, 2""",
)
def paired_lists(t):
    rows = t["lineitem"].select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", F.concat(F.lit("c"), "l_partkey").alias("parent_columns"), F.concat(F.lit("r"), "l_partkey").alias("referenced_columns"))
    out = lists.ordered_list(rows, ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_partkey"], ["parent_columns", "referenced_columns"])
    return out.withColumns({c: F.array_join(c, "; ") for c in ("parent_columns", "referenced_columns")})


@query(
    "nested_steps",
    """SELECT conv_id, string_agg(turn || ':' || role || ':' || length(text), '; ' ORDER BY turn) AS steps, count(*) AS steps_count FROM conversations GROUP BY 1""",
)
def nested_steps(t):
    rows = t["conversations"].select("conv_id", "turn", "role", F.length("text").alias("size"))
    out = lists.nest(rows, ["conv_id"], ["turn"], ["turn", "role", "size"], "steps")
    text = lambda s: F.concat_ws(":", s["turn"].cast("string"), s["role"], s["size"].cast("string"))
    return out.withColumn("steps", F.array_join(F.transform("steps", text), "; "))


@query(
    "distinct_lists",
    "SELECT user_id, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS event_type FROM events GROUP BY 1",
)
def distinct_lists(t):
    return lists.distinct_list(t["events"], ["user_id"], "event_type").withColumn("event_type", F.array_join("event_type", "; "))


@query(
    "duplicate_names",
    "SELECT p_brand, count_if(n > 1) AS duplicate_names FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY 1",
    whole=("duplicate_names",),
)
def duplicate_names(t):
    return counters.repeated_values(t["part"], ["p_brand"], "p_name", "duplicate_names")


@query(
    "ratio_null_safe",
    "SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / nullif(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE), 0) AS cents_per_finished FROM orders GROUP BY 1",
)
def ratio_null_safe(t):
    finished = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return t["orders"].groupBy("o_custkey").agg(counters.ratio(S.cents("o_totalprice"), finished).alias("cents_per_finished"))


@query("having_threshold", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10")
def having_threshold(t):
    return counters.having_more(t["orders"], ["o_custkey"], 10)


@query(
    "count_matrix",
    "SELECT o_custkey, count_if(o_orderstatus = 'F') AS finished, count_if(o_totalprice > 300000) AS big, count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS hot FROM orders GROUP BY 1",
    whole=("finished", "big", "hot"),
)
def count_matrix(t):
    return counters.count_matrix(
        t["orders"], ["o_custkey"],
        {"finished": F.col("o_orderstatus") == "F", "big": F.col("o_totalprice") > 300000, "hot": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")},
    )


@query(
    "any_per_parent",
    "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS has_return, bool_or(l_tax = 0) AS has_untaxed, bool_or(l_quantity > 49) AS has_big FROM lineitem GROUP BY 1",
)
def any_per_parent(t):
    return counters.any_per_parent(
        t["lineitem"], ["l_orderkey"], {"has_return": F.col("l_returnflag") == "R", "has_untaxed": F.col("l_tax") == 0, "has_big": F.col("l_quantity") > 49}
    )


@query(
    "review_counts",
    """SELECT lang, count_if(quality = 0 OR toxic = 1) AS needs_review, count(*) AS objects FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1""",
    whole=("needs_review",),
)
def review_counts(t):
    labelled = t["documents"].join(t["labels"], "doc_id", "left").select(
        "lang", F.when(F.col("quality") == 0, "unresolved").otherwise("sqlglot").alias("parse_status"), F.when(F.col("toxic") == 1, "doubt").alias("unresolved_reason")
    )
    return summary.review_over_all(labelled, ["lang"])


@query(
    "status_tally",
    "SELECT d.source, CASE WHEN quality = 0 THEN 'unresolved' ELSE 'sqlglot' END AS parse_status, count(*) AS objects FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 2",
)
def status_tally(t):
    from demesne.plans.references import status_tally as tally

    labelled = t["documents"].join(t["labels"], "doc_id", "left").select("source", F.when(F.col("quality") == 0, "unresolved").otherwise("sqlglot").alias("parse_status"))
    return tally(labelled, ["source"])


@query(
    "catalog_filters",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' AND o_totalprice > 100000 AND lower(o_orderpriority) NOT IN ('inserted', 'deleted')""",
)
def catalog_filters(t):
    conditions = [
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000,
        ~F.lower("o_orderpriority").isin("inserted", "deleted"),
    ]
    return t["orders"].filter(S.all_of(conditions)).select("o_orderkey", "o_orderpriority")
