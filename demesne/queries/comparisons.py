"""Comparing two extractors or annotators over the given rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from demesne.plans import compare
from demesne.plans.references import mine
from demesne.queries.mining import EXPECTED, definitions
from demesne.queries.registry import pct, query

_DAYS = "WITH d AS (SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE event_type IN ('click', 'view')),\np AS (SELECT user_id, day, bool_or(event_type = 'click') AS a, bool_or(event_type = 'view') AS b FROM d GROUP BY 1, 2)"


def _days(t):
    return t["events"].select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query(
    "set_compare",
    _DAYS + """, c AS (SELECT user_id, count_if(a) AS click_items, count_if(b) AS view_items, count_if(a AND NOT b) AS only_in_click, count_if(b AND NOT a) AS only_in_view FROM p GROUP BY 1)
SELECT user_id, CAST(coalesce(click_items, 0) AS BIGINT) AS click_items, CAST(coalesce(view_items, 0) AS BIGINT) AS view_items, CAST(coalesce(only_in_click, 0) AS BIGINT) AS only_in_click,
  CAST(coalesce(only_in_view, 0) AS BIGINT) AS only_in_view, coalesce(only_in_click, 0) = 0 AND coalesce(only_in_view, 0) = 0 AS agree FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN c USING (user_id)""",
)
def set_compare(t):
    rows = _days(t)
    return compare.compare_labelled_sets(rows, rows, ["user_id"], "event_type", "day", "click", "view")


@query("set_difference", _DAYS + " SELECT user_id, day, CASE WHEN a THEN 'click' ELSE 'view' END AS only_in FROM p WHERE a <> b")
def set_difference(t):
    return compare.set_difference(_days(t), ["user_id"], "event_type", "day", "click", "view")


@query("set_union", "SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events")
def set_union(t):
    return compare.union_of_sets([t["orders"].select(F.col("o_custkey").alias("k")), t["events"].select(F.col("user_id").alias("k"))], ["k"])


@query(
    "engine_stats",
    f"""WITH r AS (SELECT source AS engine, CASE WHEN source = 'src0' THEN 'unavailable' WHEN l.doc_id IS NULL THEN 'error' WHEN quality = 1 THEN 'resolved' ELSE 'unresolved' END AS status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT engine, count_if(status <> 'unavailable') > 0 AS available, count(*) AS total_objects, CAST(count_if(status = 'resolved') AS BIGINT) AS resolved, CAST(count_if(status = 'unresolved') AS BIGINT) AS unresolved,
  CAST(count_if(status = 'error') AS BIGINT) AS failed, {pct("count_if(status = 'resolved')", 'count(*)')} AS success_rate_pct FROM r GROUP BY 1""",
)
def engine_stats(t):
    labelled = t["documents"].select("doc_id", "source").join(t["labels"], "doc_id", "left")
    status = (
        F.when(F.col("source") == "src0", compare.UNAVAILABLE).when(F.col("quality").isNull(), compare.ERROR)
        .when(F.col("quality") == 1, compare.RESOLVED).otherwise(compare.NOT_RESOLVED)
    )
    return compare.engine_stats(labelled.select(F.col("source").alias("engine"), status.alias("status")))


def _only_sources(corpus):
    """A second, simpler extractor: whatever follows FROM, schema-qualified."""
    hits = F.regexp_extract_all("definition", F.lit(r"(?i)\bFROM\s+(s\.\w+)"), F.lit(1))
    found = corpus.select("object_name", F.array_sort(F.array_distinct(hits)).alias("referenced_tables"))
    found = found.filter(F.size("referenced_tables") > 0)
    none = F.array().cast("array<string>")
    return found.select(
        F.lit("simple").alias("engine"), "object_name", F.lit(compare.RESOLVED).alias("status"), "referenced_tables", none.alias("referenced_procs"), F.lit(None).cast("string").alias("notes")
    )


_SIMPLE = """sm AS (
  SELECT k, unnest(['s.no1', 's.no3']) AS n FROM e WHERE p = '1'
  UNION ALL SELECT k, 's.t' || c FROM e WHERE p = '2' UNION ALL SELECT k, 's.t' || c FROM e WHERE p = '3'
  UNION ALL SELECT k, 's.t' || c FROM e WHERE p = '4' AND o_orderstatus = 'F'
  UNION ALL SELECT k, unnest(['s.t' || c, 's.t' || k]) FROM e WHERE p = '4' AND o_orderstatus <> 'F'
  UNION ALL SELECT k, 's.f' || (c % 50) FROM e WHERE p = '5'),
ft AS (SELECT k, array_to_string(list_sort(list(DISTINCT ref_name)), '; ') AS l FROM r WHERE ref_kind = 'table' GROUP BY 1), st AS (SELECT k, array_to_string(list_sort(list(DISTINCT n)), '; ') AS l FROM sm GROUP BY 1),
ex AS (SELECT k, array_to_string(list_sort(list(ref_name)), '; ') AS l FROM (SELECT k, ref_name FROM r WHERE ref_kind = 'table' EXCEPT SELECT k, n FROM sm) GROUP BY 1),
ey AS (SELECT k, array_to_string(list_sort(list(n)), '; ') AS l FROM (SELECT k, n FROM sm EXCEPT SELECT k, ref_name FROM r WHERE ref_kind = 'table') GROUP BY 1)"""


@query(
    "object_report",
    EXPECTED + f""", {_SIMPLE}
SELECT CAST(e.k AS VARCHAR) AS object_name, CASE WHEN p = '4' AND o_orderstatus = 'F' THEN 'unresolved' ELSE 'resolved' END AS full_status, coalesce(ft.l, '') AS full_referenced_tables,
  CASE WHEN st.l IS NULL THEN 'missing' ELSE 'resolved' END AS simple_status, coalesce(st.l, '') AS simple_referenced_tables, coalesce(ft.l, '') = coalesce(st.l, '') AS tables_agree,
  coalesce(ex.l, '') AS tables_only_in_full, coalesce(ey.l, '') AS tables_only_in_simple
FROM e LEFT JOIN ft ON ft.k = e.k LEFT JOIN st ON st.k = e.k LEFT JOIN ex ON ex.k = e.k LEFT JOIN ey ON ey.k = e.k""",
)
def object_report(t):
    corpus = definitions(t).select(F.col("o_orderkey").cast("string").alias("object_name"), "object_type", "definition")
    _, _, report = compare.run_comparison(corpus, {"full": lambda c: compare.as_results(mine(c), "full"), "simple": _only_sources})
    text = lambda c: F.array_join(c, "; ").alias(c)
    return report.select(
        "object_name", "full_status", text("full_referenced_tables"), "simple_status", text("simple_referenced_tables"), "tables_agree", text("tables_only_in_full"), text("tables_only_in_simple")
    )


@query(
    "failed_engine",
    """SELECT 'gone' AS engine, CAST(o_orderkey AS VARCHAR) AS object_name, 'error' AS status, 'RuntimeError: exploded' AS notes FROM orders""",
)
def failed_engine(t):
    def explode(corpus):
        raise RuntimeError("exploded")

    corpus = t["orders"].select(F.col("o_orderkey").cast("string").alias("object_name"))
    results, _, _ = compare.run_comparison(corpus, {"gone": explode})
    return results.select("engine", "object_name", "status", "notes")


@query(
    "failed_engine_at_work",
    """SELECT e.engine, CAST(o_orderkey AS VARCHAR) AS object_name, CASE WHEN e.engine = 'gone' THEN 'error' ELSE 'resolved' END AS status, CASE WHEN e.engine = 'gone' THEN 'ValueError: cannot read object 7' END AS notes
FROM orders, (VALUES ('gone'), ('sound')) e(engine)""",
)
def failed_engine_at_work(t):
    """One extractor crashes on one object while its job runs; the other is compared all the same."""

    def read(batches):
        for batch in batches:
            if (batch["object_name"] == "7").any():
                raise ValueError("cannot read object 7")
            yield batch

    def found(engine, corpus):
        none = F.array().cast("array<string>")
        return corpus.select(F.lit(engine).alias("engine"), "object_name", F.lit(compare.RESOLVED).alias("status"), none.alias("referenced_tables"), none.alias("referenced_procs"), F.lit(None).cast("string").alias("notes"))

    corpus = t["orders"].select(F.col("o_orderkey").cast("string").alias("object_name"))
    results, _, _ = compare.run_comparison(corpus, {"gone": lambda c: found("gone", c.mapInPandas(read, "object_name string")), "sound": lambda c: found("sound", c)})
    return results.select("engine", "object_name", "status", "notes")
