"""Outputs written from the given rows and read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demesne.plans import changes
from demesne.plans import packages as K
from demesne.plans.runs import Run, latest_phases
from demesne.queries.catalogs import _INV, _inventory
from demesne.queries.registry import ORACLES, query
from demesne.queries.shredding import packages
from demesne.session import checkpoint_root
from demesne.sinks import writers


def _target(t, name: str) -> str:
    return f"{checkpoint_root(t.spark)}/{name}_{uuid.uuid4().hex}"


@query(
    "sink_entities",
    """SELECT 'constraints' AS entity, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'tables', count(*) FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'views', count(*) FROM supplier UNION ALL SELECT 'foreign_keys', 0""",
)
def sink_entities(t):
    _, relations = _inventory(t)
    paths = writers.write_entities({k: relations[k] for k in ("constraints", "tables", "views")}, _target(t, "entities"))
    return writers.document_rows(t.spark, {k: paths[k] for k in paths if k != "foreign_keys"}).groupBy("entity").agg(F.count(F.lit(1)).alias("n")).unionByName(
        t.spark.read.parquet(paths["foreign_keys"]).agg(F.count(F.lit(1)).alias("n")).select(F.lit("foreign_keys").alias("entity"), "n")
    )


@query(
    "sink_document",
    _INV + """ SELECT 'tables' AS entity, db || '/' || o_orderpriority || '/t' || o_orderkey AS id, o_custkey AS row_count, o_totalprice AS size_mb FROM od""",
)
def sink_document(t):
    _, relations = _inventory(t)
    root = _target(t, "document")
    paths = writers.write_entities({"tables": relations["tables"]}, f"{root}/parts")
    writers.write_document(t.spark, paths, f"{root}/whole")
    whole = t.spark.read.schema("value string, entity string").text(f"{root}/whole")
    row = F.from_json("value", "database string, schema string, name string, row_count bigint, size_mb double")
    return whole.select("entity", row.alias("r")).select(
        "entity", F.concat_ws("/", "r.database", "r.schema", "r.name").alias("id"), "r.row_count", "r.size_mb"
    )


@query(
    "sink_run_log",
    "SELECT object_type, object_name, status, parse_status, error FROM (" + ORACLES["package_log"] + ")",
)
def sink_run_log(t):
    target = _target(t, "log")
    writers.write_log(K.parse_log(K.parse(packages(t), parts=())), target)
    back = t.spark.read.option("header", True).schema("object_type string, object_name string, status string, parse_status string, error string, duration_ms string").csv(target)
    return back.drop("duration_ms")


@query(
    "error_rows",
    """SELECT 'document' AS object_type, CAST(d.doc_id AS VARCHAR) AS object_name, CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN l.doc_id IS NOT NULL THEN 'direct_metadata' END AS parse_status, CASE WHEN l.doc_id IS NULL THEN 'no label' END AS error, CAST(NULL AS DOUBLE) AS duration_ms
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def error_rows(t):
    labelled = t["documents"].select("doc_id").join(t["labels"], "doc_id", "left")
    error = F.when(F.col("quality").isNull(), "no label")
    return changes.log_rows(labelled, "document", F.col("doc_id").cast("string"), F.lit("direct_metadata"), error)


@query("sink_ordered", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def sink_ordered(t):
    """Orders by price in several files, and their places as the files tell them."""
    target = _target(t, "ordered")
    writers.write_ordered(t["orders"].select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], target, 6)
    return writers.read_ordered(t.spark, target)


@query(
    "sink_written_kinds",
    """SELECT 'rollup' AS kind, r_name AS name, CAST(row_number() OVER (ORDER BY r_name) AS VARCHAR) AS value FROM region
UNION ALL SELECT 'engine', engine || '/' || name, status FROM (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS engine, n_name AS name, 'resolved' AS status FROM nation)
UNION ALL SELECT 'report', n_name, CASE WHEN n_nationkey % 2 = 0 THEN 's.A; s.' || n_name ELSE '' END FROM nation""",
)
def sink_written_kinds(t):
    """The roll-up CSV, the mirrored outputs of extractors and the flat comparison report, read back from their files."""
    root = _target(t, "kinds")
    rollup = t["region"].select(
        F.lit("database").alias("object_type"), F.col("r_name").alias("object_name"), F.lit(1).alias("count"), F.lit(None).cast("double").alias("size_mb"),
        F.lit(0).alias("tables"), F.lit(0).alias("procs"), F.lit(0).alias("views"), F.lit(0).alias("row_order"),
    )
    writers.write_rollup(rollup, f"{root}/rollup")
    files = t.spark.read.option("header", True).schema("object_type string, object_name string, count string, size_mb string, tables string, procs string, views string").csv(f"{root}/rollup")
    lines = files.select("object_name", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("_part"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    placed = lines.withColumn("value", F.rank().over(Window.orderBy("_part", "_block", "_at")))  # a row for each region
    even = F.col("n_nationkey") % 2 == 0
    tables = F.when(even, F.array(F.lit("s.A"), F.concat(F.lit("s."), "n_name"))).otherwise(F.array().cast("array<string>"))
    found = t["nation"].select(F.when(even, "even").otherwise("odd").alias("engine"), F.col("n_name").alias("object_name"), F.lit("resolved").alias("status"), tables.alias("referenced_tables"))
    writers.write_engine_results(found, f"{root}/engines")
    engines = t.spark.read.schema("object_name string, status string, engine string").json(f"{root}/engines")
    report = found.select("object_name", F.col("status").alias("x_status"), F.col("referenced_tables").alias("x_referenced_tables"))
    writers.write_comparison(report, ["x"], f"{root}/report")
    flat = t.spark.read.option("header", True).schema("object_name string, x_status string, x_referenced_tables string").csv(f"{root}/report/comparison_report_csv")
    return (
        placed.select(F.lit("rollup").alias("kind"), F.col("object_name").alias("name"), F.col("value").cast("string"))
        .union(engines.select(F.lit("engine"), F.concat_ws("/", "engine", "object_name"), "status"))
        .union(flat.select(F.lit("report"), "object_name", F.coalesce("x_referenced_tables", F.lit(""))))
    )


@query(
    "run_isolation",
    """SELECT 'relation' AS kind, 'orders' AS name, 'success' AS status, NULL AS error, count(*) AS n FROM orders UNION ALL SELECT 'relation', 'customers', 'failed', 'ValueError: bad row 11', 0
UNION ALL SELECT 'relation', 'nations', 'success', NULL, count(*) FROM nation UNION ALL SELECT 'relation', 'unplanned', 'failed', 'KeyError: ''no such source''', 0
UNION ALL SELECT 'run', 'broken', 'failed', 'RuntimeError: stopped', 2 UNION ALL SELECT 'run', 'whole', 'finished', NULL, 0""",
)
def run_isolation(t):
    """Relations of a run that is stopped in the end, two of them failing, and of one that is not; logs with times, and the last phase of each."""

    def bad(batches):
        for batch in batches:
            if (batch["c_custkey"] == 11).any():
                raise ValueError("bad row 11")
            yield batch

    def unplanned():
        raise KeyError("no such source")

    def work(run):
        run.write("orders", t["orders"])
        run.write("customers", t["customer"].select("c_custkey").mapInPandas(bad, "c_custkey bigint"))
        run.write("nations", lambda: t["nation"])
        run.write("unplanned", unplanned, "x int")
        raise RuntimeError("stopped")

    root = _target(t, "runs")
    run = Run(t.spark, root, "broken")
    try:
        run.guarded(work)
    except RuntimeError:
        pass
    Run(t.spark, root, "whole").guarded(lambda run: run.write("nations", t["nation"]))
    names = ("orders", "customers", "nations", "unplanned")
    sizes = [t.spark.read.parquet(run.paths[name]).agg(F.lit(name).alias("object_name"), F.count(F.lit(1)).alias("n")) for name in names]
    timed = run.log_rows().filter("duration_ms > 0").join(reduce(DataFrame.unionByName, sizes), "object_name")
    phases = latest_phases(t.spark.read.parquet(f"{root}/run_phases"))
    return timed.select(F.col("object_type").alias("kind"), F.col("object_name").alias("name"), "status", "error", "n").union(
        phases.select(F.lit("run"), "run_id", "phase", "error", "objects_failed")
    )
