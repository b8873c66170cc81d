import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from demesne import schemas
from demesne.plans import discovery
from demesne.sinks import writers
from demesne.sources import snapshots
from test_packages import package, sql_task, task

ROOM = {
    "databases": [("d",)],
}


def read_csv(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    return rows


def relation(make, name, rows):
    """Rows given as dicts, other columns NULL, in the declared schema."""
    empty = make([], schemas.schema_of(name))
    values = [tuple(r.get(f.name) for f in empty.schema.fields) for r in rows]
    return make(values, schemas.schema_of(name))


@pytest.fixture(scope="module")
def estate(make):
    own = {"database": "d", "schema": "dbo"}
    rows = {
        "databases": [{"name": "d", "size_mb": 10.0, "recovery_model": "FULL", "compatibility_level": "150"}],
        "tables": [{**own, "name": "Orders", "row_count": 10, "size_mb": 1.5, "column_count": 2, "table_type": "HEAP", "trigger_count": 0}, {**own, "name": "Lines", "row_count": 0, "size_mb": 0.5, "column_count": 1, "table_type": "CLUSTERED", "trigger_count": 1}],
        "columns": [{**own, "table": "Orders", "name": "a", "data_type": "int", "nullable": True, "ordinal_position": 1}],
        "stored_procedures": [
            {**own, "name": "usp_a", "definition": "CREATE PROCEDURE dbo.usp_a AS SELECT * FROM dbo.Orders JOIN dbo.v ON 1 = 1"},
            {**own, "name": "usp_dyn", "definition": "CREATE PROCEDURE dbo.usp_dyn AS EXEC sp_executesql @s"},
        ],
        "views": [{**own, "name": "v", "definition": "CREATE VIEW dbo.v AS SELECT * FROM dbo.Lines"}],
        "constraints": [{**own, "table": "Lines", "name": "FK", "constraint_type": "FOREIGN_KEY", "columns": ["o"], "referenced_table": "dbo.Orders"}, {**own, "table": "Orders", "name": "PK", "constraint_type": "PRIMARY_KEY", "columns": ["a"]}],
    }
    names = [n for n in schemas.ENTITIES if n not in ("packages", "dependencies", "database_summary", "data_quality_summary", "agent_jobs")]
    rel = {n: relation(make, n, rows.get(n, [])) for n in names}
    rel["expression_dependencies"] = relation(make, "expression_dependencies", [])
    rel["foreign_keys"] = make([("d", "dbo.Lines", "dbo.Orders")], "database string, from_table string, to_table string")
    return rel


@pytest.fixture(scope="module")
def pkgs(make):
    script = task("Microsoft.ScriptTask", "script", "<DTS:ObjectData><ScriptTask:ScriptTaskData>x</ScriptTask:ScriptTaskData></DTS:ObjectData>")
    good = package(sql_task("a", "EXEC dbo.usp_a") + script, "Main")
    return make([("P", "F", "Main", good), ("P", "F", "Broken", "<x")], schemas.schema_of("package_text"))


def edges_of(spark, paths):
    return sorted(map(tuple, spark.read.parquet(paths["dependencies"]).collect()), key=str)


def test_full_run_and_rerun_give_the_same_edges(spark, estate, pkgs, tmp_path):
    first = discovery.run_discovery(spark, estate, pkgs, str(tmp_path / "one"), "r1", package_database="d", review_cap=1)
    one = edges_of(spark, first)
    assert {(e[1], e[5], e[3], e[4]) for e in one} == {
        ("dbo.usp_a", "reads", "dbo.Orders", "table"), ("dbo.usp_a", "reads", "dbo.v", "view"), ("dbo.v", "reads", "dbo.Lines", "table"),
        ("dbo.Lines", "foreign_key", "dbo.Orders", "table"), ("Main", "calls", "dbo.usp_a", "stored_procedure"),
    }
    ledger = spark.read.parquet(first["runs"]).first()
    # 2 tables, 2 procedures, 1 view, package with 2 tasks (3), broken package (1); one package failed
    assert (ledger["objects_scanned"], ledger["objects_skipped_unchanged"], ledger["objects_failed"]) == (9, 0, 1)
    assert ledger["finished_at"] > ledger["started_at"]
    queue = spark.read.parquet(first["review_queue"]).collect()
    assert sorted((q["object_id"], q["within_budget"]) for q in queue) == [("P.Main::script::1", False), ("d.dbo.usp_dyn", True)]

    state = spark.read.parquet(first["fingerprints"])
    second = discovery.run_discovery(spark, estate, pkgs, str(tmp_path / "two"), "r2", state, str(tmp_path / "one"), "d", 1)
    assert edges_of(spark, second) == one
    ledger = spark.read.parquet(second["runs"]).first()
    assert (ledger["objects_scanned"], ledger["objects_skipped_unchanged"]) == (1, 6)

    changed = dict(estate)
    changed["stored_procedures"] = estate["stored_procedures"].withColumn(
        "definition", F.when(F.col("name") == "usp_a", "CREATE PROCEDURE dbo.usp_a AS SELECT * FROM dbo.New").otherwise(F.col("definition"))
    )
    third = discovery.run_discovery(spark, changed, pkgs, str(tmp_path / "three"), "r3", spark.read.parquet(second["fingerprints"]), str(tmp_path / "two"), "d", 1)
    read_new = {("dbo.usp_a", "reads", "dbo.New", "table")}
    assert {(e[1], e[5], e[3], e[4]) for e in edges_of(spark, third)} == {(e[1], e[5], e[3], e[4]) for e in one if e[1] != "dbo.usp_a"} | read_new

    rollup = {r["object_type"]: r for r in read_csv(tmp_path / "one" / "rollup_csv")}
    assert (rollup["database"]["tables"], rollup["table"]["size_mb"], rollup["table"]["count"]) == ("2", "2.0", "2")
    assert (rollup["dependency_edge"]["count"], rollup["ssis_package"]["count"], rollup["unresolved_or_llm_inferred"]["count"]) == ("5", "1", "1")
    log = {r["object_name"]: r for r in read_csv(tmp_path / "one" / "log_csv")}
    assert log["Broken"]["status"] == "failed" and log["Broken"]["error"] and log["Main"]["error"] == ""
    summary = spark.read.parquet(first["database_summary"]).first()
    assert (summary["total_tables"], summary["total_constraints"], summary["largest_table"]) == (2, 2, "dbo.Orders")


def test_document_is_made_of_the_outputs(spark, estate, tmp_path):
    some = {k: estate[k] for k in ("tables", "constraints", "views")}
    paths = writers.write_entities(some, str(tmp_path / "out"))
    assert set(paths) == {"tables", "constraints", "views", "foreign_keys"}
    assert [r["name"] for r in spark.read.parquet(paths["foreign_keys"]).collect()] == ["FK"]
    writers.write_document(spark, paths, str(tmp_path / "doc"))
    doc = spark.read.schema("value string, entity string").text(str(tmp_path / "doc"))
    back = [json.loads(r["value"]) for r in doc.filter("entity = 'tables'").collect()]
    want = [json.loads(r) for r in estate["tables"].toJSON().collect()]
    assert sorted(({k: v for k, v in r.items() if v is not None} for r in back), key=str) == sorted(want, key=str)


def test_missing_relation_is_empty_with_a_failed_log_row(spark, estate, tmp_path):
    estate["views"].write.parquet(str(tmp_path / "snap" / "views"))
    found, entry = snapshots.read_optional(spark, str(tmp_path / "snap"), "views")
    assert found.count() == 1 and entry.first()["status"] == "success"
    found, entry = snapshots.read_optional(spark, str(tmp_path / "snap"), "triggers")
    assert found.count() == 0 and "definition" in found.columns and entry.first()["status"] == "absent" and entry.first()["error"]


def test_listing_truncate_and_engine_outputs(spark, make, tmp_path):
    folders, projects = make([(1, "F")], "folder_id int, name string"), make([(7, 1, "P")], "project_id int, folder_id int, name string")
    members = make([(7, "A"), (7, "B"), (8, "C")], "project_id int, name string")
    assert sorted(map(tuple, snapshots.package_listing(members, projects, folders).collect())) == [("F", "P", "A"), ("F", "P", "B")]
    writers.empty_out(spark, str(tmp_path / "t"), "synonyms")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0
    results = make([("x", "a", "resolved", ["s.T", "s.U"], [], None)], schemas.schema_of("engine_results"))
    writers.write_engine_results(results, str(tmp_path / "e"))
    assert glob.glob(f"{tmp_path}/e/engine=x/*.json")
    report = make([("a", "resolved", ["s.T", "s.U"], "missing", [], False)], "object_name string, x_status string, x_referenced_tables array<string>, y_status string, y_referenced_tables array<string>, tables_agree boolean")
    writers.write_comparison(report, ["x", "y"], str(tmp_path / "r"))
    assert read_csv(tmp_path / "r" / "comparison_report_csv")[0]["x_referenced_tables"] == "s.T; s.U"


def test_a_failing_relation_does_not_end_the_run(spark, estate, pkgs, tmp_path):
    def broken(batches):
        for batch in batches:
            raise ValueError("unreadable view")
            yield batch

    views = estate["views"].mapInPandas(broken, estate["views"].schema)
    paths = discovery.run_discovery(spark, {**estate, "views": views}, pkgs, str(tmp_path / "one"), "r1", package_database="d")
    assert spark.read.parquet(paths["views"]).count() == 0
    log = {(r["object_type"], r["object_name"]): r for r in spark.read.parquet(paths["run_log"]).collect()}
    assert log["relation", "views"]["status"] == "failed" and log["relation", "views"]["error"] == "ValueError: unreadable view"
    assert log["relation", "tables"]["status"] == "success" and all(r["duration_ms"] > 0 for k, r in log.items() if k[0] == "relation")
    assert spark.read.parquet(paths["dependencies"]).count() > 0
    assert spark.read.parquet(paths["runs"]).first()["objects_failed"] == 2  # the view relation, and a package


def test_a_run_that_raises_has_a_ledger_row(spark, estate, pkgs, tmp_path):
    with pytest.raises(Exception):
        discovery.run_discovery(spark, estate, pkgs.drop("xml"), str(tmp_path / "one"), "r1", package_database="d")
    row = spark.read.parquet(str(tmp_path / "one" / "runs")).first()
    assert row["run_id"] == "r1" and row["finished_at"] >= row["started_at"]
    phases = {r["phase"]: r for r in spark.read.parquet(str(tmp_path / "one" / "run_phases")).collect()}
    assert set(phases) == {"started", "failed"} and phases["failed"]["error"]


def test_run_of_a_snapshot_with_an_absent_relation(spark, estate, pkgs, tmp_path):
    for name, df in estate.items():
        if name != "synonyms":
            df.write.parquet(str(tmp_path / "snap" / name))
    keys = {"foreign_keys": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in estate["foreign_keys"].schema)}
    paths = discovery.run_snapshot(spark, str(tmp_path / "snap"), list(estate), pkgs, str(tmp_path / "one"), "r1", keys, package_database="d")
    log = {(r["object_type"], r["object_name"]): r["status"] for r in spark.read.parquet(paths["run_log"]).collect()}
    assert log["synonyms", str(tmp_path / "snap")] == "absent" and log["views", str(tmp_path / "snap")] == "success"
    assert spark.read.parquet(paths["synonyms"]).count() == 0 and spark.read.parquet(paths["dependencies"]).count() > 0
