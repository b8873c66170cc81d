import random

import pytest
from pyspark.sql import functions as F

from demesne.plans import discovery, edges as E

DDL = {
    "stored_procedures": "schema string, name string, definition string",
    "views": "schema string, name string, definition string",
    "functions": "schema string, name string, definition string",
    "triggers": "schema string, name string, definition string, table string",
    "constraints": "schema string, table string, name string, definition string",
    "synonyms": "schema string, name string, base_object string",
    "foreign_keys": "from_table string, to_table string",
    "columns": "schema string, table string, name string, data_type string, computed_expression string, xml_schema_collection string",
    "user_defined_types": "schema string, name string",
    "expression_dependencies": "ref_schema string, ref_name string, ref_type string, target_schema string, target_name string, target_class string, is_ambiguous boolean",
}


@pytest.fixture(scope="module")
def build(make):
    def run(**rows):
        rel = {k: make(rows.get(k, []), ddl).withColumn("database", F.lit("d")) for k, ddl in DDL.items()}
        out = discovery.estate_edges(rel, discovery.mine_objects(rel))
        return {(r.source_object, r.source_type, r.relationship_type, r.target_object, r.target_type): r.discovery_method for r in out.collect()}

    return run


def test_every_kind_of_edge(build):
    got = build(
        stored_procedures=[
            ("dbo", "usp_a", "CREATE PROC dbo.usp_a AS SELECT dbo.f1(x) FROM dbo.Orders JOIN [dbo].[V1] v ON 1 = 1; EXEC dbo.usp_b; SELECT NEXT VALUE FOR dbo.sq"),
            ("dbo", "usp_dyn", "EXEC sp_executesql @s"),
        ],
        views=[("dbo", "v1", "CREATE VIEW dbo.v1 AS SELECT * FROM dbo.Orders")],
        functions=[("dbo", "f1", "CREATE FUNCTION dbo.f1() RETURNS int AS BEGIN RETURN (SELECT dbo.f1() FROM dbo.Syn) END")],
        triggers=[("dbo", "g", "CREATE TRIGGER dbo.g ON dbo.Orders AFTER UPDATE AS INSERT INTO dbo.Log SELECT * FROM inserted", "dbo.Orders")],
        constraints=[("dbo", "Orders", "CK", "(dbo.f1([x]))"), ("dbo", "Orders", "PK", None), ("dbo", "Orders", "DF", "(NEXT VALUE FOR dbo.sq)")],
        synonyms=[("dbo", "Syn", "dbo.usp_a"), ("dbo", "Far", "Other.dbo.T"), ("dbo", "None", None)],
        foreign_keys=[("dbo.Lines", "dbo.Orders")],
        columns=[
            ("dbo", "Orders", "a", "FLAG", None, None), ("dbo", "Orders", "b", "Flag", None, None), ("dbo", "Orders", "c", "int", "([dbo].[f1]([a]))", None),
            ("dbo", "Orders", "d", "xml", None, "dbo.Coll"),
        ],
        user_defined_types=[("dbo", "Flag")],
        expression_dependencies=[
            ("dbo", "usp_dyn", "SQL_STORED_PROCEDURE", "dbo", "Hidden", "OBJECT_OR_COLUMN", False),
            ("dbo", "usp_dyn", "SQL_STORED_PROCEDURE", "dbo", "f1", "OBJECT_OR_COLUMN", False),
            ("dbo", "usp_dyn", "SQL_STORED_PROCEDURE", None, "Inserted", "OBJECT_OR_COLUMN", False),
            ("dbo", "usp_dyn", "SQL_STORED_PROCEDURE", "dbo", "Amb", "OBJECT_OR_COLUMN", True),
            ("dbo", "usp_dyn", "SQL_STORED_PROCEDURE", "dbo", "Ty", "TYPE", False),
            ("dbo", "usp_a", "SQL_STORED_PROCEDURE", "dbo", "Clean", "OBJECT_OR_COLUMN", False),
            ("dbo", "Orders", "USER_TABLE", "dbo", "f1", "OBJECT_OR_COLUMN", False),
        ],
    )
    p, m = "sqlglot", "direct_metadata"
    assert got == {
        ("dbo.usp_a", "stored_procedure", "reads", "dbo.Orders", "table"): p,
        ("dbo.usp_a", "stored_procedure", "reads", "dbo.V1", "view"): p,
        ("dbo.usp_a", "stored_procedure", "calls", "dbo.usp_b", "stored_procedure"): p,
        ("dbo.usp_a", "stored_procedure", "calls", "dbo.f1", "function"): p,
        ("dbo.usp_a", "stored_procedure", "uses_sequence", "dbo.sq", "sequence"): p,
        ("dbo.v1", "view", "reads", "dbo.Orders", "table"): p,
        ("dbo.f1", "function", "reads", "dbo.Syn", "synonym"): p,
        ("dbo.f1", "function", "calls", "dbo.f1", "function"): p,
        ("dbo.g", "trigger", "fires_on", "dbo.Orders", "table"): m,
        ("dbo.g", "trigger", "reads", "dbo.Log", "table"): p,
        ("dbo.Orders.CK", "constraint", "calls", "dbo.f1", "function"): p,
        ("dbo.Orders.DF", "constraint", "uses_sequence", "dbo.sq", "sequence"): p,
        ("dbo.Syn", "synonym", "references", "dbo.usp_a", "stored_procedure"): m,
        ("dbo.Far", "synonym", "references", "Other.dbo.T", "table"): m,
        ("dbo.Lines", "table", "foreign_key", "dbo.Orders", "table"): m,
        ("dbo.Orders", "table", "uses_type", "dbo.Flag", "user_defined_type"): m,
        ("dbo.Orders", "table", "uses_type", "dbo.Coll", "xml_schema_collection"): m,
        ("dbo.Orders", "table", "calls", "dbo.f1", "function"): p,
        ("dbo.usp_dyn", "stored_procedure", "reads", "dbo.Hidden", "table"): m,
        ("dbo.usp_dyn", "stored_procedure", "calls", "dbo.f1", "function"): m,
    }


def test_backfill_recovers_three_part_constraint_ids(make):
    objects = make([("d", "constraint", "dbo", "CK_Total", "dbo.Orders.CK_Total", "unresolved", "x")], "database string, source_type string, schema string, object string, source_object string, parse_status string, unresolved_reason string")
    deps = make([("d", "DBO", "[CK_Total]", "CHECK_CONSTRAINT", "dbo", "Other")], "database string, ref_schema string, ref_name string, ref_type string, target_schema string, target_name string")
    row = E.backfill_edges(deps, E.needs_backfill(objects)).first()
    assert (row["source_object"], row["target_object"]) == ("dbo.Orders.CK_Total", "dbo.Other")


def test_priority_of_names(make):
    one = lambda n: make([("d", n)], "database string, name string")
    catalog = E.type_catalog(one("s.a"), one("S.A"), one("s.b"), one("[s].[B]"))
    got = {r["name_key"]: r["resolved_type"] for r in catalog.collect()}
    assert got == {"s.a": "view", "s.b": "stored_procedure"}


def test_first_evidence_wins_whatever_the_input_order(make):
    rows = [("d", "a", "package", "t", "table", "reads", m, 22, [i]) for i, m in enumerate(["unresolved", "sqlglot", "llm_inferred"])]
    rows += [("d", "a", "package", "t", "table", "reads", "direct_metadata", 28, [])]
    ddl = "database string, source_object string, source_type string, target_object string, target_type string, relationship_type string, discovery_method string, edge_rank int, position array<int>"
    none = make([], "database string, name_key string, resolved_type string")
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = E.merge_edges([make(rows, ddl)], none)
        assert [r["discovery_method"] for r in got.collect()] == ["unresolved"]
        again = got.withColumn("position", F.array().cast("array<int>"))
        assert E.merge_edges([again], none).collect() == got.collect()


def test_databases_do_not_mix(make):
    rows = [(d, "dbo", "p", "SELECT * FROM dbo.v") for d in ("x", "y")]
    procs = make(rows, "database string, schema string, name string, definition string")
    views = make([("x", "dbo", "v", "SELECT 1")], "database string, schema string, name string, definition string")
    empty = {k: make([], "database string, " + DDL[k]) for k in ("functions", "triggers", "synonyms")}
    rel = {"stored_procedures": procs, "views": views, **empty}
    got = {(r["database"], r["target_type"]) for r in discovery.estate_edges(rel, discovery.mine_objects(rel)).collect()}
    assert got == {("x", "view"), ("y", "table")}
