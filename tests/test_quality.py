import pytest

from demesne.plans import quality

TABLE = "database string, schema string, name string, row_count long, size_mb double, column_count long, table_type string, trigger_count long, identity_columns array<string>, computed_columns array<string>, sparse_columns array<string>, is_cdc_enabled boolean, is_change_tracking_enabled boolean, is_temporal_table boolean"
COLUMN = "database string, schema string, table string, name string, data_type string, nullable boolean, max_length long, is_clr_type boolean, is_filestream boolean"
INDEX = "database string, schema string, table string, name string, is_clustered boolean"
CONSTRAINT = "database string, schema string, table string, constraint_type string"


def table(name, rows=100, size=1.0, cols=0, kind="CLUSTERED", triggers=0, ident=None, comp=None, sparse=None, cdc=None, track=None, temporal=None):
    return ("d", "dbo", name, rows, size, cols, kind, triggers, ident, comp, sparse, cdc, track, temporal)


def column(t, name, kind, nullable=True, length=None, clr=None, stream=None):
    return ("d", "dbo", t, name, kind, nullable, length, clr, stream)


@pytest.fixture(scope="module")
def profile(make):
    def run(tables, columns=(), indexes=(), constraints=()):
        args = make(list(tables), TABLE), make(list(columns), COLUMN), make(list(indexes), INDEX), make(list(constraints), CONSTRAINT)
        lists = quality.quality_lists(args[0], args[2]).collect()
        return quality.quality_profile(make([("d",)], "database string"), *args).first(), lists

    return run


def test_table_counters(profile):
    tables = [
        table("Empty", rows=0), table("Heap", kind="HEAP"), table("Trig", triggers=1), table("Ident", ident=["Id"]), table("Comp", comp=["c"]), table("Sparse", sparse=["s"]),
        table("Cdc", cdc=True), table("Track", track=True), table("Temp", temporal=True),
    ]
    p, _ = profile(tables, indexes=[("d", "dbo", "Heap", "i", False), ("d", "dbo", "Cdc", "i", True)], constraints=[("d", "dbo", "Cdc", "PRIMARY_KEY"), ("d", "dbo", "Cdc", "FOREIGN_KEY"), ("d", "dbo", "Gone", "PRIMARY_KEY")])
    assert (p["total_tables"], p["empty_tables"], p["heap_tables"]) == (9, 1, 1)
    assert (p["tables_without_primary_key"], p["tables_without_foreign_key"], p["tables_without_clustered_index"]) == (8, 8, 8)
    one = ["tables_with_triggers", "tables_with_identity_columns", "tables_with_computed_columns", "tables_with_sparse_columns", "tables_with_cdc_enabled", "tables_with_change_tracking_enabled", "tables_with_temporal_tables"]
    assert [p[c] for c in one] == [1] * 7


def test_column_type_mix(profile):
    cols = [
        column("W", "Id", "int", False), column("W", "Notes", "text"), column("W", "Payload", "SQL_VARIANT"), column("W", "Loc", "geography"), column("W", "Doc", "xml"),
        column("W", "Big", "NVARCHAR(MAX)", length=-1), column("W", "Short", "nvarchar", length=100), column("W", "Custom", "MyClr", clr=True), column("W", "Blob", "varbinary", length=-1, stream=True),
    ]
    p, _ = profile([table("W"), table("X")], cols + [column("X", "Id", "int"), column("X", "id", "int"), column("Gone", "Short", "int")])
    assert (p["nullable_columns"], p["non_nullable_columns"], p["deprecated_data_type_columns"], p["text_ntext_image_columns"]) == (10, 1, 1, 1)
    assert (p["sql_variant_columns"], p["large_max_columns"], p["duplicate_column_names"]) == (1, 2, 1)
    assert [p[f"tables_with_{x}"] for x in ("xml_columns", "spatial_columns", "clr_types", "lob_columns", "filestream")] == [1] * 5


def test_average_row_length(profile):
    assert profile([table("O", rows=1000, size=1.0)])[0]["average_row_length_bytes"] == round(1024 * 1024 / 1000, 2)
    assert profile([table("O", rows=0)])[0]["average_row_length_bytes"] is None


def test_lists(profile):
    tables = [table("Big", size=500.0), table("Small"), table("Wide", size=2.0, cols=60), table("Fifty", cols=50)]
    _, rows = profile(tables, indexes=[("d", "dbo", "Small", f"ix{i}", False) for i in range(12)] + [("d", "dbo", "Big", f"ix{i}", False) for i in range(10)])
    by = {}
    for r in rows:
        by.setdefault(r["list"], []).append((r["place"], r["table_name"]))
    assert sorted(by["largest_tables"]) == [(1, "dbo.Big"), (2, "dbo.Wide"), (3, "dbo.Fifty"), (4, "dbo.Small")]
    assert by["wide_schema_tables"] == [(None, "dbo.Wide")] and by["excessive_index_tables"] == [(None, "dbo.Small")]


def test_no_tables_gives_zeros(profile):
    p, rows = profile([])
    assert rows == [] and p["average_row_length_bytes"] is None
    assert all(p[c] == 0 for c in p.asDict() if c not in ("database", "average_row_length_bytes"))
