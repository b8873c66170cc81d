"""Catalog relations on the small example rows of a live server."""

from datetime import datetime

import pytest

from demesne.plans import catalog

RAW = {
    "databases": "database string, recovery_model_desc string, compatibility_level int, owner_name string, collation_name string, create_date timestamp, is_auto_close_on int, is_auto_shrink_on int, is_read_only int, is_trustworthy_on int, page_verify_option_desc string, containment_desc string, snapshot_isolation_state_desc string, is_read_committed_snapshot_on int",
    "master_files": "database string, size long",
    "backupset": "database_name string, type string, backup_finish_date timestamp",
    "restorehistory": "destination_database_name string, restore_date timestamp",
    "schemas": "database string, schema_id int, name string",
    "tables": "database string, object_id long, schema_id int, name string, create_date timestamp, modify_date timestamp",
    "change_tracking_tables": "database string, object_id long",
    "columns": "database string, object_id long, column_id long, name string, user_type_id int, is_nullable int, is_sparse int, is_filestream int, identity_seed long, identity_increment long, max_length long, xml_collection_id long",
    "computed_columns": "database string, object_id long, column_id long, definition string",
    "indexes": "database string, object_id long, index_id long, name string, type_desc string, is_unique int, has_filter int, is_disabled int, fill_factor int, data_space_id int, filter_definition string, is_primary_key int",
    "index_columns": "database string, object_id long, index_id long, column_id long, key_ordinal int, index_column_id long, is_included_column int, is_descending_key int",
    "partition_stats": "database string, object_id long, index_id long, partition_id long, row_count long, reserved_page_count long, used_page_count long, in_row_data_page_count long, lob_used_page_count long, row_overflow_used_page_count long",
    "allocation_units": "database string, container_id long, total_pages long, type_desc string",
    "partitions": "database string, object_id long, index_id long, partition_id long, partition_number int",
    "filegroups": "database string, data_space_id int, name string",
    "index_physical_stats": "database string, object_id long, index_id long, avg_fragmentation_in_percent double, page_count long, avg_page_space_used_in_percent double, record_count long",
    "index_usage_stats": "database string, object_id long, index_id long, user_seeks long, user_scans long, user_lookups long, user_updates long",
    "foreign_keys": "database string, object_id long, name string, parent_object_id long, referenced_object_id long, delete_action string, update_action string, is_not_trusted int, is_disabled int, is_system_named int",
    "foreign_key_columns": "database string, constraint_object_id long, constraint_column_id long, parent_object_id long, parent_column_id long, referenced_object_id long, referenced_column_id long",
    "key_constraints": "database string, name string, parent_object_id long, unique_index_id long, type string, is_system_named int",
    "check_constraints": "database string, name string, parent_object_id long, parent_column_id long, definition string, is_not_trusted int, is_disabled int, is_system_named int",
    "default_constraints": "database string, name string, parent_object_id long, parent_column_id long, definition string, is_system_named int",
    "triggers": "database string, object_id long, name string, parent_id long",
    "trigger_events": "database string, object_id long, type_desc string",
    "sql_modules": "database string, object_id long, definition string, execute_as_principal_id int",
    "jobs": "job_id long, name string, enabled int, owner string, description string, category_id int, operator_id int, notify_level int, date_created timestamp, date_modified timestamp",
    "job_steps": "job_id long, step_id int, step_name string, subsystem string, database_name string, command string, on_success_action int, on_fail_action int, retry_attempts int, retry_interval int",
    "job_categories": "category_id int, name string",
    "job_operators": "id int, name string",
    "job_schedules": "job_id long, schedule_id long, next_run_date int, next_run_time int",
    "schedules": "schedule_id long, schedule_name string, freq_type int, freq_interval int",
    "job_history": "job_id long, instance_id long, step_id int, run_date int, run_time int, run_status int",
}
D = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sys(make):
    class Sys(dict):
        def __missing__(self, name):
            return make([], RAW[name])

    s = Sys()
    s["schemas"] = make([("d", 1, "dbo")], RAW["schemas"])
    s["master_files"] = make([("d", 100000), ("d", 28000)], RAW["master_files"])  # 1000 MB
    s["tables"] = make([("d", 111, 1, "Orders", D, D), ("d", 112, 1, "Lines", D, D)], RAW["tables"])
    s["columns"] = make(
        [("d", 111, 1, "Id", 1, 0, 0, 0, 1, 1, 4, None), ("d", 111, 2, "Total", 1, 1, 1, 0, None, None, 4, None), ("d", 111, 3, "Calc", 1, 1, 0, 0, None, None, 4, None),
         ("d", 112, 1, "OrderId", 1, 0, 0, 0, None, None, 4, None), ("d", 112, 2, "ProductId", 1, 0, 0, 0, None, None, 4, None)], RAW["columns"])
    s["computed_columns"] = make([("d", 111, 3, "([Total]*(2))")], RAW["computed_columns"])
    s["indexes"] = make(
        [("d", 111, 1, "PK_O", "CLUSTERED", 1, 0, 0, 90, 1, None, 1), ("d", 111, 2, "IX_O", "NONCLUSTERED", 0, 0, 0, 90, 1, None, 0), ("d", 112, 0, None, "HEAP", 0, 0, 0, 0, 1, None, 0)], RAW["indexes"])
    s["index_columns"] = make([("d", 111, 1, 2, 1, 1, 0, 0), ("d", 111, 2, 2, 1, 1, 0, 1), ("d", 111, 2, 3, 0, 2, 1, 0)], RAW["index_columns"])
    s["partition_stats"] = make([("d", 111, 1, 71, 10, 12800, 5, 1, 2, 3), ("d", 111, 2, 72, 10, 12800, 5, 1, 1, 1)], RAW["partition_stats"])
    s["allocation_units"] = make([("d", 71, 30000, "IN_ROW_DATA"), ("d", 71, 21200, "LOB_DATA"), ("d", 72, 9, "IN_ROW_DATA")], RAW["allocation_units"])
    s["partitions"] = make([("d", 111, 2, 72, 1), ("d", 111, 2, 72, 1)], RAW["partitions"])
    s["filegroups"] = make([("d", 1, "PRIMARY")], RAW["filegroups"])
    s["index_physical_stats"] = make([("d", 111, 2, 12.5, 25, 80.0, 5000)], RAW["index_physical_stats"])
    s["index_usage_stats"] = make([("d", 111, 2, 100, 10, 2, 7)], RAW["index_usage_stats"])
    s["foreign_keys"] = make([("d", 901, "FK_1", 112, 111, "CASCADE", "NO_ACTION", 0, 0, 0), ("d", 902, "FK_2", 112, 111, "NO_ACTION", "NO_ACTION", 1, 0, 1)], RAW["foreign_keys"])
    s["foreign_key_columns"] = make([("d", 901, 2, 112, 2, 111, 2), ("d", 901, 1, 112, 1, 111, 1), ("d", 902, 1, 112, 1, 111, 1)], RAW["foreign_key_columns"])
    s["key_constraints"] = make([("d", "PK_O", 111, 1, "PK", 1)], RAW["key_constraints"])
    s["check_constraints"] = make([("d", "CK_T", 111, 2, "([Total]>=(0))", 0, 0, 0), ("d", "CK_Table", 111, 0, "([a]>[b])", 1, 0, 0)], RAW["check_constraints"])
    s["default_constraints"] = make([("d", "DF_T", 111, 2, "((0))", 0)], RAW["default_constraints"])
    s["triggers"] = make([("d", 801, "g", 111)], RAW["triggers"])
    s["trigger_events"] = make([("d", 801, "UPDATE"), ("d", 801, "INSERT")], RAW["trigger_events"])
    s["sql_modules"] = make([("d", 801, "CREATE TRIGGER g", None)], RAW["sql_modules"])
    return s


def test_tables(sys):
    got = {r["name"]: r for r in catalog.tables(sys).collect()}
    o, line = got["Orders"], got["Lines"]
    # one partition with two allocation units is counted once
    assert (o["row_count"], o["size_mb"], o["data_pages"], o["percent_of_database_occupied"]) == (10, 400.0, 6, 40.0)
    assert (o["table_type"], line["table_type"], o["nonclustered_index_count"], o["trigger_count"]) == ("CLUSTERED", "HEAP", 1, 1)
    assert (o["column_count"], o["identity_columns"], o["computed_columns"], o["sparse_columns"]) == (3, ["Id"], ["Calc"], ["Total"])
    # two keys between the same pair: two foreign keys, one neighbour on either side
    assert (line["foreign_key_count"], line["referenced_table_count"], line["referencing_table_count"]) == (2, 1, 0)
    assert (o["foreign_key_count"], o["referenced_table_count"], o["referencing_table_count"]) == (0, 0, 1)
    assert (line["size_mb"], line["identity_columns"]) == (0.0, [])


def test_tables_meet_each_child_once(sys):
    """Columns meet their computed ones in one join, and a table meets its storage, keys, columns and features in one each."""
    plan = catalog.tables(sys)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert sum("column_id" in line for line in joins) == 1
    assert len(joins) == 8  # schema, allocation units, computed columns, pages, and those four


def test_indexes_merge_their_statistics(sys):
    got = {r["name"]: r for r in catalog.indexes(sys).collect()}
    ix, pk = got["IX_O"], got["PK_O"]
    assert set(got) == {"IX_O", "PK_O"}
    assert (ix["key_columns"], ix["key_column_sort"], ix["included_columns"]) == (["Total"], ["DESC"], ["Calc"])
    assert (ix["filegroup"], ix["allocation_unit_type"], ix["partition_count"], ix["is_partitioned"]) == ("PRIMARY", "IN_ROW_DATA", 1, False)
    assert (ix["index_size_mb"], ix["fragmentation_pct"], ix["user_seeks"], ix["record_count"]) == (0.2, 12.5, 100, 5000)
    assert (ix["percent_of_table"], ix["percent_of_database"]) == (0.1, 0.02)
    assert pk["is_clustered"] and pk["is_primary_key"]
    assert (pk["page_count"], pk["index_size_mb"], pk["user_seeks"], pk["percent_of_table"]) == (None, None, None, None)


def test_constraints(sys):
    got = {r["name"]: r for r in catalog.constraints(sys).collect()}
    assert {k: r["constraint_type"] for k, r in got.items()} == {"PK_O": "PRIMARY_KEY", "FK_1": "FOREIGN_KEY", "FK_2": "FOREIGN_KEY", "CK_T": "CHECK", "CK_Table": "CHECK", "DF_T": "DEFAULT"}
    fk = got["FK_1"]
    assert (fk["columns"], fk["referenced_columns"], fk["referenced_table"], fk["delete_action"]) == (["OrderId", "ProductId"], ["Id", "Total"], "dbo.Orders", "CASCADE")
    assert (fk["is_trusted"], got["FK_2"]["is_trusted"], got["CK_T"]["is_trusted"], got["CK_Table"]["is_trusted"]) == (True, False, True, False)
    assert (got["PK_O"]["columns"], got["PK_O"]["is_system_named"]) == (["Total"], True)
    assert (got["CK_T"]["columns"], got["CK_Table"]["columns"], got["DF_T"]["columns"], got["DF_T"]["definition"]) == (["Total"], [], ["Total"], "((0))")
    assert {tuple(r) for r in catalog.foreign_keys(sys).collect()} == {("d", "dbo.Lines", "dbo.Orders")}


def test_triggers_have_one_row_and_a_qualified_table(sys):
    assert [(r["schema"], r["name"], r["table"], r["event"]) for r in catalog.triggers(sys).collect()] == [("dbo", "g", "dbo.Orders", "INSERT,UPDATE")]


def test_databases_without_history(make, sys):
    s = dict(sys)
    s["databases"] = make([("d", "FULL", 150, "sa", "CI", D, 0, None, 0, 1, "CHECKSUM", "NONE", "ON", 1)], RAW["databases"])
    for name in ("backupset", "restorehistory"):
        s[name] = make([], RAW[name])
    row = catalog.databases(s).first()
    assert (row["size_mb"], row["is_snapshot_isolation_on"], row["auto_shrink"], row["compatibility_level"]) == (1000.0, True, None, "150")
    assert (row["last_full_backup"], row["last_backup_date"], row["last_restore_date"]) == (None, None, None)
    s["backupset"] = make([("d", "D", datetime(2024, 6, 15)), ("d", "L", datetime(2024, 6, 16))], RAW["backupset"])
    s["restorehistory"] = make([("d", datetime(2024, 6, 17))], RAW["restorehistory"])
    row = catalog.databases(s).first()
    assert (row["last_full_backup"][:10], row["last_differential_backup"], row["last_log_backup"][:10], row["last_backup_date"][:10], row["last_restore_date"][:10]) == (
        "2024-06-15", None, "2024-06-16", "2024-06-16", "2024-06-17")


def test_jobs(make, sys):
    s = dict(sys)
    s["jobs"] = make([(101, "Nightly", 1, "sa", "ETL", 5, 9, 2, D, D), (102, "NoSteps", 1, "sa", "x", 5, 9, 0, D, D)], RAW["jobs"])
    s["job_steps"] = make([(101, 2, "b", "TSQL", "d", "EXEC b", 1, 2, 3, 5), (101, 1, "a", "TSQL", "d", "EXEC a", 3, 2, None, None)], RAW["job_steps"])
    s["job_categories"] = make([(5, "Data")], RAW["job_categories"])
    s["job_operators"] = make([(9, "DBA")], RAW["job_operators"])
    for name in ("job_schedules", "schedules", "job_history"):
        s[name] = make([], RAW[name])
    jobs = catalog.agent_jobs(s).collect()
    assert [(j["name"], j["step_count"], j["schedule_names"], j["last_run_status"], j["retry_attempts"]) for j in jobs] == [("Nightly", 2, [], None, 3)]
    s["job_schedules"] = make([(101, 1, 20240616, 20000), (101, 2, 0, 10000), (101, 3, 20240616, 30000)], RAW["job_schedules"])
    s["schedules"] = make([(1, "Nightly 2AM", 4, 1), (2, "Idle", 128, 0), (3, "Odd", 77, 0)], RAW["schedules"])
    s["job_history"] = make([(101, 1, 0, 20240614, 1, 0), (101, 2, 0, 20240615, 20000, 1), (101, 3, 1, 20240616, 1, 0)], RAW["job_history"])
    j = catalog.agent_jobs(s).first()
    assert (j["category"], j["notification_operator"], j["notification_method"], j["enabled"]) == ("Data", "DBA", "On Failure", True)
    assert j["schedule_names"] == ["Nightly 2AM", "Idle", "Odd"]
    assert j["schedule_frequency"] == ["Daily (interval=1)", "Start Whenever CPU Is Idle", "Unknown"]
    assert (j["next_scheduled_run"], j["last_run_date"], j["last_run_time"], j["last_run_status"]) == ("2024-06-16T02:00:00", "2024-06-15", "02:00:00", "Succeeded")
    assert [(x["step_id"], x["on_success_action"], x["on_fail_action"]) for x in j["step_details"]] == [(1, "Go To Next Step", "Quit With Failure"), (2, "Quit With Success", "Quit With Failure")]


def test_rows_of_indexes_are_dealt_by_table_only(spark):
    """Nothing is dealt by index, and what comes with the table is not met by dealing the finished rows again."""
    sys = {name: spark.createDataFrame([], schema) for name, schema in RAW.items()}
    plan = catalog.indexes(sys)._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert dealt and not any("index_id" in keys or "column_id" in keys for keys in dealt)
    assert sum("object_id" in keys for keys in dealt) <= 8  # columns, their places, partitions, statistics, usage, indexes, tables, pages


def test_an_index_meets_all_it_has_once(spark):
    sys = {name: spark.createDataFrame([], schema) for name, schema in RAW.items()}
    frame = lambda name, *rows: sys.update({name: spark.createDataFrame(list(rows), RAW[name])})
    frame("schemas", ("d", 1, "s"))
    frame("tables", ("d", 7, 1, "t", None, None))
    frame("filegroups", ("d", 1, "FG"))
    index = lambda i, name: ("d", 7, i, name, "NONCLUSTERED", 0, 0, 0, 90, 1 if i < 3 else None, None, 0)
    frame("indexes", index(2, "a"), index(3, "b"), ("d", 8, 2, "gone", "CLUSTERED", 0, 0, 0, 90, 1, None, 0))
    frame("columns", *[("d", 7, c, n, 1, 0, 0, 0, None, None, 4, None) for c, n in ((1, "x"), (2, "y"))])
    frame("index_columns", ("d", 7, 2, 2, 1, 1, 0, 1), ("d", 7, 2, 1, 2, 2, 0, 0), ("d", 7, 2, 9, 3, 3, 0, 0), ("d", 7, 3, 1, 1, 1, 1, 0))
    frame("partitions", ("d", 7, 2, 20, 1), ("d", 7, 2, 21, 2))
    frame("allocation_units", ("d", 20, 5, "IN_ROW_DATA"), ("d", 20, 5, "LOB_DATA"))
    frame("index_usage_stats", ("d", 7, 2, 1, 2, 3, 4), ("d", 7, 9, 9, 9, 9, 9))
    cols = ["name", "key_columns", "key_column_sort", "included_columns", "partition_count", "allocation_unit_type", "filegroup", "user_updates", "page_count"]
    rows = [tuple(r) for r in catalog.indexes(sys).orderBy("name").select(*cols).collect()]
    assert rows == [("a", ["y", "x"], ["DESC", "ASC"], [], 2, "LOB_DATA", "FG", 4, None), ("b", [], [], ["x"], None, None, None, None, None)]
