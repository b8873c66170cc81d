"""The given tables read as the raw catalog of an estate.

Orders are tables, line items their columns, partitions and indexes, customers
procedures and jobs, suppliers functions, events job history. The mapping is
plain SELECTs that Spark and the checking engine both run, so the relations
grow with the data; databases hold 4096 tables each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from demesne.queries.registry import Tables, plain


def _db(key: str) -> str:
    return f"concat('db', CAST(CAST(floor({key} / 4096) AS BIGINT) AS VARCHAR(20)))"


_COLUMN = "(l_linenumber * CAST(100000000000 AS BIGINT) + l_partkey)"
_PARTITION = "(l_orderkey * 16 + l_linenumber)"
_PROC, _VIEW, _FUNC, _TRIG = ("CAST(%d AS BIGINT)" % (2**n) for n in (45, 46, 47, 48))

_PROC_TEXT = (
    "concat('CREATE PROCEDURE s1.p', c_custkey, ' AS BEGIN\n  INSERT INTO s2.log SELECT s2.f', c_nationkey, '(a.id) FROM [s3].[t', "
    "c_custkey, '] a JOIN s1.v', c_nationkey, ' b ON a.id = b.id; -- FROM s9.none\n  EXEC s1.p', c_nationkey, '; END', "
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN ' EXEC sp_executesql @q' ELSE '' END)"
)
_VIEW_TEXT = "concat('CREATE VIEW s1.v', s_suppkey, ' AS WITH x AS (SELECT * FROM s3.t', s_suppkey, ') SELECT * FROM x')"
_FUNC_TEXT = (
    "concat('CREATE FUNCTION s2.f', s_suppkey, '(@a int) RETURNS int AS BEGIN RETURN (SELECT NEXT VALUE FOR s1.q', "
    "s_nationkey, ' FROM s3.t', s_suppkey, ') END')"
)
_TRIG_TEXT = (
    "concat('CREATE TRIGGER g', o_orderkey, ' ON t', o_orderkey, ' AFTER INSERT, UPDATE AS BEGIN UPDATE s3.t', o_custkey, "
    "' SET a = 1 FROM inserted i; EXEC s1.p', o_custkey, ' END')"
)

RAW: dict[str, str] = {
    "databases": f"""
        SELECT {_db('o_orderkey')} AS database, min(o_orderdate) AS create_date,
               CASE WHEN min(o_orderstatus) = 'F' THEN 'FULL' ELSE 'SIMPLE' END AS recovery_model_desc,
               CAST(150 AS INT) AS compatibility_level, max(o_orderpriority) AS owner_name, 'CI_AS' AS collation_name,
               CASE WHEN count(*) < 4096 THEN NULL ELSE 1 END AS is_auto_close_on, CAST(0 AS INT) AS is_auto_shrink_on,
               CAST(0 AS INT) AS is_read_only, CAST(1 AS INT) AS is_trustworthy_on, 'CHECKSUM' AS page_verify_option_desc,
               'NONE' AS containment_desc, CASE WHEN count(*) < 4096 THEN 'OFF' ELSE 'ON' END AS snapshot_isolation_state_desc,
               CAST(NULL AS INT) AS is_read_committed_snapshot_on
        FROM {{orders}} GROUP BY {_db('o_orderkey')}""",
    "master_files": f"SELECT {_db('l_orderkey')} AS database, CAST(l_quantity AS BIGINT) AS size FROM {{lineitem}}",
    "backupset": f"""
        SELECT {_db('o_orderkey')} AS database_name, o_orderdate AS backup_finish_date,
               CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'P' THEN 'I' ELSE 'L' END AS type
        FROM {{orders}} WHERE o_orderpriority <> '5-LOW'""",
    "restorehistory": f"""
        SELECT {_db('o_orderkey')} AS destination_database_name, o_orderdate AS restore_date
        FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "database_files": f"""
        SELECT {_db('s_suppkey')} AS database, s_name AS name, concat('/data/', s_name) AS physical_name,
               CAST(s_nationkey AS INT) AS data_space_id, CAST(floor(s_acctbal + 1000) AS BIGINT) AS size,
               CASE WHEN s_acctbal < 0 THEN CAST(-1 AS BIGINT) ELSE s_suppkey * 128 END AS max_size,
               CAST(s_nationkey AS BIGINT) AS growth, s_nationkey > 12 AS is_percent_growth
        FROM {{supplier}}""",
    "filegroups": f"""
        SELECT {_db('o_orderkey')} AS database, CAST(substr(o_orderpriority, 1, 1) AS INT) AS data_space_id,
               concat('FG', substr(o_orderpriority, 1, 1)) AS name
        FROM {{orders}} GROUP BY {_db('o_orderkey')}, substr(o_orderpriority, 1, 1)""",
    "schemas": f"""
        SELECT {_db('o_orderkey')} AS database, CAST(substr(o_orderpriority, 1, 1) AS INT) AS schema_id,
               concat('s', substr(o_orderpriority, 1, 1)) AS name
        FROM {{orders}} GROUP BY {_db('o_orderkey')}, substr(o_orderpriority, 1, 1)""",
    "tables": f"""
        SELECT {_db('o_orderkey')} AS database, o_orderkey AS object_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS schema_id,
               concat('t', o_orderkey) AS name, o_orderdate AS create_date, o_orderdate AS modify_date,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 0 END AS temporal_type,
               CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_tracked_by_cdc,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_memory_optimized
        FROM {{orders}}""",
    "change_tracking_tables": f"""
        SELECT {_db('o_orderkey')} AS database, o_orderkey AS object_id FROM {{orders}} WHERE o_orderpriority = '3-MEDIUM'""",
    "columns": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id, {_COLUMN} AS column_id, concat('c', l_partkey) AS name,
               CAST(l_linenumber AS INT) AS user_type_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_nullable,
               CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN 1 ELSE 0 END AS is_sparse,
               CASE WHEN l_tax = 0.08 THEN 1 ELSE 0 END AS is_filestream,
               CASE WHEN l_discount = 0 THEN CAST(1 AS BIGINT) END AS identity_seed,
               CASE WHEN l_discount = 0 THEN CAST(l_suppkey AS BIGINT) END AS identity_increment,
               CASE WHEN l_quantity > 45 THEN CAST(-1 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS max_length,
               CASE WHEN l_linenumber = 4 THEN l_suppkey END AS xml_collection_id,
               CASE WHEN l_linenumber IN (2, 3) THEN 'CI_AS' END AS collation_name,
               CASE WHEN l_tax = 0.04 AND l_discount > 0.05 THEN 1 ELSE 0 END AS is_rowguidcol
        FROM {{lineitem}}""",
    "types": f"""
        SELECT {_db('l_orderkey')} AS database, CAST(l_linenumber AS INT) AS user_type_id,
               CASE l_linenumber WHEN 1 THEN 'int' WHEN 2 THEN 'nvarchar' WHEN 3 THEN 'text' WHEN 4 THEN 'xml'
                    WHEN 5 THEN 'geography' WHEN 6 THEN 'sql_variant' ELSE 'Flag' END AS name,
               CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END AS is_assembly_type,
               CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS is_user_defined,
               CAST(0 AS INT) AS is_table_type, CAST(1 AS INT) AS schema_id
        FROM {{lineitem}} GROUP BY {_db('l_orderkey')}, l_linenumber""",
    "indexes": f"""
        SELECT {_db('o_orderkey')} AS database, o_orderkey AS object_id,
               CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS index_id,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE concat('pk_t', o_orderkey) END AS name,
               CASE WHEN o_orderstatus = 'F' THEN 'HEAP' ELSE 'CLUSTERED' END AS type_desc,
               CAST(1 AS INT) AS is_unique, CAST(0 AS INT) AS has_filter, CAST(0 AS INT) AS is_disabled, CAST(90 AS INT) AS fill_factor,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS data_space_id, CAST(NULL AS VARCHAR(10)) AS filter_definition,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_primary_key
        FROM {{orders}}
        UNION ALL
        SELECT {_db('l_orderkey')}, l_orderkey, l_suppkey + 2, concat('ix_', l_suppkey), 'NONCLUSTERED',
               0, CASE WHEN min(l_linenumber) = 1 THEN 1 ELSE 0 END, 0, CAST(min(l_linenumber) AS INT), 1,
               CASE WHEN min(l_linenumber) = 1 THEN '(a=1)' END, 0
        FROM {{lineitem}} GROUP BY l_orderkey, l_suppkey""",
    "index_columns": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id, l_suppkey + 2 AS index_id, {_COLUMN} AS column_id,
               CAST(l_linenumber AS INT) AS key_ordinal, l_partkey AS index_column_id,
               CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS is_included_column,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_descending_key
        FROM {{lineitem}}
        UNION ALL
        SELECT {_db('l_orderkey')}, l_orderkey, CAST(1 AS BIGINT), {_COLUMN}, CAST(l_linenumber AS INT), l_partkey, 0, 0
        FROM {{lineitem}} WHERE l_linenumber <= 2""",
    "partition_stats": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id,
               CASE WHEN l_linestatus = 'O' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS index_id, {_PARTITION} AS partition_id,
               CAST(l_quantity AS BIGINT) AS row_count, l_suppkey AS reserved_page_count, CAST(l_linenumber AS BIGINT) AS used_page_count,
               CAST(l_linenumber AS BIGINT) AS in_row_data_page_count, CAST(1 AS BIGINT) AS lob_used_page_count,
               CAST(0 AS BIGINT) AS row_overflow_used_page_count
        FROM {{lineitem}}""",
    "allocation_units": f"""
        SELECT {_db('l_orderkey')} AS database, {_PARTITION} AS container_id, l_suppkey AS total_pages,
               CASE WHEN l_returnflag = 'N' THEN 'IN_ROW_DATA' ELSE 'LOB_DATA' END AS type_desc
        FROM {{lineitem}}""",
    "partitions": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id, l_suppkey + 2 AS index_id, {_PARTITION} AS partition_id,
               CAST(l_linenumber AS INT) AS partition_number
        FROM {{lineitem}}""",
    "index_physical_stats": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id, l_suppkey + 2 AS index_id,
               CAST(max(l_tax) AS DOUBLE) AS avg_fragmentation_in_percent, sum(l_linenumber * 7) AS page_count,
               CAST(max(l_discount) AS DOUBLE) AS avg_page_space_used_in_percent, count(*) AS record_count
        FROM {{lineitem}} WHERE l_returnflag <> 'R' GROUP BY l_orderkey, l_suppkey""",
    "index_usage_stats": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id, l_suppkey + 2 AS index_id,
               CAST(max(l_quantity) AS BIGINT) AS user_seeks, CAST(min(l_linenumber) AS BIGINT) AS user_scans,
               CAST(0 AS BIGINT) AS user_lookups, count(*) AS user_updates
        FROM {{lineitem}} WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_suppkey""",
    "foreign_keys": f"""
        SELECT {_db('o_orderkey')} AS database, o_orderkey AS object_id, concat('fk_', o_orderkey) AS name, o_orderkey AS parent_object_id,
               CAST(floor(o_orderkey / 4096) AS BIGINT) * 4096 + (o_custkey % 512) AS referenced_object_id,
               CASE WHEN o_orderstatus = 'P' THEN 'CASCADE' ELSE 'NO_ACTION' END AS delete_action, 'NO_ACTION' AS update_action,
               CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS is_not_trusted, CAST(0 AS INT) AS is_disabled,
               CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS is_system_named
        FROM {{orders}} WHERE o_orderpriority <> '3-MEDIUM'""",
    "foreign_key_columns": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS constraint_object_id, {_COLUMN} AS constraint_column_id,
               l_orderkey AS parent_object_id, {_COLUMN} AS parent_column_id, l_orderkey AS referenced_object_id, {_COLUMN} AS referenced_column_id
        FROM {{lineitem}}""",
    "key_constraints": f"""
        SELECT {_db('o_orderkey')} AS database, concat('pk_t', o_orderkey) AS name, o_orderkey AS parent_object_id, CAST(1 AS BIGINT) AS unique_index_id,
               CASE WHEN o_orderstatus = 'O' THEN 'PK' ELSE 'UQ' END AS type,
               CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS is_system_named
        FROM {{orders}} WHERE o_orderstatus <> 'F'""",
    "check_constraints": f"""
        SELECT {_db('l_orderkey')} AS database, concat('ck_', l_partkey) AS name, l_orderkey AS parent_object_id,
               CASE WHEN l_returnflag = 'R' THEN CAST(0 AS BIGINT) ELSE {_COLUMN} END AS parent_column_id,
               concat('([c', l_partkey, ']>(0))') AS definition, CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS is_not_trusted,
               CAST(0 AS INT) AS is_disabled, CAST(1 AS INT) AS is_system_named
        FROM {{lineitem}} WHERE l_linenumber = 3""",
    "default_constraints": f"""
        SELECT {_db('l_orderkey')} AS database, concat('df_', l_partkey) AS name, l_orderkey AS parent_object_id, {_COLUMN} AS parent_column_id,
               concat('(NEXT VALUE FOR [s1].[q', l_suppkey, '])') AS definition, CAST(0 AS INT) AS is_system_named
        FROM {{lineitem}} WHERE l_linenumber = 4""",
    "computed_columns": f"""
        SELECT {_db('l_orderkey')} AS database, l_orderkey AS object_id, {_COLUMN} AS column_id,
               concat('([s2].[f', l_suppkey, ']([c', min(l_partkey), ']))') AS definition,
               CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END AS is_persisted
        FROM {{lineitem}} WHERE l_linenumber = 5 GROUP BY l_orderkey, l_suppkey, {_COLUMN}""",
    "triggers": f"""
        SELECT {_db('o_orderkey')} AS database, {_TRIG} + o_orderkey AS object_id, concat('g', o_orderkey) AS name, o_orderkey AS parent_id
        FROM {{orders}} WHERE o_orderpriority = '2-HIGH'""",
    "trigger_events": f"""
        SELECT {_db('o_orderkey')} AS database, {_TRIG} + o_orderkey AS object_id, 'INSERT' AS type_desc FROM {{orders}}
        UNION ALL
        SELECT {_db('o_orderkey')}, {_TRIG} + o_orderkey, 'UPDATE' FROM {{orders}} WHERE o_orderstatus = 'O'""",
    "procedures": f"""
        SELECT {_db('c_custkey')} AS database, {_PROC} + c_custkey AS object_id, CAST(1 AS INT) AS schema_id, concat('p', c_custkey) AS name,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS create_date, CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS modify_date,
               CAST(0 AS INT) AS is_encrypted
        FROM {{customer}}""",
    "views": f"""
        SELECT {_db('s_suppkey')} AS database, {_VIEW} + s_suppkey AS object_id, CAST(1 AS INT) AS schema_id, concat('v', s_suppkey) AS name,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS create_date, CAST(NULL AS TIMESTAMP) AS modify_date
        FROM {{supplier}}""",
    "sql_modules": f"""
        SELECT {_db('c_custkey')} AS database, {_PROC} + c_custkey AS object_id, {_PROC_TEXT} AS definition, CAST(c_nationkey AS INT) AS execute_as_principal_id FROM {{customer}}
        UNION ALL SELECT {_db('s_suppkey')}, {_VIEW} + s_suppkey, {_VIEW_TEXT}, NULL FROM {{supplier}}
        UNION ALL SELECT {_db('s_suppkey')}, {_FUNC} + s_suppkey, {_FUNC_TEXT}, NULL FROM {{supplier}}
        UNION ALL SELECT {_db('o_orderkey')}, {_TRIG} + o_orderkey, {_TRIG_TEXT}, NULL FROM {{orders}} WHERE o_orderpriority = '2-HIGH'""",
    "objects": f"""
        SELECT {_db('c_custkey')} AS database, {_PROC} + c_custkey AS object_id, CAST(1 AS INT) AS schema_id, concat('p', c_custkey) AS name, 'P' AS type, 'SQL_STORED_PROCEDURE' AS type_desc FROM {{customer}}
        UNION ALL SELECT {_db('s_suppkey')}, {_VIEW} + s_suppkey, 1, concat('v', s_suppkey), 'V', 'VIEW' FROM {{supplier}}
        UNION ALL SELECT {_db('s_suppkey')}, {_FUNC} + s_suppkey, 2, concat('f', s_suppkey), 'FN', CASE WHEN s_nationkey = 3 THEN NULL ELSE 'SQL_SCALAR_FUNCTION' END FROM {{supplier}}""",
    "parameters": f"""
        SELECT {_db('s_suppkey')} AS database, {_FUNC} + s_suppkey AS object_id, CAST(0 AS INT) AS parameter_id, CAST(1 + s_nationkey % 7 AS INT) AS user_type_id FROM {{supplier}} WHERE s_acctbal > 0
        UNION ALL SELECT {_db('s_suppkey')}, {_FUNC} + s_suppkey, 1, 1 FROM {{supplier}}""",
    "jobs": """
        SELECT c_custkey AS job_id, c_name AS name, CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS enabled, c_mktsegment AS owner,
               concat('job of ', c_name) AS description, CAST(c_nationkey AS INT) AS category_id, CAST(c_nationkey % 4 AS INT) AS operator_id,
               CAST(c_nationkey % 6 AS INT) AS notify_level, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS date_created,
               CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS date_modified
        FROM {customer}""",
    "job_categories": "SELECT CAST(n_nationkey AS INT) AS category_id, n_name AS name FROM {nation} WHERE n_regionkey <> 1",
    "job_operators": "SELECT CAST(r_regionkey AS INT) AS id, r_name AS name FROM {region} WHERE r_regionkey > 0",
    "job_steps": """
        SELECT o_custkey AS job_id, CAST(o_orderkey AS INT) AS step_id, concat('step ', o_orderkey) AS step_name,
               CASE WHEN o_orderstatus = 'F' THEN 'CmdExec' ELSE 'TSQL' END AS subsystem, 'db0' AS database_name,
               concat('EXEC s1.p', o_custkey) AS command, CAST(substr(o_orderpriority, 1, 1) AS INT) AS on_success_action,
               CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 9 END AS on_fail_action,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS retry_attempts, CAST(5 AS INT) AS retry_interval
        FROM {orders}""",
    "job_schedules": """
        SELECT o_custkey AS job_id, o_orderkey AS schedule_id,
               CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) END AS next_run_date,
               CAST(substr(o_orderpriority, 1, 1) AS INT) * 10000 + 1530 AS next_run_time
        FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "schedules": """
        SELECT o_orderkey AS schedule_id, concat('schedule ', o_orderkey) AS schedule_name,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 4 WHEN '3' THEN 8 WHEN '4' THEN 64 ELSE 99 END AS freq_type,
               CAST(o_custkey % 3 AS INT) AS freq_interval
        FROM {orders}""",
    "job_history": """
        SELECT user_id AS job_id, event_id AS instance_id, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS step_id,
               CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS run_date,
               CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS INT) AS run_time,
               CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 3 ELSE 7 END AS run_status
        FROM {events}""",
    "synonyms": f"""
        SELECT {_db('s_suppkey')} AS database, CAST(2 AS INT) AS schema_id, concat('y', s_suppkey) AS name,
               concat('s1.', CASE WHEN s_nationkey < 8 THEN 'v' WHEN s_nationkey < 16 THEN 'p' ELSE 't' END, s_suppkey) AS base_object_name
        FROM {{supplier}}""",
    "sequences": f"""
        SELECT {_db('p_partkey')} AS database, CAST(1 AS INT) AS schema_id, concat('q', p_partkey) AS name, CAST(p_size AS INT) AS start_value, 1 AS increment,
               0 AS minimum_value, p_partkey AS maximum_value, CAST(NULL AS INT) AS cache_size
        FROM {{part}}""",
    "xml_schema_collections": f"""
        SELECT {_db('l_orderkey')} AS database, l_suppkey AS xml_collection_id, CAST(1 AS INT) AS schema_id, concat('x', l_suppkey) AS name
        FROM {{lineitem}} GROUP BY {_db('l_orderkey')}, l_suppkey""",
    "assemblies": f"""
        SELECT {_db('p_partkey')} AS database, CAST(p_size AS INT) AS principal_id, concat('asm', p_partkey) AS name, p_type AS permission_set_desc,
               CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS is_visible
        FROM {{part}}""",
    "database_principals": f"""
        SELECT {_db('c_custkey')} AS database, CAST(c_custkey AS INT) AS principal_id, c_name AS name,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'S' WHEN 'MACHINERY' THEN 'R' WHEN 'HOUSEHOLD' THEN 'U' ELSE 'X' END AS type,
               concat('s', c_nationkey) AS default_schema_name, CAST(c_nationkey AS INT) AS owning_principal_id
        FROM {{customer}}""",
    "database_permissions": f"""
        SELECT {_db('o_custkey')} AS database, CAST(o_custkey AS INT) AS grantee_principal_id, 'OBJECT' AS class_desc,
               concat('t', o_orderkey) AS object_name, o_orderpriority AS permission_name, o_orderstatus AS state_desc
        FROM {{orders}}""",
    "expression_dependencies": f"""
        SELECT {_db('o_custkey')} AS database, {_PROC} + o_custkey AS referencing_id,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 's1' END AS referenced_schema_name,
               concat(CASE WHEN o_orderpriority = '2-HIGH' THEN 'p' ELSE 't' END, o_custkey) AS referenced_entity_name,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'TYPE' ELSE 'OBJECT_OR_COLUMN' END AS referenced_class_desc,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS is_ambiguous
        FROM {{orders}}""",
}


class Estate:
    """Raw relations by name, built when asked for."""

    def __init__(self, tables: Tables):
        self._tables = tables
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._tables.sql(RAW[name])
        return self._built[name]


def with_raw(body: str) -> str:
    """Checking SQL: the raw relations it names as sys_<name>, then the body."""
    used = [n for n in RAW if f"sys_{n} " in body + " " or f"sys_{n}\n" in body or f"sys_{n})" in body]
    ctes = ",\n".join(f"sys_{n} AS ({plain(RAW[n])})" for n in used)
    return f"WITH {ctes}\n{body}" if not body.lstrip().upper().startswith("WITH") else f"WITH {ctes},{body.lstrip()[4:]}"
