"""Catalog relations over the estate the given tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.plans import catalog, quality, summary
from demesne.queries.estate import Estate, with_raw
from demesne.queries.registry import mb, pct, query


def flat(df: DataFrame) -> DataFrame:
    """Lists as text, so that results can be compared value by value."""
    cols = []
    for name, kind in df.dtypes:
        cols.append(F.array_join(name, "; ").alias(name) if kind == "array<string>" else F.col(f"`{name}`"))
    return df.select(*cols)


ISO = "'%Y-%m-%dT%H:%M:%S'"
TABLE_NAMES = """
tn AS (SELECT t.database, t.object_id, s.name AS sch, t.name AS tab
       FROM sys_tables t JOIN sys_schemas s USING (database, schema_id))"""
DB_PAGES = "dbp AS (SELECT database, CAST(sum(size) AS BIGINT) AS pages FROM sys_master_files GROUP BY 1)"


@query(
    "catalog_databases",
    with_raw(f"""WITH {DB_PAGES},
b AS (SELECT database_name AS database, max(CASE WHEN type = 'D' THEN backup_finish_date END) AS f,
             max(CASE WHEN type = 'I' THEN backup_finish_date END) AS d, max(CASE WHEN type = 'L' THEN backup_finish_date END) AS l
      FROM sys_backupset GROUP BY 1),
r AS (SELECT destination_database_name AS database, max(restore_date) AS r FROM sys_restorehistory GROUP BY 1)
SELECT d.database AS name, {mb('pages')} AS size_mb, recovery_model_desc AS recovery_model, CAST(compatibility_level AS VARCHAR) AS compatibility_level,
       owner_name AS database_owner, collation_name, strftime(create_date, {ISO}) AS create_date,
       CAST(is_auto_close_on AS BOOLEAN) AS auto_close, CAST(is_auto_shrink_on AS BOOLEAN) AS auto_shrink,
       CAST(is_read_only AS BOOLEAN) AS is_read_only, CAST(is_trustworthy_on AS BOOLEAN) AS is_trustworthy_on,
       page_verify_option_desc AS page_verify_option, containment_desc AS containment,
       snapshot_isolation_state_desc = 'ON' AS is_snapshot_isolation_on, CAST(is_read_committed_snapshot_on AS BOOLEAN) AS is_read_committed_snapshot_on,
       strftime(f, {ISO}) AS last_full_backup, strftime(b.d, {ISO}) AS last_differential_backup, strftime(l, {ISO}) AS last_log_backup,
       strftime(r.r, {ISO}) AS last_restore_date, strftime(greatest(f, b.d, l), {ISO}) AS last_backup_date
FROM sys_databases d JOIN dbp USING (database) LEFT JOIN b USING (database) LEFT JOIN r USING (database)"""),
)
def catalog_databases(t):
    return catalog.databases(Estate(t))


@query(
    "catalog_database_files",
    with_raw(f"""SELECT f.database, f.name AS logical_name, physical_name, g.name AS filegroup, {mb('size')} AS current_size_mb,
       {mb('CASE WHEN max_size = -1 THEN NULL ELSE max_size END')} AS max_size_mb,
       CASE WHEN is_percent_growth THEN CAST(growth AS DOUBLE) ELSE {mb('growth')} END AS growth_mb,
       CASE WHEN is_percent_growth THEN 'PERCENT' ELSE 'MB' END AS growth_type,
       {pct('size', '(sum(size) OVER (PARTITION BY f.database))')} AS percent_of_total_database
FROM sys_database_files f LEFT JOIN sys_filegroups g ON g.database = f.database AND g.data_space_id = f.data_space_id"""),
)
def catalog_database_files(t):
    return catalog.database_files(Estate(t))


TABLES_SQL = f"""WITH {TABLE_NAMES}, {DB_PAGES},
au AS (SELECT database, container_id, sum(total_pages) AS pages FROM sys_allocation_units GROUP BY 1, 2),
st AS (SELECT p.database, p.object_id, sum(row_count) AS rc, sum(au.pages) AS tp, sum(reserved_page_count) AS rp, sum(used_page_count) AS up,
              sum(in_row_data_page_count + lob_used_page_count + row_overflow_used_page_count) AS dp
       FROM sys_partition_stats p LEFT JOIN au ON au.database = p.database AND au.container_id = p.partition_id
       WHERE index_id IN (0, 1) GROUP BY 1, 2),
co AS (SELECT c.database, c.object_id, count(*) AS n,
              string_agg(CASE WHEN identity_seed IS NOT NULL THEN c.name END, '; ' ORDER BY c.column_id, c.name) AS idc,
              string_agg(CASE WHEN k.column_id IS NOT NULL THEN c.name END, '; ' ORDER BY c.column_id, c.name) AS cc,
              string_agg(CASE WHEN is_sparse = 1 THEN c.name END, '; ' ORDER BY c.column_id, c.name) AS sc
       FROM sys_columns c LEFT JOIN (SELECT database, object_id, column_id FROM sys_computed_columns ) k USING (database, object_id, column_id)
       GROUP BY 1, 2)
, pn AS (SELECT database, object_id, max(partition_number) AS n FROM sys_partitions WHERE index_id IN (0, 1) GROUP BY 1, 2)
SELECT tn.database, tn.sch AS schema, tn.tab AS name, CAST(coalesce(rc, 0) AS BIGINT) AS row_count, {mb('coalesce(tp, 0)')} AS size_mb,
       CAST(coalesce(co.n, 0) AS BIGINT) AS column_count, strftime(t.create_date, {ISO}) AS create_date, strftime(t.modify_date, {ISO}) AS modify_date,
       CASE WHEN EXISTS (SELECT 1 FROM sys_indexes i WHERE i.database = t.database AND i.object_id = t.object_id AND i.type_desc = 'HEAP') THEN 'HEAP' ELSE 'CLUSTERED' END AS table_type,
       CAST((SELECT count(*) FROM sys_indexes i WHERE i.database = t.database AND i.object_id = t.object_id AND i.type_desc = 'NONCLUSTERED') AS BIGINT) AS nonclustered_index_count,
       CAST((SELECT count(*) FROM sys_foreign_keys f WHERE f.database = t.database AND f.parent_object_id = t.object_id) AS BIGINT) AS foreign_key_count,
       CAST((SELECT count(DISTINCT referenced_object_id) FROM sys_foreign_keys f WHERE f.database = t.database AND f.parent_object_id = t.object_id) AS BIGINT) AS referenced_table_count,
       CAST((SELECT count(DISTINCT parent_object_id) FROM sys_foreign_keys f WHERE f.database = t.database AND f.referenced_object_id = t.object_id) AS BIGINT) AS referencing_table_count,
       CAST((SELECT count(*) FROM sys_triggers g WHERE g.database = t.database AND g.parent_id = t.object_id) AS BIGINT) AS trigger_count,
       CAST(coalesce(rp, 0) AS BIGINT) AS estimated_reserved_pages, CAST(coalesce(up, 0) AS BIGINT) AS used_pages, CAST(coalesce(dp, 0) AS BIGINT) AS data_pages,
       {pct('coalesce(tp, 0)', 'dbp.pages')} AS percent_of_database_occupied,
       coalesce(idc, '') AS identity_columns, coalesce(cc, '') AS computed_columns, coalesce(sc, '') AS sparse_columns,
       t.temporal_type = 2 AS is_temporal_table, CAST(t.is_memory_optimized AS BOOLEAN) AS is_memory_optimized, CAST(t.is_tracked_by_cdc AS BOOLEAN) AS is_cdc_enabled,
       EXISTS (SELECT 1 FROM sys_change_tracking_tables k WHERE k.database = t.database AND k.object_id = t.object_id) AS is_change_tracking_enabled,
       coalesce(pn.n, 0) > 1 AS is_partitioned, CAST(coalesce(pn.n, 0) AS BIGINT) AS partition_count
FROM sys_tables t JOIN tn ON tn.database = t.database AND tn.object_id = t.object_id
LEFT JOIN st ON st.database = t.database AND st.object_id = t.object_id LEFT JOIN co ON co.database = t.database AND co.object_id = t.object_id
LEFT JOIN dbp ON dbp.database = t.database LEFT JOIN pn ON pn.database = t.database AND pn.object_id = t.object_id"""


@query("catalog_tables", with_raw(TABLES_SQL))
def catalog_tables(t):
    return flat(catalog.tables(Estate(t)))


COLUMNS_SQL = f"""WITH {TABLE_NAMES},
xc AS (SELECT x.database, x.xml_collection_id, s.name || '.' || x.name AS q FROM sys_xml_schema_collections x JOIN sys_schemas s USING (database, schema_id)),
ck AS (SELECT database, parent_object_id, parent_column_id, min(definition) AS d FROM sys_check_constraints GROUP BY 1, 2, 3)
SELECT c.database, tn.sch AS schema, tn.tab AS "table", c.name, ty.name AS data_type, CAST(c.is_nullable AS BOOLEAN) AS nullable, c.column_id AS ordinal_position,
       dc.definition AS default_constraint, ck.d AS check_constraint, c.identity_seed, c.identity_increment, cc.definition AS computed_expression,
       CAST(cc.is_persisted AS BOOLEAN) AS is_persisted, c.collation_name, CAST(c.is_rowguidcol AS BOOLEAN) AS is_rowguid,
       CAST(is_sparse AS BOOLEAN) AS is_sparse, CAST(c.is_nullable AS BOOLEAN) AS is_nullable, CAST(is_filestream AS BOOLEAN) AS is_filestream,
       CAST(ty.is_assembly_type AS BOOLEAN) AS is_clr_type, c.max_length, xc.q AS xml_schema_collection
FROM sys_columns c JOIN sys_types ty USING (database, user_type_id) JOIN tn USING (database, object_id)
LEFT JOIN sys_default_constraints dc ON dc.database = c.database AND dc.parent_object_id = c.object_id AND dc.parent_column_id = c.column_id
LEFT JOIN ck ON ck.database = c.database AND ck.parent_object_id = c.object_id AND ck.parent_column_id = c.column_id
LEFT JOIN sys_computed_columns cc ON cc.database = c.database AND cc.object_id = c.object_id AND cc.column_id = c.column_id
LEFT JOIN xc ON xc.database = c.database AND xc.xml_collection_id = c.xml_collection_id"""


@query("catalog_columns", with_raw(COLUMNS_SQL))
def catalog_columns(t):
    return catalog.columns(Estate(t))


@query(
    "catalog_procedures",
    with_raw(f"""SELECT p.database, s.name AS schema, p.name, m.definition,
       CAST(length(m.definition) - length(replace(m.definition, chr(10), '')) + 1 AS BIGINT) AS loc,
       strftime(create_date, {ISO}) AS create_date, strftime(modify_date, {ISO}) AS modify_date, CAST(is_encrypted AS BOOLEAN) AS is_encrypted,
       CAST(execute_as_principal_id AS VARCHAR) AS execute_as, 'direct_metadata' AS parse_status
FROM sys_procedures p JOIN sys_schemas s USING (database, schema_id) JOIN sys_sql_modules m USING (database, object_id)"""),
)
def catalog_procedures(t):
    return catalog.procedures(Estate(t))


@query(
    "catalog_views",
    with_raw(f"""SELECT p.database, s.name AS schema, p.name, m.definition, strftime(create_date, {ISO}) AS create_date,
       strftime(modify_date, {ISO}) AS modify_date, 'direct_metadata' AS parse_status
FROM sys_views p JOIN sys_schemas s USING (database, schema_id) JOIN sys_sql_modules m USING (database, object_id)"""),
)
def catalog_views(t):
    return catalog.views(Estate(t))


@query(
    "catalog_functions",
    with_raw("""SELECT o.database, s.name AS schema, o.name, coalesce(m.definition, '') AS definition, coalesce(o.type_desc, 'SCALAR') AS function_type, ty.name AS return_type
FROM sys_objects o JOIN sys_schemas s USING (database, schema_id)
LEFT JOIN sys_parameters p ON p.database = o.database AND p.object_id = o.object_id AND p.parameter_id = 0
LEFT JOIN sys_types ty ON ty.database = o.database AND ty.user_type_id = p.user_type_id
LEFT JOIN sys_sql_modules m ON m.database = o.database AND m.object_id = o.object_id
WHERE o.type IN ('FN', 'IF', 'TF')"""),
)
def catalog_functions(t):
    return catalog.functions(Estate(t))


@query(
    "catalog_triggers",
    with_raw(f"""WITH {TABLE_NAMES},
ev AS (SELECT database, object_id, string_agg(DISTINCT type_desc, ',' ORDER BY type_desc) AS event FROM sys_trigger_events GROUP BY 1, 2)
SELECT g.database, tn.sch AS schema, g.name, m.definition, tn.sch || '.' || tn.tab AS "table", ev.event
FROM sys_triggers g JOIN tn ON tn.database = g.database AND tn.object_id = g.parent_id
JOIN sys_sql_modules m ON m.database = g.database AND m.object_id = g.object_id JOIN ev ON ev.database = g.database AND ev.object_id = g.object_id"""),
)
def catalog_triggers(t):
    return catalog.triggers(Estate(t))


def _case(code: str, labels: dict) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + " END"


_PACKED_DATE = "CASE WHEN {0} <> 0 THEN substr(lpad(CAST({0} AS VARCHAR), 8, '0'), 1, 4) || '-' || substr(lpad(CAST({0} AS VARCHAR), 8, '0'), 5, 2) || '-' || substr(lpad(CAST({0} AS VARCHAR), 8, '0'), 7, 2) END"
_PACKED_TIME = "substr(lpad(CAST({0} AS VARCHAR), 6, '0'), 1, 2) || ':' || substr(lpad(CAST({0} AS VARCHAR), 6, '0'), 3, 2) || ':' || substr(lpad(CAST({0} AS VARCHAR), 6, '0'), 5, 2)"

JOBS_SQL = f"""WITH st AS (
  SELECT job_id, count(*) AS n, arg_max(coalesce(retry_attempts, 0), step_id) AS ra, arg_max(coalesce(retry_interval, 0), step_id) AS ri,
         string_agg(step_id || '|' || step_name || '|' || subsystem || '|' || command || '|' ||
           coalesce({_case('on_success_action', catalog.STEP_ACTION)}, '') || '|' || coalesce({_case('on_fail_action', catalog.STEP_ACTION)}, ''), '; ' ORDER BY step_id) AS steps
  FROM sys_job_steps GROUP BY 1),
sc AS (SELECT j.job_id, string_agg(schedule_name, '; ' ORDER BY j.schedule_id) AS names,
              string_agg(coalesce({_case('freq_type', {1: 'Once', 4: 'Daily', 8: 'Weekly', 64: 'Start Automatically When SQL Server Agent Starts'})}, 'Unknown')
                || CASE WHEN freq_type IN (4, 8, 16) AND freq_interval <> 0 THEN ' (interval=' || freq_interval || ')' ELSE '' END, '; ' ORDER BY j.schedule_id) AS freqs
       FROM sys_job_schedules j JOIN sys_schedules s ON s.schedule_id = j.schedule_id GROUP BY 1),
nx AS (SELECT job_id, min(next_run_date * CAST(1000000 AS BIGINT) + next_run_time) AS p FROM sys_job_schedules WHERE next_run_date > 0 GROUP BY 1),
lr AS (SELECT h.* FROM sys_job_history h JOIN (SELECT job_id, max(instance_id) AS m FROM sys_job_history WHERE step_id = 0 GROUP BY 1) x ON x.job_id = h.job_id AND x.m = h.instance_id)
SELECT j.name, CAST(enabled AS BOOLEAN) AS enabled, owner, c.name AS category, description, strftime(date_created, {ISO}) AS date_created,
       strftime(date_modified, {ISO}) AS date_modified, CAST(ra AS BIGINT) AS retry_attempts, CAST(ri AS BIGINT) AS retry_interval, op.name AS notification_operator,
       {_case('notify_level', catalog.NOTIFY_LEVEL)} AS notification_method, {_PACKED_DATE.format('lr.run_date')} AS last_run_date,
       {_PACKED_TIME.format('lr.run_time')} AS last_run_time, {_case('lr.run_status', catalog.RUN_STATUS)} AS last_run_status,
       {_PACKED_DATE.format('(nx.p // 1000000)')} || 'T' || {_PACKED_TIME.format('(nx.p % 1000000)')} AS next_scheduled_run,
       CAST(st.n AS BIGINT) AS step_count, coalesce(sc.names, '') AS schedule_names, coalesce(sc.freqs, '') AS schedule_frequency, st.steps AS steps
FROM sys_jobs j JOIN st ON st.job_id = j.job_id LEFT JOIN sys_job_categories c ON c.category_id = j.category_id
LEFT JOIN sys_job_operators op ON op.id = j.operator_id LEFT JOIN sc ON sc.job_id = j.job_id LEFT JOIN nx ON nx.job_id = j.job_id LEFT JOIN lr ON lr.job_id = j.job_id"""


@query("catalog_agent_jobs", with_raw(JOBS_SQL))
def catalog_agent_jobs(t):
    jobs = catalog.agent_jobs(Estate(t))
    text = lambda s: F.concat_ws(
        "|", s["step_id"].cast("string"), s["name"], s["subsystem"], s["command"],
        F.coalesce(s["on_success_action"], F.lit("")), F.coalesce(s["on_fail_action"], F.lit("")),
    )
    return flat(jobs.withColumn("steps", F.array_join(F.transform("step_details", text), "; ")).drop("step_details"))


INDEXES_SQL = f"""WITH {TABLE_NAMES}, {DB_PAGES},
ic AS (SELECT i.database, i.object_id, i.index_id,
         string_agg(CASE WHEN is_included_column = 0 THEN c.name END, '; ' ORDER BY key_ordinal, index_column_id, is_included_column, c.name, is_descending_key) AS kc,
         string_agg(CASE WHEN is_included_column = 0 THEN CASE WHEN is_descending_key = 1 THEN 'DESC' ELSE 'ASC' END END, '; ' ORDER BY key_ordinal, index_column_id, is_included_column, c.name, is_descending_key) AS ks,
         string_agg(CASE WHEN is_included_column = 1 THEN c.name END, '; ' ORDER BY key_ordinal, index_column_id, is_included_column, c.name, is_descending_key) AS inc
       FROM sys_index_columns i JOIN sys_columns c USING (database, object_id, column_id) GROUP BY 1, 2, 3),
pa AS (SELECT p.database, p.object_id, p.index_id, count(DISTINCT partition_number) AS n, max(a.type_desc) AS ut
       FROM sys_partitions p LEFT JOIN sys_allocation_units a ON a.database = p.database AND a.container_id = p.partition_id GROUP BY 1, 2, 3),
ts AS (SELECT database, object_id, sum(reserved_page_count) AS pages FROM sys_partition_stats GROUP BY 1, 2)
SELECT i.database, tn.sch AS schema, tn.tab AS "table", i.name, i.type_desc = 'CLUSTERED' AS is_clustered, i.type_desc = 'NONCLUSTERED' AS is_nonclustered,
       CAST(is_unique AS BOOLEAN) AS is_unique, CAST(has_filter AS BOOLEAN) AS is_filtered, CAST(is_disabled AS BOOLEAN) AS is_disabled, fill_factor,
       i.type_desc AS index_type, CAST(is_primary_key AS BOOLEAN) AS is_primary_key, filter_definition, coalesce(kc, '') AS key_columns, coalesce(ks, '') AS key_column_sort,
       coalesce(inc, '') AS included_columns, coalesce(pa.n > 1, FALSE) AS is_partitioned, CAST(pa.n AS BIGINT) AS partition_count, g.name AS filegroup, pa.ut AS allocation_unit_type,
       avg_fragmentation_in_percent AS fragmentation_pct, CAST(ph.page_count AS BIGINT) AS page_count, {mb('ph.page_count')} AS index_size_mb,
       avg_page_space_used_in_percent AS avg_page_space_used_pct, CAST(ph.record_count AS BIGINT) AS record_count,
       us.user_seeks, us.user_scans, us.user_lookups, CAST(us.user_updates AS BIGINT) AS user_updates,
       {pct('nullif(ph.page_count, 0)', 'ts.pages')} AS percent_of_table, {pct('nullif(ph.page_count, 0)', 'dbp.pages')} AS percent_of_database
FROM sys_indexes i JOIN tn USING (database, object_id)
LEFT JOIN sys_filegroups g ON g.database = i.database AND g.data_space_id = i.data_space_id
LEFT JOIN ic ON ic.database = i.database AND ic.object_id = i.object_id AND ic.index_id = i.index_id
LEFT JOIN pa ON pa.database = i.database AND pa.object_id = i.object_id AND pa.index_id = i.index_id
LEFT JOIN sys_index_physical_stats ph ON ph.database = i.database AND ph.object_id = i.object_id AND ph.index_id = i.index_id
LEFT JOIN sys_index_usage_stats us ON us.database = i.database AND us.object_id = i.object_id AND us.index_id = i.index_id
LEFT JOIN ts ON ts.database = i.database AND ts.object_id = i.object_id LEFT JOIN dbp ON dbp.database = i.database
WHERE i.name IS NOT NULL AND i.type_desc IN ('CLUSTERED', 'NONCLUSTERED')"""


@query("catalog_indexes", with_raw(INDEXES_SQL))
def catalog_indexes(t):
    return flat(catalog.indexes(Estate(t)))


@query(
    "catalog_foreign_keys",
    with_raw(f"""WITH {TABLE_NAMES}
SELECT f.database, a.sch || '.' || a.tab AS from_table, b.sch || '.' || b.tab AS to_table
FROM sys_foreign_keys f JOIN tn a ON a.database = f.database AND a.object_id = f.parent_object_id JOIN tn b ON b.database = f.database AND b.object_id = f.referenced_object_id"""),
)
def catalog_foreign_keys(t):
    return catalog.foreign_keys(Estate(t))


CONSTRAINTS_SQL = f"""WITH {TABLE_NAMES},
pk AS (SELECT k.database, k.name, k.parent_object_id, k.type, k.is_system_named, string_agg(c.name, '; ' ORDER BY i.key_ordinal, c.name) AS cols
       FROM sys_key_constraints k JOIN sys_index_columns i ON i.database = k.database AND i.object_id = k.parent_object_id AND i.index_id = k.unique_index_id
       JOIN sys_columns c ON c.database = i.database AND c.object_id = i.object_id AND c.column_id = i.column_id GROUP BY ALL),
fc AS (SELECT x.database, x.constraint_object_id, string_agg(p.name, '; ' ORDER BY x.constraint_column_id, p.name, r.name) AS cols, string_agg(r.name, '; ' ORDER BY x.constraint_column_id, p.name, r.name) AS rcols
       FROM sys_foreign_key_columns x JOIN sys_columns p ON p.database = x.database AND p.object_id = x.parent_object_id AND p.column_id = x.parent_column_id
       JOIN sys_columns r ON r.database = x.database AND r.object_id = x.referenced_object_id AND r.column_id = x.referenced_column_id GROUP BY 1, 2)
SELECT pk.database, tn.sch AS schema, tn.tab AS "table", pk.name, CASE WHEN pk.type = 'PK' THEN 'PRIMARY_KEY' ELSE 'UNIQUE' END AS constraint_type, pk.cols AS columns,
       CAST(NULL AS VARCHAR) AS referenced_table, '' AS referenced_columns, CAST(NULL AS VARCHAR) AS delete_action, CAST(NULL AS VARCHAR) AS update_action,
       CAST(NULL AS BOOLEAN) AS is_trusted, CAST(NULL AS BOOLEAN) AS is_disabled, CAST(pk.is_system_named AS BOOLEAN) AS is_system_named, CAST(NULL AS VARCHAR) AS definition
FROM pk JOIN tn ON tn.database = pk.database AND tn.object_id = pk.parent_object_id
UNION ALL
SELECT f.database, a.sch, a.tab, f.name, 'FOREIGN_KEY', fc.cols, b.sch || '.' || b.tab, fc.rcols, delete_action, update_action, is_not_trusted = 0, CAST(is_disabled AS BOOLEAN), CAST(is_system_named AS BOOLEAN), NULL
FROM sys_foreign_keys f JOIN fc ON fc.database = f.database AND fc.constraint_object_id = f.object_id
JOIN tn a ON a.database = f.database AND a.object_id = f.parent_object_id JOIN tn b ON b.database = f.database AND b.object_id = f.referenced_object_id
UNION ALL
SELECT k.database, tn.sch, tn.tab, k.name, 'CHECK', coalesce(c.name, ''), NULL, '', NULL, NULL, is_not_trusted = 0, CAST(is_disabled AS BOOLEAN), CAST(is_system_named AS BOOLEAN), k.definition
FROM sys_check_constraints k JOIN tn ON tn.database = k.database AND tn.object_id = k.parent_object_id
LEFT JOIN sys_columns c ON c.database = k.database AND c.object_id = k.parent_object_id AND c.column_id = k.parent_column_id
UNION ALL
SELECT k.database, tn.sch, tn.tab, k.name, 'DEFAULT', coalesce(c.name, ''), NULL, '', NULL, NULL, NULL, NULL, CAST(is_system_named AS BOOLEAN), k.definition
FROM sys_default_constraints k JOIN tn ON tn.database = k.database AND tn.object_id = k.parent_object_id
LEFT JOIN sys_columns c ON c.database = k.database AND c.object_id = k.parent_object_id AND c.column_id = k.parent_column_id"""


@query("catalog_constraints", with_raw(CONSTRAINTS_SQL))
def catalog_constraints(t):
    return flat(catalog.constraints(Estate(t)))


@query(
    "catalog_small_objects",
    with_raw("""SELECT 'synonym' AS kind, y.database, s.name AS schema, y.name, base_object_name AS detail FROM sys_synonyms y JOIN sys_schemas s USING (database, schema_id)
UNION ALL SELECT 'sequence', q.database, s.name, q.name, start_value || '/' || increment || '/' || minimum_value || '/' || maximum_value FROM sys_sequences q JOIN sys_schemas s USING (database, schema_id)
UNION ALL SELECT 'type', y.database, s.name, y.name, CASE WHEN is_table_type = 1 THEN 'TABLE_TYPE' ELSE 'USER_DEFINED' END || '/' || user_type_id FROM sys_types y JOIN sys_schemas s USING (database, schema_id) WHERE is_user_defined = 1
UNION ALL SELECT 'xml_collection', x.database, s.name, x.name, NULL FROM sys_xml_schema_collections x JOIN sys_schemas s USING (database, schema_id)
UNION ALL SELECT 'assembly', a.database, p.default_schema_name, a.name, permission_set_desc || '/' || CASE WHEN is_visible = 1 THEN 'true' ELSE 'false' END
          FROM sys_assemblies a LEFT JOIN sys_database_principals p ON p.database = a.database AND p.principal_id = a.principal_id"""),
)
def catalog_small_objects(t):
    e = Estate(t)
    show = lambda df, kind, detail: df.select(F.lit(kind).alias("kind"), "database", "schema", "name", detail.alias("detail"))
    return (
        show(catalog.synonyms(e), "synonym", F.col("base_object"))
        .unionByName(show(catalog.sequences(e), "sequence", F.concat_ws("/", "current_value", "increment", "minimum_value", "maximum_value")))
        .unionByName(show(catalog.user_defined_types(e), "type", F.concat_ws("/", "type_kind", "base_type")))
        .unionByName(show(catalog.xml_schema_collections(e), "xml_collection", F.lit(None).cast("string")))
        .unionByName(show(catalog.assemblies(e), "assembly", F.concat_ws("/", "permission_set", F.col("is_visible").cast("string"))))
    )


@query(
    "catalog_security",
    with_raw("""SELECT database, name, 'USER' AS principal_type, default_schema_name AS default_schema, CAST(owning_principal_id AS VARCHAR) AS owning_principal FROM sys_database_principals WHERE type IN ('U', 'S', 'G')
UNION ALL SELECT database, name, 'ROLE', default_schema_name, CAST(owning_principal_id AS VARCHAR) FROM sys_database_principals WHERE type = 'R'"""),
)
def catalog_security(t):
    return catalog.security_principals(Estate(t))


@query(
    "catalog_permissions",
    with_raw("""SELECT p.database, d.name AS grantee, d.type AS principal_type, class_desc, object_name, permission_name, state_desc
FROM sys_database_permissions p JOIN sys_database_principals d ON d.database = p.database AND d.principal_id = p.grantee_principal_id"""),
)
def catalog_permissions(t):
    return catalog.permissions(Estate(t))


@query(
    "catalog_expression_dependencies",
    with_raw("""SELECT e.database, s.name AS ref_schema, o.name AS ref_name, o.type_desc AS ref_type, referenced_schema_name AS target_schema,
       referenced_entity_name AS target_name, referenced_class_desc AS target_class, CAST(is_ambiguous AS BOOLEAN) AS is_ambiguous
FROM sys_expression_dependencies e JOIN sys_objects o ON o.database = e.database AND o.object_id = e.referencing_id
JOIN sys_schemas s ON s.database = o.database AND s.schema_id = o.schema_id"""),
)
def catalog_expression_dependencies(t):
    return catalog.expression_dependencies(Estate(t))


# --- summaries over the catalog ---

# the quality profile reads a catalog that is simpler to state: one database per order status,
# an order is a table, a line item a column, an (order, supplier) pair an index


def _profile_catalog(t):
    tables = t.sql("""
        SELECT o_orderstatus AS database, o_orderpriority AS schema, concat('t', o_orderkey) AS name,
               CASE WHEN o_totalprice < 5000 THEN 0 ELSE CAST(o_totalprice AS BIGINT) END AS row_count, o_totalprice AS size_mb,
               o_custkey AS column_count, CASE WHEN o_orderpriority = '5-LOW' THEN 'HEAP' ELSE 'CLUSTERED' END AS table_type,
               CASE WHEN o_custkey < 100 THEN 1 ELSE 0 END AS trigger_count,
               CASE WHEN o_orderpriority = '1-URGENT' THEN array('id') ELSE array() END AS identity_columns,
               CASE WHEN o_custkey > 500 THEN array('a', 'b') ELSE array() END AS computed_columns,
               CAST(NULL AS array<string>) AS sparse_columns, o_totalprice > 400000 AS is_cdc_enabled,
               CASE WHEN o_custkey > 200 THEN o_totalprice > 300000 END AS is_change_tracking_enabled, o_custkey = 7 AS is_temporal_table
        FROM {orders}""")
    spot = "o_orderstatus AS database, o_orderpriority AS schema, concat('t', o_orderkey) AS table"
    columns = t.sql(f"""
        SELECT {spot}, concat('c', l_partkey) AS name, {_DATA_TYPE} AS data_type, l_returnflag = 'R' AS nullable,
               CASE WHEN l_quantity > 40 THEN -1 ELSE CAST(l_quantity AS INT) END AS max_length, l_tax = 0.08 AS is_clr_type,
               CASE WHEN l_linestatus = 'F' THEN l_tax = 0.01 END AS is_filestream
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""")
    indexes = t.sql(f"""
        SELECT {spot}, concat('ix', l_suppkey, '_', l_linenumber, '_', l_partkey) AS name, l_linenumber = 1 AS is_clustered
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""")
    constraints = t.sql(f"""
        SELECT {spot}, CASE WHEN l_linenumber = 2 THEN 'PRIMARY_KEY' WHEN l_linenumber = 3 THEN 'FOREIGN_KEY' ELSE 'CHECK' END AS constraint_type
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""")
    databases = t.sql("SELECT o_orderstatus AS database FROM {orders} UNION SELECT 'empty' AS database")
    return databases, tables, columns, indexes, constraints


_DATA_TYPE = "CASE l_linenumber WHEN 1 THEN 'INT' WHEN 2 THEN 'NVARCHAR(200)' WHEN 3 THEN 'text' WHEN 4 THEN 'xml' WHEN 5 THEN '[geography]' WHEN 6 THEN 'sql_variant' ELSE 'varbinary' END"
_TYPE_KEY = "CASE l_linenumber WHEN 1 THEN 'int' WHEN 2 THEN 'nvarchar' WHEN 3 THEN 'text' WHEN 4 THEN 'xml' WHEN 5 THEN 'geography' WHEN 6 THEN 'sql_variant' ELSE 'varbinary' END"


@query(
    "quality_profile",
    f"""WITH li AS (SELECT o_orderstatus AS db, l.*, {_TYPE_KEY} AS ty FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
pt AS (SELECT l_orderkey, bool_or(l_linenumber = 2) AS pk, bool_or(l_linenumber = 3) AS fk, bool_or(l_linenumber = 1) AS cl, bool_or(ty = 'xml') AS x, bool_or(ty = 'geography') AS sp,
              bool_or(l_tax = 0.08) AS clr, bool_or(ty IN ('text', 'nvarchar', 'varbinary', 'xml')) AS lob, bool_or(l_linestatus = 'F' AND l_tax = 0.01) AS fs FROM li GROUP BY 1),
tab AS (SELECT o_orderstatus AS database, count(*) AS total_tables, count_if(o_totalprice < 5000) AS empty_tables, count_if(NOT coalesce(pk, FALSE)) AS tables_without_primary_key,
  count_if(NOT coalesce(cl, FALSE)) AS tables_without_clustered_index, count_if(NOT coalesce(fk, FALSE)) AS tables_without_foreign_key, count_if(o_orderpriority = '5-LOW') AS heap_tables,
  count_if(o_custkey < 100) AS tables_with_triggers, count_if(o_orderpriority = '1-URGENT') AS tables_with_identity_columns, count_if(o_custkey > 500) AS tables_with_computed_columns,
  CAST(0 AS BIGINT) AS tables_with_sparse_columns, count_if(o_totalprice > 400000) AS tables_with_cdc_enabled, count_if(o_custkey > 200 AND o_totalprice > 300000) AS tables_with_change_tracking_enabled,
  count_if(o_custkey = 7) AS tables_with_temporal_tables, count_if(x) AS tables_with_xml_columns, count_if(sp) AS tables_with_spatial_columns, count_if(clr) AS tables_with_clr_types,
  count_if(lob) AS tables_with_lob_columns, count_if(fs) AS tables_with_filestream,
  sum(CAST(round(o_totalprice * 100) AS HUGEINT)) AS cents, sum(CASE WHEN o_totalprice < 5000 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(20, 0)) END) AS dummy,
  sum(CASE WHEN o_totalprice < 5000 THEN 0 ELSE CAST(trunc(o_totalprice) AS HUGEINT) END) AS rows
  FROM orders LEFT JOIN pt ON l_orderkey = o_orderkey GROUP BY 1),
col AS (SELECT db AS database, count_if(l_returnflag = 'R') AS nullable_columns, count_if(l_returnflag <> 'R') AS non_nullable_columns, count_if(ty = 'text') AS deprecated_data_type_columns,
  count_if(ty = 'sql_variant') AS sql_variant_columns, count_if(ty = 'text') AS text_ntext_image_columns, count_if(ty IN ('nvarchar', 'varbinary') AND l_quantity > 40) AS large_max_columns FROM li GROUP BY 1),
dup AS (SELECT db AS database, count_if(n > 1) AS duplicate_column_names FROM (SELECT db, l_partkey, count(*) AS n FROM li GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT o_orderstatus AS database FROM orders UNION SELECT 'empty')
SELECT database, {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in [
    'total_tables', 'empty_tables', 'tables_without_primary_key', 'tables_without_clustered_index', 'tables_without_foreign_key', 'heap_tables', 'tables_with_triggers',
    'tables_with_identity_columns', 'tables_with_computed_columns', 'tables_with_sparse_columns', 'tables_with_cdc_enabled', 'tables_with_change_tracking_enabled', 'tables_with_temporal_tables',
    'tables_with_xml_columns', 'tables_with_spatial_columns', 'tables_with_clr_types', 'tables_with_lob_columns', 'tables_with_filestream', 'nullable_columns', 'non_nullable_columns',
    'deprecated_data_type_columns', 'sql_variant_columns', 'text_ntext_image_columns', 'large_max_columns', 'duplicate_column_names'])},
  {pct('(cents * 1048576)', '(rows * 10000)')} AS average_row_length_bytes
FROM d LEFT JOIN tab USING (database) LEFT JOIN col USING (database) LEFT JOIN dup USING (database)""",
)
def quality_profile(t):
    return quality.quality_profile(*_profile_catalog(t))


@query(
    "quality_lists",
    """WITH big AS (SELECT o_orderstatus AS database, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderpriority, 't' || o_orderkey) AS place,
  o_orderpriority || '.t' || o_orderkey AS table_name, o_totalprice AS measure FROM orders)
SELECT database, 'largest_tables' AS list, CAST(place AS INT) AS place, table_name, measure FROM big WHERE place <= 10
UNION ALL SELECT o_orderstatus, 'wide_schema_tables', NULL, o_orderpriority || '.t' || o_orderkey, CAST(o_custkey AS DOUBLE) FROM orders WHERE o_custkey > 50
UNION ALL SELECT o_orderstatus, 'excessive_index_tables', NULL, o_orderpriority || '.t' || o_orderkey, CAST(count(*) AS DOUBLE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus, o_orderpriority, o_orderkey HAVING count(*) > 10""",
)
def quality_lists(t):
    _, tables, _, indexes, _ = _profile_catalog(t)
    return quality.quality_lists(tables, indexes)


def _inventory(t):
    """The given tables as the relations of an estate, one database per region."""
    region = "concat('r', CAST({0} AS VARCHAR(20)))"
    own = t.sql(f"""
        SELECT {region.format('r_regionkey')} AS name, CAST(r_regionkey + 1 AS DOUBLE) AS size_mb, 'FULL' AS recovery_model, '150' AS compatibility_level,
               '2024-01-0' || CAST(r_regionkey + 1 AS VARCHAR(2)) AS last_backup_date, CAST(NULL AS STRING) AS last_restore_date
        FROM {{region}}""")
    by_nation = lambda table, col: t.sql(
        f"SELECT {region.format('n_regionkey')} AS database, x.* FROM {{{table}}} x JOIN {{nation}} ON {col} = n_nationkey"
    )
    people = by_nation("customer", "c_nationkey")
    orders = people.select("database", "c_custkey").join(t["orders"], F.col("c_custkey") == F.col("o_custkey"))
    tables = orders.select(
        "database", F.col("o_orderpriority").alias("schema"), F.concat(F.lit("t"), "o_orderkey").alias("name"),
        F.col("o_custkey").alias("row_count"), F.col("o_totalprice").alias("size_mb"),
    )
    kinds = F.when(F.col("o_orderstatus") == "F", "PRIMARY_KEY").when(F.col("o_orderstatus") == "O", "CHECK").otherwise("UNIQUE")
    return own, {
        "tables": tables,
        "stored_procedures": people,
        "views": by_nation("supplier", "s_nationkey"),
        "constraints": orders.select("database", kinds.alias("constraint_type")),
        "security_principals": people.select("database", F.when(F.col("c_acctbal") < 0, "ROLE").otherwise("USER").alias("principal_type")),
    }


_INV = """WITH cu AS (SELECT 'r' || n_regionkey AS db, c.* FROM customer c JOIN nation ON c_nationkey = n_nationkey),
su AS (SELECT 'r' || n_regionkey AS db, s.* FROM supplier s JOIN nation ON s_nationkey = n_nationkey),
od AS (SELECT db, o.* FROM orders o JOIN cu ON o_custkey = c_custkey)"""


@query(
    "inventory_summary",
    _INV + """
SELECT 'r' || r_regionkey AS database, '2024-01-0' || (r_regionkey + 1) AS last_backup, CAST(NULL AS VARCHAR) AS last_restore, 'FULL' AS recovery_model, '150' AS compatibility_level,
  CAST(r_regionkey + 1 AS DOUBLE) AS database_size_mb, (SELECT count(*) FROM od WHERE db = 'r' || r_regionkey) AS total_tables, (SELECT count(*) FROM su WHERE db = 'r' || r_regionkey) AS total_views,
  (SELECT count(*) FROM cu WHERE db = 'r' || r_regionkey) AS total_stored_procedures, CAST(0 AS BIGINT) AS total_functions, CAST(0 AS BIGINT) AS total_triggers, CAST(0 AS BIGINT) AS total_indexes,
  CAST(0 AS BIGINT) AS total_foreign_keys, CAST(0 AS BIGINT) AS total_synonyms, CAST(0 AS BIGINT) AS total_sequences,
  (SELECT count(*) FROM cu WHERE db = 'r' || r_regionkey AND NOT c_acctbal < 0) AS total_users, (SELECT count(*) FROM cu WHERE db = 'r' || r_regionkey AND c_acctbal < 0) AS total_roles,
  (SELECT count(*) FROM od WHERE db = 'r' || r_regionkey) AS total_constraints, (SELECT count(*) FROM od WHERE db = 'r' || r_regionkey AND o_orderstatus = 'F') AS total_primary_key_constraints,
  (SELECT count(*) FROM od WHERE db = 'r' || r_regionkey AND o_orderstatus = 'P') AS total_unique_constraints, (SELECT count(*) FROM od WHERE db = 'r' || r_regionkey AND o_orderstatus = 'O') AS total_check_constraints,
  CAST(0 AS BIGINT) AS total_default_constraints, CAST((SELECT coalesce(sum(o_custkey), 0) FROM od WHERE db = 'r' || r_regionkey) AS BIGINT) AS total_row_count,
  (SELECT arg_min(o_orderpriority || '.t' || o_orderkey, struct_pack(a := -o_totalprice, b := o_orderpriority || '.t' || o_orderkey)) FROM od WHERE db = 'r' || r_regionkey) AS largest_table
FROM region""",
)
def inventory_summary(t):
    return summary.database_summary(*_inventory(t))


@query(
    "inventory_rollup",
    _INV + """
SELECT 0 AS row_order, 'database' AS object_type, 'r' || r_regionkey AS object_name, CAST(1 AS BIGINT) AS count, CAST(r_regionkey + 1 AS DOUBLE) AS size_mb,
  (SELECT count(*) FROM od WHERE db = 'r' || r_regionkey) AS tables, (SELECT count(*) FROM cu WHERE db = 'r' || r_regionkey) AS procs, (SELECT count(*) FROM su WHERE db = 'r' || r_regionkey) AS views FROM region
UNION ALL SELECT 1, 'table', '(all)', count(*), CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100, NULL, NULL, NULL FROM od
UNION ALL SELECT 2, 'stored_procedure', '(all)', count(*), NULL, NULL, NULL, NULL FROM cu
UNION ALL SELECT 5, 'constraint', '(all)', count(*), NULL, NULL, NULL, NULL FROM od
UNION ALL SELECT 9, 'view', '(all)', count(*), NULL, NULL, NULL, NULL FROM su
UNION ALL SELECT 12, 'unresolved_or_llm_inferred', '(needs human review)', (SELECT count(*) FROM labels WHERE quality = 0 OR toxic = 1) + (SELECT count(*) FROM documents WHERE n_chars < 500), NULL, NULL, NULL, NULL""",
)
def inventory_rollup(t):
    own, relations = _inventory(t)
    procs = t.sql("SELECT CASE WHEN quality = 0 THEN 'unresolved' ELSE 'sqlglot' END AS parse_status, CASE WHEN toxic = 1 THEN 'doubt' END AS unresolved_reason FROM {labels}")
    stmts = t.sql("SELECT CASE WHEN n_chars < 500 THEN 'llm_inferred' ELSE 'sqlglot' END AS parse_status, CAST(NULL AS STRING) AS unresolved_reason FROM {documents}")
    return summary.rollup(summary.backfill_counts(own, relations), relations, summary.needs_review(procs, stmts))
