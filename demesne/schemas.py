"""Declared schemas (DDL) of the snapshot relations. Nothing is inferred on read."""

from __future__ import annotations

NAMES = "database string, schema string, name string"
STATE = "parse_status string, unresolved_reason string"
REFS = (
    "referenced_tables array<string>, referenced_procs array<string>, "
    "referenced_functions array<string>, referenced_sequences array<string>"
)

ENTITIES: dict[str, str] = {
    "databases": (
        "name string, size_mb double, table_count bigint, proc_count bigint, view_count bigint, "
        "recovery_model string, compatibility_level string, database_owner string, collation_name string, "
        "create_date string, last_backup_date string, last_full_backup string, last_differential_backup string, "
        "last_log_backup string, last_restore_date string, auto_close boolean, auto_shrink boolean, "
        "is_read_only boolean, is_trustworthy_on boolean, page_verify_option string, containment string, "
        "is_snapshot_isolation_on boolean, is_read_committed_snapshot_on boolean"
    ),
    "tables": (
        f"{NAMES}, row_count bigint, size_mb double, column_count bigint, create_date string, modify_date string, "
        "table_type string, nonclustered_index_count bigint, foreign_key_count bigint, referenced_table_count bigint, "
        "referencing_table_count bigint, trigger_count bigint, estimated_reserved_pages bigint, used_pages bigint, "
        "data_pages bigint, percent_of_database_occupied double, identity_columns array<string>, "
        "computed_columns array<string>, sparse_columns array<string>, is_temporal_table boolean, "
        "is_cdc_enabled boolean, is_change_tracking_enabled boolean"
    ),
    "columns": (
        "database string, schema string, table string, name string, data_type string, nullable boolean, "
        "ordinal_position bigint, default_constraint string, check_constraint string, identity_seed bigint, "
        "identity_increment bigint, computed_expression string, is_persisted boolean, collation_name string, "
        "is_rowguid boolean, is_sparse boolean, is_nullable boolean, is_filestream boolean, is_clr_type boolean, "
        "max_length bigint, xml_schema_collection string"
    ),
    "database_files": (
        "database string, logical_name string, physical_name string, filegroup string, current_size_mb double, "
        "max_size_mb double, growth_mb double, growth_type string, percent_of_total_database double"
    ),
    "views": (f"{NAMES}, definition string, create_date string, modify_date string, {STATE}"),
    "stored_procedures": (
        f"{NAMES}, definition string, loc bigint, create_date string, modify_date string, is_encrypted boolean, "
        f"execute_as string, {STATE}"
    ),
    "functions": (f"{NAMES}, definition string, function_type string, return_type string, {STATE}"),
    "triggers": (f"{NAMES}, definition string, table string, event string, {STATE}"),
    "indexes": (
        "database string, schema string, table string, name string, is_clustered boolean, is_nonclustered boolean, "
        "is_unique boolean, is_filtered boolean, is_disabled boolean, fill_factor int, fragmentation_pct double, "
        "page_count bigint, index_size_mb double, key_columns array<string>, included_columns array<string>, "
        "index_type string, is_primary_key boolean, filter_definition string, key_column_sort array<string>, "
        "is_partitioned boolean, partition_count bigint, filegroup string, allocation_unit_type string, "
        "user_seeks bigint, user_scans bigint, user_lookups bigint, user_updates bigint, "
        "avg_page_space_used_pct double, record_count bigint, percent_of_table double, percent_of_database double"
    ),
    "constraints": (
        "database string, schema string, table string, name string, constraint_type string, columns array<string>, "
        "referenced_table string, referenced_columns array<string>, delete_action string, update_action string, "
        f"is_trusted boolean, is_disabled boolean, is_system_named boolean, definition string, {STATE}"
    ),
    "agent_jobs": (
        "name string, enabled boolean, owner string, category string, description string, date_created string, "
        "date_modified string, retry_attempts bigint, retry_interval bigint, notification_operator string, "
        "notification_method string, last_run_date string, last_run_time string, last_run_status string, "
        "next_scheduled_run string, step_count bigint, schedule_names array<string>, "
        "schedule_frequency array<string>, step_details array<struct<step_id:int,name:string,subsystem:string,"
        "database_name:string,command:string,on_success_action:string,on_fail_action:string,"
        "retry_attempts:bigint,retry_interval:bigint>>"
    ),
    "packages": ("project string, folder string, name string, deployment_model string, parse_status string"),
    "dependencies": (
        "database string, source_object string, source_type string, target_object string, target_type string, "
        "relationship_type string, discovery_method string, edge_rank int"
    ),
    "synonyms": (f"{NAMES}, base_object string"),
    "sequences": (
        f"{NAMES}, current_value bigint, increment bigint, minimum_value bigint, maximum_value bigint, cache bigint"
    ),
    "user_defined_types": (f"{NAMES}, type_kind string, base_type string"),
    "xml_schema_collections": NAMES,
    "assemblies": (f"{NAMES}, permission_set string, is_visible boolean"),
    "security_principals": (
        "database string, name string, principal_type string, default_schema string, owning_principal string"
    ),
    "permissions": (
        "database string, grantee string, principal_type string, class_desc string, object_name string, "
        "permission_name string, state_desc string"
    ),
    "database_summary": (
        "database string, total_tables bigint, total_views bigint, total_stored_procedures bigint, "
        "total_functions bigint, total_triggers bigint, total_users bigint, total_roles bigint, "
        "total_indexes bigint, total_foreign_keys bigint, total_synonyms bigint, total_sequences bigint, "
        "total_row_count bigint, largest_table string, last_backup string, last_restore string, "
        "recovery_model string, compatibility_level string, database_size_mb double, total_constraints bigint, "
        "total_primary_key_constraints bigint, total_unique_constraints bigint, total_check_constraints bigint, "
        "total_default_constraints bigint"
    ),
    "data_quality_summary": ("database string, total_tables bigint"),
}

SIDE_RELATIONS: dict[str, str] = {
    "expression_dependencies": (
        "database string, ref_schema string, ref_name string, ref_type string, target_schema string, "
        "target_name string, target_class string, is_ambiguous boolean"
    ),
    "fingerprints": (
        "object_id string, object_type string, fingerprint string, last_run_id string, last_seen_at timestamp"
    ),
    "runs": (
        "run_id string, started_at timestamp, finished_at timestamp, objects_scanned bigint, "
        "objects_skipped_unchanged bigint, objects_failed bigint"
    ),
    "run_log": (
        "object_type string, object_name string, status string, parse_status string, error string, duration_ms double"
    ),
    "package_text": ("project string, folder string, name string, xml string"),
    "engine_results": (
        "engine string, object_name string, status string, referenced_tables array<string>, "
        "referenced_procs array<string>, notes string"
    ),
}

# --- fixed values: closed sets of states ---
PARSE_STATES = ("direct_metadata", "sqlglot", "xml_parsed", "llm_inferred", "unresolved")
LOG_STATES = ("success", "failed", "skipped_unchanged")
DEPLOYMENT_MODELS = ("ssisdb", "file_system")
METADATA, TEXT_MINED, XML_PARSED, INFERRED, UNRESOLVED = PARSE_STATES


def schema_of(name: str) -> str:
    return ENTITIES.get(name) or SIDE_RELATIONS[name]
