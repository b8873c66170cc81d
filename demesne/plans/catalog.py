"""Catalog relations built from raw system relations of a whole estate.

`sys` maps the name of a raw relation to its DataFrame. Every raw relation has
a `database` column, so one pass serves all databases, and every join is on
(database, id). Children are reduced per key before they meet their parent.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.functions.scalars import (
    NOTIFY_LEVEL,
    RUN_STATUS,
    STEP_ACTION,
    choose,
    combine_date_time,
    decode_int_date,
    decode_int_time,
    growth_value,
    inverted,
    iso_text,
    latest_of,
    line_count,
    map_code,
    null_if,
    or_empty,
    or_zero,
    pages_to_mb,
    percent_of,
    qualify,
    schedule_label,
    state_is,
    tri_state,
)
from demesne.operators.keyed import conditional_max, earliest, latest_per_key, percent_if_any
from demesne.operators.lists import collect_ordered, ordered_list, split_items
from demesne.operators.membership import meet, tagged_union
from demesne.schemas import METADATA
from demesne.session import dealt

Sys = Mapping[str, DataFrame]
OBJ = ["database", "object_id"]
IDX = ["database", "object_id", "index_id"]


def _schemas(sys: Sys) -> DataFrame:
    return sys["schemas"].select("database", "schema_id", F.col("name").alias("schema"))


def _named(df: DataFrame, sys: Sys) -> DataFrame:
    """Attach the schema name."""
    return df.join(_schemas(sys), ["database", "schema_id"])


def _tables(sys: Sys) -> DataFrame:
    """(database, object_id, schema, table) of every table."""
    return _named(sys["tables"], sys).select(*OBJ, "schema", F.col("name").alias("table"))


def _columns(sys: Sys) -> DataFrame:
    return sys["columns"].select(*OBJ, "column_id", F.col("name").alias("column_name"))


def _modules(sys: Sys) -> DataFrame:
    return sys["sql_modules"].select(*OBJ, "definition", "execute_as_principal_id")


# --- databases ---


def database_pages(sys: Sys) -> DataFrame:
    return sys["master_files"].groupBy("database").agg(F.sum("size").alias("database_pages"))


def backup_dates(sys: Sys) -> DataFrame:
    """Last full, differential and log backup, and last restore, per database."""
    kinds = {
        "last_full_backup": F.col("type") == "D",
        "last_differential_backup": F.col("type") == "I",
        "last_log_backup": F.col("type") == "L",
    }
    backups = conditional_max(
        sys["backupset"].withColumnRenamed("database_name", "database"), ["database"], "backup_finish_date", kinds
    )
    restores = (
        sys["restorehistory"]
        .groupBy(F.col("destination_database_name").alias("database"))
        .agg(F.max("restore_date").alias("last_restore_date"))
    )
    return backups.join(restores, "database", "full_outer")


def databases(sys: Sys) -> DataFrame:
    """Size, properties and backup history; missing history leaves NULLs."""
    base = sys["databases"].join(database_pages(sys), "database")
    dated = base.join(backup_dates(sys), "database", "left")
    return dated.select(
        F.col("database").alias("name"),
        pages_to_mb("database_pages").alias("size_mb"),
        F.col("recovery_model_desc").alias("recovery_model"),
        F.col("compatibility_level").cast("string").alias("compatibility_level"),
        F.col("owner_name").alias("database_owner"),
        "collation_name",
        iso_text("create_date").alias("create_date"),
        tri_state("is_auto_close_on").alias("auto_close"),
        tri_state("is_auto_shrink_on").alias("auto_shrink"),
        tri_state("is_read_only").alias("is_read_only"),
        tri_state("is_trustworthy_on").alias("is_trustworthy_on"),
        F.col("page_verify_option_desc").alias("page_verify_option"),
        F.col("containment_desc").alias("containment"),
        state_is("snapshot_isolation_state_desc").alias("is_snapshot_isolation_on"),
        tri_state("is_read_committed_snapshot_on").alias("is_read_committed_snapshot_on"),
        iso_text("last_full_backup").alias("last_full_backup"),
        iso_text("last_differential_backup").alias("last_differential_backup"),
        iso_text("last_log_backup").alias("last_log_backup"),
        iso_text("last_restore_date").alias("last_restore_date"),
        iso_text(latest_of("last_full_backup", "last_differential_backup", "last_log_backup")).alias(
            "last_backup_date"
        ),
    )


def database_files(sys: Sys) -> DataFrame:
    groups = sys["filegroups"].select("database", "data_space_id", F.col("name").alias("filegroup"))
    files = sys["database_files"].join(groups, ["database", "data_space_id"], "left")
    totals = sys["database_files"].groupBy("database").agg(F.sum("size").alias("_total"))
    return files.join(totals, "database", "left").select(
        "database",
        F.col("name").alias("logical_name"),
        "physical_name",
        "filegroup",
        pages_to_mb(F.coalesce("size", F.lit(0))).alias("current_size_mb"),
        pages_to_mb(null_if("max_size", -1)).alias("max_size_mb"),
        growth_value(F.coalesce("growth", F.lit(0)), "is_percent_growth").alias("growth_mb"),
        choose("is_percent_growth", "PERCENT", "MB").alias("growth_type"),
        percent_of(F.coalesce("size", F.lit(0)), "_total").alias("percent_of_total_database"),
    )


# --- tables and columns ---


def table_storage(sys: Sys) -> DataFrame:
    """Rows and pages per table. Allocation units are summed per partition first, so no partition counts twice."""
    base = sys["partition_stats"].filter(F.col("index_id").isin(0, 1))
    units = (
        sys["allocation_units"]
        .groupBy("database", F.col("container_id").alias("partition_id"))
        .agg(F.sum("total_pages").alias("unit_pages"))
    )
    data = F.col("in_row_data_page_count") + F.col("lob_used_page_count") + F.col("row_overflow_used_page_count")
    return (
        base.join(units, ["database", "partition_id"], "left")
        .groupBy(*OBJ)
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("unit_pages").alias("total_pages"),
            F.sum("reserved_page_count").alias("estimated_reserved_pages"),
            F.sum("used_page_count").alias("used_pages"),
            F.sum(data).alias("data_pages"),
        )
    )


def foreign_key_degrees(sys: Sys) -> DataFrame:
    """Foreign keys a table has, and distinct tables on either side of them, in one aggregate."""
    fk = sys["foreign_keys"]
    out = fk.select("database", F.col("parent_object_id").alias("object_id"), F.col("referenced_object_id").alias("to"), F.lit(None).cast("bigint").alias("from"))
    into = fk.select("database", F.col("referenced_object_id").alias("object_id"), F.lit(None).cast("bigint").alias("to"), F.col("parent_object_id").alias("from"))
    # distinct pairs first: a hub table then costs one row per neighbour, not one per key
    per_pair = out.unionByName(into).groupBy(*OBJ, "to", "from").agg(F.count(F.lit(1)).alias("_n"))
    return per_pair.groupBy(*OBJ).agg(
        F.sum(F.when(F.col("to").isNotNull(), F.col("_n"))).alias("foreign_key_count"),
        F.count("to").alias("referenced_table_count"),
        F.count("from").alias("referencing_table_count"),
    )


def _given(df: DataFrame, name: str) -> Column:
    """A column that older servers do not have; NULL then."""
    return F.col(name) if name in df.columns else F.lit(None).cast("int").alias(name)


def table_features(sys: Sys) -> DataFrame:
    """Temporal, memory-optimised, change-data-capture, change-tracking and partition facts of tables, and the number of
    their heaps, nonclustered indexes and triggers: one aggregate over a tagged union, so the tables meet it once."""
    t = sys["tables"]
    flags = t.select(
        *OBJ,
        (_given(t, "temporal_type") == 2).alias("temporal"),
        _given(t, "is_memory_optimized").cast("boolean").alias("memory"),
        _given(t, "is_tracked_by_cdc").cast("boolean").alias("cdc"),
        F.lit(None).cast("boolean").alias("tracked"),
        F.lit(None).cast("bigint").alias("partition"),
        F.lit(None).cast("string").alias("kind"),
    )
    none, no_number, no_kind = F.lit(None).cast("boolean"), F.lit(None).cast("bigint"), F.lit(None).cast("string")
    tracked = sys["change_tracking_tables"].select(*OBJ, none, none, none, F.lit(True), no_number, no_kind)
    own = sys["partitions"].filter(F.col("index_id").isin(0, 1))
    parts = own.select(*OBJ, none, none, none, none, F.col("partition_number").cast("bigint"), no_kind)
    indexes = sys["indexes"].filter(F.col("type_desc").isin("HEAP", "NONCLUSTERED"))
    indexes = indexes.select(*OBJ, none, none, none, none, no_number, F.col("type_desc"))
    triggers = sys["triggers"].select("database", "parent_id", none, none, none, none, no_number, F.lit("TRIGGER"))
    return flags.union(tracked).union(parts).union(indexes).union(triggers).groupBy(*OBJ).agg(
        F.bool_or("temporal").alias("is_temporal_table"),
        F.bool_or("memory").alias("_memory"),
        F.bool_or("cdc").alias("is_cdc_enabled"),
        F.bool_or("tracked").alias("_tracked"),
        F.max("partition").alias("partition_count"),
        F.count_if(F.col("kind") == "HEAP").alias("_heaps"),
        F.count_if(F.col("kind") == "NONCLUSTERED").alias("nonclustered_index_count"),
        F.count_if(F.col("kind") == "TRIGGER").alias("trigger_count"),
    )


def column_marks(sys: Sys) -> DataFrame:
    """Columns with their identity, computed and sparse marks."""
    computed = sys["computed_columns"].select(*OBJ, "column_id", F.lit(True).alias("computed"))
    return sys["columns"].join(computed, [*OBJ, "column_id"], "left").select(
        *OBJ,
        "column_id",
        "name",
        F.col("identity_seed").isNotNull().alias("identity"),
        F.coalesce("computed", F.lit(False)).alias("computed"),
        F.coalesce(F.col("is_sparse").cast("boolean"), F.lit(False)).alias("sparse"),
    )


def column_facts(marks: DataFrame) -> DataFrame:
    """Number of columns per table and names of the marked ones, in column order, in one pass; a table's columns are bounded by its source."""
    item = F.struct("column_id", "name", "identity", "computed", "sparse")
    marked = F.collect_list(F.when(F.expr("identity or computed or sparse"), item))
    folded = marks.groupBy(*OBJ).agg(F.count(F.lit(1)).alias("column_count"), F.array_sort(marked).alias("_items"))
    names = lambda flag: F.transform(F.filter("_items", lambda x: x[flag]), lambda x: x["name"])
    return folded.select(
        *OBJ,
        "column_count",
        names("identity").alias("identity_columns"),
        names("computed").alias("computed_columns"),
        names("sparse").alias("sparse_columns"),
    )


def tables(sys: Sys) -> DataFrame:
    """Tables with kind, storage, child counts, degrees, marked columns, features and share of the database; one row each."""
    base = _named(sys["tables"], sys)
    for part in (table_storage(sys), foreign_key_degrees(sys), column_facts(column_marks(sys)), table_features(sys)):
        base = base.join(part, OBJ, "left")
    return base.join(database_pages(sys), "database", "left").select(
        "database",
        "schema",
        "name",
        or_zero("row_count").alias("row_count"),
        pages_to_mb(or_zero("total_pages")).alias("size_mb"),
        or_zero("column_count").alias("column_count"),
        iso_text("create_date").alias("create_date"),
        iso_text("modify_date").alias("modify_date"),
        choose(F.col("_heaps") > 0, "HEAP", "CLUSTERED").alias("table_type"),
        or_zero("nonclustered_index_count").alias("nonclustered_index_count"),
        or_zero("foreign_key_count").alias("foreign_key_count"),
        or_zero("referenced_table_count").alias("referenced_table_count"),
        or_zero("referencing_table_count").alias("referencing_table_count"),
        or_zero("trigger_count").alias("trigger_count"),
        or_zero("estimated_reserved_pages").alias("estimated_reserved_pages"),
        or_zero("used_pages").alias("used_pages"),
        or_zero("data_pages").alias("data_pages"),
        percent_of(or_zero("total_pages"), "database_pages").alias("percent_of_database_occupied"),
        or_empty("identity_columns").alias("identity_columns"),
        or_empty("computed_columns").alias("computed_columns"),
        or_empty("sparse_columns").alias("sparse_columns"),
        "is_temporal_table",
        F.col("_memory").alias("is_memory_optimized"),
        "is_cdc_enabled",
        F.coalesce("_tracked", F.lit(False)).alias("is_change_tracking_enabled"),
        (or_zero("partition_count") > 1).alias("is_partitioned"),
        or_zero("partition_count").alias("partition_count"),
    )


def typed_columns(sys: Sys) -> DataFrame:
    """Columns with their table, type, computed text and XML binding."""
    types = sys["types"].select("database", "user_type_id", F.col("name").alias("data_type"), "is_assembly_type")
    raw = sys["computed_columns"]
    persisted = _given(raw, "is_persisted").cast("boolean").alias("is_persisted")
    computed = raw.select(*OBJ, "column_id", F.col("definition").alias("computed_expression"), persisted)
    collections = _named(sys["xml_schema_collections"], sys).select(
        "database", "xml_collection_id", qualify("schema", "name").alias("xml_schema_collection")
    )
    cols = sys["columns"]
    cols = cols.withColumns({"collation_name": _given(cols, "collation_name").cast("string"), "is_rowguid": _given(cols, "is_rowguidcol").cast("boolean")})
    plain = cols.join(types, ["database", "user_type_id"]).join(_tables(sys), OBJ)
    plain = plain.join(computed, [*OBJ, "column_id"], "left")
    # columns without an XML binding would all meet under the NULL key, so they skip that join
    bound = plain.filter("xml_collection_id is not null").join(collections, ["database", "xml_collection_id"], "left")
    free = plain.filter("xml_collection_id is null").withColumn("xml_schema_collection", F.lit(None).cast("string"))
    return bound.unionByName(free)


def columns(sys: Sys) -> DataFrame:
    """Typed columns with their default and check; a check joins on its own column."""
    key = [*OBJ, "column_id"]
    on_column = lambda df, text: df.select(
        "database",
        F.col("parent_object_id").alias("object_id"),
        F.col("parent_column_id").alias("column_id"),
        F.col("definition").alias(text),
    )
    checks = on_column(sys["check_constraints"], "check_constraint").groupBy(*key).agg(
        F.min("check_constraint").alias("check_constraint")
    )
    return (
        typed_columns(sys)
        .join(on_column(sys["default_constraints"], "default_constraint"), key, "left")
        .join(checks, key, "left")
        .select(
            "database",
            "schema",
            "table",
            "name",
            "data_type",
            tri_state("is_nullable").alias("nullable"),
            F.col("column_id").alias("ordinal_position"),
            "default_constraint",
            "check_constraint",
            F.col("identity_seed").cast("bigint").alias("identity_seed"),
            F.col("identity_increment").cast("bigint").alias("identity_increment"),
            "computed_expression",
            "is_persisted",
            "collation_name",
            "is_rowguid",
            tri_state("is_sparse").alias("is_sparse"),
            tri_state("is_nullable").alias("is_nullable"),
            tri_state("is_filestream").alias("is_filestream"),
            tri_state("is_assembly_type").alias("is_clr_type"),
            F.col("max_length").cast("bigint").alias("max_length"),
            "xml_schema_collection",
        )
    )


# --- objects with text ---


def procedures(sys: Sys) -> DataFrame:
    return _named(sys["procedures"], sys).join(_modules(sys), OBJ).select(
        "database",
        "schema",
        "name",
        "definition",
        line_count("definition").alias("loc"),
        iso_text("create_date").alias("create_date"),
        iso_text("modify_date").alias("modify_date"),
        F.coalesce(F.col("is_encrypted").cast("boolean"), F.lit(False)).alias("is_encrypted"),
        F.col("execute_as_principal_id").cast("string").alias("execute_as"),
        F.lit(METADATA).alias("parse_status"),
    )


def views(sys: Sys) -> DataFrame:
    return _named(sys["views"], sys).join(_modules(sys), OBJ).select(
        "database",
        "schema",
        "name",
        "definition",
        iso_text("create_date").alias("create_date"),
        iso_text("modify_date").alias("modify_date"),
        F.lit(METADATA).alias("parse_status"),
    )


def functions(sys: Sys) -> DataFrame:
    """T-SQL functions with return type and text; a missing kind counts as scalar."""
    objects = sys["objects"].filter(F.col("type").isin("FN", "IF", "TF"))
    returns = sys["parameters"].filter(F.col("parameter_id") == 0).select(*OBJ, "user_type_id")
    types = sys["types"].select("database", "user_type_id", F.col("name").alias("return_type"))
    return (
        _named(objects, sys)
        .join(returns, OBJ, "left")
        .join(types, ["database", "user_type_id"], "left")
        .join(_modules(sys), OBJ, "left")
        .select(
            "database",
            "schema",
            "name",
            F.coalesce("definition", F.lit("")).alias("definition"),
            F.coalesce("type_desc", F.lit("SCALAR")).alias("function_type"),
            "return_type",
        )
    )


def triggers(sys: Sys) -> DataFrame:
    """One row per trigger: its qualified table, and all its events as one sorted text."""
    events = (
        sys["trigger_events"].groupBy(*OBJ)
        .agg(F.array_join(F.array_sort(F.collect_set("type_desc")), ",").alias("event"))  # a handful of event kinds
    )
    parents = _tables(sys).select("database", F.col("object_id").alias("parent_id"), "schema", "table")
    return (
        sys["triggers"]
        .join(parents, ["database", "parent_id"])
        .join(_modules(sys), OBJ)
        .join(events, OBJ)
        .select("database", "schema", "name", "definition", qualify("schema", "table").alias("table"), "event")
    )


# --- jobs ---


def job_schedules(sys: Sys) -> DataFrame:
    """Schedule names and their labels as parallel lists; a job's schedules are few by nature."""
    rows = sys["job_schedules"].join(sys["schedules"], "schedule_id").select(
        "job_id", "schedule_name", schedule_label("freq_type", "freq_interval").alias("schedule_frequency"), "schedule_id"
    )
    lists = ordered_list(rows, ["job_id"], ["schedule_id"], ["schedule_name", "schedule_frequency"])
    return lists.withColumnsRenamed({"schedule_name": "schedule_names"})


def job_next_run(sys: Sys) -> DataFrame:
    """Earliest scheduled run; date and time belong to one schedule."""
    due = sys["job_schedules"].filter(F.col("next_run_date") > 0)
    first = earliest(due, ["job_id"], ["next_run_date", "next_run_time"])
    when = combine_date_time(decode_int_date("next_run_date"), decode_int_time("next_run_time"))
    return first.select("job_id", when.alias("next_scheduled_run"))


def job_last_run(sys: Sys) -> DataFrame:
    """Job-level outcome of the latest run."""
    outcomes = sys["job_history"].filter(F.col("step_id") == 0)
    last = latest_per_key(outcomes.select("job_id", "instance_id", "run_date", "run_time", "run_status"), ["job_id"], ["instance_id"])
    return last.select(
        "job_id",
        decode_int_date("run_date").alias("last_run_date"),
        decode_int_time("run_time").alias("last_run_time"),
        map_code("run_status", RUN_STATUS).alias("last_run_status"),
    )


def job_steps(sys: Sys) -> DataFrame:
    """Steps of every job as one ordered list with their number."""
    steps = sys["job_steps"].select(
        "job_id",
        "step_id",
        F.col("step_name").alias("name"),
        "subsystem",
        "database_name",
        "command",
        map_code("on_success_action", STEP_ACTION).alias("on_success_action"),
        map_code("on_fail_action", STEP_ACTION).alias("on_fail_action"),
        F.col("retry_attempts").cast("bigint").alias("retry_attempts"),
        F.col("retry_interval").cast("bigint").alias("retry_interval"),
    )
    cols = [c for c in steps.columns if c != "job_id"]
    last = F.max_by(F.struct("retry_attempts", "retry_interval"), "step_id").alias("_last")
    folded = collect_ordered(steps, ["job_id"], ["step_id"], cols, [last, F.count(F.lit(1)).alias("step_count")])
    details = F.transform("_items", lambda x: F.struct(*[x[c].alias(c) for c in cols]))
    return folded.select(
        "job_id",
        details.alias("step_details"),
        "step_count",
        F.coalesce(F.col("_last.retry_attempts"), F.lit(0)).alias("retry_attempts"),
        F.coalesce(F.col("_last.retry_interval"), F.lit(0)).alias("retry_interval"),
    )


def agent_jobs(sys: Sys) -> DataFrame:
    """Jobs that have steps, with schedules, next and last run where known."""
    category = sys["job_categories"].select("category_id", F.col("name").alias("category"))
    operator = sys["job_operators"].select(F.col("id").alias("operator_id"), F.col("name").alias("notification_operator"))
    schedules = job_schedules(sys)
    return (
        sys["jobs"]
        .join(job_steps(sys), "job_id")
        .join(category, "category_id", "left")
        .join(operator, "operator_id", "left")
        .join(schedules, "job_id", "left")
        .join(job_next_run(sys), "job_id", "left")
        .join(job_last_run(sys), "job_id", "left")
        .select(
            "name",
            tri_state("enabled").alias("enabled"),
            F.col("owner").cast("string").alias("owner"),
            "category",
            "description",
            iso_text("date_created").alias("date_created"),
            iso_text("date_modified").alias("date_modified"),
            "retry_attempts",
            "retry_interval",
            "notification_operator",
            map_code("notify_level", NOTIFY_LEVEL).alias("notification_method"),
            "last_run_date",
            "last_run_time",
            "last_run_status",
            "next_scheduled_run",
            "step_count",
            or_empty("schedule_names").alias("schedule_names"),
            or_empty("schedule_frequency").alias("schedule_frequency"),
            "step_details",
        )
    )


# --- indexes ---


def index_partitions(sys: Sys) -> DataFrame:
    """Partitions of indexes with their allocation type."""
    units = (
        sys["allocation_units"].groupBy("database", F.col("container_id").alias("partition_id"))
        .agg(F.max("type_desc").alias("unit_type"))
    )
    parts = sys["partitions"].select(*IDX, "partition_id", "partition_number").join(units, ["database", "partition_id"], "left")
    return parts.select(*IDX, "partition_number", "unit_type")


def index_items(sys: Sys) -> DataFrame:
    """Columns of indexes, dealt by table: a column and its places in indexes meet in one aggregate."""
    name = _columns(sys).withColumn("known", F.lit(True)).repartition(*OBJ)
    places = sys["index_columns"].select(
        *IDX,
        "column_id",
        "key_ordinal",
        "index_column_id",
        F.col("is_included_column").cast("boolean").alias("is_included"),
        F.col("is_descending_key").cast("boolean").alias("is_descending"),
    )
    cols = meet([*OBJ, "column_id"], places.repartition(*OBJ), {"named": name}).filter("known")
    return cols.select(*IDX, "key_ordinal", "index_column_id", "is_included", "column_name", "is_descending")


def table_pages(sys: Sys) -> DataFrame:
    return sys["partition_stats"].groupBy(*OBJ).agg(F.sum("reserved_page_count").alias("table_pages"))


def indexes(sys: Sys) -> DataFrame:
    """Named row-store indexes with columns, storage, statistics and shares; absent statistics stay NULL.

    All that belongs to a table is dealt by table once. What belongs to an index meets there in one aggregate, and what
    belongs to a database comes with the table, so no wide row is dealt again.
    """
    named = sys["indexes"].filter(F.col("name").isNotNull() & F.col("type_desc").isin("CLUSTERED", "NONCLUSTERED"))
    named = named.select(
        *IDX, "data_space_id", "name", "type_desc", "is_unique", "has_filter", "is_disabled", "fill_factor", "is_primary_key", "filter_definition"
    )
    groups = sys["filegroups"].select("database", "data_space_id", F.col("name").alias("filegroup"))
    tables = _tables(sys).join(database_pages(sys), "database", "left").join(table_pages(sys), OBJ, "left")
    named = named.join(groups, ["database", "data_space_id"], "left").repartition(*OBJ).join(dealt(tables), OBJ)
    physical = sys["index_physical_stats"].select(
        *IDX, "avg_fragmentation_in_percent", "page_count", "avg_page_space_used_in_percent", "record_count"
    )
    usage = sys["index_usage_stats"].select(*IDX, "user_seeks", "user_scans", "user_lookups", "user_updates")
    # (the lists are bounded by the source: the columns of a table, and 15,000 partitions)
    out = meet(
        IDX, named, {"physical": physical.repartition(*OBJ), "usage": usage.repartition(*OBJ)},
        {"_items": index_items(sys), "_parts": index_partitions(sys).repartition(*OBJ)},
    )
    out = out.withColumn("_items", F.array_sort("_items")).withColumns(split_items("is_included", "column_name", "is_descending"))
    numbers = F.array_distinct(F.filter(F.transform("_parts", lambda x: x["partition_number"]), lambda n: n.isNotNull()))
    out = out.withColumn("partition_count", F.when(F.size("_parts") > 0, F.size(numbers).cast("bigint")))
    out = out.withColumn("allocation_unit_type", F.array_max(F.transform("_parts", lambda x: x["unit_type"])))
    return out.select(
        "database",
        "schema",
        "table",
        "name",
        (F.col("type_desc") == "CLUSTERED").alias("is_clustered"),
        (F.col("type_desc") == "NONCLUSTERED").alias("is_nonclustered"),
        tri_state("is_unique").alias("is_unique"),
        tri_state("has_filter").alias("is_filtered"),
        tri_state("is_disabled").alias("is_disabled"),
        "fill_factor",
        F.col("type_desc").alias("index_type"),
        tri_state("is_primary_key").alias("is_primary_key"),
        "filter_definition",
        or_empty("key_columns").alias("key_columns"),
        or_empty("key_column_sort").alias("key_column_sort"),
        or_empty("included_columns").alias("included_columns"),
        F.coalesce(F.col("partition_count") > 1, F.lit(False)).alias("is_partitioned"),
        "partition_count",
        "filegroup",
        "allocation_unit_type",
        F.bround("avg_fragmentation_in_percent", 2).alias("fragmentation_pct"),
        "page_count",
        pages_to_mb("page_count").alias("index_size_mb"),
        F.bround("avg_page_space_used_in_percent", 2).alias("avg_page_space_used_pct"),
        "record_count",
        "user_seeks",
        "user_scans",
        "user_lookups",
        "user_updates",
        percent_if_any(F.col("page_count"), F.col("table_pages")).alias("percent_of_table"),
        percent_if_any(F.col("page_count"), F.col("database_pages")).alias("percent_of_database"),
    )


# --- constraints and keys ---


def foreign_keys(sys: Sys) -> DataFrame:
    """Pairs of qualified table names."""
    t = _tables(sys).select("database", "object_id", qualify("schema", "table").alias("q"))
    parent = t.select("database", F.col("object_id").alias("parent_object_id"), F.col("q").alias("from_table"))
    child = t.select("database", F.col("object_id").alias("referenced_object_id"), F.col("q").alias("to_table"))
    return (
        sys["foreign_keys"].join(parent, ["database", "parent_object_id"]).join(child, ["database", "referenced_object_id"])
        .select("database", "from_table", "to_table")
    )


_CONSTRAINT = [
    "database", "schema", "table", "name", "constraint_type", "columns", "referenced_table",
    "referenced_columns", "delete_action", "update_action", "is_trusted", "is_disabled", "is_system_named", "definition",
]


def _constraint(df: DataFrame, **given: Column) -> DataFrame:
    types = {
        "columns": "array<string>", "referenced_columns": "array<string>", "is_trusted": "boolean",
        "is_disabled": "boolean", "is_system_named": "boolean",
    }
    cols = []
    for c in _CONSTRAINT:
        if c in given:
            cols.append(given[c].alias(c))
        elif c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast(types.get(c, "string")).alias(c))
    return df.select(*cols)


def key_constraints(sys: Sys) -> DataFrame:
    """Primary keys and unique constraints with their columns in key order."""
    cols = sys["index_columns"].join(_columns(sys), [*OBJ, "column_id"]).select(*IDX, "key_ordinal", "column_name")
    keys = sys["key_constraints"].select(
        "database",
        F.col("parent_object_id").alias("object_id"),
        F.col("unique_index_id").alias("index_id"),
        "name",
        "type",
        F.col("is_system_named").cast("boolean").alias("is_system_named"),
    )
    lists = ordered_list(cols, IDX, ["key_ordinal"], ["column_name"])
    rows = keys.join(lists, IDX).join(_tables(sys), OBJ)
    kind = F.when(F.col("type") == "PK", "PRIMARY_KEY").otherwise("UNIQUE")
    return _constraint(rows, constraint_type=kind, columns=F.col("column_name"), referenced_columns=or_empty(F.lit(None)))


def foreign_key_constraints(sys: Sys) -> DataFrame:
    """Foreign keys with both column lists in pairing order."""
    c = _columns(sys)
    parent = c.select("database", F.col("object_id").alias("parent_object_id"), F.col("column_id").alias("parent_column_id"), F.col("column_name").alias("parent_column"))
    other = c.select("database", F.col("object_id").alias("referenced_object_id"), F.col("column_id").alias("referenced_column_id"), F.col("column_name").alias("referenced_column"))
    pairs = (
        sys["foreign_key_columns"]
        .join(parent, ["database", "parent_object_id", "parent_column_id"])
        .join(other, ["database", "referenced_object_id", "referenced_column_id"])
        .select("database", "constraint_object_id", "constraint_column_id", "parent_column", "referenced_column")
    )
    lists = ordered_list(pairs, ["database", "constraint_object_id"], ["constraint_column_id"], ["parent_column", "referenced_column"])
    t = _tables(sys)
    from_t = t.withColumnRenamed("object_id", "parent_object_id")
    to_t = t.select("database", F.col("object_id").alias("referenced_object_id"), qualify("schema", "table").alias("referenced_table"))
    rows = (
        sys["foreign_keys"].withColumnRenamed("object_id", "constraint_object_id")
        .join(lists, ["database", "constraint_object_id"])
        .join(from_t, ["database", "parent_object_id"])
        .join(to_t, ["database", "referenced_object_id"])
    )
    return _constraint(
        rows,
        constraint_type=F.lit("FOREIGN_KEY"),
        columns=F.col("parent_column"),
        referenced_columns=F.col("referenced_column"),
        is_trusted=inverted("is_not_trusted"),
        is_disabled=F.coalesce(F.col("is_disabled").cast("boolean"), F.lit(False)),
        is_system_named=F.coalesce(F.col("is_system_named").cast("boolean"), F.lit(False)),
    )


def _on_column(sys: Sys, raw: str) -> DataFrame:
    """Expression constraints with their one column, or none for table-level ones."""
    col = _columns(sys).select("database", F.col("object_id").alias("parent_object_id"), F.col("column_id").alias("parent_column_id"), "column_name")
    t = _tables(sys).withColumnRenamed("object_id", "parent_object_id")
    return sys[raw].join(t, ["database", "parent_object_id"]).join(col, ["database", "parent_object_id", "parent_column_id"], "left")


def _one_column() -> Column:
    return F.when(F.col("column_name").isNull(), F.array().cast("array<string>")).otherwise(F.array("column_name"))


def check_constraints(sys: Sys) -> DataFrame:
    return _constraint(
        _on_column(sys, "check_constraints"),
        constraint_type=F.lit("CHECK"),
        columns=_one_column(),
        referenced_columns=or_empty(F.lit(None)),
        is_trusted=inverted("is_not_trusted"),
        is_disabled=F.coalesce(F.col("is_disabled").cast("boolean"), F.lit(False)),
        is_system_named=F.coalesce(F.col("is_system_named").cast("boolean"), F.lit(False)),
    )


def default_constraints(sys: Sys) -> DataFrame:
    return _constraint(
        _on_column(sys, "default_constraints"),
        constraint_type=F.lit("DEFAULT"),
        columns=_one_column(),
        referenced_columns=or_empty(F.lit(None)),
        is_system_named=F.coalesce(F.col("is_system_named").cast("boolean"), F.lit(False)),
    )


def constraints(sys: Sys) -> DataFrame:
    """All constraints of every kind in one relation."""
    return (
        key_constraints(sys)
        .unionByName(foreign_key_constraints(sys))
        .unionByName(check_constraints(sys))
        .unionByName(default_constraints(sys))
    )


# --- remaining object kinds ---


def synonyms(sys: Sys) -> DataFrame:
    return _named(sys["synonyms"], sys).select("database", "schema", "name", F.col("base_object_name").alias("base_object"))


def sequences(sys: Sys) -> DataFrame:
    whole = lambda c, out: F.col(c).cast("bigint").alias(out)
    return _named(sys["sequences"], sys).select(
        "database",
        "schema",
        "name",
        whole("start_value", "current_value"),
        whole("increment", "increment"),
        whole("minimum_value", "minimum_value"),
        whole("maximum_value", "maximum_value"),
        whole("cache_size", "cache"),
    )


def user_defined_types(sys: Sys) -> DataFrame:
    own = sys["types"].filter(F.col("is_user_defined").cast("boolean"))
    return _named(own, sys).select(
        "database",
        "schema",
        "name",
        choose(F.col("is_table_type").cast("boolean"), "TABLE_TYPE", "USER_DEFINED").alias("type_kind"),
        F.col("user_type_id").cast("string").alias("base_type"),
    )


def xml_schema_collections(sys: Sys) -> DataFrame:
    return _named(sys["xml_schema_collections"], sys).select("database", "schema", "name")


def assemblies(sys: Sys) -> DataFrame:
    """Assemblies with their owner's default schema."""
    owners = sys["database_principals"].select("database", "principal_id", F.col("default_schema_name").alias("schema"))
    return sys["assemblies"].join(owners, ["database", "principal_id"], "left").select(
        "database", "schema", "name", F.col("permission_set_desc").alias("permission_set"), tri_state("is_visible").alias("is_visible")
    )


def security_principals(sys: Sys) -> DataFrame:
    p = sys["database_principals"]
    both = tagged_union(
        {"USER": p.filter(F.col("type").isin("U", "S", "G")), "ROLE": p.filter(F.col("type") == "R")}, "principal_type"
    )
    return both.select(
        "database",
        "name",
        "principal_type",
        F.col("default_schema_name").alias("default_schema"),
        F.col("owning_principal_id").cast("string").alias("owning_principal"),
    )


def permissions(sys: Sys) -> DataFrame:
    grantees = sys["database_principals"].select(
        "database", F.col("principal_id").alias("grantee_principal_id"), F.col("name").alias("grantee"), F.col("type").alias("principal_type")
    )
    return sys["database_permissions"].join(grantees, ["database", "grantee_principal_id"]).select(
        "database", "grantee", "principal_type", "class_desc", "object_name", "permission_name", "state_desc"
    )


def expression_dependencies(sys: Sys) -> DataFrame:
    """Catalog dependency rows with the referencing object's name and type."""
    o = _named(sys["objects"], sys).select(
        "database",
        F.col("object_id").alias("referencing_id"),
        F.col("schema").alias("ref_schema"),
        F.col("name").alias("ref_name"),
        F.col("type_desc").alias("ref_type"),
    )
    return sys["expression_dependencies"].join(o, ["database", "referencing_id"]).select(
        "database",
        "ref_schema",
        "ref_name",
        "ref_type",
        F.col("referenced_schema_name").alias("target_schema"),
        F.col("referenced_entity_name").alias("target_name"),
        F.col("referenced_class_desc").alias("target_class"),
        tri_state("is_ambiguous").alias("is_ambiguous"),
    )
