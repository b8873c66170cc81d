"""Data-quality and readiness counters from catalog relations, one row per database."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.functions.scalars import cents, percent_of, qualify, type_key
from demesne.operators.counters import having_more, repeated_values
from demesne.operators.keyed import top_n

# --- fixed values: type groups and thresholds ---
DEPRECATED_TYPES = ["text", "ntext", "image", "timestamp"]
TEXT_TYPES = ["text", "ntext", "image"]
SPATIAL_TYPES = ["geography", "geometry"]
LOB_TYPES = ["text", "ntext", "image", "varchar", "nvarchar", "varbinary", "xml"]
MAX_LENGTH_TYPES = ["varchar", "nvarchar", "varbinary"]
MAX_LENGTH = -1
WIDE_COLUMNS = 50
MANY_INDEXES = 10
LARGEST = 10

TABLE = ["database", "schema", "table"]
BYTES_PER_MB = 1024 * 1024


def _some(c: str) -> Column:
    return F.size(F.coalesce(F.col(c), F.array().cast("array<string>"))) > 0


def column_facts(columns: DataFrame) -> DataFrame:
    """Counters and any-column flags per table."""
    kind = type_key("data_type")
    yes = lambda c: F.coalesce(c, F.lit(False))
    counts = {
        "nullable_columns": F.col("nullable"),
        "non_nullable_columns": ~yes(F.col("nullable")),
        "deprecated_data_type_columns": kind.isin(*DEPRECATED_TYPES),
        "sql_variant_columns": kind == "sql_variant",
        "text_ntext_image_columns": kind.isin(*TEXT_TYPES),
        "large_max_columns": kind.isin(*MAX_LENGTH_TYPES) & (F.col("max_length") == MAX_LENGTH),
    }
    flags = {
        "xml_columns": kind == "xml",
        "spatial_columns": kind.isin(*SPATIAL_TYPES),
        "clr_types": F.col("is_clr_type"),
        "lob_columns": kind.isin(*LOB_TYPES),
        "filestream": F.col("is_filestream"),
    }
    return columns.groupBy(*TABLE).agg(
        *[F.count_if(yes(c)).alias(n) for n, c in counts.items()],
        *[F.bool_or(yes(c)).alias(n) for n, c in flags.items()],
    )


def table_facts(tables: DataFrame, columns: DataFrame, indexes: DataFrame, constraints: DataFrame) -> DataFrame:
    """Tables with what their columns, indexes and constraints say; every child is reduced before its join."""
    keys = constraints.groupBy(*TABLE).agg(
        F.bool_or(F.col("constraint_type") == "PRIMARY_KEY").alias("has_pk"),
        F.bool_or(F.col("constraint_type") == "FOREIGN_KEY").alias("has_fk"),
    )
    clustered = indexes.groupBy(*TABLE).agg(F.bool_or(F.coalesce("is_clustered", F.lit(False))).alias("has_clustered"))
    base = tables.withColumnRenamed("name", "table")
    return reduce(lambda a, b: a.join(b, TABLE, "left"), [keys, clustered, column_facts(columns)], base)


def quality_profile(
    databases: DataFrame, tables: DataFrame, columns: DataFrame, indexes: DataFrame, constraints: DataFrame
) -> DataFrame:
    """All counters per database; a database without tables has a row of zeros."""
    facts = table_facts(tables, columns, indexes, constraints)
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    conditions = {
        "empty_tables": F.col("row_count") == 0,
        "tables_without_primary_key": no("has_pk"),
        "tables_without_clustered_index": no("has_clustered"),
        "tables_without_foreign_key": no("has_fk"),
        "heap_tables": F.col("table_type") == "HEAP",
        "tables_with_triggers": F.col("trigger_count") > 0,
        "tables_with_identity_columns": _some("identity_columns"),
        "tables_with_computed_columns": _some("computed_columns"),
        "tables_with_sparse_columns": _some("sparse_columns"),
        "tables_with_cdc_enabled": F.col("is_cdc_enabled"),
        "tables_with_change_tracking_enabled": F.col("is_change_tracking_enabled"),
        "tables_with_temporal_tables": F.col("is_temporal_table"),
        "tables_with_xml_columns": F.col("xml_columns"),
        "tables_with_spatial_columns": F.col("spatial_columns"),
        "tables_with_clr_types": F.col("clr_types"),
        "tables_with_lob_columns": F.col("lob_columns"),
        "tables_with_filestream": F.col("filestream"),
    }
    sums = [
        "nullable_columns",
        "non_nullable_columns",
        "deprecated_data_type_columns",
        "sql_variant_columns",
        "text_ntext_image_columns",
        "large_max_columns",
    ]
    counted = facts.groupBy("database").agg(
        F.count(F.lit(1)).alias("total_tables"),
        *[F.count_if(c).alias(n) for n, c in conditions.items()],
        *[F.sum(n).alias(n) for n in sums],
        F.sum(cents("size_mb")).cast("decimal(30,0)").alias("_size"),
        F.sum("row_count").alias("_rows"),
    )
    of_tables = columns.join(tables.select("database", "schema", F.col("name").alias("table")), TABLE, "left_semi")
    repeated = repeated_values(of_tables, ["database"], "name", "duplicate_column_names")
    joined = databases.select("database").join(counted, "database", "left").join(repeated, "database", "left")
    zero = ["total_tables", *conditions, *sums, "duplicate_column_names"]
    length = percent_of(F.col("_size") * BYTES_PER_MB, F.col("_rows") * 10000)
    return joined.select(
        "database",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero],
        length.alias("average_row_length_bytes"),
    )


def quality_lists(tables: DataFrame, indexes: DataFrame) -> DataFrame:
    """Named tables behind the profile: (database, list, table_name, measure), place for the top list."""
    name = qualify("schema", "name").alias("table_name")
    largest = top_n(
        tables.select("database", "schema", "name", "size_mb"),
        ["database"],
        [F.col("size_mb").desc(), F.col("schema"), F.col("name")],
        LARGEST,
    ).select("database", F.lit("largest_tables").alias("list"), "place", name, "size_mb")
    wide = tables.filter(F.col("column_count") > WIDE_COLUMNS).select(
        "database",
        F.lit("wide_schema_tables").alias("list"),
        F.lit(None).cast("int").alias("place"),
        name,
        F.col("column_count").cast("double").alias("measure"),
    )
    many = having_more(indexes, TABLE, MANY_INDEXES).select(
        "database",
        F.lit("excessive_index_tables").alias("list"),
        F.lit(None).cast("int").alias("place"),
        qualify("schema", "table").alias("table_name"),
        F.col("n").cast("double").alias("measure"),
    )
    return largest.withColumnRenamed("size_mb", "measure").unionByName(wide).unionByName(many)
