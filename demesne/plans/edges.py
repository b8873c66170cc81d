"""One typed, deduplicated dependency-edge relation out of every source of evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.functions.patterns import PSEUDO_TABLES
from demesne.functions.scalars import name_key, qualify, type_key
from demesne.operators.keyed import first_wins
from demesne.operators.membership import bare_catalog, name_catalog
from demesne.schemas import METADATA, TEXT_MINED, UNRESOLVED, XML_PARSED

EDGE = [
    "database",
    "source_object",
    "source_type",
    "target_object",
    "target_type",
    "relationship_type",
    "discovery_method",
    "edge_rank",
    "position",
]
EDGE_KEY = EDGE[:6]

# --- fixed values: emission order of edges mined from text, by source type and kind of reference ---
TEXT_RANK = {
    "stored_procedure:table": 1,
    "stored_procedure:proc": 2,
    "stored_procedure:function": 3,
    "stored_procedure:sequence": 4,
    "view:table": 5,
    "view:function": 6,
    "view:sequence": 7,
    "function:table": 8,
    "function:function": 9,
    "function:sequence": 10,
    "trigger:table": 12,
    "trigger:proc": 13,
    "trigger:function": 14,
    "trigger:sequence": 15,
    "constraint:table": 16,
    "constraint:function": 17,
    "constraint:sequence": 18,
    "package:table": 22,
    "package:proc": 23,
    "package:sequence": 24,
    "table:function": 27,
}
FIRES_ON, SYNONYM, FOREIGN_KEY, EXECUTES, USES_UDT, USES_XML, BACKFILL = 11, 19, 20, 21, 25, 26, 28
WRITES = 29

# --- fixed values: target type and relationship by kind of reference ---
KIND_TARGET = {"proc": "stored_procedure", "function": "function", "sequence": "sequence"}
KIND_RELATION = {"table": "reads", "proc": "calls", "function": "calls", "sequence": "uses_sequence"}

# --- fixed values: catalog object types that may be completed from the catalog's own dependency rows ---
BACKFILL_TYPES = {
    "SQL_STORED_PROCEDURE": "stored_procedure",
    "VIEW": "view",
    "SQL_TRIGGER": "trigger",
    "CHECK_CONSTRAINT": "constraint",
    "SQL_SCALAR_FUNCTION": "function",
    "SQL_TABLE_VALUED_FUNCTION": "function",
    "SQL_INLINE_TABLE_VALUED_FUNCTION": "function",
}


def _lookup(labels: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for item in labels.items() for x in item]), key)


def _start() -> Column:
    return F.array().cast("array<int>")


def _edges(
    df: DataFrame,
    source: Column,
    source_type: str,
    target: Column,
    target_type: str | None,
    relation: str,
    rank: int,
    method: str = METADATA,
) -> DataFrame:
    return df.select(
        "database",
        source.alias("source_object"),
        F.lit(source_type).alias("source_type"),
        target.alias("target_object"),
        F.lit(target_type).cast("string").alias("target_type"),
        F.lit(relation).alias("relationship_type"),
        F.lit(method).alias("discovery_method"),
        F.lit(rank).alias("edge_rank"),
        _start().alias("position"),
    )


def type_catalog(views: DataFrame, synonyms: DataFrame, procs: DataFrame, functions: DataFrame) -> DataFrame:
    """Known names and their type; a view beats a synonym beats a procedure beats a function."""
    parts = [("view", views), ("synonym", synonyms), ("stored_procedure", procs), ("function", functions)]
    return name_catalog([(k, df.select("database", "name")) for k, df in parts], ["database"])


def text_edges(refs: DataFrame) -> DataFrame:
    """Edges of mined references.

    refs: database, source_object, source_type, ref_kind, ref_name, parse_status, position.
    """
    key = F.concat_ws(":", "source_type", "ref_kind")
    return refs.select(
        "database",
        "source_object",
        "source_type",
        F.col("ref_name").alias("target_object"),
        _lookup(KIND_TARGET, F.col("ref_kind")).alias("target_type"),
        _lookup(KIND_RELATION, F.col("ref_kind")).alias("relationship_type"),
        F.when(F.col("source_type") == "table", TEXT_MINED).otherwise(F.col("parse_status")).alias("discovery_method"),
        _lookup(TEXT_RANK, key).alias("edge_rank"),
        "position",
    ).filter("edge_rank is not null")


def trigger_edges(triggers: DataFrame) -> DataFrame:
    """trigger -> the table it fires on, whatever its text holds (database, name, table)."""
    known = triggers.filter("`table` is not null and `table` != ''")
    return _edges(known, F.col("name"), "trigger", F.col("table"), None, "fires_on", FIRES_ON)


def synonym_edges(synonyms: DataFrame) -> DataFrame:
    known = synonyms.filter("base_object is not null and base_object != ''")
    return _edges(known, F.col("name"), "synonym", F.col("base_object"), None, "references", SYNONYM)


def foreign_key_edges(foreign_keys: DataFrame) -> DataFrame:
    """table -> table (database, from_table, to_table)."""
    return _edges(
        foreign_keys, F.col("from_table"), "table", F.col("to_table"), "table", "foreign_key", FOREIGN_KEY
    )


def package_edges(tasks: DataFrame) -> DataFrame:
    """package -> package (database, package, executed_package)."""
    calls = tasks.filter("executed_package is not null and executed_package != ''")
    return _edges(
        calls, F.col("package"), "package", F.col("executed_package"), "package", "executes", EXECUTES, XML_PARSED
    )


def write_edges(tasks: DataFrame) -> DataFrame:
    """package -> table a data flow loads (database, package, written_tables); optional evidence."""
    rows = tasks.select("database", "package", F.explode("written_tables").alias("_t"))
    target = F.regexp_replace("_t", r"[\[\]]", "")
    return _edges(rows, F.col("package"), "package", target, None, "writes", WRITES, XML_PARSED)


def type_edges(columns: DataFrame, types: DataFrame, order: list[str] | None = None) -> DataFrame:
    """table -> user-defined type or XML schema collection of its columns.

    columns: database, table_name, data_type, xml_schema_collection; types: database, name.
    Column types carry no schema, so they are matched on the bare name; of several types the last by
    `order` (columns of types) counts. Both uses are rows of one pass over the columns.
    """
    order = order or []
    catalog = bare_catalog(types.select("database", "name", *order).distinct(), ["database"], "name", order, "type_name")
    uses = F.array(
        F.struct(F.lit("user_defined_type").alias("kind"), type_key("data_type").alias("key")),
        F.struct(F.lit("xml_schema_collection").alias("kind"), F.col("xml_schema_collection").alias("key")),
    )
    used = columns.select("database", "table_name", F.inline(uses)).filter("key is not null and key != ''").distinct()
    by_type = F.col("kind") == "user_defined_type"
    keyed = used.withColumn("bare_key", F.when(by_type, F.col("key")).otherwise(F.concat(F.lit("\0"), "key")))
    found = keyed.join(catalog, ["database", "bare_key"], "left").filter(~by_type | F.col("type_name").isNotNull())
    return found.select(
        "database",
        F.col("table_name").alias("source_object"),
        F.lit("table").alias("source_type"),
        F.coalesce("type_name", "key").alias("target_object"),
        F.col("kind").alias("target_type"),
        F.lit("uses_type").alias("relationship_type"),
        F.lit(METADATA).alias("discovery_method"),
        F.when(by_type, USES_UDT).otherwise(USES_XML).alias("edge_rank"),
        _start().alias("position"),
    )


def needs_backfill(objects: DataFrame) -> DataFrame:
    """Objects whose own text gave no result or a doubtful one.

    objects: database, source_type, schema, object, source_object, parse_status, unresolved_reason.
    """
    weak = (F.col("parse_status") == UNRESOLVED) | F.col("unresolved_reason").isNotNull()
    keyed = objects.filter(weak).select(
        "database",
        "source_type",
        name_key("schema").alias("schema_key"),
        name_key("object").alias("object_key"),
        "source_object",
    )
    keys = ["database", "source_type", "schema_key", "object_key"]
    return keyed.groupBy(*keys).agg(F.max("source_object").alias("source_object"))


def valid_dependencies(rows: DataFrame) -> DataFrame:
    """Catalog dependency rows that are unambiguous, about objects, and fully named."""
    named = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("ref_schema", "ref_name", "target_name")]
    sure = ~F.coalesce("is_ambiguous", F.lit(False)) & (F.col("target_class") == "OBJECT_OR_COLUMN")
    return rows.filter(reduce(lambda a, b: a & b, named, sure))


def backfill_edges(dependencies: DataFrame, needs: DataFrame) -> DataFrame:
    """Catalog dependency rows, only for the objects that need them.

    The needs relation also holds the object's own id, so the restriction and
    the recovery of three-part constraint ids are one join. Whether an edge
    reads or calls depends on its target, so it is left open until that is known.
    """
    rows = dependencies.select(
        "database",
        _lookup(BACKFILL_TYPES, F.col("ref_type")).alias("source_type"),
        name_key("ref_schema").alias("schema_key"),
        name_key("ref_name").alias("object_key"),
        qualify("ref_schema", "ref_name").alias("_plain_id"),
        qualify("target_schema", "target_name").alias("target_object"),
        name_key("target_name").alias("_target_key"),
    ).filter(F.col("source_type").isNotNull() & ~F.col("_target_key").isin(*PSEUDO_TABLES))
    hits = rows.join(needs, ["database", "source_type", "schema_key", "object_key"])
    own_id = F.when(F.col("source_type") == "constraint", F.col("source_object")).otherwise(F.col("_plain_id"))
    return hits.select(
        "database",
        own_id.alias("source_object"),
        "source_type",
        "target_object",
        F.lit(None).cast("string").alias("target_type"),
        F.lit(None).cast("string").alias("relationship_type"),
        F.lit(METADATA).alias("discovery_method"),
        F.lit(BACKFILL).alias("edge_rank"),
        _start().alias("position"),
    )


def resolve_targets(edges: DataFrame, catalog: DataFrame) -> DataFrame:
    """Fill open target types by the catalog, and open relationships by the target type.

    Dangling targets stay as tables. Edges whose target type is known get a key
    of their own that matches nothing, so one join serves the whole union.
    """
    known = F.col("target_type").isNotNull()
    key = F.when(known, F.concat(F.lit("\0"), "target_object")).otherwise(name_key("target_object"))
    joined = edges.withColumn("name_key", key).join(catalog, ["database", "name_key"], "left")
    filled = joined.withColumn("target_type", F.coalesce("target_type", "resolved_type", F.lit("table")))
    relation = F.when(F.col("target_type").isin("stored_procedure", "function"), "calls").otherwise("reads")
    return filled.withColumn("relationship_type", F.coalesce("relationship_type", relation)).select(*EDGE)


def merge_edges(streams: list[DataFrame], catalog: DataFrame) -> DataFrame:
    """All edge streams as one, each edge once with its first evidence."""
    together = reduce(DataFrame.unionByName, [s.select(*EDGE) for s in streams])
    return first_wins(resolve_targets(together, catalog), EDGE_KEY, ["edge_rank", "position"]).drop("position")
