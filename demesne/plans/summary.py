"""Counts over all relations of an estate: per-database summary and flat roll-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.functions.scalars import cents, qualify
from demesne.operators.keyed import argmax
from demesne.schemas import INFERRED, UNRESOLVED

# --- fixed values: summary counter, relation it counts, condition on the relation ---
SUMMARY_COUNTS: list[tuple[str, str, str | None]] = [
    ("total_tables", "tables", None),
    ("total_views", "views", None),
    ("total_stored_procedures", "stored_procedures", None),
    ("total_functions", "functions", None),
    ("total_triggers", "triggers", None),
    ("total_indexes", "indexes", None),
    ("total_foreign_keys", "foreign_keys", None),
    ("total_synonyms", "synonyms", None),
    ("total_sequences", "sequences", None),
    ("total_users", "security_principals", "principal_type = 'USER'"),
    ("total_roles", "security_principals", "principal_type = 'ROLE'"),
    ("total_constraints", "constraints", None),
    ("total_primary_key_constraints", "constraints", "constraint_type = 'PRIMARY_KEY'"),
    ("total_unique_constraints", "constraints", "constraint_type = 'UNIQUE'"),
    ("total_check_constraints", "constraints", "constraint_type = 'CHECK'"),
    ("total_default_constraints", "constraints", "constraint_type = 'DEFAULT'"),
]

# --- fixed values: roll-up rows after the databases, in their order ---
ROLLUP_KINDS = [
    ("table", "tables"),
    ("stored_procedure", "stored_procedures"),
    ("database_file", "database_files"),
    ("index", "indexes"),
    ("constraint", "constraints"),
    ("function", "functions"),
    ("synonym", "synonyms"),
    ("sequence", "sequences"),
    ("view", "views"),
    ("ssis_package", "packages"),
    ("dependency_edge", "dependencies"),
]


def inventory_counts(relations: dict[str, DataFrame], by: str = "database") -> DataFrame:
    """All summary counters per database in one aggregate over the tagged rows."""
    parts = []
    for name in dict.fromkeys(rel for _, rel, _ in SUMMARY_COUNTS):
        if name not in relations:
            continue
        hits = [(out, F.expr(cond) if cond else F.lit(True)) for out, rel, cond in SUMMARY_COUNTS if rel == name]
        counted = relations[name].groupBy(by).agg(*[F.count_if(c).alias(out) for out, c in hits])
        missing = [out for out, rel, _ in SUMMARY_COUNTS if rel != name]
        parts.append(counted.select(by, *[out for out, _ in hits], *[F.lit(None).cast("bigint").alias(m) for m in missing]))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(by).agg(*[F.coalesce(F.sum(out), F.lit(0)).alias(out) for out, _, _ in SUMMARY_COUNTS])


def database_summary(databases: DataFrame, relations: dict[str, DataFrame]) -> DataFrame:
    """One row per database: counters, total rows, largest table, and the database's own facts."""
    t = relations["tables"].withColumn("_q", qualify("schema", "name"))
    rows = t.groupBy("database").agg(F.sum("row_count").alias("total_row_count"))
    largest = argmax(t, ["database"], "_q", "size_mb", "largest_table")
    own = databases.select(
        F.col("name").alias("database"),
        F.col("last_backup_date").alias("last_backup"),
        F.col("last_restore_date").alias("last_restore"),
        "recovery_model",
        "compatibility_level",
        F.col("size_mb").alias("database_size_mb"),
    )
    joined = own.join(inventory_counts(relations), "database", "left").join(rows, "database", "left").join(largest, "database", "left")
    zero = [out for out, _, _ in SUMMARY_COUNTS] + ["total_row_count"]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})


def backfill_counts(databases: DataFrame, relations: dict[str, DataFrame]) -> DataFrame:
    """Databases with their numbers of tables, procedures and views."""
    counts = inventory_counts({k: relations[k] for k in ("tables", "stored_procedures", "views")})
    n = lambda c, out: F.coalesce(F.col(c), F.lit(0)).alias(out)
    named = counts.withColumnRenamed("database", "name")
    base = databases.drop("table_count", "proc_count", "view_count").join(named, "name", "left")
    kept = [c for c in databases.columns if c not in ("table_count", "proc_count", "view_count")]
    return base.select(
        *kept, n("total_tables", "table_count"), n("total_stored_procedures", "proc_count"), n("total_views", "view_count")
    )


def needs_review(procs: DataFrame, statements: DataFrame) -> DataFrame:
    """One row: objects a human must look at, by the two rules for procedures and embedded SQL."""
    noted = F.coalesce(F.col("unresolved_reason"), F.lit("")) != ""
    p = procs.select(((F.col("parse_status") == UNRESOLVED) | noted).alias("review"))
    s = statements.select((F.col("parse_status").isin(UNRESOLVED, INFERRED) | noted).alias("review"))
    return p.unionByName(s).agg(F.count_if("review").alias("count"))


def review_over_all(mined: DataFrame, by: list[str]) -> DataFrame:
    """The wider count: every kind of object with text."""
    noted = F.coalesce(F.col("unresolved_reason"), F.lit("")) != ""
    weak = F.col("parse_status").isin(UNRESOLVED, INFERRED) | noted
    return mined.groupBy(*by).agg(F.count_if(weak).alias("needs_review"), F.count(F.lit(1)).alias("objects"))


def _row(df: DataFrame, order: int, kind: str, name: Column, count: Column, **given: Column) -> DataFrame:
    blank = {"size_mb": "double", "tables": "bigint", "procs": "bigint", "views": "bigint"}
    return df.select(
        F.lit(order).alias("row_order"),
        F.lit(kind).alias("object_type"),
        name.alias("object_name"),
        count.alias("count"),
        *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in blank.items()],
    )


def rollup(databases: DataFrame, relations: dict[str, DataFrame], review: DataFrame) -> DataFrame:
    """One row per database, one per kind of object, one for what needs review."""
    parts = [
        _row(
            databases, 0, "database", F.col("name"), F.lit(1).cast("bigint"),
            size_mb=F.col("size_mb"), tables=F.col("table_count"), procs=F.col("proc_count"), views=F.col("view_count"),
        )
    ]
    for i, (kind, name) in enumerate(ROLLUP_KINDS, start=1):
        if name not in relations:
            continue
        aggs = [F.count(F.lit(1)).alias("n")]
        if kind == "table":
            aggs.append((F.coalesce(F.sum(cents("size_mb")), F.lit(0)) / 100.0).alias("size"))
        total = relations[name].agg(*aggs)
        given = {"size_mb": F.col("size")} if kind == "table" else {}
        parts.append(_row(total, i, kind, F.lit("(all)"), F.col("n"), **given))
    parts.append(
        _row(review, len(ROLLUP_KINDS) + 1, "unresolved_or_llm_inferred", F.lit("(needs human review)"), F.col("count"))
    )
    return reduce(DataFrame.unionByName, parts)
