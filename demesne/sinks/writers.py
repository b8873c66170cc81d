"""Outputs: one folder per relation first, every other form derived from those."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.operators.keyed import after_parts
from demesne.schemas import schema_of
from demesne.sources.snapshots import read_snapshot

LOG_COLUMNS = ["object_type", "object_name", "status", "parse_status", "error", "duration_ms"]
ROLLUP_COLUMNS = ["object_type", "object_name", "count", "size_mb", "tables", "procs", "views"]


def write_entities(relations: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """One output per relation, and the foreign keys derived from the constraints."""
    relations = dict(relations)
    if "constraints" in relations:
        relations["foreign_keys"] = relations["constraints"].filter(F.col("constraint_type") == "FOREIGN_KEY")
    paths = {}
    for name, df in relations.items():
        paths[name] = f"{root}/{name}"
        df.write.mode("overwrite").format(fmt).save(paths[name])
    return paths


def document_rows(spark: SparkSession, paths: dict[str, str], schemas: dict | None = None, fmt: str = "parquet"):
    """(entity, body) rows re-read from the entity outputs, body as JSON."""
    parts = []
    for name, path in paths.items():
        root, folder = path.rsplit("/", 1)
        schema = (schemas or {}).get(name)
        df = spark.read.format(fmt).load(path) if schema is None else read_snapshot(spark, root, folder, fmt, schema)
        body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        parts.append(df.select(F.lit(name).alias("entity"), body.alias("body")))
    return reduce(DataFrame.unionByName, parts)


def write_document(spark: SparkSession, paths: dict[str, str], target: str, fmt: str = "parquet") -> None:
    """The aggregate document, assembled from the entity outputs and from nothing else."""
    document_rows(spark, paths, fmt=fmt).write.mode("overwrite").partitionBy("entity").text(target)


def write_rollup(rollup: DataFrame, target: str) -> None:
    """Fixed-column CSV in the roll-up's own row order (a few rows per database)."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ROLLUP_COLUMNS]
    rows = rollup.orderBy("row_order", "object_name").select(*text)
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(target)


def write_ordered(df: DataFrame, order: list, target: str, parts: int | None = None) -> None:
    """Part files that follow each other in the order given, each sorted: every task writes its own range."""
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite").parquet(target)


def read_ordered(spark: SparkSession, target: str, place: str = "place") -> DataFrame:
    """Rows of `write_ordered` with their place in the whole, told from the number of the part file and of the row in it."""
    rows = spark.read.parquet(target).select(
        "*",
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("_part"),
        F.col("_metadata.row_index").alias("_at"),
    )
    return after_parts(rows, "_part", F.col("_at"), place).drop("_at")


def write_log(log: DataFrame, target: str) -> None:
    """Per-object log CSV; missing values are empty fields."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LOG_COLUMNS]
    log.select(*text).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(target)


def write_engine_results(results: DataFrame, target: str) -> None:
    """Mirrored outputs, one folder per extractor."""
    results.write.mode("overwrite").partitionBy("engine").json(target)


def flat_report(report: DataFrame, engines: list[str]) -> DataFrame:
    """Comparison rows with their lists joined by '; '."""
    cols = [F.col("object_name")]
    for e in engines:
        cols.append(F.col(f"{e}_status"))
        cols.append(F.array_join(f"{e}_referenced_tables", "; ").alias(f"{e}_referenced_tables"))
    return report.select(*cols, *([F.col("tables_agree")] if len(engines) > 1 else []))


def write_comparison(report: DataFrame, engines: list[str], root: str) -> None:
    report.write.mode("overwrite").json(f"{root}/comparison_report_json")
    flat_report(report, engines).write.mode("overwrite").option("header", True).csv(f"{root}/comparison_report_csv")


def empty_out(spark: SparkSession, path: str, name: str, fmt: str = "parquet", schema=None) -> None:
    """Truncate a relation: overwrite it with its empty self."""
    spark.createDataFrame([], schema or schema_of(name)).write.mode("overwrite").format(fmt).save(path)
