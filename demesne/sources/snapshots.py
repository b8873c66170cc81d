"""Catalog snapshots: one folder per relation, or one query over JDBC."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.schemas import schema_of


def read_snapshot(
    spark: SparkSession, root: str, name: str, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """One relation of a snapshot with its declared schema; `database` is a plain column."""
    return spark.read.format(fmt).schema(schema or schema_of(name)).load(f"{root}/{name}")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores where the source has fewer splits than the session has cores.

    For per-row heavy work (text mining, XML) on a source of few files. Sources
    with enough splits, as every large one has, are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def read_optional(
    spark: SparkSession, root: str, name: str, fmt: str = "parquet", schema: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """A relation that may be absent, and its run-log row; absence is no failure.

    Absent gives the empty relation of the declared schema, so that later left
    joins yield NULLs and the rest of the run goes on.
    """
    schema = schema or schema_of(name)
    try:
        found = read_snapshot(spark, root, name, fmt, schema)
        error = None
    except AnalysisException as exc:
        found = spark.createDataFrame([], schema)
        error = exc.getCondition() or str(exc)
    entry = spark.createDataFrame(
        [(name, root, "absent" if error else "success", None if error else "direct_metadata", error, None)],
        schema_of("run_log"),
    )
    return found, entry


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str],
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Live source; with (column, low, high, parts) the query is read in parallel slices."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if partition is None:
        return reader.option("query", query).load()
    column, low, high, parts = partition
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
        .load()
    )


def read_jdbc_slices(spark: SparkSession, url: str, query: str, properties: dict[str, str], column: str, parts: int) -> DataFrame:
    """The query read in parallel slices of a column of whole numbers; its bounds come from a query of their own.

    Rows with a NULL there are in the first slice; filters on the result reach the source.
    """
    low, high = read_jdbc(spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM ({query}) b", properties).first()
    if low is None or parts < 2 or low == high:
        return read_jdbc(spark, url, query, properties)
    return read_jdbc(spark, url, query, properties, (column, int(low), int(high) + 1, min(parts, int(high) - int(low) + 1)))


def project_listing(projects: DataFrame, folders: DataFrame) -> DataFrame:
    """Deployed projects with their folder."""
    return projects.join(folders.select("folder_id", F.col("name").alias("folder")), "folder_id").select(
        "folder", F.col("name").alias("project"), "project_id"
    )


def package_listing(packages: DataFrame, projects: DataFrame, folders: DataFrame) -> DataFrame:
    """Packages with project and folder; filter on those two for a single project."""
    owners = project_listing(projects, folders)
    return packages.select("project_id", F.col("name").alias("name")).join(owners, "project_id").select(
        "folder", "project", "name"
    )
