"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Hub objects and big databases make hot keys, so adaptive execution must be
# free to split them even where that costs one more exchange.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session somebody else started."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("demesne")
    for name, value in ADAPTIVE.items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode where none is set, as in tests."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = context.getCheckpointDir()
    if not root and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """Write a DataFrame out and read it back, so that lost executors cost no recompute."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def dealt(side: DataFrame) -> DataFrame:
    """A side of a join that is met by key in the executors, however small: a job of many rounds would else leave
    one broadcast after the other in the driver."""
    return side.hint("merge")
