"""Text, package and archive files as rows."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.functions.scalars import drop_suffix, last_path_part
from demesne.session import cut

# workers may not have this package on their path, so its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed value: batch separator line of a script ---
BATCH_LINE = r"(?m)^\s*GO\s*$"


def _stem(path, suffix: str):
    return drop_suffix(last_path_part(path, "/"), suffix)


def _decoded_path():
    return F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))


def read_sql_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every .sql file of a folder as (object_name, text)."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.sql")
    return files.select(_stem(_decoded_path(), ".sql").alias("object_name"), F.col("value").alias("text"))


def read_package_dir(spark: SparkSession, path: str, project: str, folder: str | None = None) -> DataFrame:
    """Every .dtsx file of a folder as (project, folder, name, xml)."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.dtsx")
    return files.select(
        F.lit(project).alias("project"),
        F.lit(folder or project).alias("folder"),
        _stem(_decoded_path(), ".dtsx").alias("name"),
        F.col("value").alias("xml"),
    )


def read_archives(spark: SparkSession, path: str, glob: str = "*.ispac") -> DataFrame:
    """Project archives as (folder, project, content); the parent directory is the folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    parts = F.split("path", "/")
    return files.select(
        F.element_at(parts, -2).alias("folder"),
        F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("project"),
        "content",
    )


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder, project, content in zip(batch["folder"], batch["project"], batch["content"]):
            for name, xml, error in _texts(content):
                yield pd.DataFrame([(folder, project, name, xml, error)], columns=["folder", "project", "name", "xml", "error"])


def _texts(content) -> Iterator[tuple[str | None, str | None, str | None]]:
    """(name, text, error) of each package in an archive: a bad member is its own error, a bad archive one without a name."""
    try:
        with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
            for member in archive.namelist():
                if member.lower().endswith(".dtsx"):
                    try:
                        yield member[:-5], archive.read(member).decode("utf-8"), None
                    except Exception as exc:
                        yield member[:-5], None, f"{type(exc).__name__}: {exc}"
    except Exception as exc:
        yield None, None, f"{type(exc).__name__}: {exc}"


def expand_archives(archives: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Package members of every archive: (folder, project, name, xml, error).

    With an expected listing (folder, project, name) the result has exactly its
    rows; a member the archive lacks has an error instead of XML.
    """
    found = archives.mapInPandas(_members, "folder string, project string, name string, xml string, error string")
    if expected is None:
        return found
    keys = ["folder", "project"]
    found = cut(found)  # both halves below read it, and an archive is opened once
    broken = found.filter("name is null").select(*keys, F.col("error").alias("_broken"))
    members = found.filter("name is not null").select(*keys, "name", "xml", F.col("error").alias("_bad"))
    rows = expected.select(*keys, "name").join(members, [*keys, "name"], "left").join(broken, keys, "left")
    missing = F.concat(F.lit("member not in archive: "), F.col("name"), F.lit(".dtsx"))
    error = F.when(F.col("xml").isNull(), F.coalesce("_bad", "_broken", missing))
    return rows.select(*keys, "name", "xml", error.alias("error"))


def split_batches(df: DataFrame, text: str) -> DataFrame:
    """Script text as one row per batch (batch_no from 0, batch), blank batches left out."""
    pieces = F.transform(F.split(text, BATCH_LINE), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    kept = F.filter(pieces, lambda x: x != "")
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(kept).alias("batch_no", "batch"))
