"""Query registry and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demesne.session import tune
from demesne.sources.snapshots import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder, each resolved once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder
        self._read: dict = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def spread(self, name: str, key: str) -> DataFrame:
        """A table over all cores, for heavy work per row."""
        if (name, key) not in self._read:
            self._read[name, key] = spread(self[name], key)
        return self._read[name, key]

    def sql(self, text: str, **given: DataFrame) -> DataFrame:
        """A SELECT over {table} placeholders."""
        used = {n: given.get(n, self[n]) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def query(name: str, oracle: str | None = None, whole: tuple[str, ...] = ()):
    """Register fn(tables) -> DataFrame under a name, with the SQL that gives the same rows.

    `whole` names columns that the checking engine counts in a wider type.
    """
    if oracle is not None and whole:
        casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in whole)
        oracle = f"SELECT * REPLACE ({casts}) FROM ({oracle})"

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def plain(text: str) -> str:
    """The same SELECT for an engine where the tables have their own names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def pct(part: str, whole: str) -> str:
    """SQL of scalars.percent_of: whole numbers, halves to even."""
    q = f"((CAST({part} AS HUGEINT) * 10000) // nullif(CAST({whole} AS HUGEINT), 0))"
    r = f"(CAST({part} AS HUGEINT) * 10000 - {q} * CAST({whole} AS HUGEINT))"
    up = f"(2 * {r} > CAST({whole} AS HUGEINT) OR (2 * {r} = CAST({whole} AS HUGEINT) AND {q} % 2 = 1))"
    return f"CAST({q} + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) / 100.0"


def mb(pages: str) -> str:
    """SQL of scalars.pages_to_mb."""
    return f"CAST(round_even(CAST({pages} AS DOUBLE) * 0.0078125, 2) AS DOUBLE)"
