"""Counting aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_matrix(df: DataFrame, by: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows that meet each named condition per key, all in one pass."""
    return df.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def any_per_parent(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Whether some child row meets each condition, per parent."""
    return df.groupBy(*keys).agg(
        *[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]
    )


def repeated_values(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """How many values of a column occur more than once, per key."""
    times = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return times.groupBy(*by).agg(F.count_if(F.col("_n") > 1).alias(out))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two sums, NULL on a zero denominator."""
    return F.sum(numerator) / F.nullif(F.sum(denominator), F.lit(0))


def having_more(df: DataFrame, keys: list[str], more_than: int, out: str = "n") -> DataFrame:
    """Keys with more rows than the threshold."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > more_than)


def degrees(edges: DataFrame, scope: list[str], source: str, target: str, node: str = "node") -> DataFrame:
    """Distinct neighbours of every node, outgoing and incoming, in one aggregate."""
    pairs = edges.select(*scope, F.col(source).alias("_s"), F.col(target).alias("_t")).distinct()
    ends = F.explode(
        F.array(
            F.struct(F.col("_s").alias("n"), F.lit(1).alias("o"), F.lit(0).alias("i")),
            F.struct(F.col("_t").alias("n"), F.lit(0).alias("o"), F.lit(1).alias("i")),
        )
    )
    rows = pairs.select(*scope, ends.alias("_e"))
    return rows.groupBy(*scope, F.col("_e.n").alias(node)).agg(
        F.sum("_e.o").alias("out_degree"), F.sum("_e.i").alias("in_degree")
    )


def distinct_and_max(df: DataFrame, keys: list[str], distinct: str, label: str, n_out: str, label_out: str) -> DataFrame:
    """Distinct count of one column and the greatest label of another.

    Two levels, so that a hot key is spread over its distinct values first.
    """
    inner = df.groupBy(*keys, distinct).agg(F.max(label).alias("_l"))
    return inner.groupBy(*keys).agg(F.count(distinct).alias(n_out), F.max("_l").alias(label_out))
