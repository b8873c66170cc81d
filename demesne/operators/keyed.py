"""One row per key: latest, first, earliest, top, share of total.

Everything that keeps one row per key is an aggregate over a struct, not a
window: partial results are formed before the shuffle, so a key that holds a
third of all rows costs one row per input partition. Only top_n uses a window,
where Spark cuts each input partition to n rows per key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demesne.functions.scalars import percent_of
from demesne.session import cut


def _others(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest order columns of every key."""
    rest = _others(df, keys)
    newest = F.max_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order]))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], rank: list[str]) -> DataFrame:
    """The row with the least rank columns of every key.

    Remaining columns break ties, so the result does not depend on input order.
    """
    rest = _others(df, keys)
    first = F.min(F.struct(*rank, *[c for c in rest if c not in rank]))
    return df.groupBy(*keys).agg(first.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def earliest(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Least combination of several columns together, never column by column."""
    return df.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("_r")).select(*keys, "_r.*")


def conditional_max(df: DataFrame, keys: list[str], value: str, cases: dict[str, Column]) -> DataFrame:
    """Greatest value per key for each named condition, NULL where none met it."""
    return df.groupBy(*keys).agg(*[F.max(F.when(cond, F.col(value))).alias(name) for name, cond in cases.items()])


def argmax(df: DataFrame, keys: list[str], name: str, value: str, out: str) -> DataFrame:
    """Name with the greatest value per key, the least name among equals."""
    return df.groupBy(*keys).agg(F.min_by(F.col(name), F.struct(-F.col(value), F.col(name))).alias(out))


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, out: str = "place") -> DataFrame:
    """First n rows per key; order must be total for a repeatable result."""
    if not by:
        df = df.orderBy(*order).limit(n)
        place = F.row_number().over(Window.orderBy(*order))  # at most n rows
        return df.withColumn(out, place)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(out, place).filter(F.col(out) <= n)


def share_of_total(df: DataFrame, value: str, by: list[str], out: str) -> DataFrame:
    """Percent of the key's total. Value must be a whole number (bytes, pages, cents)."""
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    return percent_of_total(df, totals, by, value, "_total", out).drop("_total")


def percent_of_total(
    df: DataFrame, totals: DataFrame, keys: list[str], value: str, total: str, out: str
) -> DataFrame:
    """Percent of a total found elsewhere, NULL where that total is missing or 0."""
    joined = df.join(totals, keys, "left")
    return joined.withColumn(out, percent_of(F.col(value), F.col(total)))


def percent_if_any(part: Column, whole: Column) -> Column:
    """As percent_of, but NULL also when the part itself is 0 or missing."""
    return percent_of(F.nullif(part, F.lit(0)), whole)


def after_parts(df: DataFrame, part: str, at: Column, out: str) -> DataFrame:
    """Place from 1 of rows that are in order within numbered parts, which follow each other; `at` counts from 0 within a part.

    Only one row a part is ever brought into order as a whole.
    """
    sizes = df.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(part, F.coalesce(earlier, F.lit(0)).alias("_start"))
    return df.join(F.broadcast(starts), part).withColumn(out, F.col("_start") + at + 1).drop("_start", part)


def global_rank(df: DataFrame, order: list[Column | str], out: str = "place") -> DataFrame:
    """Place of every row in one order over the whole table, without a task that holds more than its range.

    Rows are range-partitioned and sorted; where a row stands in its partition, and the rows of the partitions
    before it, give its place. The sorted rows are written, as both need the same partitions. Order must be unique.
    """
    spot = F.monotonically_increasing_id()  # partition number in the high bits, place in the partition in the low 33
    rows = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("_spot", spot)
    rows = rows.withColumn("_part", F.shiftright("_spot", 33))
    return after_parts(rows, "_part", F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1)), out).drop("_spot")


def mark_within_budget(
    df: DataFrame, keys: list[str], order: list[str], cap: int, place: str = "place", flag: str = "within_budget"
) -> DataFrame:
    """Mark the first cap rows in a global order; all other rows stay, unplaced.

    The order columns must be unique. A cap of a third of all rows costs no more than one of ten.
    """
    first = keys + [c for c in df.columns if c not in keys]
    ranked = global_rank(df.select(*first), order, place)
    within = F.col(place) <= cap
    return ranked.withColumn(flag, within).withColumn(place, F.when(within, F.col(place)).cast("int"))
