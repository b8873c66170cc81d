"""Child rows folded into ordered lists.

A list is one value of one row, so these operators are for children that their
source bounds: the columns of an index or a constraint, the steps and schedules
of a job, the events of a trigger. For groups without such a bound the child
rows themselves, with their key and order columns, are the relation to work on;
counts and last values come from aggregates, never from the length of a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collect_ordered(df: DataFrame, keys: list[str], order: list[str], cols: list[str], aggs: list[Column] | None = None) -> DataFrame:
    """Rows (keys, _items, aggs…), items sorted by the order columns; one row a key, one pass over the rows."""
    item = F.struct(*order, *[c for c in cols if c not in order])
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items"), *(aggs or []))


def pick(col: str, condition=None) -> Column:
    """One field of every item as a list, optionally only of items that meet a condition."""
    items = F.col("_items")
    if condition is not None:
        items = F.filter(items, condition)
    return F.transform(items, lambda x: x[col])


def ordered_list(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    cols: list[str],
) -> DataFrame:
    """Parallel ordered lists, one per column (key columns of a constraint, both sides of a foreign key)."""
    folded = collect_ordered(df, keys, order, cols)
    return folded.select(*keys, *[pick(c).alias(c) for c in cols])


def split_list(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    flag: str,
    name: str,
    descending: str,
) -> DataFrame:
    """One ordered column list split into key columns, their directions, and included columns."""
    folded = collect_ordered(df, keys, order, [flag, name, descending])
    return folded.select(*keys, *[c.alias(n) for n, c in split_items(flag, name, descending).items()])


def split_items(flag: str, name: str, descending: str) -> dict[str, Column]:
    """Names of key columns, their directions, and names of included columns, out of ordered `_items`."""
    is_key = lambda x: ~x[flag]
    sort = F.transform(F.filter("_items", is_key), lambda x: F.when(x[descending], "DESC").otherwise("ASC"))
    return {"key_columns": pick(name, is_key), "key_column_sort": sort, "included_columns": pick(name, lambda x: x[flag])}


def nest(
    df: DataFrame, keys: list[str], order: list[str], cols: list[str], out: str
) -> DataFrame:
    """Child rows as one ordered array of structs with their number."""
    folded = collect_ordered(df, keys, order, cols, [F.count(F.lit(1)).alias(f"{out}_count")])
    fields = F.transform("_items", lambda x: F.struct(*[x[c].alias(c) for c in cols]))
    return folded.select(*keys, fields.alias(out), f"{out}_count")


def distinct_list(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Sorted list of distinct values per key."""
    return ordered_list(df.select(*keys, col).distinct(), keys, [col], [col])
