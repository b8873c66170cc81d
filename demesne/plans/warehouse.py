"""Load, merge, archive and validation jobs of a small warehouse, on any tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from demesne.session import cut, dealt


def summary_per_parent(parent: DataFrame, child: DataFrame, key: str, counted: str, summed: Column, n: str, total: str) -> DataFrame:
    """Every parent with the number and sum of its children; the sum is NULL without any."""
    sums = child.groupBy(key).agg(F.count(counted).alias(n), F.sum(summed).alias(total))
    return parent.join(sums, key, "left").withColumn(n, F.coalesce(F.col(n), F.lit(0)))


def upsert_by_key(target: DataFrame, staging: DataFrame, key: str, updated: list[str], inserted: dict[str, Column]) -> DataFrame:
    """MERGE as a full outer join: matched rows take the staged values, new ones are inserted.

    A staged NULL overwrites, as an assignment does. Target columns that are
    neither the key nor updated keep their value; on insert they come from `inserted`.
    """
    t = target.withColumn("_old", F.lit(True))
    s = staging.select(key, *[F.col(c).alias(f"_new_{c}") for c in updated], F.lit(True).alias("_new"))
    joined = t.join(s, key, "full_outer")
    fresh = F.col("_new").isNotNull()
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.col(c))
        elif c in updated:
            cols.append(F.when(fresh, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(F.col("_old").isNull(), inserted.get(c, F.lit(None))).otherwise(F.col(c)).alias(c))
    return joined.select(*cols)


def insert_new(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Target and the staged rows whose key it lacks."""
    return target.unionByName(staging.join(target.select(key), key, "left_anti").select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], assigned: dict[str, Column]) -> DataFrame:
    """UPDATE … FROM: rows with a match take the assigned values; source keys are unique."""
    s = source.withColumn("_hit", F.lit(True))
    joined = target.join(s, keys, "left")
    hit = F.col("_hit").isNotNull()
    return joined.select(
        *[F.when(hit, assigned[c]).otherwise(target[c]).alias(c) if c in assigned else target[c] if c not in keys else F.col(c) for c in target.columns]
    )


def archive_by_cutoff(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, old: Column):
    """(archived parents, kept parents, kept children): children go with their parent."""
    keep = ~F.coalesce(old, F.lit(False))
    gone = parents.filter(old).select(F.col(parent_key).alias(child_key))
    return parents.filter(old), parents.filter(keep), children.join(gone, child_key, "left_anti")


def stats_by_dimension(facts: DataFrame, dimension: DataFrame, key: str, label: str, summed: Column, n: str, total: str) -> DataFrame:
    """Counts and sums per label; the facts are reduced to one row per key before the join."""
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(summed).alias("_s"))
    return (
        per_key.join(dimension.select(key, label), key).groupBy(label)
        .agg(F.sum("_n").alias(n), F.sum("_s").alias(total))
    )


def validate_totals(headers: DataFrame, details: DataFrame, key: str, stated: Column, computed: Column) -> DataFrame:
    """Headers whose stated total is not the sum of their details; headers without details do not count."""
    sums = details.groupBy(key).agg(F.sum(computed).alias("computed_total"))
    return headers.withColumn("stated_total", stated).join(sums, key).filter("stated_total <> computed_total")


def touch_changed(table: DataFrame, changed: DataFrame, key: str, stamp: str, now: Column) -> DataFrame:
    """Set the change stamp of the rows whose key was changed."""
    hit = changed.select(key).distinct().withColumn("_hit", F.lit(True))
    value = F.when(F.col("_hit").isNotNull(), now).otherwise(F.col(stamp))
    return table.join(hit, key, "left").withColumn(stamp, value).drop("_hit")


def read_since(table: DataFrame, stamp: str, watermark: Column) -> DataFrame:
    """Rows changed after the watermark; the filter reaches the scan."""
    return table.filter(F.col(stamp) > watermark)


def lookup_route(rows: DataFrame, reference: DataFrame, keys: list[str], out: str = "matched") -> DataFrame:
    """Rows with the looked-up columns, and whether there was a match, for routing the rest."""
    marked = reference.withColumn("_hit", F.lit(True))
    return rows.join(marked, keys, "left").withColumn(out, F.col("_hit").isNotNull()).drop("_hit")


def trimmed(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.trim(F.col(col)))


def for_each_value(rows: DataFrame, variables: DataFrame, listed: str, value: str, by: str) -> DataFrame:
    """Loop over a comma-separated list variable as one join: each listed value with its rows."""
    values = variables.select(*[c for c in variables.columns if c != listed], F.explode(F.split(listed, ",")).alias(value))
    values = values.withColumn(value, F.trim(value)).filter(F.col(value) != "")
    return values.join(rows, values[value] == rows[by])


def run_order(nodes: DataFrame, edges: DataFrame, scope: list[str], node: str, source: str, target: str) -> DataFrame:
    """Step at which every task can run: 0 without predecessors, else one after its last predecessor.

    Two kinds of rounds, each of a number that grows with the logarithm of the longest chain. A task with one predecessor
    points to it, and pointers are followed four at a time until they end at a task with none or several.
    Tasks with several wait for each other by longest distances, which are squared (longest of two halves) until
    nothing changes; these pairs are as many as such tasks reach each other, chains between them being folded.
    A task on a cycle, or behind one, never becomes ready and has a NULL step. Edges from tasks that are not among
    the nodes hold nothing up. Both sides of every join are dealt by key: none is collected in the driver.
    """
    key = F.struct(*scope, node).alias("v")
    all_ = nodes.select(key)
    pairs = edges.select(F.struct(*scope, F.col(source).alias(node)).alias("u"), F.struct(*scope, F.col(target).alias(node)).alias("v"))
    # A target that is no node is the source of no edge that is left, so it holds nothing up and is told from the nodes at the end.
    # Pairs are told apart where the join has dealt them.
    waits = cut(pairs.join(dealt(all_.withColumnRenamed("v", "u")), "u", "left_semi").distinct())
    many = Observation()
    before = waits.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("u"))
    before = cut(before.observe(many, F.count_if(F.col("n") > 1).alias("n")))
    chains = _chains(before.filter("n = 1").select("v", F.col("u").alias("r"), F.lit(1).cast("long").alias("d")))
    if not many.get["n"]:  # chains only
        return _placed(all_, chains.select("v", F.when(~F.col("stuck"), F.col("d")).alias("step")))
    # What each task with several predecessors waits for: the ends of chains, at their distance; `stuck` where a chain has no end.
    merges = before.filter("n > 1").select("v")
    own = chains.select(F.col("v").alias("u"), "r", "d", "stuck")
    held = waits.join(dealt(merges), "v").join(dealt(own), "u", "left").select(
        "v", F.coalesce("r", "u").alias("u"), (F.coalesce("d", F.lit(0)) + 1).alias("w"), F.coalesce("stuck", F.lit(False)).alias("stuck")
    )
    held = cut(held.join(dealt(merges.select(F.col("v").alias("u"), F.lit(True).alias("inner"))), "u", "left"))
    base = held.groupBy("v").agg(F.max(F.when(F.col("inner").isNull(), F.col("w"))).alias("b"), F.max("stuck").alias("stuck"))
    far = _longest(held.filter("inner").groupBy("u", "v").agg(F.max("w").alias("w")))
    cyclic = far.filter("u = v").select("v", F.lit(True).alias("loop")).distinct()
    base = cut(base.join(dealt(cyclic), "v", "left").select("v", "b", (F.col("stuck") | F.col("loop").isNotNull()).alias("stuck")))
    over = far.filter("u <> v").join(dealt(base.select(F.col("v").alias("u"), "b", "stuck")), "u").select("v", (F.col("b") + F.col("w")).alias("b"), "stuck")
    steps = base.unionByName(over).groupBy("v").agg(F.max("b").alias("b"), F.max("stuck").alias("stuck"))
    steps = steps.select("v", F.when(~F.col("stuck"), F.col("b")).alias("step"), F.lit(True).alias("known"))
    ends = chains.join(dealt(steps.withColumnRenamed("v", "r")), "r", "left")
    step = F.when(~F.col("stuck") & (F.col("known").isNull() | F.col("step").isNotNull()), F.coalesce("step", F.lit(0)) + F.col("d"))
    return _placed(all_, steps.select("v", "step").unionByName(ends.select("v", step.alias("step"))))


def _placed(nodes: DataFrame, steps: DataFrame) -> DataFrame:
    """Every node once, with its step; 0 without one. Both sides are met by one aggregate, which sorts neither."""
    none = F.lit(None).cast("long")
    sides = nodes.select("v", F.lit(True).alias("node"), F.lit(False).alias("placed"), none.alias("step")).unionByName(
        steps.select("v", F.lit(False).alias("node"), F.lit(True).alias("placed"), F.col("step").cast("long").alias("step"))
    )
    met = sides.groupBy("v").agg(F.max("node").alias("node"), F.max("placed").alias("placed"), F.max("step").alias("step")).filter("node")
    return met.select("v.*", F.when(F.col("placed"), F.col("step")).otherwise(0).cast("int").alias("step"))


def _chains(links: DataFrame) -> DataFrame:
    """(v, r, d, stuck) of pointers (v, r, d): where each ends, and how far; stuck if it runs into a cycle.

    Pointers that span more steps than there are pointers, and still move on, run in a cycle. The first round follows
    them once only, which is enough where no chain has more than one.
    """
    reached, times = 1, 1
    while True:
        for _ in range(times):
            onward = links.select(F.col("v").alias("r"), F.col("r").alias("r2"), F.col("d").alias("d2"))
            links = links.select("v", "r", "d").join(dealt(onward), "r", "left").select(
                "v", F.coalesce("r2", "r").alias("r"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d"), F.col("r2").isNotNull().alias("stuck")
            )
        seen = Observation()
        links = cut(links.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("stuck").alias("open")))
        reached, times = reached * 2**times, 2
        if not seen.get["open"] or reached > 2 * seen.get["n"]:
            return links


def _longest(pairs: DataFrame) -> DataFrame:
    """(u, v, w) for all u that v waits for: the longest distance, by squaring; what waits for itself is told, and not walked through again."""
    far, told = cut(pairs), None
    if far.isEmpty():
        return far
    while True:
        loops = far.filter("u = v").select(F.col("v").alias("x"))
        inner = far.join(dealt(loops), far["v"] == loops["x"], "left_anti")
        half = inner.select("u", F.col("v").alias("m"), F.col("w").alias("w1"))
        twice = half.join(dealt(inner.filter("u <> v").select(F.col("u").alias("m"), "v", F.col("w").alias("w2"))), "m").select("u", "v", (F.col("w1") + F.col("w2")).alias("w"))
        seen = Observation()
        far = far.unionByName(twice).groupBy("u", "v").agg(F.max("w").alias("w"))
        # Distances to a task that waits for itself mean nothing, so they are not counted as changes.
        far = far.withColumn("w", F.when(F.col("u") == F.col("v"), 1).otherwise(F.col("w")))
        far = cut(far.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("w").alias("s")))
        now = (seen.get["n"], seen.get["s"])
        if now == told:
            return far
        told = now
