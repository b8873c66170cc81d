"""Working only on what changed, the run ledger, and the review queue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.operators.keyed import latest_per_key, mark_within_budget
from demesne.schemas import UNRESOLVED

# --- fixed values ---
NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def detect_changes(current: DataFrame, previous: DataFrame, key: str = "object_id", mark: str = "fingerprint") -> DataFrame:
    """Current rows with `change`: new, changed or unchanged against the last recorded fingerprint."""
    last = previous.select(key, F.col(mark).alias("_last"), F.lit(True).alias("_seen"))
    joined = current.join(last, key, "left")
    change = (
        F.when(F.col("_seen").isNull(), NEW)
        .when(~F.col(mark).eqNullSafe(F.col("_last")), CHANGED)
        .otherwise(UNCHANGED)
    )
    return joined.withColumn("change", change).drop("_last", "_seen")


def upsert_fingerprints(state: DataFrame, current: DataFrame, run_id: str, seen_at: Column) -> DataFrame:
    """Next state: every object once, with the latest fingerprint. Written to a new path, never in place."""
    cols = ["object_id", "object_type", "fingerprint", "last_run_id", "last_seen_at"]
    fresh = current.select(
        "object_id", "object_type", "fingerprint", F.lit(run_id).alias("last_run_id"), seen_at.alias("last_seen_at")
    )
    return latest_per_key(state.select(*cols).unionByName(fresh), ["object_id"], ["last_seen_at", "last_run_id"])


def carry_forward(fresh: DataFrame, previous: DataFrame, changes: DataFrame, key: str = "object_id") -> DataFrame:
    """Results of this run: what was processed now, and the earlier result of everything unchanged."""
    same = changes.filter(F.col("change") == UNCHANGED).select(key)
    return fresh.unionByName(previous.join(same, key, "left_semi"))


def to_process(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("change") != UNCHANGED)


def run_counters(actions: DataFrame) -> DataFrame:
    """Scanned, skipped and failed per run; a row may stand for several objects (`weight`)."""
    total = lambda a: F.coalesce(F.sum(F.when(F.col("action") == a, F.col("weight"))), F.lit(0)).cast("bigint")
    return actions.groupBy("run_id").agg(
        total("scanned").alias("objects_scanned"),
        total("skipped_unchanged").alias("objects_skipped_unchanged"),
        total("failed").alias("objects_failed"),
    )


def change_actions(changes: DataFrame, run_id: Column, weight: Column) -> DataFrame:
    """Ledger actions of a change report. Skipping costs one, whatever the object holds."""
    skipped = F.col("change") == UNCHANGED
    return changes.select(
        run_id.alias("run_id"),
        F.when(skipped, "skipped_unchanged").otherwise("scanned").alias("action"),
        F.when(skipped, F.lit(1)).otherwise(weight).cast("bigint").alias("weight"),
    )


def ledger_row(counters: DataFrame, started_at: Column, finished_at: Column) -> DataFrame:
    """Run ledger rows; the end is the end, not the start again."""
    return counters.select(
        "run_id",
        started_at.alias("started_at"),
        finished_at.alias("finished_at"),
        "objects_scanned",
        "objects_skipped_unchanged",
        "objects_failed",
    )


def log_rows(df: DataFrame, object_type: str, name: Column, parse_status: Column, error: Column) -> DataFrame:
    """Run-log rows out of data that carries its own errors."""
    failed = error.isNotNull()
    return df.select(
        F.lit(object_type).alias("object_type"),
        name.alias("object_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(~failed, parse_status).alias("parse_status"),
        error.alias("error"),
        F.lit(None).cast("double").alias("duration_ms"),
    )


def review_items(procs: DataFrame, statements: DataFrame, scripts: DataFrame) -> DataFrame:
    """Everything no text mining could resolve, in one order: procedures, then package by package
    its statements and then its scripts.

    procs: object_id, parse_status; statements: object_id, package, path, statement_no, parse_status;
    scripts: object_id, package, path.
    """
    none = F.array().cast("array<int>")
    blank = F.lit("")
    open_ = F.col("parse_status") == UNRESOLVED
    parts = [
        procs.filter(open_).select("object_id", F.lit(0).alias("phase"), blank.alias("package"), F.lit(0).alias("part"), none.alias("path")),
        statements.filter(open_).select(
            "object_id", F.lit(1).alias("phase"), "package", F.lit(0).alias("part"),
            F.concat("path", F.array(F.col("statement_no").cast("int"))).alias("path"),
        ),
        scripts.select("object_id", F.lit(1).alias("phase"), "package", F.lit(1).alias("part"), "path"),
    ]
    return reduce(DataFrame.unionByName, parts)


def review_queue(items: DataFrame, order: list[str], cap: int) -> DataFrame:
    """The first cap items get a place and may be attempted; all of them stay for a human."""
    marked = mark_within_budget(items, ["object_id"], order, cap)
    note = F.when(F.col("within_budget"), "queued").otherwise(f"run cap of {cap} objects reached")
    return marked.withColumn("note", note).withColumn("needs_human_review", F.lit(True))
