"""A run that outlives what fails in it: relations written apart, a log of every kind, a ledger in phases."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demesne.operators.keyed import latest_per_key
from demesne.plans.compare import reason_of
from demesne.schemas import ENTITIES, SIDE_RELATIONS, schema_of
from demesne.sinks import writers

# --- fixed values: phases of a run ---
STARTED, FINISHED, FAILED = "started", "finished", "failed"
PHASES = "run_id string, phase string, at timestamp, started_at timestamp, objects_scanned bigint, objects_skipped_unchanged bigint, objects_failed bigint, error string"


class Run:
    """One run into `root`: what it wrote, what failed, and how far it came."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root, run_id
        self.started = datetime.now(timezone.utc)
        self.paths: dict[str, str] = {}
        self.entries: list[tuple] = []
        self.reached = {"objects_scanned": 0, "objects_skipped_unchanged": 0, "objects_failed": 0}

    def write(self, name: str, relation: DataFrame | Callable[[], DataFrame], schema: str | None = None) -> DataFrame:
        """Write one relation by a job of its own, and read it back.

        Where it cannot be built, or its job fails, the relation is empty, the log has a failed row and the run goes on;
        without any known schema there is nothing to go on with, and the error is raised. The log row has the wall time.
        """
        begun, path, error, columns = time.monotonic(), f"{self.root}/{name}", None, None
        counted = Observation(f"rows_{uuid.uuid4().hex}")
        try:
            df = relation() if callable(relation) else relation
            columns = df.schema
            df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
            rows = counted.get["n"]
        except Exception as exc:
            known = columns or schema or ENTITIES.get(name) or SIDE_RELATIONS.get(name)
            if known is None:
                raise
            error, rows = reason_of(exc), 0
            self.reached["objects_failed"] += 1
            writers.empty_out(self.spark, path, name, schema=known)
        self.paths[name] = path
        self.log("relation", name, error, begun, rows)
        return self.spark.read.parquet(path)

    def log(self, object_type: str, name: str, error: str | None, begun: float, rows: int | None = None) -> None:
        status = "failed" if error else "success"
        self.entries.append((object_type, name, status, None if error else "direct_metadata", error, (time.monotonic() - begun) * 1000.0))

    def log_rows(self) -> DataFrame:
        """The log of the relations written so far: a row each."""
        return self.spark.createDataFrame(self.entries, schema_of("run_log"))

    def phase(self, phase: str, error: str | None = None) -> None:
        """Add a row to the phases of this root; a run that dies has at least its first one."""
        row = (self.run_id, phase, datetime.now(timezone.utc), self.started, *self.reached.values(), error)
        self.spark.createDataFrame([row], PHASES).coalesce(1).write.mode("append").parquet(f"{self.root}/run_phases")

    def guarded(self, work: Callable[[Run], None]) -> dict[str, str]:
        """Do the work between the phases `started` and `finished`; a failure leaves `failed`, with the counts reached, and is raised."""
        self.phase(STARTED)
        error = None
        try:
            work(self)
        except BaseException as exc:
            error = reason_of(exc)
            raise
        finally:
            self.phase(FAILED if error else FINISHED, error)
            ledger = run_ledger(self.spark.read.parquet(f"{self.root}/run_phases"))
            self.paths.update(writers.write_entities({"runs": ledger}, self.root))
            self.paths["run_phases"] = f"{self.root}/run_phases"
        return self.paths


def latest_phases(phases: DataFrame) -> DataFrame:
    """The last phase of each run."""
    order = F.when(F.col("phase") == STARTED, 0).otherwise(1)
    return latest_per_key(phases.withColumn("_order", order), ["run_id"], ["at", "_order"]).drop("_order")


def run_ledger(phases: DataFrame) -> DataFrame:
    """Ledger rows of the runs that came to an end, whichever."""
    ended = latest_phases(phases).filter(F.col("phase") != STARTED)
    return ended.select("run_id", "started_at", F.col("at").alias("finished_at"), "objects_scanned", "objects_skipped_unchanged", "objects_failed")
