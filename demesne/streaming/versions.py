"""Change detection on a stream of object versions, with the last fingerprint as keyed state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from demesne.plans.changes import CHANGED, NEW, UNCHANGED

# workers may not have this package on their path, so its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LATE = "late"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERSION = "object_id string, fingerprint string, version_at timestamp"
STATE = "fingerprint string, at bigint"
OUTPUT = VERSION + ", change string"
# inside the operator a time is a count of microseconds: the rows of a task know no session time zone
TIMED = "object_id string, fingerprint string, at bigint, change string"


def _newest(rows: pd.DataFrame) -> pd.DataFrame:
    """The newest version of each object; a missing mark is older than any other of its time, a missing time no version."""
    timed = rows[rows["version_at"].notna()]
    return timed.sort_values(["version_at", "fingerprint"], na_position="first").drop_duplicates("object_id", keep="last")


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield _newest(rows)


class VersionProcessor(StatefulProcessor):
    """Newest version of each key in a micro-batch against the last one seen.

    Rows are taken one by one, as plain rows and without a frame for each key, and only the newest is held, so a
    key with many versions needs no more memory than one with few. A version older than
    the state is reported as late and leaves the state alone.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max(((r["at"], r["fingerprint"] is not None, r["fingerprint"] or "") for r in rows if r["at"] is not None), default=None)
        if newest is None:
            return
        at, marked, mark = newest
        mark = mark if marked else None
        last = self._last.get()
        if last is None:
            change = NEW
        elif last[1] > at:
            change = LATE
        else:
            change = UNCHANGED if last[0] == mark else CHANGED
        if change != LATE:
            self._last.update((mark, at))
        yield Row(object_id=key[0], fingerprint=mark, at=at, change=change)

    def close(self) -> None:
        pass


def stream_changes(versions: DataFrame, lateness: str | None = None) -> DataFrame:
    """Streaming (object_id, fingerprint, version_at) to one change row per object and micro-batch.

    Every input batch is first reduced to the newest version per object, so a
    hot object sends a row per batch through the shuffle, not all its versions.
    With `lateness` the event-time watermark drops versions older than that;
    without it every late version is reported.
    """
    versions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    typed = versions.select(
        F.col("object_id").cast("string"), F.col("fingerprint").cast("string"), F.col("version_at").cast("timestamp")
    )
    reduced = typed.mapInPandas(_combine, VERSION)
    if lateness is not None:
        reduced = reduced.withWatermark("version_at", lateness)
    timed = reduced.withColumn("at", F.unix_micros("version_at"))
    found = timed.groupBy("object_id").transformWithState(
        VersionProcessor(), TIMED, "Update", "None" if lateness is None else "EventTime"
    )
    return found.select("object_id", "fingerprint", F.timestamp_micros("at").alias("version_at"), "change")


def run_available(changes: DataFrame, target: str, checkpoint: str) -> None:
    """Process what is there, into one folder per micro-batch; a repeated batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        changes.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_changes(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(OUTPUT + ", batch bigint").parquet(target)
