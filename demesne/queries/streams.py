"""Change detection on the events as a stream of object versions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from demesne.queries.registry import query
from demesne.session import checkpoint_root
from demesne.streaming import versions as V


@query(
    "stream_state",
    """SELECT CAST(user_id AS VARCHAR) AS object_id, arg_max(event_type, struct_pack(a := ts, b := event_type)) AS fingerprint, max(ts) AS version_at, 'new' AS change, CAST(0 AS BIGINT) AS batch FROM events GROUP BY 1""",
)
def stream_state(t):
    events = t.spark.readStream.schema(t["events"].schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    versions = events.select(F.col("user_id").alias("object_id"), F.col("event_type").alias("fingerprint"), F.col("ts").alias("version_at"))
    root = f"{checkpoint_root(t.spark)}/stream_state_{uuid.uuid4().hex}"
    V.run_available(V.stream_changes(versions), f"{root}/out", f"{root}/checkpoint")
    return V.read_changes(t.spark, f"{root}/out").withColumn("version_at", F.col("version_at").cast("timestamp_ntz"))


_BATCHES = """WITH v AS (SELECT CAST(user_id AS VARCHAR) AS id, event_id % 4 AS b, max(ts) AS w, arg_max(event_type, struct_pack(a := ts, b := event_type)) AS mark FROM events GROUP BY 1, 2),
i AS (SELECT DISTINCT id FROM v),
s AS (SELECT i.id AS id, b0.w AS a0, b0.mark AS m0, b1.w AS a1, b1.mark AS m1, b2.w AS a2, b2.mark AS m2, b3.w AS a3, b3.mark AS m3 FROM i
  LEFT JOIN v b0 ON b0.id = i.id AND b0.b = 0 LEFT JOIN v b1 ON b1.id = i.id AND b1.b = 1 LEFT JOIN v b2 ON b2.id = i.id AND b2.b = 2 LEFT JOIN v b3 ON b3.id = i.id AND b3.b = 3),
t1 AS (SELECT *, CASE WHEN a1 IS NOT NULL AND (a0 IS NULL OR a0 <= a1) THEN a1 ELSE a0 END AS k1, CASE WHEN a1 IS NOT NULL AND (a0 IS NULL OR a0 <= a1) THEN m1 ELSE m0 END AS n1 FROM s),
t2 AS (SELECT *, CASE WHEN a2 IS NOT NULL AND (k1 IS NULL OR k1 <= a2) THEN a2 ELSE k1 END AS k2, CASE WHEN a2 IS NOT NULL AND (k1 IS NULL OR k1 <= a2) THEN m2 ELSE n1 END AS n2 FROM t1),
o AS (SELECT id, 0 AS b, a0 AS w, m0 AS mark, NULL AS k, NULL AS n FROM t2 UNION ALL SELECT id, 1, a1, m1, a0, m0 FROM t2 UNION ALL SELECT id, 2, a2, m2, k1, n1 FROM t2 UNION ALL SELECT id, 3, a3, m3, k2, n2 FROM t2)
SELECT id AS object_id, mark AS fingerprint, w AS version_at, CASE WHEN k IS NULL THEN 'new' WHEN k > w THEN 'late' WHEN n = mark THEN 'unchanged' ELSE 'changed' END AS change, CAST(b AS BIGINT) AS batch FROM o WHERE w IS NOT NULL"""


@query("stream_batches", _BATCHES)
def stream_batches(t):
    """The events as four files, a micro-batch each; the query is stopped after two and goes on from its checkpoint."""
    root = f"{checkpoint_root(t.spark)}/stream_batches_{uuid.uuid4().hex}"
    events = t["events"].select(F.col("user_id").cast("string").alias("object_id"), F.col("event_type").alias("fingerprint"), F.col("ts").cast("timestamp").alias("version_at"), (F.col("event_id") % 4).alias("b"))
    for b in range(4):
        events.filter(F.col("b") == b).drop("b").coalesce(1).write.mode("append").parquet(f"{root}/in")
        if b % 2:
            source = t.spark.readStream.schema(V.VERSION).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
            V.run_available(V.stream_changes(source), f"{root}/out", f"{root}/checkpoint")
    return V.read_changes(t.spark, f"{root}/out").withColumn("version_at", F.col("version_at").cast("timestamp_ntz"))
