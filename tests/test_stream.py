from datetime import datetime, timedelta

from pyspark.sql import Row

from demesne.streaming import versions as V

T0 = datetime(2024, 1, 1)


def test_stream_agrees_with_state_over_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [("a", "1", 0), ("b", "1", 0)] + [("hot", str(i), i) for i in range(500)],
        [("a", "1", 10), ("b", "2", 10), ("c", "1", 10), ("hot", "499", 600)],
        [("a", "9", 5), ("b", "2", 20), ("b", "3", 30)],
        [("a", None, 50), ("a", "7", 50), ("c", None, 60), ("d", None, None), ("d", "1", None)],
    ]
    ddl = "object_id string, fingerprint string, version_at timestamp"
    for rows in batches:
        spark.createDataFrame([(k, m, None if i is None else T0 + timedelta(minutes=i)) for k, m, i in rows], ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).parquet(source)
        V.run_available(V.stream_changes(stream), out, str(tmp_path / "ckpt"))
    got = {(r["batch"], r["object_id"]): (r["change"], r["fingerprint"]) for r in V.read_changes(spark, out).collect()}
    assert got == {
        (0, "a"): ("new", "1"), (0, "b"): ("new", "1"), (0, "hot"): ("new", "499"),
        (1, "a"): ("unchanged", "1"), (1, "b"): ("changed", "2"), (1, "c"): ("new", "1"), (1, "hot"): ("unchanged", "499"),
        (2, "a"): ("late", "9"), (2, "b"): ("changed", "3"),
        (3, "a"): ("changed", "7"), (3, "c"): ("changed", None),
    }


def test_a_key_is_handled_as_plain_rows():
    """No frame is built for a key: versions come as rows, and only the newest of them meets the state."""

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    state = Held()
    processor = V.VersionProcessor()
    processor.init(type("Handle", (), {"getValueState": lambda self, name, schema: state})())
    give = lambda *rows: [(r["fingerprint"], r["at"], r["change"]) for r in processor.handleInputRows(("a",), (Row(object_id="a", fingerprint=m, at=at) for m, at in rows), None)]
    assert give(("x", None)) == [] and state.value is None
    assert give(("x", 1), (None, 2), ("y", 2)) == [("y", 2, "new")]
    assert give(("z", 1)) == [("z", 1, "late")] and state.value == ("y", 2)
    assert give((None, 3), ("w", None)) == [(None, 3, "changed")] and give((None, 4)) == [(None, 4, "unchanged")]


def test_versions_behind_the_watermark_are_dropped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "object_id string, fingerprint string, version_at timestamp"
    for rows in ([("a", "1", 0), ("b", "1", 600)], [("a", "2", 1), ("b", "2", 590)]):
        spark.createDataFrame([(k, m, T0 + timedelta(minutes=i)) for k, m, i in rows], ddl).coalesce(1).write.mode("append").parquet(source)
        V.run_available(V.stream_changes(spark.readStream.schema(ddl).parquet(source), "1 hour"), out, str(tmp_path / "ckpt"))
    got = {(r["object_id"], r["fingerprint"]): (r["change"], r["version_at"]) for r in V.read_changes(spark, out).collect()}
    assert got == {("a", "1"): ("new", T0), ("b", "1"): ("new", T0 + timedelta(minutes=600)), ("b", "2"): ("late", T0 + timedelta(minutes=590))}
