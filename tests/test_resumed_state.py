"""The latest state on the arbitrary stateful operator: resets, hot patients, bounded state."""

import os

from pyspark.sql import functions as F

import sample_data as sd
from sample_data import sample
from test_streaming import _wire_parts, _wire_stream, _write_part
from vigilo import schemas
from vigilo.operators import monitor
from vigilo.sources import files
from vigilo.streaming import jobs


def _run(spark, folder, out, checkpoint):
    q = jobs.resumable_state_stream(_wire_stream(spark, folder), out, os.path.join(folder, checkpoint), trigger="availableNow")
    q.awaitTermination()
    return q


def test_reset_goes_on_from_the_stored_state(spark, workdir):
    parts = _wire_parts(spark, 2)
    out, first, second, third = (os.path.join(workdir, x) for x in ("out", "1", "2", "3"))
    _write_part(first, 0, parts[0])
    _run(spark, first, out, "ck")
    _write_part(second, 0, parts[1])
    _run(spark, second, out, "ck-new")         # a new checkpoint: the state is read from out
    messages = files.scan_observations(spark, sample("observations.csv")).select(*schemas.MESSAGE.fieldNames())
    want = sorted(map(tuple, monitor.latest_messages(messages).select(*schemas.MESSAGE.fieldNames()).collect()))
    got = jobs.read_latest_messages(spark, out).select(*schemas.MESSAGE.fieldNames())
    assert sorted(map(tuple, got.collect())) == want and len(want) == sd.monitored()
    before = spark.read.parquet(os.path.join(out, "latest")).count()
    for i in (0, 1):
        _write_part(third, i, parts[i])
    q = _run(spark, third, out, "ck-again")     # everything delivered again after another reset
    assert spark.read.parquet(os.path.join(out, "latest")).count() == before       # nothing changes, nothing is written
    state = q.recentProgress[-1]["stateOperators"][0] if isinstance(q.recentProgress[-1], dict) else q.recentProgress[-1].stateOperators[0]
    total = state["numRowsTotal"] if isinstance(state, dict) else state.numRowsTotal
    assert total == sd.monitored()


def test_batches_send_one_row_a_patient(spark):
    import pyarrow as pa
    row = [("p1", "2025-01-01T10:00", "b"), ("p1", None, "z"), ("p1", "2025-01-01T10:00", "c"), ("p2", "2025-01-01T09:00", None)]
    names = ["patient_key", "timestamp", "mesure_id"]
    out = list(jobs.latest_of_batches()([pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*row)))))]))
    assert [tuple(b.values()) for b in pa.Table.from_batches(out).to_pylist()] == [("p1", "2025-01-01T10:00", "c"), ("p2", "2025-01-01T09:00", None)]
    assert list(jobs.latest_of_batches()([])) == []


def test_restart_from_the_same_checkpoint(spark, workdir):
    parts, out = _wire_parts(spark, 3), os.path.join(workdir, "out")
    for i in range(3):
        _write_part(workdir, i, parts[i])
        _run(spark, workdir, out, "ck")
    assert jobs.read_latest_messages(spark, out).count() == sd.monitored()
    jobs.compact_state(spark, out, "latest")
    assert jobs.read_latest_messages(spark, out).agg(F.countDistinct("patient_id")).first()[0] == sd.monitored()


def test_session_with_the_default_state_store(spark, workdir):
    parts, out = _wire_parts(spark, 2), os.path.join(workdir, "out")
    plain, key = spark.newSession(), "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain.conf.set(key, default)        # as in a session made without this package's settings
    for i in range(2):
        folder = os.path.join(workdir, str(i))
        _write_part(folder, 0, parts[i])
        _run(plain, folder, out, "ck")
        assert plain.conf.get(key) == default
    messages = files.scan_observations(spark, sample("observations.csv")).select(*schemas.MESSAGE.fieldNames())
    want = sorted(map(tuple, monitor.latest_messages(messages).select(*schemas.MESSAGE.fieldNames()).collect()))
    got = jobs.read_latest_messages(plain, out).select(*schemas.MESSAGE.fieldNames())
    assert sorted(map(tuple, got.collect())) == want and len(want) == sd.monitored()


def test_messages_without_a_patient_are_one_patients(spark, workdir):
    names, out = schemas.MESSAGE.fieldNames(), os.path.join(workdir, "out")
    rows = [("m1", None, "2025-01-02T08:00"), ("m2", None, "2025-01-02T09:00"), ("m3", "7", "2025-01-02T07:00"),
            ("m4", None, "2025-01-02T08:30"), ("m5", None, "2025-01-03T08:00")]
    for i, part in enumerate((rows[:4], rows[4:])):      # with a new checkpoint each
        message = F.to_json(F.struct(*[F.col(c) if c in ("mesure_id", "patient_id", "timestamp") else F.lit(None).cast(schemas.MESSAGE[c].dataType).alias(c)
                                       for c in names]))
        folder = os.path.join(workdir, str(i))
        _write_part(folder, 0, spark.createDataFrame(part, "mesure_id string, patient_id string, timestamp string")
                    .select(F.col("patient_id").alias("key"), message.alias("value")))
        _run(spark, folder, out, "ck")
        got = sorted((r["mesure_id"], r["patient_id"]) for r in jobs.read_latest_messages(spark, out).collect())
        assert [r[0] for r in got] == [["m2", "m3"], ["m3", "m5"]][i]
        _write_part(os.path.join(workdir, "again"), i, spark.read.json(os.path.join(folder, "in", "*")))
    before = spark.read.parquet(os.path.join(out, "latest")).count()
    _run(spark, os.path.join(workdir, "again"), out, "ck")      # the state without a patient was stored too
    assert spark.read.parquet(os.path.join(out, "latest")).count() == before == 3


def test_batches_keep_messages_without_a_patient():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"patient_key": ["p1", None, None, "p1"], "timestamp": ["3", "1", "2", "4"], "mesure_id": list("abcd")})
    out = pa.Table.from_batches(list(jobs.latest_of_batches()([batch]))).to_pylist()
    assert sorted(r["mesure_id"] for r in out) == ["c", "d"]
