"""Streaming: stream = batch, restart from the checkpoint, idempotent batch replay
(SURVEY §5 items 5–6)."""

import os

from pyspark.sql import functions as F

import sample_data as sd
from sample_data import sample
from vigilo import schemas
from vigilo.operators import alerts as al
from vigilo.operators import monitor
from vigilo.sources import files
from vigilo.sources import reference_tables as ref
from vigilo.sources.stream import encode_messages, file_stream
from vigilo.streaming import jobs


def _wire_parts(spark, parts=3):
    """The sample observations as wire records, split into ``parts`` slices."""
    from pyspark.sql.window import Window
    obs = files.scan_observations(spark, sample("observations.csv"))
    wire = encode_messages(obs).withColumn("_n", F.row_number().over(Window.orderBy("value")))
    return [wire.filter(F.col("_n") % parts == i).drop("_n") for i in range(parts)]


def _write_part(folder, i, part):
    part.coalesce(1).write.mode("overwrite").json(os.path.join(folder, "in", f"part-{i}"))


def _split_sample(spark, folder, parts=3):
    for i, part in enumerate(_wire_parts(spark, parts)):
        _write_part(folder, i, part)


def _wire_stream(spark, folder):
    return file_stream(spark, os.path.join(folder, "in", "*"), "key string, value string",
                       fmt="json", max_files_per_trigger=1)


def _batch_alerts(spark):
    obs = files.scan_observations(spark, sample("observations.csv"))
    msgs = obs.select(*[f.name for f in schemas.MESSAGE.fields])
    return al.to_history(al.alerts(msgs, ref.thresholds(spark)))


def test_stream_equals_batch(spark, workdir):
    _split_sample(spark, workdir)
    patients = files.scan_patients(spark, sample("patients.csv"))
    out = os.path.join(workdir, "out")
    q = jobs.alert_stream(_wire_stream(spark, workdir), out, os.path.join(workdir, "ck"),
                              ref.thresholds(spark), patients, trigger="availableNow")
    q.awaitTermination()
    streamed = jobs.read_output(spark, out, "alertes")
    assert streamed.count() == len(sd.alerts())
    assert streamed.exceptAll(_batch_alerts(spark)).count() == 0
    assert _batch_alerts(spark).exceptAll(streamed).count() == 0
    upd = jobs.read_output(spark, out, "patient_updates")
    assert upd.count() == sd.OBSERVATIONS
    assert {r["niveau_max"]: r["count"] for r in upd.groupBy("niveau_max").count().collect()} == \
        sd.levels()
    assert jobs.read_output(spark, out, "rejets").count() == 0


def test_restart_no_loss_no_duplicate(spark, workdir):
    parts = _wire_parts(spark)
    _write_part(workdir, 0, parts[0])       # only the first file exists for the first run
    patients = files.scan_patients(spark, sample("patients.csv"))
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    jobs.alert_stream(_wire_stream(spark, workdir), out, ck, ref.thresholds(spark), patients,
                          trigger="availableNow").awaitTermination()
    first = jobs.read_output(spark, out, "alertes").count()
    assert 0 < first < len(sd.alerts())
    for i in (1, 2):
        _write_part(workdir, i, parts[i])
    jobs.alert_stream(_wire_stream(spark, workdir), out, ck, ref.thresholds(spark), patients,
                          trigger="availableNow").awaitTermination()
    alerts = jobs.read_output(spark, out, "alertes")
    assert alerts.count() == len(sd.alerts())
    assert alerts.select("alerte_id").distinct().count() == len(sd.alerts())


def test_batch_replay_is_idempotent(spark, workdir):
    obs = files.scan_observations(spark, sample("observations.csv"))
    wire = encode_messages(obs)
    patients = files.scan_patients(spark, sample("patients.csv"))
    out = os.path.join(workdir, "out")
    for _ in range(2):   # the same batch id delivered twice
        jobs.process_batch(wire, 7, out, ref.thresholds(spark), patients)
    assert jobs.read_output(spark, out, "alertes").count() == len(sd.alerts())


def test_malformed_records_are_rejected(spark, workdir):
    raw = spark.createDataFrame([("k", "{not json"), ("k", '{"mesure_id":"M1","patient_id":"P002",'
                                 '"frequence_cardiaque_bpm":150}')], "key string, value string")
    out = os.path.join(workdir, "out")
    jobs.process_batch(raw, 0, out, ref.thresholds(spark), spark.createDataFrame([], schemas.PATIENTS))
    assert jobs.read_output(spark, out, "rejets").count() == 1
    a = jobs.read_output(spark, out, "alertes").collect()
    assert [(r["alerte_id"], r["niveau_alerte"], r["patient_id"]) for r in a] == \
        [("M1_frequence_cardiaque", "CRITIQUE", "PAT0002")]


def test_latest_state_stream_matches_batch(spark, workdir):
    _split_sample(spark, workdir)
    out = os.path.join(workdir, "out")
    jobs.latest_state_stream(_wire_stream(spark, workdir), out, os.path.join(workdir, "ck"),
                                 trigger="availableNow").awaitTermination()
    streamed = {r["mesure_id"] for r in jobs.read_latest_messages(spark, out).collect()}
    obs = files.scan_observations(spark, sample("observations.csv"))
    msgs = obs.select(*[f.name for f in schemas.MESSAGE.fields])
    batch = {r["mesure_id"] for r in monitor.latest_messages(msgs).collect()}
    assert streamed == batch and len(batch) == sd.monitored()


def test_observation_csv_as_stream_source(spark, workdir):
    """The observation CSV replayed as a file stream (S14) through encode → decode."""
    import shutil
    os.makedirs(os.path.join(workdir, "csv"))
    shutil.copy(sample("observations.csv"), os.path.join(workdir, "csv", "obs.csv"))
    obs = file_stream(spark, os.path.join(workdir, "csv"), schemas.OBSERVATIONS, fmt="csv",
                      max_files_per_trigger=1, header=True, sep=",")
    out = os.path.join(workdir, "out")
    patients = files.scan_patients(spark, sample("patients.csv"))
    jobs.alert_stream(encode_messages(obs), out, os.path.join(workdir, "ck"), ref.THRESHOLD_ROWS,
                          patients, trigger="availableNow").awaitTermination()
    assert jobs.read_output(spark, out, "alertes").count() == len(sd.alerts())
    assert jobs.read_output(spark, out, "comptages").agg(F.sum("nb_mesures")).first()[0] == sd.OBSERVATIONS


def test_counters_stream(spark, workdir):
    _split_sample(spark, workdir)
    out = os.path.join(workdir, "out")
    jobs.counters_stream(_wire_stream(spark, workdir), out, os.path.join(workdir, "ck"),
                             ref.THRESHOLD_ROWS, trigger="availableNow").awaitTermination()
    c = jobs.read_counters(spark, out).first()
    assert (c["alertes_total"], c["patients_surveilles"]) == (len(sd.alerts()), sd.monitored())
    assert c["alertes_critiques"] + c["alertes_warning"] == len(sd.alerts())


def _alert_run(spark, workdir, out, checkpoint, dedup=True, stream=None):
    patients = files.scan_patients(spark, sample("patients.csv"))
    jobs.alert_stream(stream or _wire_stream(spark, workdir), out, os.path.join(workdir, checkpoint), ref.THRESHOLD_ROWS,
                      patients, trigger="availableNow", dedup=dedup).awaitTermination()
    return jobs.read_output(spark, out, "alertes")


def test_replayed_measurements_are_left_out(spark, workdir):
    parts = _wire_parts(spark, parts=1)
    _write_part(workdir, 0, parts[0])
    _write_part(workdir, 1, parts[0])          # the same measurements delivered again
    alerts = _alert_run(spark, workdir, os.path.join(workdir, "out"), "ck")
    assert alerts.count() == len(sd.alerts()) and alerts.select("alerte_id").distinct().count() == len(sd.alerts())
    twice = _alert_run(spark, workdir, os.path.join(workdir, "out2"), "ck2", dedup=False)
    assert twice.count() == 2 * len(sd.alerts())   # at-least-once without dedup


def test_late_files_and_checkpoint_reset_lose_nothing(spark, workdir):
    """Newest measurements first, one file a batch, then all again under a new checkpoint."""
    from pyspark.sql.window import Window
    wire = encode_messages(files.scan_observations(spark, sample("observations.csv")))
    wire = wire.withColumn("_n", F.ntile(4).over(Window.orderBy(F.col("value").desc())))
    for i in range(1, 5):
        _write_part(workdir, i, wire.filter(F.col("_n") == i).drop("_n"))
    out = os.path.join(workdir, "out")
    batch = _batch_alerts(spark)
    for checkpoint in ("ck", "ck-new"):
        alerts = _alert_run(spark, workdir, out, checkpoint)
        assert alerts.exceptAll(batch).count() == 0 and batch.exceptAll(alerts).count() == 0
    counts = jobs.read_output(spark, out, "comptages")
    assert counts.count() == 8 and counts.agg(F.sum("nb_mesures")).first()[0] == sd.OBSERVATIONS


def test_checkpoint_reset_keeps_the_runs_before(spark, workdir):
    parts = _wire_parts(spark, parts=2)
    out = os.path.join(workdir, "out")
    for i in (0, 1):     # two runs over different messages, both with batch 0
        folder = os.path.join(workdir, str(i))
        _write_part(folder, 0, parts[i])
        _alert_run(spark, workdir, out, f"ck{i}", dedup=False, stream=_wire_stream(spark, folder))
        jobs.counters_stream(_wire_stream(spark, folder), out, os.path.join(workdir, f"c{i}"), ref.THRESHOLD_ROWS,
                             trigger="availableNow").awaitTermination()
    assert jobs.read_output(spark, out, "alertes").count() == len(sd.alerts())
    runs = sorted(os.listdir(os.path.join(out, "compteurs")))
    assert len(runs) == 2
    new = spark.read.parquet(os.path.join(out, "compteurs", runs[1])).agg(F.sum("alertes_total")).first()[0]
    ours = spark.read.parquet(os.path.join(out, "compteurs", runs[1])).select("patient_id").collect()
    old = (spark.read.parquet(os.path.join(out, "compteurs", runs[0]))
           .filter(~F.col("patient_id").isin([r[0] for r in ours])).agg(F.coalesce(F.sum("alertes_total"), F.lit(0))).first()[0])
    assert jobs.read_counters(spark, out).first()["alertes_total"] == new + old   # the newer run counts


def test_messages_without_id_are_never_merged(spark, workdir):
    raw = [(f"P{i}", f'{{"patient_id":"P{i:03d}","timestamp":"{sd.DAY}T10:00:00","frequence_cardiaque_bpm":150}}')
           for i in range(1, 6)] + [("x", "{broken"), ("y", "[]")]
    wire = spark.createDataFrame(raw, "key string, value string")
    for dedup in (False, True):
        out = os.path.join(workdir, f"out{dedup}")
        jobs.process_batch(wire, 0, out, ref.THRESHOLD_ROWS, spark.createDataFrame([], schemas.PATIENTS), dedup=dedup)
        assert jobs.read_output(spark, out, "patient_updates").count() == 5
        assert jobs.read_output(spark, out, "rejets").count() == 2


def test_state_tables_are_compacted(spark, workdir):
    parts = _wire_parts(spark, parts=5)
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    for i in range(5):
        _write_part(workdir, i, parts[i])
    jobs.counters_stream(_wire_stream(spark, workdir), out, ck + "c", ref.THRESHOLD_ROWS,
                         trigger="availableNow").awaitTermination()
    jobs.latest_state_stream(_wire_stream(spark, workdir), out, ck + "l", trigger="availableNow").awaitTermination()
    counters = jobs.read_counters(spark, out).first()
    latest = sorted(jobs.read_latest_messages(spark, out).collect())
    for table in ("compteurs", "latest"):
        jobs.compact_state(spark, out, table)
        run = os.listdir(os.path.join(out, table))
        assert len(run) == 1 and len([x for x in os.listdir(os.path.join(out, table, run[0])) if x.startswith("batch")]) == 2
    assert jobs.read_counters(spark, out).first() == counters
    assert sorted(jobs.read_latest_messages(spark, out).collect()) == latest


def test_own_profile_is_released(spark, workdir):
    import time
    _split_sample(spark, workdir)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    _alert_run(spark, workdir, os.path.join(workdir, "out"), "ck")
    for _ in range(50):
        if len(spark.sparkContext._jsc.getPersistentRDDs()) <= before:
            break
        time.sleep(0.1)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_shared_dir_refuses_a_private_folder_on_a_cluster(monkeypatch):
    import pytest

    from vigilo import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_fresh_folders_can_be_removed(spark):
    from vigilo import session
    path = session.fresh_path(spark, "test")
    spark.range(3).write.parquet(path)
    session.remove_fresh(spark)
    assert not os.path.exists(path.removeprefix("file:")) and not session._fresh


def test_shared_dir_is_stable_root(spark):
    from vigilo.session import shared_dir
    root = spark.conf.get("spark.checkpoint.dir", None)
    d = shared_dir(spark)
    assert d == shared_dir(spark)
    if root:
        assert d == root.rstrip("/")


def test_history_is_partitioned_by_day(spark, workdir):
    obs = files.scan_observations(spark, sample("observations.csv"))
    out = os.path.join(workdir, "out")
    jobs.process_batch(encode_messages(obs), 3, out, ref.THRESHOLD_ROWS,
                       files.scan_patients(spark, sample("patients.csv")))
    assert os.path.isdir(os.path.join(out, "alertes", "run_id=0", "batch_id=3", f"date_alerte={sd.DAY}"))
    hist = jobs.read_output(spark, out, "alertes")
    assert dict(hist.dtypes)["date_alerte"] == "string"
    day = hist.filter(F.col("date_alerte") == sd.DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_alerte" in plan
    assert day.count() == len(sd.alerts())


def test_processing_time_trigger(spark, workdir):
    """The default 5-second processing-time trigger (T1), driven to completion."""
    _split_sample(spark, workdir)
    out = os.path.join(workdir, "out")
    q = jobs.alert_stream(_wire_stream(spark, workdir), out, os.path.join(workdir, "ck"),
                          ref.THRESHOLD_ROWS, files.scan_patients(spark, sample("patients.csv")))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert jobs.read_output(spark, out, "alertes").count() == len(sd.alerts())
    assert jobs.read_output(spark, out, "comptages").count() == 3          # one batch per file


def test_stateful_counters_restart_from_checkpoint(spark, workdir):
    parts = _wire_parts(spark)
    _write_part(workdir, 0, parts[0])
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    jobs.counters_stream(_wire_stream(spark, workdir), out, ck, ref.THRESHOLD_ROWS,
                         trigger="availableNow").awaitTermination()
    first = jobs.read_counters(spark, out).first()["alertes_total"]
    assert 0 < first < len(sd.alerts())
    for i in (1, 2):
        _write_part(workdir, i, parts[i])
    jobs.counters_stream(_wire_stream(spark, workdir), out, ck, ref.THRESHOLD_ROWS,
                         trigger="availableNow").awaitTermination()
    c = jobs.read_counters(spark, out).first()
    assert (c["alertes_total"], c["patients_surveilles"]) == (len(sd.alerts()), sd.monitored())   # state restored, not recounted


def test_ids_of_a_failed_batch_are_not_taken_for_replays(spark, workdir, monkeypatch):
    """The alert write fails and the stream restarts with a reset checkpoint (a new run)."""
    import pytest
    wire = _wire_parts(spark, parts=1)[0]
    patients = files.scan_patients(spark, sample("patients.csv"))
    out, write = os.path.join(workdir, "out"), jobs._write_partition

    def failing(df, out, table, *place):
        if table == "alertes":
            raise OSError("no alerts today")
        write(df, out, table, *place)
    monkeypatch.setattr(jobs, "_write_partition", failing)
    with pytest.raises(OSError):
        jobs.process_batch(wire, 0, out, ref.THRESHOLD_ROWS, patients, run_id="1", dedup=True)
    monkeypatch.setattr(jobs, "_write_partition", write)
    jobs.process_batch(wire, 0, out, ref.THRESHOLD_ROWS, patients, run_id="2", dedup=True)
    assert jobs.read_output(spark, out, "alertes").count() == len(sd.alerts())
