"""The live view, counts per batch and published messages over several micro-batches."""

import os
import threading

import pytest

import sample_data as sd
from sample_data import sample
from test_streaming import _wire_parts, _wire_stream, _write_part
from vigilo import schemas
from vigilo.operators import alerts as al
from vigilo.operators import monitor
from vigilo.sources import files
from vigilo.sources import reference_tables as ref
from vigilo.sources.stream import decode_messages, file_stream
from vigilo.streaming import jobs, live, metrics


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _messages(spark):
    return files.scan_observations(spark, sample("observations.csv")).select(*schemas.MESSAGE.fieldNames())


def _patients(spark):
    return files.scan_patients(spark, sample("patients.csv"))


def _batch_replay(messages, patients):
    events = al.alerts(messages.filter(al.is_valid(messages)), ref.THRESHOLD_ROWS)
    return monitor.recent_alerts_replay(events, monitor.latest_patient_state(messages, ref.THRESHOLD_ROWS, patients))


def test_live_view_equals_batch(spark, workdir, monkeypatch):
    """One file a batch, folders merged often, old entries removed."""
    monkeypatch.setattr(live, "FANOUT", 2)
    monkeypatch.setattr(live, "KEEP", 1)
    for i, part in enumerate(_wire_parts(spark, 6)):
        _write_part(workdir, i, part)
    out = os.path.join(workdir, "live")
    live.live_stream(_wire_stream(spark, workdir), out, os.path.join(workdir, "ck"), ref.THRESHOLD_ROWS,
                     trigger="availableNow").awaitTermination()
    view = live.Snapshot(spark, out, ref.THRESHOLD_ROWS)
    messages, patients = _messages(spark), _patients(spark)
    events = al.alerts(messages, ref.THRESHOLD_ROWS)
    assert view.lot == 6 and rows(view.alerts()) == rows(monitor.recent_alerts(events))
    assert rows(view.alerts(monitor.LOG_LINES)) == rows(monitor.recent_alerts(events, monitor.LOG_LINES))
    assert rows(view.replay(patients)) == rows(_batch_replay(messages, patients))
    assert len(view.entry["etats"]) <= 3 and len(live._log(spark, out).numbers()) == 2
    assert len(os.listdir(os.path.join(out, "alertes"))) == 2


def test_a_batch_is_committed_once(spark, workdir):
    out, parts = os.path.join(workdir, "live"), [decode_messages(p) for p in _wire_parts(spark, 3)]
    assert live.commit_batch(parts[0], "r", 0, out, ref.THRESHOLD_ROWS) == 1
    first = rows(live.Snapshot(spark, out, ref.THRESHOLD_ROWS).alerts())
    assert live.commit_batch(parts[0], "r", 0, out, ref.THRESHOLD_ROWS) == 1          # handled again after the commit
    assert rows(live.Snapshot(spark, out, ref.THRESHOLD_ROWS).alerts()) == first and first


def test_a_batch_that_fails_isn_t_seen(spark, workdir, monkeypatch):
    out, parts = os.path.join(workdir, "live"), [decode_messages(p) for p in _wire_parts(spark, 3)]
    patients = _patients(spark)
    live.commit_batch(parts[0], "r", 0, out, ref.THRESHOLD_ROWS)
    before = rows(live.Snapshot(spark, out, ref.THRESHOLD_ROWS).replay(patients))
    with monkeypatch.context() as m:
        m.setattr(live.Log, "append", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            live.commit_batch(parts[1], "r", 1, out, ref.THRESHOLD_ROWS)
    assert rows(live.Snapshot(spark, out, ref.THRESHOLD_ROWS).replay(patients)) == before
    for k in (1, 2):
        live.commit_batch(parts[k], "r", k, out, ref.THRESHOLD_ROWS)
    assert rows(live.Snapshot(spark, out, ref.THRESHOLD_ROWS).replay(patients)) == rows(_batch_replay(_messages(spark), patients))


def test_a_reader_never_mixes_batches(spark, workdir):
    """Snapshots read while batches go on: each is what the batches up to its entry give."""
    out, patients = os.path.join(workdir, "live"), _patients(spark)
    parts = [decode_messages(p).persist() for p in _wire_parts(spark, 4)]
    want, done = {}, parts[0].limit(0)
    for k, p in enumerate(parts):
        done = done.unionByName(p)
        want[k + 1] = rows(_batch_replay(done, patients))
    live.commit_batch(parts[0], "r", 0, out, ref.THRESHOLD_ROWS)
    failed = []

    def write():
        try:
            for k in (1, 2, 3):
                live.commit_batch(parts[k], "r", k, out, ref.THRESHOLD_ROWS)
        except Exception as e:  # noqa: BLE001 - shown below
            failed.append(e)
    writer = threading.Thread(target=write)
    writer.start()
    seen = set()
    while True:
        running = writer.is_alive()
        view = live.Snapshot(spark, out, ref.THRESHOLD_ROWS)
        assert rows(view.replay(patients)) == want[view.lot]
        seen.add(view.lot)
        if not running:
            break
    writer.join()
    assert not failed and 4 in seen
    assert rows(live.Snapshot(spark, out, ref.THRESHOLD_ROWS, lot=2).replay(patients)) == want[2]


def test_counts_per_batch_are_those_of_the_files(spark, workdir):
    sizes = []
    for i, part in enumerate(_wire_parts(spark, 5)):
        part = part.limit(3 + 4 * i)
        _write_part(workdir, i, part)
        sizes.append(part.count())
    _write_part(workdir, 5, spark.createDataFrame([("k", "{broken")], "key string, value string"))
    out, listener = os.path.join(workdir, "out"), metrics.BatchCounts(spark)
    spark.streams.addListener(listener)
    try:
        q = jobs.alert_stream(_wire_stream(spark, workdir), out, os.path.join(workdir, "ck"), ref.THRESHOLD_ROWS,
                              _patients(spark), trigger="availableNow", counts=listener)      # one file a batch
        q.awaitTermination()
        listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    counts = metrics.read_counts(spark, f"{out}/{jobs.COUNTS}").collect()
    assert sorted(r.lot for r in counts) == list(range(6))
    assert sorted((r.nb_mesures, r.nb_rejets) for r in counts) == sorted([(n, 0) for n in sizes] + [(1, 1)])
    stored = {r.lot: r.nb_mesures for r in jobs.read_output(spark, out, "comptages").collect()}
    assert {r.lot: r.nb_mesures for r in counts} == stored


def test_published_in_order_per_patient(spark, workdir):
    obs = files.scan_observations(spark, sample("observations.csv"))
    folder, out = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    obs.repartition(3).write.parquet(folder)
    stream = file_stream(spark, folder, schemas.OBSERVATIONS)
    jobs.publish_stream(stream, out, os.path.join(workdir, "ck"), partitions=5, trigger="availableNow").awaitTermination()
    published = jobs.read_published(spark, out)
    assert published.count() == sd.OBSERVATIONS
    by_key = {}
    for r in published.collect():
        by_key.setdefault(r.key, []).append((r.batch_id, r.partition, r.position, r.value))
    for own in by_key.values():
        assert len({p for _, p, _, _ in own}) == 1                     # one partition a key
        places = sorted(own)
        stamps = [v.split('"timestamp":"')[1][:19] for *_, v in places]
        assert stamps == sorted(stamps)
        assert [p[2] for p in places] == list(range(places[0][2], places[0][2] + len(places)))
    # the batch published again replaces itself
    before = rows(published.select("key", "value"))
    jobs._write_partition(jobs.ordered_records(obs, 5), out, "messages", 0, published.first().run_id)
    assert rows(jobs.read_published(spark, out).select("key", "value")) == before


def test_other_sinks_get_keys_and_values(spark, workdir):
    got = []
    obs = files.scan_observations(spark, sample("observations.csv"))
    obs.write.parquet(os.path.join(workdir, "in"))
    jobs.publish_stream(file_stream(spark, os.path.join(workdir, "in"), schemas.OBSERVATIONS), "", os.path.join(workdir, "ck"),
                        trigger="availableNow", sink=lambda df, run, batch: got.append((df.columns[:2], df.count()))).awaitTermination()
    assert got == [(["key", "value"], sd.OBSERVATIONS)]
