"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the adapter
(``vigilo.sources.testdata``), so its work grows with them. Streaming keys
run the real streaming job (``availableNow``) over the events table into a
fresh folder below the session's shared checkpoint folder and return the
written table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilo import schemas
from vigilo.functions.vitals import DEFAULT_SOURCE
from vigilo.operators import alerts as al
from vigilo.operators import enrich, kpis, monitor, profiles, quality
from vigilo.plans import batch_job
from vigilo.session import fresh_path
from vigilo.sources import files
from vigilo.sources import reference_tables as ref
from vigilo.sources import stream as st
from vigilo.sources import testdata as td
from vigilo.streaming import jobs, live, metrics

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ inputs

def _patients(spark, sf):
    return quality.drop_header_rows(td.patients(spark, sf), "patient_id")


def _sensors(spark, sf):
    return quality.drop_header_rows(td.sensors(spark, sf), "capteur_id")


def _signals(spark, sf):
    return quality.drop_header_rows(td.signals(spark, sf), "mesure_id")


def messages(spark, sf) -> DataFrame:
    """Stream messages as the producer emits them (16 fields, source constant)."""
    obs = td.observations(spark, sf)
    return obs.select(*[F.col(f.name) if f.name != "source" else F.lit(DEFAULT_SOURCE).alias("source")
                        for f in schemas.MESSAGE.fields])


def _valid_messages(spark, sf) -> DataFrame:
    m = messages(spark, sf)
    return m.filter(al.is_valid(m))


def _stats(spark, sf) -> DataFrame:
    return kpis.patient_day_stats_from_sources(td.signals(spark, sf), td.sensors(spark, sf),
                                               td.patients(spark, sf))


def _enriched(spark, sf) -> DataFrame:
    return enrich.enriched(td.signals(spark, sf), td.sensors(spark, sf), td.patients(spark, sf))


def _updates(spark, sf) -> DataFrame:
    return profiles.updates_from_messages(_valid_messages(spark, sf), ref.THRESHOLD_ROWS,
                                          td.patients(spark, sf))


def _latest_updates(spark, sf) -> DataFrame:
    return monitor.latest_patient_state(messages(spark, sf), ref.THRESHOLD_ROWS, td.patients(spark, sf))


def _alert_events(spark, sf) -> DataFrame:
    return al.alerts(_valid_messages(spark, sf), ref.THRESHOLD_ROWS)


# ------------------------------------------------------------------ streaming

def _wire_stream(spark, sf) -> DataFrame:
    """The events table (a file or a folder; a stream takes a file by a pattern) replayed as
    a stream of wire records."""
    events = st.file_stream(spark, f"{sf.rstrip('/')}/events.parquet*", td.SOURCE_SCHEMAS["events"])
    return st.encode_messages(td.events_as_observations(events))


def _run_alert_stream(spark, sf, times: int = 1, dedup: bool = False) -> str:
    out = fresh_path(spark, "alert-stream")
    profile = jobs.prepare_profile(td.patients(spark, sf))
    try:
        for k in range(times):      # each with a checkpoint of its own
            jobs.alert_stream(_wire_stream(spark, sf), out, f"{out}/_checkpoint-{k}", ref.THRESHOLD_ROWS,
                              profile=profile, trigger="availableNow", dedup=dedup).awaitTermination()
    finally:
        profile.unpersist()
    return out


def stream_alerts(spark, sf) -> DataFrame:
    return jobs.read_output(spark, _run_alert_stream(spark, sf), "alertes")


def stream_alerts_dedup(spark, sf) -> DataFrame:
    """All events delivered twice, the second time after a checkpoint reset: each alert
    is stored once (T10)."""
    return jobs.read_output(spark, _run_alert_stream(spark, sf, times=2, dedup=True), "alertes")


def stream_patient_updates(spark, sf) -> DataFrame:
    out = _run_alert_stream(spark, sf)
    return profiles.flat_updates(jobs.read_output(spark, out, "patient_updates"))


def stream_latest_state(spark, sf) -> DataFrame:
    out = fresh_path(spark, "latest-stream")
    jobs.latest_state_stream(_wire_stream(spark, sf), out, f"{out}/_checkpoint",
                                 trigger="availableNow").awaitTermination()
    last = jobs.read_latest_messages(spark, out)
    upd = profiles.patient_updates(al.with_alerts(last, ref.THRESHOLD_ROWS), td.patients(spark, sf),
                                   salt_buckets=1)          # one row per patient: no skew
    return profiles.flat_updates(upd)


def stream_latest_state_resumed(spark, sf) -> DataFrame:
    """The events in two deliveries, the checkpoint lost between them: the state goes on from
    what is stored (T9)."""
    out = fresh_path(spark, "resumed-stream")
    for k in (0, 1):
        mine = _wire_stream(spark, sf).where(F.pmod(F.xxhash64("value"), F.lit(2)) == k)
        jobs.resumable_state_stream(mine, out, f"{out}/_checkpoint-{k}", trigger="availableNow").awaitTermination()
    last = jobs.read_latest_messages(spark, out)
    return profiles.flat_updates(profiles.patient_updates(al.with_alerts(last, ref.THRESHOLD_ROWS), td.patients(spark, sf),
                                                          salt_buckets=1))


#: Into how many deliveries the events are dealt where several batches matter; by the last
#: digit of the measurement's id they hold a tenth, two, three and four tenths.
DELIVERIES = 4


def _delivery() -> Column:
    last = F.substring("mesure_id", -1, 1).cast("int")
    return F.when(last == 0, 0).when(last <= 2, 1).when(last <= 5, 2).otherwise(3)


def _deliver(spark, sf, folder: str, k: int) -> DataFrame:
    """Writes delivery ``k`` to ``folder`` as wire records; the stream of all files there."""
    records = st.encode_messages(td.observations(spark, sf).where(_delivery() == k))
    records.write.mode("append").parquet(folder)
    return st.file_stream(spark, folder, "key string, value string")


def _live(spark, sf) -> live.Snapshot:
    """The live view over the deliveries, read at its newest entry."""
    out = fresh_path(spark, "live-stream")
    for k in range(DELIVERIES):
        live.live_stream(_deliver(spark, sf, f"{out}/_in", k), f"{out}/live", f"{out}/_checkpoint", ref.THRESHOLD_ROWS,
                         trigger="availableNow").awaitTermination()
    return live.Snapshot(spark, f"{out}/live", ref.THRESHOLD_ROWS)


def stream_delivery_counts(spark, sf) -> DataFrame:
    """Measurements of the micro-batches as the running query reports them (A13), summed over
    the batches of each delivery."""
    out = fresh_path(spark, "counted-stream")
    listener = metrics.BatchCounts(spark)
    spark.streams.addListener(listener)
    profile, ends = jobs.prepare_profile(td.patients(spark, sf)), []
    try:
        for k in range(DELIVERIES):
            query = jobs.alert_stream(_deliver(spark, sf, f"{out}/_in", k), out, f"{out}/_checkpoint", ref.THRESHOLD_ROWS,
                                      profile=profile, trigger="availableNow", counts=listener)
            query.awaitTermination()
            listener.wait(query)
            ends.append(metrics.read_counts(spark, f"{out}/{jobs.COUNTS}").agg(F.max("lot")).first()[0])
    finally:
        profile.unpersist()
        spark.streams.removeListener(listener)
    counts = metrics.read_counts(spark, f"{out}/{jobs.COUNTS}")
    delivery = F.lit(DELIVERIES - 1)
    for k in range(DELIVERIES - 2, -1, -1):
        delivery = F.when(F.col("lot") <= ends[k], k).otherwise(delivery)
    return (counts.groupBy(delivery.alias("livraison")).agg(F.sum("nb_mesures").alias("nb_mesures"),
                                                            F.sum("nb_rejets").alias("nb_rejets")))


def stream_published(spark, sf) -> DataFrame:
    """Observations published as messages keyed by patient (K3, T8), with the rank of each
    among those of its patient as they were published."""
    out = fresh_path(spark, "published")
    events = st.file_stream(spark, f"{sf.rstrip('/')}/events.parquet*", td.SOURCE_SCHEMAS["events"])
    jobs.publish_stream(td.events_as_observations(events), out, f"{out}/_checkpoint", trigger="availableNow").awaitTermination()
    order = Window.partitionBy("key").orderBy("run_id", "batch_id", "partition", "position")
    return jobs.read_published(spark, out).select("key", "value", F.row_number().over(order).cast("long").alias("rang"))


def stream_monitor_counters(spark, sf) -> DataFrame:
    out = fresh_path(spark, "counters-stream")
    jobs.counters_stream(_wire_stream(spark, sf), out, f"{out}/_checkpoint", ref.THRESHOLD_ROWS,
                             trigger="availableNow").awaitTermination()
    return jobs.read_counters(spark, out)


def dashboard_from_stored(spark, sf) -> DataFrame:
    """The two-step shape: the ETL writes the enriched table (Parquet, shared
    folder), the KPI job reads it back and groups by the five keys. The written
    table also cuts the lineage between the two jobs."""
    path = fresh_path(spark, "enriched")
    files.write_table(_enriched(spark, sf), path)
    return kpis.dashboard_view(kpis.patient_day_stats(files.scan_enriched(spark, path)))


def enriched_text_roundtrip(spark, sf) -> DataFrame:
    """Enriched table stored as ``;``-separated text without header (K1) and read
    back with the declared 36-column schema (S5)."""
    path = fresh_path(spark, "enriched-text")
    files.write_table(_enriched(spark, sf), path, fmt="text")
    return files.scan_enriched(spark, path, fmt="text")


# ------------------------------------------------------------------ text path

def _as_text(spark, df: DataFrame, sep: str = ";") -> str:
    """A table stored as delimited text the way a user brings it: a header line in each
    file and once more among the rows, CRLF line ends, accents, empty and missing values
    (both an empty field, so both read back as missing)."""
    path = fresh_path(spark, "text")
    words = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    again = words.limit(1).select(*[F.lit(c).alias(c) for c in df.columns])
    (words.unionByName(again).write.option("sep", sep).option("header", True).option("lineSep", "\r\n")
     .option("encoding", "UTF-8").csv(path))
    return path


def text_patients(spark, sf) -> DataFrame:
    return files.scan_patients(spark, _as_text(spark, td.patients(spark, sf)))


def text_signals(spark, sf) -> DataFrame:
    return files.scan_signals(spark, _as_text(spark, td.signals(spark, sf)))


def text_sensors(spark, sf) -> DataFrame:
    return files.scan_sensors(spark, _as_text(spark, td.sensors(spark, sf)))


def text_observations(spark, sf) -> DataFrame:
    return files.scan_observations(spark, _as_text(spark, td.observations(spark, sf), ","))


def text_profiles(spark, sf) -> DataFrame:
    """The profile lookup of the streaming job from the patients' text file."""
    path = _as_text(spark, td.patients(spark, sf))
    return profiles.profile_lookup(files.load_optional(spark, path, schemas.PATIENTS, reader=files.scan_patients))


# ------------------------------------------------------------------ stored batch job

def _batch_job(spark, sf) -> dict[str, str]:
    """The batch job on measurements ingested from text, all tables stored."""
    store = fresh_path(spark, "signals")
    files.ingest_signals(text_signals(spark, sf), store)
    return batch_job.run(spark, td.patients(spark, sf), files.scan_ingested_signals(spark, store),
                         td.sensors(spark, sf), fresh_path(spark, "batch"))


def batch_job_view(spark, sf) -> DataFrame:
    view = kpis.dashboard_view(_stats(spark, sf)).schema
    return files.read_table(spark, _batch_job(spark, sf)["vue_dashboard_patient"], view)


def batch_job_counts(spark, sf) -> DataFrame:
    """Row counts of the tables that the batch job stored."""
    return files.read_table(spark, _batch_job(spark, sf)["comptages"], batch_job.COUNTS)


# ------------------------------------------------------------------ presentation orders

def ranked(df: DataFrame, order: list) -> DataFrame:
    """``df`` in a presentation order with the rank as a column. A range partitioning sorts;
    only one count per partition is prefix-summed."""
    return st.with_row_index(df.orderBy(*order), "position").withColumn("position", F.col("position") + 1)


def _presented(kpi: str, table) -> Query:
    return lambda s, sf: ranked(table(_stats(s, sf)), [*kpis.presentation_order(kpi), "patient_id", "date_mesure", "nom"])


def presented_alert_summary(spark, sf) -> DataFrame:
    return ranked(al.alert_summary_patient_day(al.to_history(_alert_events(spark, sf))),
                  [*al.summary_order(), "patient_id"])


def presented_alert_stats(spark, sf) -> DataFrame:
    return ranked(al.alert_stats_by_signal(al.to_history(_alert_events(spark, sf))),
                  [*al.stats_order(), "signal", "niveau_alerte", "unite"])


def stream_batch_counts(spark, sf) -> DataFrame:
    """Measurements per micro-batch (A13), summed over the run; into how many batches a
    stream is cut depends on its files, so that number is no part of the result."""
    out = _run_alert_stream(spark, sf)
    return jobs.read_output(spark, out, "comptages").agg(
        F.sum("nb_mesures").cast("long").alias("nb_mesures"))


def alert_history(spark, sf) -> DataFrame:
    """Alert history written as batch ``0`` of the history table (partitioned by
    day inside the batch) and read back (K6)."""
    out = fresh_path(spark, "alert-history")
    hist = al.to_history(_alert_events(spark, sf))
    jobs.write_alert_history(hist, out, 0)
    return jobs.read_output(spark, out, "alertes")


# ------------------------------------------------------------------ registry

QUERIES: dict[str, Query] = {
    # sources
    "scan_patients": _patients,
    "scan_signals": _signals,
    "scan_sensors": _sensors,
    "text_patients": text_patients,
    "text_signals": text_signals,
    "text_sensors": text_sensors,
    "text_observations": text_observations,
    "text_profiles": text_profiles,
    # filters, joins, derived columns
    "filter_sensors_ok": lambda s, sf: quality.sensors_ok(_sensors(s, sf)),
    "filter_signals_ok": lambda s, sf: quality.signals_ok(_signals(s, sf)),
    "join_signals_sensors": lambda s, sf: enrich.join_signals_sensors(td.signals(s, sf), td.sensors(s, sf)),
    "derived_flags": lambda s, sf: enrich.with_derived(
        enrich.join_signals_sensors(td.signals(s, sf), td.sensors(s, sf))),
    "etl_enriched": _enriched,
    "enriched_text_roundtrip": enriched_text_roundtrip,
    # KPIs
    "kpi1_daily_vitals": lambda s, sf: kpis.kpi1_daily_vitals(_stats(s, sf)),
    "kpi2_hypertension": lambda s, sf: kpis.kpi2_hypertension(_stats(s, sf)),
    "kpi3_cardiac_stability": lambda s, sf: kpis.kpi3_cardiac_stability(_stats(s, sf)),
    "kpi4_oxygenation": lambda s, sf: kpis.kpi4_oxygenation(_stats(s, sf)),
    "dashboard_view": lambda s, sf: kpis.dashboard_view(_stats(s, sf)),
    "dashboard_from_stored": dashboard_from_stored,
    "table_row_counts": lambda s, sf: kpis.table_row_counts(_stats(s, sf)),
    "batch_job_view": batch_job_view,
    "batch_job_counts": batch_job_counts,
    "presented_kpi1": _presented("kpi1", kpis.kpi1_daily_vitals),
    "presented_kpi2": _presented("kpi2", kpis.kpi2_hypertension),
    "presented_kpi3": _presented("kpi3", kpis.kpi3_cardiac_stability),
    "presented_kpi4": _presented("kpi4", kpis.kpi4_oxygenation),
    # alerts
    "normalise_patient_id": lambda s, sf: al.with_patient_key(messages(s, sf)).select(
        "mesure_id", "patient_id_brut", "patient_id"),
    "vitals_long": lambda s, sf: al.vitals_long(messages(s, sf)),
    "classify_level": lambda s, sf: al.classify_levels(messages(s, sf), ref.THRESHOLD_ROWS),
    "alerts_batch": _alert_events,
    "patient_updates": lambda s, sf: profiles.flat_updates(_updates(s, sf)),
    "nearest_centre": lambda s, sf: profiles.nearest_centre(td.patients(s, sf), ref.CENTRE_ROWS),
    "patient_cards": lambda s, sf: profiles.patient_cards(_latest_updates(s, sf)),
    "patient_dossier": lambda s, sf: profiles.patient_dossier(_latest_updates(s, sf)),
    # wire format
    "json_decode": lambda s, sf: st.decode_messages(st.encode_messages(td.observations(s, sf))),
    "observations_encode": lambda s, sf: st.encode_messages(td.observations(s, sf)),
    # alert tables
    "alert_history": alert_history,
    "alert_summary_patient_day": lambda s, sf: al.alert_summary_patient_day(
        al.to_history(_alert_events(s, sf))),
    "alert_stats_by_signal": lambda s, sf: al.alert_stats_by_signal(al.to_history(_alert_events(s, sf))),
    "presented_alert_summary": presented_alert_summary,
    "presented_alert_stats": presented_alert_stats,
    # live state
    "monitor_counters": lambda s, sf: monitor.monitor_counters(messages(s, sf), ref.THRESHOLD_ROWS),
    "latest_patient_state": lambda s, sf: profiles.flat_updates(_latest_updates(s, sf)),
    "patients_by_severity": lambda s, sf: monitor.patients_by_severity(_latest_updates(s, sf)),
    "recent_alerts": lambda s, sf: monitor.recent_alerts(_alert_events(s, sf)),
    "alert_log": lambda s, sf: monitor.recent_alerts(_alert_events(s, sf), monitor.LOG_LINES),
    "recent_alerts_replay": lambda s, sf: monitor.recent_alerts_replay(
        _alert_events(s, sf), _latest_updates(s, sf)),
    # streaming
    "stream_alerts": stream_alerts,
    "stream_alerts_dedup": stream_alerts_dedup,
    "stream_patient_updates": stream_patient_updates,
    "stream_latest_state": stream_latest_state,
    "stream_latest_state_resumed": stream_latest_state_resumed,
    "stream_recent_alerts": lambda s, sf: _live(s, sf).alerts(),
    "stream_alert_log": lambda s, sf: _live(s, sf).alerts(monitor.LOG_LINES),
    "stream_replay": lambda s, sf: _live(s, sf).replay(td.patients(s, sf)),
    "stream_delivery_counts": stream_delivery_counts,
    "stream_published": stream_published,
    "stream_batch_counts": stream_batch_counts,
    "stream_monitor_counters": stream_monitor_counters,
}
