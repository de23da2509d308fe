"""The runnable jobs on the sample files: batch pipeline and streaming app."""

import os
import shutil

from pyspark.sql import functions as F

import sample_data as sd
from sample_data import sample
from vigilo import schemas
from vigilo.functions.ids import normalise_patient_id
from vigilo.plans import batch_job
from vigilo.sources import files, versions
from vigilo.sources.reference_tables import THRESHOLD_ROWS
from vigilo.streaming import app, jobs, live


def test_batch_job_on_sample(spark, workdir):
    obs = files.scan_observations(spark, sample("observations.csv"))
    # the sample signals as the batch job expects them (sensor ids of the sensor table)
    sig_dir = os.path.join(workdir, "signals")
    (obs.select(*[F.regexp_replace("capteur_id", "^CAP", "CAPT").alias(c) if c == "capteur_id"
                  else normalise_patient_id(F.col(c)).alias(c) if c == "patient_id" else F.col(c)
                  for c in [f.name for f in schemas.SIGNALS.fields]])
     .coalesce(1).write.option("sep", ";").option("header", True).csv(sig_dir))
    out = os.path.join(workdir, "out")
    batch_job.main(["--patients", sample("patients.csv"), "--signals", sig_dir,
                    "--sensors", sample("sensors.csv"), "--out", out])
    counts = {r["table_name"]: r["nb_lignes"] for r in batch_job.read(spark, out, "comptages").collect()}
    groups = len(sd.kpis())
    assert counts == {"mesures_patients": len(sd.kept()), "kpi1_moyennes_vitaux": groups, "kpi2_hypertension": groups,
                      "kpi3_stabilite_cardiaque": groups, "kpi4_oxygenation": groups}
    view = {r["patient_id"]: r for r in batch_job.read(spark, out, "vue_dashboard_patient").collect()}
    for patient, want in sd.kpis().items():
        assert view[patient]["niveau_oxygenation"] == want["niveau_oxygenation"]
        assert view[patient]["classification_oms"] == want["classification_oms"]
    assert len(batch_job.read(spark, out, "mesures_patients").columns) == 36


def test_streaming_app_replays_observation_files(spark, workdir):
    src = os.path.join(workdir, "src")
    os.makedirs(src)
    shutil.copy(sample("observations.csv"), os.path.join(src, "obs.csv"))
    out = os.path.join(workdir, "out")
    a = app.parse(["--source-dir", src, "--source-format", "csv", "--patients",
                   sample("patients.csv"), "--out", out, "--checkpoint",
                   os.path.join(workdir, "ck"), "--trigger", "availableNow"])
    for q in app.start(spark, a):
        q.awaitTermination()
    assert jobs.read_output(spark, f"{out}/alertes_job", "alertes").count() == len(sd.alerts())
    upd = jobs.read_output(spark, f"{out}/alertes_job", "patient_updates")
    assert upd.filter("ville = 'Inconnue'").count() == 0
    assert jobs.read_latest_messages(spark, f"{out}/etat").count() == sd.monitored()
    app.compact(spark, out)
    assert jobs.read_output(spark, f"{out}/alertes_job", "alertes").count() == len(sd.alerts())
    view = live.Snapshot(spark, f"{out}/direct", THRESHOLD_ROWS)
    assert view.latest_messages().count() == sd.monitored() and view.alerts().count() == min(100, len(sd.alerts()))
    c = jobs.read_counters(spark, f"{out}/compteurs_job").first()
    assert (c["alertes_total"], c["patients_surveilles"]) == (len(sd.alerts()), sd.monitored())


def test_original_sql_runs_on_registered_views(spark):
    from vigilo.operators import alerts as al
    from vigilo.plans import views
    from vigilo.sources import reference_tables as ref
    obs = files.scan_observations(spark, sample("observations.csv"))
    signals = obs.select(
        *[F.regexp_replace("capteur_id", "^CAP", "CAPT").alias(c) if c == "capteur_id"
          else normalise_patient_id(F.col(c)).alias(c) if c == "patient_id" else F.col(c)
          for c in [f.name for f in schemas.SIGNALS.fields]])
    msgs = obs.select(*[f.name for f in schemas.MESSAGE.fields])
    history = al.to_history(al.alerts(msgs, ref.THRESHOLD_ROWS))
    names = views.register(spark, files.scan_patients(spark, sample("patients.csv")), signals,
                           files.scan_sensors(spark, sample("sensors.csv")), history)
    assert "vue_dashboard_patient" in names and "vue_alertes_resume" in names
    # the row-count check, written as in the original SQL
    counts = {r[0]: r[1] for r in spark.sql("""
        SELECT 'mesures_patients' AS table_name, COUNT(*) AS nb_lignes FROM mesures_patients
        UNION ALL SELECT 'kpi1_moyennes_vitaux', COUNT(*) FROM kpi1_moyennes_vitaux
        UNION ALL SELECT 'kpi4_oxygenation', COUNT(*) FROM kpi4_oxygenation""").collect()}
    assert counts == {"mesures_patients": len(sd.kept()), "kpi1_moyennes_vitaux": len(sd.kpis()),
                      "kpi4_oxygenation": len(sd.kpis())}
    crit = [r[0] for r in spark.sql("SELECT patient_id FROM vue_dashboard_patient "
                                    "WHERE niveau_oxygenation = 'CRITIQUE' ORDER BY patient_id").collect()]
    assert crit == sorted(p for p, k in sd.kpis().items() if k["niveau_oxygenation"] == "CRITIQUE")
    assert spark.sql("SELECT SUM(total_alertes) FROM vue_alertes_resume").first()[0] == len(sd.alerts())
    assert spark.sql("SELECT COUNT(*) FROM seuils_alerte").first()[0] == 7
    assert spark.sql("SELECT COUNT(DISTINCT gouvernorat) FROM centres_sante").first()[0] == 22


def test_batch_job_recomputes_only_given_days(spark, workdir):
    obs = files.scan_observations(spark, sample("observations.csv"))
    base = obs.select(
        *[F.regexp_replace("capteur_id", "^CAP", "CAPT").alias(c) if c == "capteur_id"
          else normalise_patient_id(F.col(c)).alias(c) if c == "patient_id" else F.col(c)
          for c in [f.name for f in schemas.SIGNALS.fields]])
    odd = F.col("mesure_id").substr(-1, 1).isin("1", "3", "5", "7", "9")
    two_days = base.withColumn("date", F.when(odd, F.lit("2025-03-05")).otherwise(F.col("date")))
    changed = two_days.filter(~(F.col("date") == "2025-03-05") | F.col("mesure_id").substr(-1, 1).isin("1", "3"))
    patients = files.scan_patients(spark, sample("patients.csv"))
    sensors = files.scan_sensors(spark, sample("sensors.csv"))

    def view(out):
        return {(r["patient_id"], r["date_mesure"]): r.asDict()
                for r in batch_job.read(spark, out, "vue_dashboard_patient").collect()}

    inc, ref_out = os.path.join(workdir, "inc"), os.path.join(workdir, "ref")
    batch_job.run(spark, patients, two_days, sensors, inc)
    before = view(inc)
    batch_job.run(spark, patients, changed, sensors, inc, days=["2025-03-05"])
    after = view(inc)
    batch_job.run(spark, patients, changed, sensors, ref_out)
    rebuilt = view(ref_out)
    day1 = lambda v: {k: x for k, x in v.items() if str(k[1]) == "2025-03-04"}
    assert day1(after) == day1(before) and day1(after)
    assert after == rebuilt
    counts = {r["table_name"]: r["nb_lignes"] for r in batch_job.read(spark, inc, "comptages").collect()}
    ref_counts = {r["table_name"]: r["nb_lignes"] for r in batch_job.read(spark, ref_out, "comptages").collect()}
    assert counts == ref_counts


def test_streaming_app_with_thresholds_table(spark, workdir):
    from vigilo.sources import reference_tables as ref
    src = os.path.join(workdir, "src")
    os.makedirs(src)
    shutil.copy(sample("observations.csv"), os.path.join(src, "obs.csv"))
    th = os.path.join(workdir, "seuils")
    ref.thresholds(spark).write.option("header", False).csv(th)      # comma text, no header
    out = os.path.join(workdir, "out")
    a = app.parse(["--source-dir", src, "--source-format", "csv", "--thresholds", th,
                   "--out", out, "--checkpoint", os.path.join(workdir, "ck"), "--trigger", "availableNow"])
    for q in app.start(spark, a):
        q.awaitTermination()
    assert jobs.read_output(spark, f"{out}/alertes_job", "alertes").count() == len(sd.alerts())
    upd = jobs.read_output(spark, f"{out}/alertes_job", "patient_updates")
    assert upd.filter("ville = 'Inconnue'").count() == sd.OBSERVATIONS            # no profile table given


def test_views_with_cached_kpis(spark):
    from vigilo.plans import views
    from vigilo.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    names = views.register(spark, td.patients(spark, sf), td.signals(spark, sf), td.sensors(spark, sf),
                           cache_kpis=True)
    assert "alertes" not in names and "kpi3_stabilite_cardiaque" in names
    n1 = spark.sql("SELECT COUNT(*) FROM kpi1_moyennes_vitaux").first()[0]
    n4 = spark.sql("SELECT COUNT(*) FROM kpi4_oxygenation").first()[0]
    total = spark.sql("SELECT SUM(nb_mesures) FROM vue_dashboard_patient").first()[0]
    assert n1 == n4 > 0
    assert total == spark.sql("SELECT COUNT(*) FROM mesures_patients").first()[0]


def test_emptied_day_and_ingested_signals(spark, workdir):
    """A day recomputed from an input in which nothing qualifies any more has no rows left, in
    any table; signals kept by day give the same tables; a day has few files."""
    from vigilo.plans.batch_job import KPI_TABLES
    obs = files.scan_observations(spark, sample("observations.csv"))
    signals = obs.select(
        *[F.regexp_replace("capteur_id", "^CAP", "CAPT").alias(c) if c == "capteur_id"
          else normalise_patient_id(F.col(c)).alias(c) if c == "patient_id" else F.col(c)
          for c in [f.name for f in schemas.SIGNALS.fields]])
    later = F.when(F.col("mesure_id") > "RT_00048", F.lit("2025-03-05")).otherwise(F.col("date"))
    two_days = signals.withColumn("date", later).repartition(12)
    patients = files.scan_patients(spark, sample("patients.csv"))
    sensors = files.scan_sensors(spark, sample("sensors.csv"))
    out, store = os.path.join(workdir, "out"), os.path.join(workdir, "signals")
    files.ingest_signals(two_days, store)
    ingested = files.scan_ingested_signals(spark, store)
    assert ingested.exceptAll(two_days).count() == 0 and ingested.count() == two_days.count()
    batch_job.run(spark, patients, ingested, sensors, out)
    day = os.path.join(versions.folders(spark, f"{out}/mesures_patients")[0], "date_mesure=2025-03-05")
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) <= 2
    spoilt = two_days.withColumn("qualite_signal", F.lit("mauvais"))
    files.ingest_signals(spoilt, store, ["2025-03-05"])
    batch_job.run(spark, patients, files.scan_ingested_signals(spark, store), sensors, out, days=["2025-03-05"])
    for table in ["mesures_patients", "_patient_day_stats", *KPI_TABLES]:
        days = {str(r[0]) for r in batch_job.read(spark, out, table).select("date_mesure").distinct().collect()}
        assert days == {"2025-03-04"}, table
    counts = {r["table_name"]: r["nb_lignes"] for r in batch_job.read(spark, out, "comptages").collect()}
    for table, n in counts.items():
        assert n == batch_job.read(spark, out, table).count() > 0
