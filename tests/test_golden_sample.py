"""The sample of ``sample_data`` against its plain-Python results."""

from pyspark.sql import functions as F

import sample_data as sd
from sample_data import sample
from vigilo import schemas
from vigilo.functions.ids import normalise_patient_id
from vigilo.operators import alerts as al
from vigilo.operators import enrich, kpis, monitor, profiles
from vigilo.sources import files
from vigilo.sources import reference_tables as ref


def _messages(spark):
    obs = files.scan_observations(spark, sample("observations.csv"))
    return obs.select(*[f.name for f in schemas.MESSAGE.fields])


def test_alerts(spark):
    m = _messages(spark)
    assert m.count() == sd.OBSERVATIONS
    got = {(r["mesure_id"], r["signal"], r["niveau_alerte"]) for r in al.alerts(m, ref.thresholds(spark)).collect()}
    assert got == set(sd.alerts()) and len(got) > 100
    levels = {r["niveau_max"]: r["count"] for r in
              al.with_alerts(m, ref.thresholds(spark)).groupBy("niveau_max").count().collect()}
    assert levels == sd.levels()


def test_latest_level_by_patient(spark):
    st = monitor.latest_patient_state(_messages(spark), ref.thresholds(spark),
                                      files.scan_patients(spark, sample("patients.csv")))
    assert {r["patient_id"]: r["niveau_max"] for r in st.collect()} == sd.latest_levels()
    # every patient matches a profile after normalisation
    assert all(r["ville"] != "Inconnue" for r in st.collect())


def _batch_inputs(spark):
    obs = files.scan_observations(spark, sample("observations.csv"))
    signals = obs.select(
        *[F.regexp_replace("capteur_id", "^CAP", "CAPT").alias(c) if c == "capteur_id"
          else normalise_patient_id(F.col(c)).alias(c) if c == "patient_id" else F.col(c)
          for c in [f.name for f in schemas.SIGNALS.fields]])
    sensors = files.scan_sensors(spark, sample("sensors.csv"))
    patients = files.scan_patients(spark, sample("patients.csv"))
    return signals, sensors, patients


def test_batch_etl(spark):
    signals, sensors, patients = _batch_inputs(spark)
    assert sensors.count() == sd.SENSORS and patients.count() == sd.PATIENTS
    e = enrich.enriched(signals, sensors, patients)
    assert {r[0] for r in e.select("mesure_id").collect()} == {r[0] for r in sd.kept()}
    flags = {"flag_fievre": lambda r: r[5] > 37.8, "flag_hyperglycemie": lambda r: r[11] > 1.10,
             "flag_hypoglycemie": lambda r: r[11] < 0.7, "flag_tachycardie": lambda r: r[8] > 100,
             "flag_bradycardie": lambda r: r[8] < 60, "flag_hypoxie": lambda r: r[9] < 94,
             "flag_hypoxie_critique": lambda r: r[9] < 90, "flag_hypertension": lambda r: r[6] >= 140 or r[7] >= 90,
             "flag_batterie_critique": lambda r: False}
    sums = e.agg(*[F.sum(c).alias(c) for c in flags]).first()
    for flag, rule in flags.items():
        assert sums[flag] == sum(map(rule, sd.kept())), flag


def test_nearest_centre(spark):
    patients = files.scan_patients(spark, sample("patients.csv"))
    got = {r["patient_id"]: r["centre_id"] for r in profiles.nearest_centre(patients, ref.centres(spark)).collect()}
    first = {}
    for row in ref.CENTRE_ROWS:
        first.setdefault(row[3].lower(), row[0])
    for row in sd.patients():
        city = row[4].lower()
        want = next((c for g, c in sorted(first.items(), key=lambda x: x[1]) if city in g or g in city), first["tunis"])
        assert got[row[0]] == want, row


def test_kpi_table(spark):
    signals, sensors, patients = _batch_inputs(spark)
    rows = {r["patient_id"]: r for r in
            kpis.all_kpis(kpis.patient_day_stats_from_sources(signals, sensors, patients)).collect()}
    assert set(rows) == set(sd.kpis())
    for patient, want in sd.kpis().items():
        for col, value in want.items():
            got = rows[patient][col]
            if isinstance(value, float):
                assert abs(got - value) <= 0.0051, (patient, col, got, value)
            else:
                assert got == value, (patient, col, got, value)
