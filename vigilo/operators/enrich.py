"""Batch ETL: sensor join, patient join, derived columns.

Join strategy. Sensors and patients both grow with the deployment, so
neither is forced to broadcast. The planner broadcasts a side only when its
size estimate (static: file statistics; AQE: measured shuffle output) is
under ``autoBroadcastJoinThreshold``; beyond it the join is a sort-merge join
and AQE splits skewed partitions (a hot sensor or a hot patient) into
several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions.vitals import derived_columns, derived_map
from vigilo.operators import quality

# Columns kept after the sensor join (P1), in output order.
P1_SIGNAL_COLS = [
    "mesure_id", "patient_id", "date", "heure", "temperature_C", "tension_systolique_mmHg",
    "tension_diastolique_mmHg", "frequence_cardiaque_bpm", "spo2_pct", "frequence_respiratoire_rpm",
    "glycemie_g_L", "poids_kg", "imc", "activite_physique_steps", "duree_sommeil_h",
    "score_douleur_0_10", "qualite_signal",
]
P1_SENSOR_COLS = ["type_capteur", "batterie_pct", "statut_capteur"]


def join_signals_sensors(signals: DataFrame, sensors: DataFrame) -> DataFrame:
    """Quality-filtered signals ⋈ quality-filtered sensors on ``capteur_id`` (J1 + P1)."""
    s = quality.signals_ok(quality.drop_header_rows(signals, "mesure_id"))
    c = quality.sensors_ok(quality.drop_header_rows(sensors, "capteur_id"))
    j = s.alias("s").join(c.alias("c"), F.col("s.capteur_id") == F.col("c.capteur_id"), "inner")
    return j.select(*[F.col(f"s.{x}").alias(x) for x in P1_SIGNAL_COLS],
                    *[F.col(f"c.{x}").alias(x) for x in P1_SENSOR_COLS])


def with_derived(joined: DataFrame) -> DataFrame:
    """P1 rows plus the twelve derived columns (key ``derived_flags``)."""
    return joined.select("mesure_id", "patient_id", *derived_columns())


def enriched(signals: DataFrame, sensors: DataFrame, patients: DataFrame) -> DataFrame:
    """The 36-column enriched measurement table (J2 + P2): one row per kept
    measurement and matching patient row."""
    j = join_signals_sensors(signals, sensors).alias("m")
    p = quality.drop_header_rows(patients, "patient_id").alias("p")
    jp = j.join(p, F.col("m.patient_id") == F.col("p.patient_id"), "inner")
    m = lambda c: F.col(f"m.{c}")
    return jp.select(
        m("mesure_id").alias("mesure_id"),
        m("patient_id").alias("patient_id"),
        F.col("p.nom").alias("nom"),
        F.col("p.age").alias("age"),
        F.col("p.sexe").alias("sexe"),
        F.col("p.ville").alias("ville"),
        F.col("p.maladie_chronique").alias("maladie_chronique"),
        m("date").alias("date_mesure"),
        m("heure").alias("heure_mesure"),
        m("temperature_C").alias("temperature_C"),
        m("tension_systolique_mmHg").alias("tension_systolique"),
        m("tension_diastolique_mmHg").alias("tension_diastolique"),
        m("frequence_cardiaque_bpm").alias("frequence_cardiaque"),
        m("spo2_pct").alias("spo2"),
        m("frequence_respiratoire_rpm").alias("frequence_respiratoire"),
        m("glycemie_g_L").alias("glycemie"),
        m("poids_kg").alias("poids"),
        m("imc").alias("imc"),
        m("activite_physique_steps").alias("steps"),
        m("duree_sommeil_h").alias("duree_sommeil"),
        m("score_douleur_0_10").alias("score_douleur"),
        m("batterie_pct").alias("batterie_pct"),
        m("qualite_signal").alias("qualite_signal"),
        m("type_capteur").alias("type_capteur"),
        *derived_columns(
            sys=m("tension_systolique_mmHg"), dia=m("tension_diastolique_mmHg"),
            fc=m("frequence_cardiaque_bpm"), spo2=m("spo2_pct"), temp=m("temperature_C"),
            gly=m("glycemie_g_L"), battery=m("batterie_pct")),
    )


def measurements_for_kpis(signals: DataFrame, sensors: DataFrame) -> DataFrame:
    """Kept measurements in enriched naming, before the patient join: only the
    columns the KPIs read. Feeds the aggregate-first KPI plan."""
    j = join_signals_sensors(signals, sensors)
    return j.select(
        "patient_id",
        F.col("date").alias("date_mesure"),
        F.col("temperature_C"),
        F.col("tension_systolique_mmHg").alias("tension_systolique"),
        F.col("tension_diastolique_mmHg").alias("tension_diastolique"),
        F.col("frequence_cardiaque_bpm").alias("frequence_cardiaque"),
        F.col("spo2_pct").alias("spo2"),
        F.col("frequence_respiratoire_rpm").alias("frequence_respiratoire"),
        F.col("glycemie_g_L").alias("glycemie"),
        F.col("score_douleur_0_10").alias("score_douleur"),
        *[c.alias(n) for n, c in derived_map().items() if n in _KPI_DERIVED],
    )


_KPI_DERIVED = {
    "flag_hypertension", "flag_tachycardie", "flag_bradycardie", "flag_hypoxie",
    "flag_hypoxie_critique", "indice_oxygenation", "ecart_fc_normale",
}
