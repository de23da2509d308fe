"""Live monitoring queries over the alert and update tables.

* Latest state per patient is ``max_by(row, (timestamp, mesure_id))`` — an
  algebraic aggregate with map-side partials, so a patient that holds a third
  of all measurements still costs one partial row per task. It is computed on
  the raw messages first; alerts and the profile join then run on one row per
  patient instead of one per measurement.
* Recent alerts are a top-k (``orderBy().limit(n)`` → TakeOrderedAndProject):
  each task keeps its own n best, the driver merges at most n × tasks rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions.ids import normalise_patient_id
from vigilo.functions.vitals import SIGNAL_NAMES, severity_rank
from vigilo.operators import alerts as al
from vigilo.operators import profiles

RECENT_ALERTS = 100     # alert history kept by the live server
REPLAY_ALERTS = 20      # alerts replayed to a newly connected reader
LOG_LINES = 150         # lines kept in the live alert log


def latest_messages(messages: DataFrame) -> DataFrame:
    """Last message per (normalised) patient, ordered by (timestamp, mesure_id)."""
    valid = messages.filter(al.is_valid(messages))
    fields = valid.columns
    return (valid.groupBy(normalise_patient_id(F.col("patient_id")).alias("_k"))
            .agg(F.max_by(F.struct(*fields), F.struct("timestamp", "mesure_id")).alias("_m"))
            .select(*[F.col(f"_m.{c}").alias(c) for c in fields]))


def latest_patient_state(messages: DataFrame, thresholds: al.Thresholds, patients: DataFrame) -> DataFrame:
    """Latest patient update per patient (A11), with its alert list."""
    # one row per patient: no patient can skew this join, so it is not salted
    return profiles.updates_from_messages(latest_messages(messages), thresholds, patients,
                                          salt_buckets=1)


def monitor_counters(messages: DataFrame, thresholds: al.Thresholds) -> DataFrame:
    """Total / critical / warning alerts and patients monitored (A9, A10), one pass
    over the seven level columns (no alert records are built)."""
    valid = messages.filter(al.is_valid(messages))
    lv = al.with_patient_key(valid).select("patient_id", *al.level_columns(thresholds))
    c = al.level_counts()
    total = lambda col: F.coalesce(F.sum(col), F.lit(0)).cast("long")
    return lv.agg(
        total(c["nb_alertes"]).alias("alertes_total"),
        total(c["nb_critiques"]).alias("alertes_critiques"),
        total(c["nb_warnings"]).alias("alertes_warning"),
        F.countDistinct("patient_id").alias("patients_surveilles"),
    )


def patients_by_severity(latest_updates: DataFrame) -> DataFrame:
    """Patients ordered CRITIQUE → WARNING → NORMAL, then by id (O7, intended order)."""
    return (latest_updates.select(
        "patient_id", "nom", "niveau_max", severity_rank(F.col("niveau_max")).alias("rang_gravite"),
        "nb_alertes", "timestamp")
        .orderBy("rang_gravite", "patient_id"))


def signal_position(signal: Column) -> Column:
    """Evaluation position of a signal within its measurement (arrival order)."""
    return F.array_position(F.array(*[F.lit(s) for s in SIGNAL_NAMES]), signal)


def recent_alerts(alert_events: DataFrame, n: int = RECENT_ALERTS) -> DataFrame:
    """The ``n`` most recent alerts, newest first."""
    return (alert_events
            .orderBy(F.col("timestamp").desc(), F.col("mesure_id").desc(),
                     signal_position(F.col("signal")).desc())
            .limit(n))


def recent_alerts_replay(alert_events: DataFrame, latest_updates: DataFrame,
                         n: int = REPLAY_ALERTS) -> DataFrame:
    """What a new reader receives: the last ``n`` alerts and every latest state."""
    a = recent_alerts(alert_events, n).select(
        F.lit("alerte").alias("evenement"), "patient_id", F.col("alerte_id").alias("reference"),
        "timestamp", F.col("niveau_alerte").alias("niveau"))
    u = latest_updates.select(
        F.lit("patient_update").alias("evenement"), "patient_id", F.col("mesure_id").alias("reference"),
        "timestamp", F.col("niveau_max").alias("niveau"))
    return a.unionByName(u)
