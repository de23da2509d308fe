"""Register the pipeline's tables and views under their original names, so
existing SQL runs unchanged on Spark SQL:

    views.register(spark, patients=..., signals=..., sensors=..., alert_history=...)
    spark.sql("SELECT * FROM vue_dashboard_patient WHERE niveau_oxygenation = 'CRITIQUE'")

Everything registered is a lazy DataFrame (temp view); the four KPI tables and
the dashboard view share one aggregation, which is persisted once when
``cache_kpis`` is set so that several SQL statements do not recompute it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from vigilo.operators import alerts as al
from vigilo.operators import enrich, kpis, quality
from vigilo.sources import reference_tables as ref

# The original table and view names.
ENRICHED_TABLE = "mesures_patients"
KPI_VIEWS = {
    "kpi1_moyennes_vitaux": kpis.kpi1_daily_vitals,
    "kpi2_hypertension": kpis.kpi2_hypertension,
    "kpi3_stabilite_cardiaque": kpis.kpi3_cardiac_stability,
    "kpi4_oxygenation": kpis.kpi4_oxygenation,
    "vue_dashboard_patient": kpis.dashboard_view,
}
THRESHOLDS_TABLE = "seuils_alerte"
CENTRES_TABLE = "centres_sante"
PATIENTS_TABLE = "table_patients"
ALERTS_TABLE = "alertes"
ALERT_SUMMARY_VIEW = "vue_alertes_resume"
ALERT_STATS_VIEW = "vue_alertes_par_signal"


_cached: list[DataFrame] = []


def release() -> None:
    """Give up what ``register(..., cache_kpis=True)`` keeps; the views stay and recompute."""
    while _cached:
        _cached.pop().unpersist()


def register(spark: SparkSession, patients: DataFrame | None = None, signals: DataFrame | None = None,
             sensors: DataFrame | None = None, alert_history: DataFrame | None = None,
             cache_kpis: bool = False) -> list[str]:
    """Create the temp views that the given inputs allow; returns their names."""
    names = []

    def view(name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        names.append(name)

    view(THRESHOLDS_TABLE, ref.thresholds(spark))
    view(CENTRES_TABLE, ref.centres(spark))
    if patients is not None:
        view(PATIENTS_TABLE, quality.drop_header_rows(patients, "patient_id"))
    if patients is not None and signals is not None and sensors is not None:
        enriched = enrich.enriched(signals, sensors, patients)
        view(ENRICHED_TABLE, enriched)
        stats = kpis.patient_day_stats(enriched)
        if cache_kpis:
            stats = stats.persist(StorageLevel.MEMORY_AND_DISK)
            _cached.append(stats)
        for name, build in KPI_VIEWS.items():
            view(name, build(stats))
    if alert_history is not None:
        view(ALERTS_TABLE, alert_history)
        view(ALERT_SUMMARY_VIEW, al.alert_summary_patient_day(alert_history))
        view(ALERT_STATS_VIEW, al.alert_stats_by_signal(alert_history))
    return names
