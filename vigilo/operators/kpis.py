"""Patient-day KPIs 1–4, the dashboard view and the row-count check
(A1–A4, J3, A12, U1).

All four KPIs group the same rows by the same keys, so they are computed in
ONE aggregation; each KPI and the dashboard view are projections of it (no
four-way self join, one shuffle).

Two plans produce the same table:

* ``patient_day_stats(enriched)`` — the reference shape: group the stored
  36-column enriched table by (patient, name, age, disease, date). Partial
  aggregation runs map-side, so a hot patient costs one partial row per task.
* ``patient_day_stats_from_sources(signals, sensors, patients)`` — aggregate
  first: measurements are reduced to (patient, date) partial states before
  any shuffle, and only those aggregates meet the patient table. A patient
  row that occurs ``m`` times multiplies counts and sums by ``m`` and leaves
  averages, extrema and the population deviation unchanged, which is exactly
  what joining first and grouping afterwards yields.

Grouping keys are five columns; the dashboard view is keyed by (patient, date).
When a patient id carries one attribute set (always true for unique patient
ids) the single pass equals the reference's four-way join; with several
attribute sets for one id we emit one row per set instead of every
combination across the four tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.operators import enrich, quality

GROUP_KEYS = ["patient_id", "nom", "age", "maladie_chronique", "date_mesure"]

# ---------------------------------------------------------------------------
# Fixed values of the KPI rules.
# WHO blood-pressure grades on the day's average pressures, first match wins
# (systolic OR diastolic at or above the pair):
OMS_GRADES = [
    (180, 110, "HTA grade 3 (sévère)"),
    (160, 100, "HTA grade 2 (modérée)"),
    (140, 90, "HTA grade 1 (légère)"),
    (130, 85, "Pré-hypertension"),
]
OMS_NORMAL = "Normale"
# Cardiac stability: score = max(0, 100 - 5·rate·100 per tachycardia and per
# bradycardia rate, - 20 if mean deviation > 0.3); status by episode share.
SCORE_START, EPISODE_WEIGHT, PERCENT = 100.0, 5.0, 100.0
DEVIATION_LIMIT, DEVIATION_PENALTY = 0.3, 20.0
UNSTABLE_ABOVE, WATCH_ABOVE = 0.5, 0.2
CARDIAC_LABELS = ("Instable", "Attention", "Stable")
# Oxygenation level: CRITIQUE if mean SpO2 < 90 or any critical episode;
# ATTENTION if mean SpO2 < 94 or hypoxia share > 0.3; else NORMAL.
O2_CRITICAL_MEAN, O2_WATCH_MEAN, O2_WATCH_SHARE = 90.0, 94.0, 0.3
O2_LABELS = ("CRITIQUE", "ATTENTION", "NORMAL")
# Respiratory distress: hypoxia with respiration above 20.
DISTRESS_RESPIRATION_ABOVE = 20
# ---------------------------------------------------------------------------

# Stats columns that scale with the multiplicity of a patient row.
_ADDITIVE = ["n", "s_hta", "s_tachy", "s_brady", "s_hypox", "s_hypox_crit", "s_detresse"]


def _stats_aggs() -> list[Column]:
    """Algebraic aggregates (partial/final capable) over enriched-named rows."""
    d = lambda c: F.col(c).cast("double")
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg("frequence_cardiaque").alias("avg_fc"),
        F.min("frequence_cardiaque").alias("min_fc"),
        F.max("frequence_cardiaque").alias("max_fc"),
        F.stddev_pop(d("frequence_cardiaque")).alias("sd_fc"),
        F.avg("frequence_respiratoire").alias("avg_fr"),
        F.min("frequence_respiratoire").alias("min_fr"),
        F.max("frequence_respiratoire").alias("max_fr"),
        F.avg(d("glycemie")).alias("avg_gly"),
        F.min("glycemie").alias("min_gly"),
        F.max("glycemie").alias("max_gly"),
        F.avg(d("temperature_C")).alias("avg_temp"),
        F.avg(d("spo2")).alias("avg_spo2"),
        F.min("spo2").alias("min_spo2"),
        F.avg("score_douleur").alias("avg_douleur"),
        F.avg("tension_systolique").alias("avg_sys"),
        F.avg("tension_diastolique").alias("avg_dia"),
        F.max("tension_systolique").alias("max_sys"),
        F.max("tension_diastolique").alias("max_dia"),
        F.sum("flag_hypertension").alias("s_hta"),
        F.sum("flag_tachycardie").alias("s_tachy"),
        F.sum("flag_bradycardie").alias("s_brady"),
        F.avg(d("ecart_fc_normale")).alias("avg_ecart"),
        F.sum("flag_hypoxie").alias("s_hypox"),
        F.sum("flag_hypoxie_critique").alias("s_hypox_crit"),
        F.sum(F.when((F.col("flag_hypoxie") == 1)
                     & (F.col("frequence_respiratoire") > DISTRESS_RESPIRATION_ABOVE), 1)
              .otherwise(0)).alias("s_detresse"),
        F.avg(d("indice_oxygenation")).alias("avg_indice"),
    ]


def patient_day_stats(enriched_df: DataFrame) -> DataFrame:
    """One row per group of the five keys with every statistic the KPIs need."""
    return enriched_df.groupBy(*GROUP_KEYS).agg(*_stats_aggs())


#: Measurements per patient and day from which aggregating before the join shuffles less
#: (measured: 2.3 times more at 2, 2.4 times less at 40; the middle of the two on a log scale).
DENSE = 9.0


def readings_per_patient_day(signals: DataFrame) -> float:
    """Measurements per patient and day, from a distinct-count sketch: one pass over two
    columns with one small sketch per task, no shuffle of rows."""
    n, groups = signals.agg(F.count(F.lit(1)), F.approx_count_distinct(F.struct("patient_id", "date"), rsd=0.05)).first()
    return n / max(groups, 1)


def patient_day_stats_from_sources(signals: DataFrame, sensors: DataFrame,
                                   patients: DataFrame, aggregate_first: bool | None = True) -> DataFrame:
    """Patient-day statistics straight from the sources.

    ``aggregate_first=None`` chooses by ``readings_per_patient_day`` (a job now).
    ``True`` (default): measurements are reduced to (patient, day)
    states before any shuffle and only those meet the patient table — the plan for
    dense telemetry and hot patients. ``False``: join, then group by the five keys
    (one shuffle of raw rows, which suits sparse data: a few readings per
    patient-day; measured in PLANS.md). Both give the same table."""
    if aggregate_first is None:
        aggregate_first = readings_per_patient_day(signals) >= DENSE
    if not aggregate_first:
        return patient_day_stats(enrich.enriched(signals, sensors, patients))
    per_day = (enrich.measurements_for_kpis(signals, sensors)
               .groupBy("patient_id", "date_mesure").agg(*_stats_aggs()))
    people = (quality.drop_header_rows(patients, "patient_id")
              .groupBy("patient_id", "nom", "age", "maladie_chronique")
              .agg(F.count(F.lit(1)).alias("_m")))
    j = per_day.join(people, "patient_id", "inner")
    scaled = {c: (F.col(c) * F.col("_m")).alias(c) for c in _ADDITIVE}
    out = [scaled.get(c, F.col(c)) for c in per_day.columns if c not in ("patient_id", "date_mesure")]
    return j.select(*[F.col(k) for k in GROUP_KEYS], *out)


def _kpi_columns(st: DataFrame) -> dict[str, Column]:
    n = F.col("n")
    dbl = lambda c: F.col(c).cast("double")
    rate = lambda s: dbl(s) * PERCENT / n
    avg_sys, avg_dia = F.col("avg_sys"), F.col("avg_dia")
    oms = None
    for sys_min, dia_min, label in OMS_GRADES:
        cond = (avg_sys >= sys_min) | (avg_dia >= dia_min)
        oms = F.when(cond, label) if oms is None else oms.when(cond, label)
    oms = oms.otherwise(OMS_NORMAL)
    score = F.round(F.greatest(
        F.lit(0.0),
        F.lit(SCORE_START)
        - (dbl("s_tachy") * EPISODE_WEIGHT / n) * PERCENT
        - (dbl("s_brady") * EPISODE_WEIGHT / n) * PERCENT
        - F.when(F.col("avg_ecart") > DEVIATION_LIMIT, DEVIATION_PENALTY).otherwise(0.0)), 2)
    unstable = (dbl("s_tachy") + dbl("s_brady")) * 1.0 / n
    statut = (F.when(unstable > UNSTABLE_ABOVE, CARDIAC_LABELS[0])
              .when(unstable > WATCH_ABOVE, CARDIAC_LABELS[1]).otherwise(CARDIAC_LABELS[2]))
    niveau_o2 = (
        F.when((F.col("avg_spo2") < O2_CRITICAL_MEAN) | (F.col("s_hypox_crit") > 0), O2_LABELS[0])
        .when((F.col("avg_spo2") < O2_WATCH_MEAN) | (dbl("s_hypox") * 1.0 / n > O2_WATCH_SHARE),
              O2_LABELS[1])
        .otherwise(O2_LABELS[2])
    )
    r2 = lambda c: F.round(F.col(c), 2)
    return {
        "nb_mesures": n,
        # KPI 1
        "moy_fc_bpm": r2("avg_fc"), "min_fc_bpm": F.col("min_fc"), "max_fc_bpm": F.col("max_fc"),
        "moy_fr_rpm": r2("avg_fr"), "min_fr_rpm": F.col("min_fr"), "max_fr_rpm": F.col("max_fr"),
        "moy_glycemie_gL": F.round("avg_gly", 3),
        "min_glycemie_gL": F.round(dbl("min_gly"), 3),
        "max_glycemie_gL": F.round(dbl("max_gly"), 3),
        "moy_temperature_C": r2("avg_temp"), "moy_spo2_pct": r2("avg_spo2"),
        "moy_score_douleur": r2("avg_douleur"),
        # KPI 2
        "moy_systolique_mmHg": r2("avg_sys"), "moy_diastolique_mmHg": r2("avg_dia"),
        "max_systolique_mmHg": F.col("max_sys"), "max_diastolique_mmHg": F.col("max_dia"),
        "nb_mesures_hta": F.col("s_hta"), "taux_hypertension_pct": F.round(rate("s_hta"), 2),
        "classification_oms": oms,
        # KPI 3
        "moy_fc": r2("avg_fc"), "stddev_fc": r2("sd_fc"),
        "nb_tachycardie": F.col("s_tachy"), "nb_bradycardie": F.col("s_brady"),
        "moy_ecart_fc": F.round("avg_ecart", 4), "score_stabilite_cardiaque": score,
        "statut_cardiaque": statut,
        # KPI 4
        "min_spo2_pct": F.round(dbl("min_spo2"), 2),
        "nb_episodes_hypoxie": F.col("s_hypox"),
        "nb_episodes_hypoxie_critique": F.col("s_hypox_crit"),
        "taux_hypoxie_pct": F.round(rate("s_hypox"), 2),
        "nb_detresse_respiratoire": F.col("s_detresse"),
        "indice_oxygenation_moy": F.round("avg_indice", 4),
        "niveau_oxygenation": niveau_o2,
    }


KPI1 = ["nb_mesures", "moy_fc_bpm", "min_fc_bpm", "max_fc_bpm", "moy_fr_rpm", "min_fr_rpm",
        "max_fr_rpm", "moy_glycemie_gL", "min_glycemie_gL", "max_glycemie_gL",
        "moy_temperature_C", "moy_spo2_pct", "moy_score_douleur"]
KPI2 = ["nb_mesures", "moy_systolique_mmHg", "moy_diastolique_mmHg", "max_systolique_mmHg",
        "max_diastolique_mmHg", "nb_mesures_hta", "taux_hypertension_pct", "classification_oms"]
KPI3 = ["nb_mesures", "moy_fc", "stddev_fc", "nb_tachycardie", "nb_bradycardie", "moy_ecart_fc",
        "score_stabilite_cardiaque", "statut_cardiaque"]
KPI4 = ["nb_mesures", "moy_spo2_pct", "min_spo2_pct", "moy_fr_rpm", "nb_episodes_hypoxie",
        "nb_episodes_hypoxie_critique", "taux_hypoxie_pct", "nb_detresse_respiratoire",
        "indice_oxygenation_moy", "niveau_oxygenation"]
VIEW = ["nb_mesures", "moy_fc_bpm", "moy_fr_rpm", "moy_glycemie_gL", "moy_temperature_C",
        "moy_spo2_pct", "moy_systolique_mmHg", "moy_diastolique_mmHg", "taux_hypertension_pct",
        "classification_oms", "score_stabilite_cardiaque", "statut_cardiaque", "nb_tachycardie",
        "nb_bradycardie", "indice_oxygenation_moy", "niveau_oxygenation", "nb_episodes_hypoxie",
        "nb_detresse_respiratoire"]

# Presentation order of each reference table (applied only when asked: a
# table has no order, and sorting before a write is a wasted global shuffle).
def presentation_order(kpi: str) -> list[Column]:
    """Reference ORDER BY of each KPI table."""
    return {
        "kpi1": [F.col("patient_id"), F.col("date_mesure")],
        "kpi2": [F.col("taux_hypertension_pct").desc()],
        "kpi3": [F.col("score_stabilite_cardiaque").asc()],
        "kpi4": [F.col("indice_oxygenation_moy").asc()],
    }[kpi]


def project(stats: DataFrame, cols: list[str]) -> DataFrame:
    k = _kpi_columns(stats)
    return stats.select(*[F.col(c) for c in GROUP_KEYS], *[k[c].alias(c) for c in cols])


def kpi1_daily_vitals(stats: DataFrame) -> DataFrame:
    return project(stats, KPI1)


def kpi2_hypertension(stats: DataFrame) -> DataFrame:
    return project(stats, KPI2)


def kpi3_cardiac_stability(stats: DataFrame) -> DataFrame:
    return project(stats, KPI3)


def kpi4_oxygenation(stats: DataFrame) -> DataFrame:
    return project(stats, KPI4)


def dashboard_view(stats: DataFrame) -> DataFrame:
    """Patient-day dashboard (23 columns) as a projection of the single pass."""
    return project(stats, VIEW)


def all_kpis(stats: DataFrame) -> DataFrame:
    """Every KPI column of the four tables in one row per group."""
    cols = list(dict.fromkeys(KPI1 + KPI2 + KPI3 + KPI4))
    return project(stats, cols)


def table_row_counts(stats: DataFrame, enriched_df: DataFrame | None = None) -> DataFrame:
    """Row count per table, labelled, as a union of five counts.

    Every enriched row falls in exactly one KPI group, so without an explicit
    ``enriched_df`` its count is the sum of ``nb_mesures`` over the shared
    aggregation; the four KPI counts prune to the same grouping, so all five
    branches reuse one shuffle.
    """
    def cnt(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("nb_lignes")).select(
            F.lit(label).alias("table_name"), "nb_lignes")

    if enriched_df is not None:
        first = cnt("mesures_patients", enriched_df)
    else:
        first = stats.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("nb_lignes")).select(
            F.lit("mesures_patients").alias("table_name"), "nb_lignes")
    # each KPI table is a projection of ``stats`` (one row per group)
    groups = stats.select(*GROUP_KEYS)
    parts = [first] + [cnt(label, groups) for label in (
        "kpi1_moyennes_vitaux", "kpi2_hypertension", "kpi3_stabilite_cardiaque", "kpi4_oxygenation")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stored_counts(tables: dict[str, list[DataFrame]]) -> DataFrame:
    """Row count of each stored table, labelled (A12, U1): a table that wasn't written shows.

    A table is given as its scans (one per write that counts), each counted by itself: with a
    session of ``files.footer_session`` the counts come from the Parquet footers."""
    out = None
    for name, scans in tables.items():
        counts = None
        for df in scans:
            one = df.agg(F.count(F.lit(1)).alias("n"))
            counts = one if counts is None else counts.unionByName(one)
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("nb_lignes"))
        row = total.select(F.lit(name).alias("table_name"), "nb_lignes")
        out = row if out is None else out.unionByName(row)
    return out
