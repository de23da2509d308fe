"""KPI rules on hand-made enriched rows: grade edges, penalties, clamps."""

import pytest

from vigilo import schemas
from vigilo.functions.vitals import derived_map
from vigilo.operators import kpis


def enriched_rows(spark, days):
    """days: list of (patient, [(sys, dia, fc, spo2, fr), ...]) → enriched DataFrame."""
    rows = []
    n = 0
    for pid, meas in days:
        for sys_, dia, fc, spo2, fr in meas:
            n += 1
            rows.append({"mesure_id": f"M{n}", "patient_id": pid, "nom": pid, "age": 70, "sexe": "F",
                         "ville": "Sfax", "maladie_chronique": "x", "date_mesure": "2025-01-15",
                         "heure_mesure": "08:00:00", "temperature_C": 37.0, "tension_systolique": sys_,
                         "tension_diastolique": dia, "frequence_cardiaque": fc, "spo2": spo2,
                         "frequence_respiratoire": fr, "glycemie": 0.9, "poids": 70.0, "imc": 25.0,
                         "steps": 1, "duree_sommeil": 7.0, "score_douleur": None, "batterie_pct": 50,
                         "qualite_signal": "bon", "type_capteur": "t"})
    base = [f for f in schemas.ENRICHED.fields if f.name in rows[0]]
    from pyspark.sql.types import StructType
    df = spark.createDataFrame([tuple(r[f.name] for f in base) for r in rows], StructType(base))
    d = derived_map(sys="tension_systolique", dia="tension_diastolique", fc="frequence_cardiaque",
                    spo2="spo2", temp="temperature_C", gly="glycemie", battery="batterie_pct")
    return df.select("*", *[c.alias(k) for k, c in d.items()])


def kpi(spark, days):
    st = kpis.patient_day_stats(enriched_rows(spark, days))
    return {r["patient_id"]: r for r in kpis.all_kpis(st).collect()}


@pytest.mark.parametrize("sys_,dia,label", [
    (180, 70, "HTA grade 3 (sévère)"), (120, 110, "HTA grade 3 (sévère)"),
    (179, 109, "HTA grade 2 (modérée)"), (160, 60, "HTA grade 2 (modérée)"),
    (140, 60, "HTA grade 1 (légère)"), (100, 90, "HTA grade 1 (légère)"),
    (130, 60, "Pré-hypertension"), (100, 85, "Pré-hypertension"), (129, 84, "Normale"),
])
def test_who_grade_edges(spark, sys_, dia, label):
    r = kpi(spark, [("A", [(sys_, dia, 75, 97.0, 16)])])["A"]
    assert r["classification_oms"] == label


def test_grade_uses_unrounded_average(spark):
    # averages 139.5 / 89.5 stay below grade 1 (140 / 90) although one reading is at it
    r = kpi(spark, [("A", [(139, 89, 75, 97.0, 16), (140, 90, 75, 97.0, 16)])])["A"]
    assert r["moy_systolique_mmHg"] == 139.5 and r["classification_oms"] == "Pré-hypertension"
    assert r["taux_hypertension_pct"] == 50.0
    r = kpi(spark, [("B", [(139, 89, 75, 97.0, 16), (139, 89, 75, 97.0, 16)])])["B"]
    assert r["classification_oms"] == "Pré-hypertension"
    assert r["taux_hypertension_pct"] == 0.0


def test_cardiac_score_penalties_and_clamp(spark):
    res = kpi(spark, [
        ("calm", [(120, 80, 75, 97.0, 16)] * 10),                                   # 100
        ("one_tachy", [(120, 80, 101, 97.0, 16)] + [(120, 80, 75, 97.0, 16)] * 9),  # 100 - 50 = 50
        ("drift", [(120, 80, 100, 97.0, 16)] * 4),                                  # |100-75|/75 > 0.3 -> 80
        ("wild", [(120, 80, 140, 97.0, 16)] * 3),                                   # clamp at 0
    ])
    assert res["calm"]["score_stabilite_cardiaque"] == 100.0 and res["calm"]["statut_cardiaque"] == "Stable"
    assert res["one_tachy"]["score_stabilite_cardiaque"] == 50.0
    assert res["one_tachy"]["statut_cardiaque"] == "Stable"          # 10 % episodes
    assert res["drift"]["score_stabilite_cardiaque"] == 80.0
    assert res["wild"]["score_stabilite_cardiaque"] == 0.0 and res["wild"]["statut_cardiaque"] == "Instable"
    assert res["wild"]["stddev_fc"] == 0.0


def test_oxygenation_levels_and_distress(spark):
    res = kpi(spark, [
        ("crit_episode", [(120, 80, 75, 89.9, 16)] + [(120, 80, 75, 99.0, 16)] * 9),
        ("low_mean", [(120, 80, 75, 93.0, 16)] * 2),
        ("share", [(120, 80, 75, 93.5, 22)] * 4 + [(120, 80, 75, 99.5, 16)] * 6),
        ("ok", [(120, 80, 75, 96.0, 25)] * 3),
    ])
    assert res["crit_episode"]["niveau_oxygenation"] == "CRITIQUE"
    assert res["low_mean"]["niveau_oxygenation"] == "ATTENTION"
    assert res["share"]["niveau_oxygenation"] == "ATTENTION"        # 40 % hypoxia > 30 %
    assert res["share"]["nb_detresse_respiratoire"] == 4 and res["share"]["taux_hypoxie_pct"] == 40.0
    assert res["ok"]["niveau_oxygenation"] == "NORMAL" and res["ok"]["nb_detresse_respiratoire"] == 0
    assert res["low_mean"]["indice_oxygenation_moy"] == 0.3
