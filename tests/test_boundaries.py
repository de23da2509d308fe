"""Hand-made boundary, null and malformed rows."""

import math

import pytest
from pyspark.sql import functions as F

from vigilo import schemas
from vigilo.functions.ids import normalise_patient_id
from vigilo.functions.vitals import SIGNAL_COLUMNS, derived_columns
from vigilo.operators import alerts as al
from vigilo.operators import profiles
from vigilo.sources import reference_tables as ref
from vigilo.sources.stream import decode_messages, encode_messages

NORMAL_VITALS = {"frequence_cardiaque_bpm": 75, "spo2_pct": 97.0, "temperature_C": 37.0,
                 "tension_systolique_mmHg": 120, "tension_diastolique_mmHg": 75,
                 "glycemie_g_L": 0.9, "frequence_respiratoire_rpm": 16}


def message(i, **over):
    row = {"mesure_id": f"M{i}", "patient_id": "P001", "timestamp": f"2025-01-15T08:{i % 60:02d}:00",
           "date": "2025-01-15", "heure": f"08:{i % 60:02d}:00", "poids_kg": 70.0,
           "score_douleur_0_10": 1, "capteur_id": "CAPT001", "source": "smartwatch"}
    row.update(NORMAL_VITALS)
    row.update(over)
    return tuple(row[f.name] for f in schemas.MESSAGE.fields)


def levels(spark, rows):
    df = spark.createDataFrame(rows, schemas.MESSAGE)
    out = al.classify_levels(df, ref.thresholds(spark)).collect()
    return {(r["mesure_id"], r["signal"]): r["niveau"] for r in out}


BOUNDS = {r[0]: r[1:5] for r in ref.THRESHOLD_ROWS}
COL = dict(SIGNAL_COLUMNS)
INT_COLS = {"frequence_cardiaque_bpm", "tension_systolique_mmHg", "tension_diastolique_mmHg",
            "frequence_respiratoire_rpm"}


def _cases():
    """(signal, value, expected) for on / just inside / just outside each bound."""
    out = []
    for s, (wmin, wmax, cmin, cmax) in BOUNDS.items():
        step = 1 if COL[s] in INT_COLS else 0.1
        out += [(s, wmin, "NORMAL"), (s, wmax, "NORMAL"),
                (s, cmin, "WARNING" if cmin < wmin else "NORMAL"),
                (s, cmax, "WARNING" if cmax > wmax else "NORMAL"),
                (s, cmin - step, "CRITIQUE"), (s, cmax + step, "CRITIQUE")]
        if wmin - step > cmin:
            out.append((s, wmin - step, "WARNING"))
        if wmax + step < cmax:
            out.append((s, wmax + step, "WARNING"))
    return out


def test_threshold_bounds(spark):
    cases = _cases()
    rows = []
    for i, (s, v, _) in enumerate(cases):
        c = COL[s]
        rows.append(message(i, **{c: int(round(v)) if c in INT_COLS else float(v)}))
    got = levels(spark, rows)
    for i, (s, v, exp) in enumerate(cases):
        assert got[(f"M{i}", s)] == exp, (s, v)


def test_spo2_above_100_is_critical(spark):
    got = levels(spark, [message(0, spo2_pct=100.1), message(1, spo2_pct=100.0)])
    assert got[("M0", "spo2")] == "CRITIQUE" and got[("M1", "spo2")] == "NORMAL"


def test_float_glycaemia_stream_vs_batch(spark):
    # stream: float 0.70 equals the float bound -> NORMAL; batch: 0.7f < 0.70 (double) -> flagged
    got = levels(spark, [message(0, glycemie_g_L=0.70), message(1, glycemie_g_L=1.10)])
    assert got[("M0", "glycemie")] == "NORMAL" and got[("M1", "glycemie")] == "NORMAL"
    df = spark.createDataFrame([(0.70, 1.10)], "g1 float, g2 float")
    r = df.select(derived_columns(gly="g1")[7].alias("hypo"),
                  derived_columns(gly="g2")[8].alias("hyper")).first()
    assert r["hypo"] == 1 and r["hyper"] == 1


def test_batch_hypertension_inclusive_stream_strict(spark):
    df = spark.createDataFrame([(140, 80), (139, 90), (139, 89)], "s int, d int")
    flags = [r[0] for r in df.select(derived_columns(sys="s", dia="d")[1]).collect()]
    assert flags == [1, 1, 0]
    got = levels(spark, [message(0, tension_systolique_mmHg=140, tension_diastolique_mmHg=80),
                         message(1, tension_systolique_mmHg=139, tension_diastolique_mmHg=90)])
    assert got[("M0", "tension_systolique")] == "NORMAL"
    assert got[("M1", "tension_diastolique")] == "NORMAL"


def test_null_and_nan_vitals_are_normal(spark):
    got = levels(spark, [message(0, spo2_pct=None, frequence_cardiaque_bpm=None),
                         message(1, spo2_pct=math.nan)])
    assert got[("M0", "spo2")] == "NORMAL" and got[("M0", "frequence_cardiaque")] == "NORMAL"
    assert got[("M1", "spo2")] == "NORMAL"
    df = spark.createDataFrame([message(0, spo2_pct=None, glycemie_g_L=None)], schemas.MESSAGE)
    assert al.alerts(df, ref.thresholds(spark)).count() == 0


def test_alert_record_fields(spark):
    df = spark.createDataFrame([message(0, frequence_cardiaque_bpm=131, source=None),
                                message(1, spo2_pct=89.5, source="")], schemas.MESSAGE)
    a = {r["alerte_id"]: r for r in al.alerts(df, ref.thresholds(spark)).collect()}
    r = a["M0_frequence_cardiaque"]
    assert r["niveau_alerte"] == "CRITIQUE" and r["valeur_mesuree"] == 131.0
    assert r["unite"] == "bpm" and r["seuil_warn_min"] == 60.0 and r["source"] == "smartwatch"
    assert r["patient_id"] == "PAT0001"
    r = a["M1_spo2"]
    assert r["niveau_alerte"] == "CRITIQUE" and r["valeur_mesuree"] == 89.5
    assert r["source"] == "smartwatch"


@pytest.mark.parametrize("raw,expected", [
    ("P3", "PAT0003"), ("P12345", "PAT12345"), ("PAT0003", "PAT0003"), ("X9", "X9"),
    (None, None), ("P-1", "PAT-001"), ("P", "PAT0000"),
])
def test_normalise_patient_id(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "p string")
    assert df.select(normalise_patient_id(F.col("p"))).first()[0] == expected


def test_unknown_patient_fallbacks(spark):
    df = spark.createDataFrame([message(0, patient_id="ZZ7", tension_systolique_mmHg=None)],
                               schemas.MESSAGE)
    patients = spark.createDataFrame([], schemas.PATIENTS)
    u = profiles.patient_updates(al.with_alerts(df, ref.thresholds(spark)), patients).first()
    assert u["nom"] == "ZZ7" and u["age"] is None and u["age_affiche"] == "?"
    assert u["ville"] == "Inconnue" and u["maladie"] == "?" and u["tension"] == "None/75"


def test_nearest_centre_edge_cities(spark):
    rows = [("A", ""), ("B", None), ("C", "Kef"), ("D", "Grand Tunis"), ("E", "Paris"), ("F", "gabès")]
    p = spark.createDataFrame([(i, "n", 70, "F", v, "x", "d", "1", "2023-01-01") for i, v in rows],
                              schemas.PATIENTS)
    got = {r["patient_id"]: r["centre_id"] for r in profiles.nearest_centre(p, ref.centres(spark)).collect()}
    assert got == {"A": "C001", "B": "C001", "C": "C018", "D": "C001", "E": "C001", "F": "C014"}


def test_json_round_trip_and_malformed(spark):
    df = spark.createDataFrame([message(0), message(1, glycemie_g_L=None)], schemas.MESSAGE)
    back = decode_messages(encode_messages(df)).orderBy("mesure_id").collect()
    assert back[0]["glycemie_g_L"] == pytest.approx(0.9) and back[1]["glycemie_g_L"] is None
    raw = spark.createDataFrame([("{broken",), ('{"mesure_id":"M9","spo2_pct":"high"}',)], "value string")
    dec = decode_messages(raw).collect()
    assert all(v is None for v in dec[0].asDict().values())
    assert dec[1]["mesure_id"] == "M9" and dec[1]["spo2_pct"] is None


def test_encode_defaults_for_absent_columns(spark):
    df = spark.createDataFrame([("P001", "75"), ("P002", "x")], "patient_id string, frequence_cardiaque_bpm string")
    rows = decode_messages(encode_messages(df)).orderBy("mesure_id").collect()
    assert [r["mesure_id"] for r in rows] == ["RT_00000", "RT_00001"]
    assert rows[0]["frequence_cardiaque_bpm"] == 75 and rows[1]["frequence_cardiaque_bpm"] is None
    assert rows[0]["spo2_pct"] == 0.0 and rows[0]["capteur_id"] == "" and rows[0]["source"] == "smartwatch"


def test_missing_dimension_gives_empty_typed_frame(spark, tmp_path):
    from vigilo.sources import files
    df = files.load_optional(spark, str(tmp_path / "absent"), schemas.PATIENTS)
    assert df.count() == 0 and df.schema == schemas.PATIENTS
    msgs = spark.createDataFrame([message(0)], schemas.MESSAGE)
    u = profiles.patient_updates(al.with_alerts(msgs, ref.THRESHOLD_ROWS), df).first()
    assert u["nom"] == "PAT0001" and u["ville"] == "Inconnue"
    nc = profiles.nearest_centre(spark.createDataFrame([("A", "n", 70, "F", "Sfax", "x", "d", "1", "d")],
                                                       schemas.PATIENTS),
                                 files.load_optional(spark, str(tmp_path / "none"), schemas.CENTRES))
    assert nc.first()["centre_id"] is None


def test_nearest_centre_literal_equals_table(spark):
    cities = ["", None, "Kef", "Grand Tunis", "Paris", "gabès", "Sfax", "ARIANA", "ben arous", "x"]
    p = spark.createDataFrame([(str(i), "n", 70, "F", v, "x", "d", "1", "d") for i, v in enumerate(cities)],
                              schemas.PATIENTS)
    a = profiles.nearest_centre(p, ref.centres(spark)).orderBy("patient_id").collect()
    b = profiles.nearest_centre(p, ref.CENTRE_ROWS).orderBy("patient_id").collect()
    assert a == b


def test_decode_python_producer_format(spark):
    """Messages as a Python producer writes them (spaces, \\u escapes, ints for floats)."""
    import json
    msg = {"mesure_id": "RT_00001", "patient_id": "P001", "timestamp": "2025-01-15T08:00:00",
           "date": "2025-01-15", "heure": "08:00:00", "temperature_C": 36.5,
           "tension_systolique_mmHg": 109, "tension_diastolique_mmHg": 68, "frequence_cardiaque_bpm": 83,
           "spo2_pct": 98.7, "frequence_respiratoire_rpm": 17, "glycemie_g_L": 0.75, "poids_kg": 78,
           "score_douleur_0_10": 0, "capteur_id": "CAPé01", "source": "smartwatch"}
    raw = spark.createDataFrame([("P001", json.dumps(msg).encode("utf-8"))], "key string, value binary")
    r = decode_messages(raw).first()
    assert r["capteur_id"] == "CAPé01" and r["poids_kg"] == 78.0 and r["tension_systolique_mmHg"] == 109
    assert r["spo2_pct"] == pytest.approx(98.7) and r["source"] == "smartwatch"
