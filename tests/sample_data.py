"""A small sample made here: patients, sensors and observations as delimited text, and what
the pipeline must make of them, worked out in plain Python.

Values are drawn with a fixed seed; no value lies on a threshold.
"""

from __future__ import annotations

import random
import tempfile
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

from vigilo import schemas
from vigilo.sources.reference_tables import THRESHOLD_ROWS

SMALL_SF = "/root/testdata/sf0.001"
DAY = "2025-03-04"
PATIENTS, SENSORS, OBSERVATIONS = 40, 15, 96
# a city in each governorate looked up, one contained in a name, unknown ones
TOWNS = ["Sfax", "Tunis", "Médenine", "kef", "Oslo", "", "Ben Arous", "Gabès"]
_VITALS = {"frequence_cardiaque": 8, "spo2": 9, "temperature_C": 5, "tension_systolique": 6,
           "tension_diastolique": 7, "glycemie": 11, "frequence_respiratoire": 10}


@cache
def patients() -> list[list]:
    r = random.Random(3)
    return [[f"PAT{i:04d}", f"Nom {i}", 66 + r.randrange(25), "FM"[i % 2], TOWNS[i % len(TOWNS)],
             r.choice(["Asthme", "Arthrose", "Anémie"]), f"Dr. {'ABCD'[i % 4]}", f"2160000{i:04d}", "2024-02-03"]
            for i in range(1, PATIENTS + 1)]


@cache
def sensors() -> list[list]:
    r = random.Random(4)
    return [[f"CAPT{i:03d}", "Bracelet", "Fabricant", "2024-01-01", 5 if i % 7 == 0 else 25 + r.randrange(70),
             "En maintenance" if i % 5 == 0 else "Actif", 5] for i in range(1, SENSORS + 1)]


@cache
def observations() -> list[list]:
    """Rows in the order of the observation schema; ids as on the wire (``P007``)."""
    r, out = random.Random(5), []
    for i in range(1, OBSERVATIONS + 1):
        ill = i % 8 in (3, 5)
        odd = lambda lo, hi, d: round(r.uniform(lo, hi), d)
        temp, glucose = odd(36.2, 37.7, 1), odd(0.75, 1.05, 2)
        spo2, rate, breath = odd(95.1, 99.8, 1), r.randint(62, 98), r.randint(13, 19)
        systolic, diastolic = r.randint(92, 138), r.randint(62, 88)
        if ill:
            temp, glucose, spo2 = odd(38.6, 40.4, 1), odd(1.2, 2.8, 2), odd(86.1, 93.8, 1)
            rate, breath, systolic, diastolic = r.randint(31, 145), r.randint(22, 34), r.randint(141, 195), r.randint(91, 118)
        hour = f"{8 + i // 60:02d}:{i % 60:02d}:00"
        out.append([f"RT_{i:05d}", f"P{1 + i % 8:03d}", f"{DAY}T{hour}", DAY, hour, temp, systolic, diastolic, rate, spo2,
                    breath, glucose, odd(55, 90, 1), odd(18, 30, 1), r.randrange(9000), odd(4, 9, 1), r.randrange(11),
                    f"CAP{1 + i % 12:03d}", ["bon", "moyen", "mauvais", "bon"][i % 4], "smartwatch"])
    return out


@cache
def files() -> Path:
    """A folder with the three tables as text, header first."""
    folder = Path(tempfile.mkdtemp(prefix="vigilo-sample-"))
    for name, schema, rows, sep in (("patients.csv", schemas.PATIENTS, patients(), ";"),
                                    ("sensors.csv", schemas.SENSORS, sensors(), ";"),
                                    ("observations.csv", schemas.OBSERVATIONS, observations(), ",")):
        lines = [sep.join(schema.fieldNames())] + [sep.join('""' if v == "" else str(v) for v in row) for row in rows]
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return folder


def sample(name: str) -> str:
    return str(files() / name)


@cache
def alerts() -> list[tuple[str, str, str]]:
    """(measurement, signal, level) of every abnormal value."""
    out = []
    for row in observations():
        for signal, w_min, w_max, c_min, c_max, _, _ in THRESHOLD_ROWS:
            v = row[_VITALS[signal]]
            if v < c_min or v > c_max:
                out.append((row[0], signal, "CRITIQUE"))
            elif v < w_min or v > w_max:
                out.append((row[0], signal, "WARNING"))
    return out


def level_of(measurement: str) -> str:
    found = {level for m, _, level in alerts() if m == measurement}
    return "CRITIQUE" if "CRITIQUE" in found else "WARNING" if found else "NORMAL"


def levels() -> dict[str, int]:
    return dict(Counter(level_of(row[0]) for row in observations()))


def latest_levels() -> dict[str, str]:
    last = {}
    for row in observations():
        last["PAT0" + row[1][1:]] = level_of(row[0])
    return last


def monitored() -> int:
    return len({row[1] for row in observations()})


@cache
def kept() -> list[list]:
    """Observations that pass the batch job's filters and joins."""
    good = {s[0] for s in sensors() if s[5] == "Actif" and s[4] >= 20}
    return [r for r in observations() if r[18] != "mauvais" and "CAPT" + r[17][3:] in good]


@cache
def kpis() -> dict[str, dict]:
    """Per patient the statistics of the day."""
    groups = defaultdict(list)
    for row in kept():
        groups["PAT0" + row[1][1:]].append(row)
    out = {}
    for patient, rows in groups.items():
        n = len(rows)
        mean = lambda k: sum(r[k] for r in rows) / n  # noqa: E731, B023
        count = lambda f: sum(map(f, rows))  # noqa: E731, B023
        systolic, diastolic, spo2 = mean(6), mean(7), mean(9)
        fast, slow = count(lambda r: r[8] > 100), count(lambda r: r[8] < 60)
        low, very_low = count(lambda r: r[9] < 94), count(lambda r: r[9] < 90)
        far = sum(abs(r[8] - 75) / 75 for r in rows) / n
        grade = next((g for s, d, g in ((180, 110, "HTA grade 3 (sévère)"), (160, 100, "HTA grade 2 (modérée)"),
                                        (140, 90, "HTA grade 1 (légère)"), (130, 85, "Pré-hypertension"))
                      if systolic >= s or diastolic >= d), "Normale")
        out[patient] = {
            "nb_mesures": n, "moy_fc_bpm": mean(8), "moy_fr_rpm": mean(10), "moy_glycemie_gL": mean(11),
            "moy_temperature_C": mean(5), "moy_spo2_pct": spo2, "moy_systolique_mmHg": systolic,
            "moy_diastolique_mmHg": diastolic,
            "taux_hypertension_pct": 100 * count(lambda r: r[6] >= 140 or r[7] >= 90) / n, "classification_oms": grade,
            "score_stabilite_cardiaque": max(0, 100 - 500 * fast / n - 500 * slow / n - (20 if far > 0.3 else 0)),
            "nb_tachycardie": fast, "nb_bradycardie": slow, "nb_episodes_hypoxie": low,
            "nb_episodes_hypoxie_critique": very_low,
            "nb_detresse_respiratoire": count(lambda r: r[9] < 94 and r[10] > 20),
            "niveau_oxygenation": "CRITIQUE" if spo2 < 90 or very_low else
                                  "ATTENTION" if spo2 < 94 or low / n > 0.3 else "NORMAL",
        }
    return out
