"""Adapter: the driver's generated tables → the domain tables.

``/root/testdata/sf*/`` holds no vitals, so measurements, patients and sensors
are derived from ``events``, ``customer`` and ``supplier`` by integer
arithmetic that Spark and DuckDB evaluate identically. The expressions are
kept as SQL text with two dialect hooks (zero padding and date formatting),
so the Spark plan and the oracle SQL read the very same inputs.

All derivations are row-wise projections of a single scan: no join, no
shuffle; the scan is pruned to the columns a query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilo.sources.reference_tables import CENTRE_ROWS

# Cities of patients: the governorates of the health centres (fixed values that the nearest
# centre is looked up by), a longer and a shorter form of two of them, one elsewhere, none.
CITIES = [*dict.fromkeys(row[3] for row in CENTRE_ROWS), "Grand " + CENTRE_ROWS[0][3],
          CENTRE_ROWS[17][3].split()[-1], "Oslo", ""]
# Free choices.
DOCTORS = ["Dr. Amri", "Dr. Belhaj", "Dr. Chebbi", "Dr. Dridi", "Dr. Essid", "Dr. Ferchichi"]
SENSOR_TYPES = ["Bracelet", "Patch thoracique", "Ceinture", "Bague", "Brassard"]
MAKERS = ["Alpha", "Bêta", "Gamma", "Delta", "Epsilon"]
FREQUENCIES = [2, 4, 8, 20, 45]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, values) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {_q(v) if isinstance(v, str) else v}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


class Dialect:
    """SQL spelling differences between Spark and DuckDB."""

    def __init__(self, name: str):
        self.name = name

    def zfill(self, expr: str, width: int) -> str:
        s = f"CAST({expr} AS {'STRING' if self.name == 'spark' else 'VARCHAR'})"
        return f"(CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END)"

    def fmt_ts(self, expr: str, kind: str) -> str:
        if self.name == "spark":
            pat = {"timestamp": "yyyy-MM-dd'T'HH:mm:ss", "date": "yyyy-MM-dd",
                   "heure": "HH:mm:ss"}[kind]
            return f"date_format({expr}, {_q(pat)})"
        pat = {"timestamp": "%Y-%m-%dT%H:%M:%S", "date": "%Y-%m-%d", "heure": "%H:%M:%S"}[kind]
        return f"strftime({expr}, {_q(pat)})"

    def date_plus(self, start: str, days_expr: str) -> str:
        if self.name == "spark":
            return f"date_format(date_add(DATE {_q(start)}, CAST({days_expr} AS INT)), 'yyyy-MM-dd')"
        return f"strftime(DATE {_q(start)} + CAST({days_expr} AS INTEGER), '%Y-%m-%d')"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _tenth(expr: str, div: int = 10) -> str:
    return f"CAST(CAST({expr} AS DOUBLE) / {div} AS FLOAT)"


def patient_exprs(d: Dialect) -> list[tuple[str, str]]:
    c = "c_custkey"
    return [
        ("patient_id", f"'PAT' || {d.zfill(c, 4)}"),
        ("nom", "c_name"),
        ("age", f"CAST(65 + {c} % 30 AS INT)"),
        ("sexe", f"CASE WHEN {c} % 2 = 0 THEN 'F' ELSE 'M' END"),
        ("ville", _case(f"{c} % {len(CITIES)}", CITIES)),
        ("maladie_chronique", "c_mktsegment"),
        ("medecin_referent", _case(f"{c} % 6", DOCTORS)),
        ("numero_urgence", f"'216' || lpad(CAST(({c} * 7919) % 100000000 AS {'STRING' if d.name == 'spark' else 'VARCHAR'}), 8, '0')"),
        ("date_inscription", d.date_plus("2022-01-01", f"{c} % 720")),
    ]


def sensor_exprs(d: Dialect) -> list[tuple[str, str]]:
    k = "s_suppkey"
    return [
        ("capteur_id", f"'CAPT' || {d.zfill(k, 3)}"),
        ("type_capteur", _case(f"{k} % 5", SENSOR_TYPES)),
        ("fabricant", _case(f"({k} * 3) % 5", MAKERS)),
        ("date_installation", d.date_plus("2022-01-13", f"{k} % 480")),
        ("batterie_pct", f"CAST(({k} * 37) % 100 AS INT)"),
        ("statut_capteur", f"CASE {k} % 10 WHEN 3 THEN 'En maintenance' WHEN 7 THEN 'Défaillant' ELSE 'Actif' END"),
        ("frequence_mesure_min", f"CAST({_case(f'{k} % 5', FREQUENCIES)} AS INT)"),
    ]


def _batch_pid(d: Dialect) -> str:
    return f"'PAT' || {d.zfill('user_id + 1', 4)}"


def signal_exprs(d: Dialect, stream_ids: bool = False) -> list[tuple[str, str]]:
    e = "event_id"
    pid = _batch_pid(d)
    if stream_ids:
        pid = (f"CASE WHEN {e} % 97 = 0 THEN 'ZZ' || CAST({e} AS {'STRING' if d.name == 'spark' else 'VARCHAR'}) "
               f"WHEN {e} % 2 = 0 THEN {pid} ELSE 'P' || {d.zfill('user_id + 1', 3)} END")
    return [
        ("mesure_id", f"'RT_' || {d.zfill(e, 6)}"),
        ("patient_id", pid),
        ("timestamp", d.fmt_ts("ts", "timestamp")),
        ("date", d.fmt_ts("ts", "date")),
        ("heure", d.fmt_ts("ts", "heure")),
        # on the wire in eighths: ties when an alert's value is rounded to two digits
        ("temperature_C", _tenth(f"276 + ({e} * 211) % 47", 8) if stream_ids else _tenth(f"345 + ({e} * 211) % 56")),
        ("tension_systolique_mmHg", f"CAST(70 + ({e} * 6151) % 125 AS INT)"),
        ("tension_diastolique_mmHg", f"CAST(44 + ({e} * 4093) % 75 AS INT)"),
        ("frequence_cardiaque_bpm", f"CAST(38 + ({e} * 7919) % 105 AS INT)"),
        ("spo2_pct", _tenth(f"860 + ({e} * 10007) % 145")),
        ("frequence_respiratoire_rpm", f"CAST(7 + ({e} * 1031) % 26 AS INT)"),
        ("glycemie_g_L", f"CASE WHEN {e} % 41 = 0 THEN NULL ELSE {_tenth(f'45 + ({e} * 613) % 220', 100)} END"),
        ("poids_kg", _tenth(f"550 + ({e} * 37) % 350")),
        ("imc", _tenth(f"180 + ({e} * 53) % 150")),
        ("activite_physique_steps", f"CAST(({e} * 97) % 12000 AS INT)"),
        ("duree_sommeil_h", _tenth(f"40 + ({e} * 7) % 60")),
        ("score_douleur_0_10", f"CASE WHEN {e} % 29 = 0 THEN NULL ELSE CAST(({e} * 3) % 11 AS INT) END"),
        # two sensors to three users at every scale
        ("capteur_id", f"'CAPT' || {d.zfill('CAST(floor(user_id * 2 / 3) AS BIGINT)', 3)}"),
        ("qualite_signal", f"CASE WHEN {e} % 53 = 0 THEN NULL WHEN {e} % 9 = 0 THEN 'mauvais' "
                           f"WHEN {e} % 4 = 0 THEN 'moyen' ELSE 'bon' END"),
    ]


def observation_exprs(d: Dialect) -> list[tuple[str, str]]:
    """Replayable observations: signals with raw (un-normalised) stream patient ids
    plus ``source``."""
    return signal_exprs(d, stream_ids=True) + [("source", "'smartwatch'")]


def _select_sql(exprs) -> str:
    return ",\n    ".join(f"{x} AS {n}" for n, x in exprs)


# ---------------------------------------------------------------- Spark side

# Declared schemas of the driver tables (the columns the adapter reads): no
# footer inference when a query is defined.
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "supplier": "s_suppkey bigint",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").selectExpr(*[f"{x} AS {n}" for n, x in patient_exprs(SPARK)])


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").selectExpr(*[f"{x} AS {n}" for n, x in sensor_exprs(SPARK)])


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").selectExpr(*[f"{x} AS {n}" for n, x in signal_exprs(SPARK)])


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").selectExpr(*[f"{x} AS {n}" for n, x in observation_exprs(SPARK)])


def events_as_observations(events: DataFrame) -> DataFrame:
    """Same projection over an arbitrary (e.g. streaming) ``events`` DataFrame."""
    return events.selectExpr(*[f"{x} AS {n}" for n, x in observation_exprs(SPARK)])


# ---------------------------------------------------------------- DuckDB side

def duck_ctes() -> str:
    """CTEs ``patients, sensors, signals, observations`` over the pre-registered views."""
    return (
        "patients AS (SELECT\n    " + _select_sql(patient_exprs(DUCK)) + "\nFROM customer),\n"
        "sensors AS (SELECT\n    " + _select_sql(sensor_exprs(DUCK)) + "\nFROM supplier),\n"
        "signals AS (SELECT\n    " + _select_sql(signal_exprs(DUCK)) + "\nFROM events),\n"
        "observations AS (SELECT\n    " + _select_sql(observation_exprs(DUCK)) + "\nFROM events)"
    )
