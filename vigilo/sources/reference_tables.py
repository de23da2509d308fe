"""Reference dimensions defined by literal rows: alert thresholds and health centres.

Both are small by construction (7 and 28 rows, code constants), which is the
size bound that lets every consumer broadcast them or fold them into a
single-row scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo import schemas

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's literal tables for right results).
# Thresholds: signal, warning min, warning max, critical min, critical max,
# unit, description. A value strictly outside a bound raises the level.
# ---------------------------------------------------------------------------
THRESHOLD_ROWS = [
    ("frequence_cardiaque", 60.0, 100.0, 40.0, 130.0, "bpm", "Fréquence cardiaque"),
    ("spo2", 94.0, 100.0, 90.0, 100.0, "%", "Saturation oxygène"),
    ("temperature_C", 36.0, 38.0, 35.0, 39.5, "°C", "Température corporelle"),
    ("tension_systolique", 90.0, 140.0, 80.0, 180.0, "mmHg", "Tension systolique"),
    ("tension_diastolique", 60.0, 90.0, 50.0, 110.0, "mmHg", "Tension diastolique"),
    ("glycemie", 0.70, 1.10, 0.50, 2.50, "g/L", "Glycémie"),
    ("frequence_respiratoire", 12.0, 20.0, 8.0, 30.0, "rpm", "Fréquence respiratoire"),
]

# ---------------------------------------------------------------------------
# Health centres (id, name, city, governorate, type, phone,
# latitude, longitude), in load order.
# ---------------------------------------------------------------------------
CENTRE_ROWS = [
    ("C001", "Hôpital Charles Nicolle", "Tunis", "Tunis", "CHU", "71-578-000", 36.818, 10.181),
    ("C002", "Hôpital La Rabta", "Tunis", "Tunis", "CHU", "71-562-600", 36.829, 10.171),
    ("C003", "Clinique Taoufik", "Tunis", "Tunis", "Clinique", "71-890-100", 36.841, 10.195),
    ("C004", "Hôpital Régional Ariana", "Ariana", "Ariana", "Hôpital", "71-717-000", 36.862, 10.194),
    ("C005", "Clinique Hannibal", "Ariana", "Ariana", "Clinique", "71-780-500", 36.875, 10.202),
    ("C006", "CHU Farhat Hached", "Sousse", "Sousse", "CHU", "73-241-311", 35.825, 10.638),
    ("C007", "Clinique Les Oliviers", "Sousse", "Sousse", "Clinique", "73-226-500", 35.831, 10.645),
    ("C008", "CHU Fattouma Bourguiba", "Monastir", "Monastir", "CHU", "73-460-144", 35.764, 10.812),
    ("C009", "Hôpital Régional Nabeul", "Nabeul", "Nabeul", "Hôpital", "72-285-633", 36.456, 10.735),
    ("C010", "Hôpital Régional Bizerte", "Bizerte", "Bizerte", "Hôpital", "72-431-422", 37.274, 9.873),
    ("C011", "CHU Hédi Chaker", "Sfax", "Sfax", "CHU", "74-241-833", 34.740, 10.760),
    ("C012", "Clinique La Rose Sfax", "Sfax", "Sfax", "Clinique", "74-297-000", 34.748, 10.771),
    ("C013", "Hôpital Régional Kairouan", "Kairouan", "Kairouan", "Hôpital", "77-231-422", 35.678, 10.096),
    ("C014", "Hôpital Régional Gabès", "Gabès", "Gabès", "Hôpital", "75-270-233", 33.881, 10.097),
    ("C015", "Hôpital Régional Gafsa", "Gafsa", "Gafsa", "Hôpital", "76-221-600", 34.425, 8.784),
    ("C016", "Hôpital Régional Médenine", "Médenine", "Médenine", "Hôpital", "75-640-311", 33.354, 10.505),
    ("C017", "Hôpital Régional Jendouba", "Jendouba", "Jendouba", "Hôpital", "78-630-444", 36.501, 8.778),
    ("C018", "Hôpital Régional Le Kef", "Le Kef", "Le Kef", "Hôpital", "78-202-533", 36.182, 8.714),
    ("C019", "Hôpital Régional Siliana", "Siliana", "Siliana", "Hôpital", "78-870-311", 36.085, 9.370),
    ("C020", "Hôpital Régional Zaghouan", "Zaghouan", "Zaghouan", "Hôpital", "72-676-022", 36.402, 10.143),
    ("C021", "Hôpital Régional Ben Arous", "Ben Arous", "Ben Arous", "Hôpital", "71-380-711", 36.753, 10.228),
    ("C022", "Clinique Ennasr", "Ben Arous", "Ben Arous", "Clinique", "71-382-500", 36.748, 10.235),
    ("C023", "Hôpital Régional Manouba", "Manouba", "Manouba", "Hôpital", "71-603-444", 36.810, 10.097),
    ("C024", "Hôpital Régional Kasserine", "Kasserine", "Kasserine", "Hôpital", "77-471-022", 35.167, 8.836),
    ("C025", "Hôpital Régional Sidi Bouzid", "Sidi Bouzid", "Sidi Bouzid", "Hôpital", "76-630-711", 35.038, 9.485),
    ("C026", "Hôpital Régional Tozeur", "Tozeur", "Tozeur", "Hôpital", "76-452-600", 33.919, 8.134),
    ("C027", "Hôpital Régional Kébili", "Kébili", "Kébili", "Hôpital", "75-491-311", 33.705, 8.965),
    ("C028", "Hôpital Régional Tataouine", "Tataouine", "Tataouine", "Hôpital", "75-860-244", 32.921, 10.451),
]

# Fixed value: fallback governorate when no governorate matches a patient's city.
DEFAULT_GOVERNORATE = "Tunis"


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table evaluated in the JVM (an inline array of structs over a
    one-row range): no Python worker, no driver-side RDD."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def thresholds(spark: SparkSession) -> DataFrame:
    """Alert thresholds (S7): 7 rows, FLOAT bounds."""
    return literal_table(spark, THRESHOLD_ROWS, schemas.THRESHOLDS)


def centres(spark: SparkSession) -> DataFrame:
    """Health centres (S8): 28 rows, FLOAT coordinates."""
    return literal_table(spark, CENTRE_ROWS, schemas.CENTRES)


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def thresholds_sql() -> str:
    """Same table as SQL ``VALUES`` (for the DuckDB oracle)."""
    rows = ",\n".join(
        "(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in THRESHOLD_ROWS)
    return (
        "SELECT signal, CAST(wmin AS FLOAT) AS seuil_warning_min, CAST(wmax AS FLOAT) AS seuil_warning_max, "
        "CAST(cmin AS FLOAT) AS seuil_critique_min, CAST(cmax AS FLOAT) AS seuil_critique_max, unite, description "
        f"FROM (VALUES {rows}) AS t(signal, wmin, wmax, cmin, cmax, unite, description)")


def centres_sql() -> str:
    rows = ",\n".join(
        "(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in CENTRE_ROWS)
    return (
        "SELECT centre_id, nom_centre, ville, gouvernorat, type_centre, telephone, "
        "CAST(lat AS FLOAT) AS latitude, CAST(lon AS FLOAT) AS longitude "
        f"FROM (VALUES {rows}) AS t(centre_id, nom_centre, ville, gouvernorat, type_centre, telephone, lat, lon)")
