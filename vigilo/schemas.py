"""Explicit schemas. Columns bind by position at read time; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

S, I, FL, D = StringType(), IntegerType(), FloatType(), DoubleType()


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


PATIENTS = _schema(
    ("patient_id", S), ("nom", S), ("age", I), ("sexe", S), ("ville", S),
    ("maladie_chronique", S), ("medecin_referent", S), ("numero_urgence", S),
    ("date_inscription", S),
)

SIGNALS = _schema(
    ("mesure_id", S), ("patient_id", S), ("timestamp", S), ("date", S), ("heure", S),
    ("temperature_C", FL), ("tension_systolique_mmHg", I), ("tension_diastolique_mmHg", I),
    ("frequence_cardiaque_bpm", I), ("spo2_pct", FL), ("frequence_respiratoire_rpm", I),
    ("glycemie_g_L", FL), ("poids_kg", FL), ("imc", FL), ("activite_physique_steps", I),
    ("duree_sommeil_h", FL), ("score_douleur_0_10", I), ("capteur_id", S), ("qualite_signal", S),
)

SENSORS = _schema(
    ("capteur_id", S), ("type_capteur", S), ("fabricant", S), ("date_installation", S),
    ("batterie_pct", I), ("statut_capteur", S), ("frequence_mesure_min", I),
)

# Enriched measurement table (ETL output = KPI input), 36 columns.
ENRICHED = _schema(
    ("mesure_id", S), ("patient_id", S), ("nom", S), ("age", I), ("sexe", S), ("ville", S),
    ("maladie_chronique", S), ("date_mesure", S), ("heure_mesure", S), ("temperature_C", FL),
    ("tension_systolique", I), ("tension_diastolique", I), ("frequence_cardiaque", I),
    ("spo2", FL), ("frequence_respiratoire", I), ("glycemie", FL), ("poids", FL), ("imc", FL),
    ("steps", I), ("duree_sommeil", FL), ("score_douleur", I), ("batterie_pct", I),
    ("qualite_signal", S), ("type_capteur", S), ("pression_pulsee", I),
    ("flag_hypertension", I), ("flag_tachycardie", I), ("flag_bradycardie", I),
    ("flag_hypoxie", I), ("flag_hypoxie_critique", I), ("flag_fievre", I),
    ("flag_hypoglycemie", I), ("flag_hyperglycemie", I), ("indice_oxygenation", FL),
    ("ecart_fc_normale", FL), ("flag_batterie_critique", I),
)

# Stream message (JSON on the wire), 16 nullable fields.
MESSAGE = _schema(
    ("mesure_id", S), ("patient_id", S), ("timestamp", S), ("date", S), ("heure", S),
    ("temperature_C", FL), ("tension_systolique_mmHg", I), ("tension_diastolique_mmHg", I),
    ("frequence_cardiaque_bpm", I), ("spo2_pct", FL), ("frequence_respiratoire_rpm", I),
    ("glycemie_g_L", FL), ("poids_kg", FL), ("score_douleur_0_10", I), ("capteur_id", S),
    ("source", S),
)

# Replayable observation file: the 19 signal columns plus ``source``.
OBSERVATIONS = StructType(SIGNALS.fields + [StructField("source", S, True)])

THRESHOLDS = _schema(
    ("signal", S), ("seuil_warning_min", FL), ("seuil_warning_max", FL),
    ("seuil_critique_min", FL), ("seuil_critique_max", FL), ("unite", S), ("description", S),
)

CENTRES = _schema(
    ("centre_id", S), ("nom_centre", S), ("ville", S), ("gouvernorat", S), ("type_centre", S),
    ("telephone", S), ("latitude", FL), ("longitude", FL),
)

# Alert event as emitted per abnormal signal (13 fields).
ALERT = _schema(
    ("alerte_id", S), ("patient_id", S), ("mesure_id", S), ("timestamp", S), ("date", S),
    ("heure", S), ("signal", S), ("valeur_mesuree", D), ("unite", S), ("seuil_warn_min", FL),
    ("seuil_warn_max", FL), ("niveau_alerte", S), ("source", S),
)

# Persistent alert history (13 columns, renamed fields, FLOAT value).
ALERT_HISTORY = _schema(
    ("alerte_id", S), ("patient_id", S), ("mesure_id", S), ("timestamp_alerte", S),
    ("date_alerte", S), ("heure_alerte", S), ("signal", S), ("valeur_mesuree", FL), ("unite", S),
    ("seuil_warning_min", FL), ("seuil_warning_max", FL), ("niveau_alerte", S), ("source", S),
)

ALERT_ARRAY = ArrayType(ALERT)
