"""Profile enrichment and patient views.

The profile is a lookup keyed by patient id: one profile per id (a
dictionary in the reference), so duplicates are collapsed before the left
join and a measurement never fans out. Collapsing is an aggregation by
``patient_id``; its output is already hash-partitioned on the join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions.render import fixed, initials, js_number, signal_label
from vigilo.functions.vitals import CRITIQUE, NORMAL, WARNING
from vigilo.operators import alerts as al
from vigilo.operators import quality
from vigilo.schemas import CENTRES
from vigilo.sources.reference_tables import DEFAULT_GOVERNORATE

_CENTRE_FIELDS = [f for f in CENTRES.fields if f.name != "gouvernorat"]

PROFILE_FIELDS = ["nom", "age", "sexe", "ville", "maladie_chronique", "medecin_referent",
                  "numero_urgence", "date_inscription"]

# Clinical note per level, and the fallbacks of an unknown patient.
NOTE = {
    CRITIQUE: "Intervention urgente recommandée.",
    WARNING: "Surveillance renforcée conseillée.",
    NORMAL: "État stable — suivi routinier.",
}
UNKNOWN = "?"
UNKNOWN_CITY = "Inconnue"
MISSING_VALUE = "None"


# A patient may own a large share of all measurements. The profile side is the
# output of the per-id aggregation, so a join on the id alone needs no exchange
# there, and AQE's skew-join split (which needs shuffle stages on both sides)
# cannot apply. Joining on (id, salt) puts an exchange on both sides; AQE then
# splits a hot patient's partition into as many tasks as its size requires.
# Two salt values are enough for that, so the profile is copied only twice.
SALT_BUCKETS = 2


def profile_lookup(patients: DataFrame) -> DataFrame:
    """One profile per patient id (deterministic pick among duplicates), with a
    ``_profil`` marker that survives the left join only for matched ids."""
    p = quality.drop_header_rows(patients, "patient_id")
    return (p.groupBy("patient_id")
            .agg(F.min(F.struct(*PROFILE_FIELDS)).alias("_p"))
            .select("patient_id", F.lit(True).alias("_profil"),
                    *[F.col(f"_p.{c}").alias(c) for c in PROFILE_FIELDS]))


def updates_from_messages(messages: DataFrame, thresholds, patients: DataFrame | None = None,
                          profile: DataFrame | None = None, salt_buckets: int | None = None) -> DataFrame:
    """Patient updates straight from messages: the profile join runs on the raw
    message fields (normalised id), and the alerts are computed after it, so a
    shuffled join never moves the alert arrays."""
    keyed = al.with_patient_key(messages)
    return patient_updates(keyed, patients, profile, thresholds=thresholds, salt_buckets=salt_buckets)


def patient_updates(measurements: DataFrame, patients: DataFrame | None = None,
                    profile: DataFrame | None = None, thresholds=None,
                    salt_buckets: int | None = None) -> DataFrame:
    """Per measurement: profile (or fallbacks when the patient is unknown),
    current vitals, alert count, worst level and the alert list (J5 + P5).

    ``measurements`` is the output of ``alerts.with_alerts``, or — with
    ``thresholds`` — keyed messages whose alerts are added after the join.
    Pass ``patients`` (raw table) or an already prepared ``profile`` lookup.
    ``salt_buckets`` (default ``SALT_BUCKETS``; 1 = plain join) salts the join so
    that AQE can split a patient that owns many measurements."""
    if profile is None:
        profile = profile_lookup(patients)
    j = salted_profile_join(measurements, profile, SALT_BUCKETS if salt_buckets is None else salt_buckets)
    if thresholds is not None:
        j = al.add_alerts(j, thresholds)
    matched = F.col("_profil").isNotNull()
    pick = lambda c, default: F.when(matched, F.col(c)).otherwise(default)
    txt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_VALUE))
    return j.select(
        F.col("patient_id"),
        F.col("mesure_id"),
        pick("nom", F.col("patient_id")).alias("nom"),
        F.when(matched, F.col("age")).alias("age"),
        F.when(matched, F.col("age").cast("string")).otherwise(F.lit(UNKNOWN)).alias("age_affiche"),
        pick("sexe", F.lit(UNKNOWN)).alias("sexe"),
        pick("ville", F.lit(UNKNOWN_CITY)).alias("ville"),
        pick("maladie_chronique", F.lit(UNKNOWN)).alias("maladie"),
        pick("medecin_referent", F.lit(UNKNOWN)).alias("medecin"),
        pick("numero_urgence", F.lit(UNKNOWN)).alias("urgence"),
        pick("date_inscription", F.lit(UNKNOWN)).alias("inscription"),
        F.col("timestamp"),
        F.col("frequence_cardiaque_bpm").alias("fc"),
        F.col("spo2_pct").alias("spo2"),
        F.concat(txt("tension_systolique_mmHg"), F.lit("/"), txt("tension_diastolique_mmHg")).alias("tension"),
        F.col("glycemie_g_L").alias("glycemie"),
        F.col("temperature_C").alias("temperature"),
        F.col("nb_alertes"),
        F.col("niveau_max"),
        F.col("alertes"),
    )


def _is_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate is below the session's broadcast threshold."""
    limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def salted_profile_join(measurements: DataFrame, profile: DataFrame,
                        buckets: int = SALT_BUCKETS) -> DataFrame:
    """Left join of measurements with the one-per-id profile on (patient, salt).

    Each measurement gets a deterministic salt from its id (stable on task
    retry); each profile row is replicated once per salt value. The salted key
    gives both sides a shuffle, which lets AQE split a hot patient's partition;
    the cost is ``buckets`` copies of the (much smaller) profile table. Profiles
    that the planner will broadcast need neither shuffle nor salt."""
    if buckets <= 1 or _is_broadcast(profile):
        prof = profile.withColumnRenamed("patient_id", "_pid")
        return measurements.join(prof, measurements["patient_id"] == prof["_pid"], "left")
    m = measurements.withColumn("_salt", F.pmod(F.xxhash64("mesure_id"), F.lit(buckets)))
    prof = (profile.withColumnRenamed("patient_id", "_pid")
            .withColumn("_salt_p", F.explode(F.sequence(F.lit(0).cast("long"),
                                                         F.lit(buckets - 1).cast("long")))))
    cond = (m["patient_id"] == prof["_pid"]) & (m["_salt"] == prof["_salt_p"])
    return m.join(prof, cond, "left").drop("_salt", "_salt_p")


def flat_updates(updates: DataFrame) -> DataFrame:
    """Updates with the alert list rendered as the comma-joined signal names."""
    return (updates.withColumn("signaux_alertes", F.array_join(F.col("alertes.signal"), ","))
            .drop("alertes"))


# --------------------------------------------------------------- nearest centre

def governorate_list(centres: DataFrame) -> Column:
    """Governorates in load order (first centre id), each with its first centre,
    as one array value (scalar subquery; one entry per governorate of the
    literal centre table)."""
    first = F.min(F.struct("centre_id", "nom_centre", "ville", "type_centre", "telephone",
                           "latitude", "longitude")).alias("centre")
    g = centres.groupBy("gouvernorat").agg(first)
    return g.select(F.array_sort(F.collect_list(F.struct(
        F.col("centre.centre_id").alias("ordre"),
        F.lower("gouvernorat").alias("g"),
        F.col("gouvernorat"),
        F.col("centre")))).alias("govs")).scalar()


def nearest_centre_of(city: Column, govs: Column) -> Column:
    """First governorate (load order) whose lower-cased name contains the city or is
    contained in it; else the first centre of the default governorate (J6).
    A null city is treated as empty, which every governorate contains."""
    c = F.lower(F.coalesce(city, F.lit("")))
    hit = F.get(F.filter(govs, lambda g: g["g"].contains(c) | c.contains(g["g"])), 0)
    fallback = F.get(F.filter(govs, lambda g: g["gouvernorat"] == DEFAULT_GOVERNORATE), 0)
    return F.coalesce(hit, fallback)


def nearest_centre_literal(city: Column, rows) -> Column:
    """``nearest_centre_of`` for literal centre rows: the governorates become a
    CASE chain in load order (constants, no lambda, stays in codegen)."""
    first: dict[str, tuple] = {}
    for r in sorted(rows, key=lambda r: r[0]):          # lowest centre id first
        first.setdefault(r[3], r)
    govs = sorted(first.values(), key=lambda r: r[0])   # governorate load order

    def value(r):
        centre = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in
                            zip((r[0], r[1], r[2], r[4], r[5], r[6], r[7]), _CENTRE_FIELDS)])
        return F.struct(F.lit(r[0]).alias("ordre"), F.lit(r[3].lower()).alias("g"),
                        F.lit(r[3]).alias("gouvernorat"), centre.alias("centre"))

    c = F.lower(F.coalesce(city, F.lit("")))
    out = None
    for r in govs:
        g = F.lit(r[3].lower())
        cond = g.contains(c) | c.contains(g)
        out = F.when(cond, value(r)) if out is None else out.when(cond, value(r))
    fallback = [r for r in govs if r[3] == DEFAULT_GOVERNORATE]
    if out is None:
        return F.lit(None)
    return out.otherwise(value(fallback[0]) if fallback else F.lit(None))


def nearest_centre(patients: DataFrame, centres) -> DataFrame:
    """Nearest health centre per patient: a narrow per-row expression, no join.
    ``centres`` is a DataFrame (scalar-subquery list) or literal centre rows."""
    p = quality.drop_header_rows(patients, "patient_id")
    if isinstance(centres, DataFrame):
        # The list is projected as a column first: a subquery may not sit in a lambda.
        p = p.select("patient_id", "ville", governorate_list(centres).alias("_govs"))
        hit = nearest_centre_of(F.col("ville"), F.col("_govs"))
    else:
        hit = nearest_centre_literal(F.col("ville"), centres)
    # the match is computed once, then its fields are read
    m = p.select("patient_id", "ville", hit.alias("_hit"))
    return m.select(
        "patient_id", "ville",
        F.col("_hit.gouvernorat").alias("gouvernorat"),
        F.col("_hit.centre.centre_id").alias("centre_id"),
        F.col("_hit.centre.nom_centre").alias("nom_centre"),
        F.col("_hit.centre.type_centre").alias("type_centre"),
        F.col("_hit.centre.telephone").alias("telephone"),
    )


# --------------------------------------------------------------- views

def level_of(alerts: Column, *signals: str) -> Column:
    """Level of the first alert on one of ``signals``, NORMAL if none.
    Alerts are in signal order and a signal alerts at most once per measurement."""
    names = alerts["signal"]
    found = [F.get(alerts, F.array_position(names, s) - 1)["niveau_alerte"] for s in signals]
    return F.coalesce(*found, F.lit(NORMAL))


def _alert_text(a: Column) -> Column:
    return F.concat_ws(" ", signal_label(a["signal"]), F.lit("="), js_number(a["valeur_mesuree"]),
                       a["unite"])


def patient_cards(latest_updates: DataFrame) -> DataFrame:
    """Card per patient: name, level, vitals with their level, first three alerts and
    the number not shown (O11, X16, X19)."""
    a = F.col("alertes")
    niveau = F.coalesce(F.col("niveau_max"), F.lit(NORMAL))
    nom = F.when(F.col("nom").isNull() | (F.col("nom") == ""), F.col("patient_id")).otherwise(F.col("nom"))
    return latest_updates.select(
        "patient_id",
        nom.alias("nom_affiche"),
        niveau.alias("niveau"),
        F.col("ville"), F.col("maladie"),
        F.col("fc"), level_of(a, "frequence_cardiaque").alias("niveau_fc"),
        F.col("spo2"), level_of(a, "spo2").alias("niveau_spo2"),
        F.col("tension"), level_of(a, "tension_systolique", "tension_diastolique").alias("niveau_tension"),
        fixed(F.col("glycemie"), 2).alias("glycemie_affichee"),
        level_of(a, "glycemie").alias("niveau_glycemie"),
        F.array_join(F.transform(F.slice(a, 1, 3), _alert_text), " | ").alias("alertes_affichees"),
        F.greatest(F.size(a) - 3, F.lit(0)).alias("nb_alertes_masquees"),
        F.col("timestamp"),
    )


def patient_dossier(latest_updates: DataFrame) -> DataFrame:
    """Dossier per patient: profile block, current vitals with levels, active
    alerts with reference thresholds, clinical note and intervention flag
    (X17, X18, X20)."""
    a = F.col("alertes")
    niveau = F.coalesce(F.col("niveau_max"), F.lit(NORMAL))
    nom = F.when(F.col("nom").isNull() | (F.col("nom") == ""), F.col("patient_id")).otherwise(F.col("nom"))
    seuils = F.array_join(F.transform(a, lambda x: F.concat(
        signal_label(x["signal"]), F.lit(": warning ["),
        F.coalesce(js_number(x["seuil_warn_min"]), F.lit(UNKNOWN)), F.lit(" – "),
        F.coalesce(js_number(x["seuil_warn_max"]), F.lit(UNKNOWN)), F.lit("] "),
        F.coalesce(x["unite"], F.lit("")))), " | ")
    return latest_updates.select(
        "patient_id",
        nom.alias("nom_affiche"),
        initials(nom).alias("initiales"),
        niveau.alias("niveau"),
        F.col("age_affiche"), F.col("sexe"), F.col("inscription"),
        F.col("maladie"), F.col("medecin"), F.col("urgence"),
        F.when(F.col("ville").isNull() | (F.col("ville") == ""), F.lit(UNKNOWN_CITY))
        .otherwise(F.col("ville")).alias("localisation"),
        F.col("timestamp").alias("derniere_mesure"),
        fixed(F.col("temperature"), 1).alias("temperature_affichee"),
        level_of(a, "temperature_C").alias("niveau_temperature"),
        F.size(a).alias("nb_alertes_actives"),
        seuils.alias("seuils_reference"),
        F.when(niveau == CRITIQUE, NOTE[CRITIQUE]).when(niveau == WARNING, NOTE[WARNING])
        .otherwise(NOTE[NORMAL]).alias("note_clinique"),
        (niveau == CRITIQUE).alias("intervention_recommandee"),
    )
