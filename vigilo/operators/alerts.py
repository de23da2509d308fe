"""Threshold alerts.

Rules come from either source, one rule per monitored signal (a proven
size: seven):

* a thresholds *table* is folded into ONE row by an uncorrelated scalar
  subquery (``DataFrame.scalar()``); Spark runs it once per query (once per
  micro-batch in a stream; all references share one execution) and reads
  fields of the constant struct;
* the fixed literal threshold rows become small literal structs that
  Catalyst folds into constants.

Either way classification is a narrow per-row expression — no join, no
shuffle, no Python.

Two shapes:

* ``alerts`` (one event per abnormal signal) unpivots the seven vitals into
  (signal, value) rows (an ``Expand``), picks the rule by signal, classifies
  and keeps abnormal rows — each event is built only for rows that survive.
* ``with_alerts`` (one row per measurement) keeps the measurement wide and
  adds a compact array of its abnormal signals, their count and worst level.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions.ids import normalise_patient_id
from vigilo.schemas import THRESHOLDS
from vigilo.functions.vitals import (
    CRITIQUE,
    NORMAL,
    SIGNAL_COLUMNS,
    SIGNAL_NAMES,
    WARNING,
    classify,
    default_source,
)

# A thresholds table (DataFrame) or literal threshold rows (``reference_tables.THRESHOLD_ROWS``).
Thresholds = Union[DataFrame, Sequence[tuple]]

RULE_FIELDS = ["seuil_warning_min", "seuil_warning_max", "seuil_critique_min",
               "seuil_critique_max", "unite"]
MESSAGE_KEYS = ["mesure_id", "patient_id", "timestamp", "date", "heure", "source"]


def rules_row(thresholds: DataFrame) -> Column:
    """``struct<signal: struct<bounds…, unite>>`` — one rule per monitored signal
    (the greatest row if a signal is listed twice; null if absent) — as a scalar
    subquery over a thresholds table."""
    sig = F.col("signal")
    rule = F.struct(*RULE_FIELDS)
    return thresholds.agg(F.struct(*[
        F.max(F.when(sig == s, rule)).alias(s) for s in SIGNAL_NAMES]).alias("rules")).scalar()


def _best_rules(rows) -> dict[str, tuple]:
    """One rule per monitored signal from literal rows (the greatest if listed twice)."""
    best: dict[str, tuple] = {}
    for r in rows:
        if r[0] in SIGNAL_NAMES:
            rule = tuple(r[1:6])
            best[r[0]] = max(best.get(r[0], rule), rule, key=_rule_order)
    return best


def _literal_rule(rule: tuple | None) -> Column:
    if rule is None:
        return F.lit(None).cast(_RULE_TYPE)
    types = {f.name: f.dataType for f in THRESHOLDS.fields}
    return F.struct(*[F.lit(v).cast(types[f]).alias(f) for v, f in zip(rule, RULE_FIELDS)])


def rules_literal(rows) -> Column:
    """The same struct built from literal threshold rows (``signal, wmin, wmax, cmin,
    cmax, unite, …``); Catalyst folds every bound into a constant."""
    best = _best_rules(rows)
    return F.struct(*[_literal_rule(best.get(s)).alias(s) for s in SIGNAL_NAMES])


def _rule_order(rule: tuple):
    return tuple((v is not None, v) for v in rule)


_RULE_TYPE = "struct<seuil_warning_min:float,seuil_warning_max:float,seuil_critique_min:float," \
             "seuil_critique_max:float,unite:string>"


def rules_of(thresholds) -> dict[str, Column]:
    """The rule of each monitored signal, as one small expression per signal: a field
    of the one-row scalar subquery (thresholds DataFrame) or a literal struct
    (threshold rows). Per-signal expressions keep plans small: every reference to a
    rule carries that rule only, not the whole rule set."""
    if isinstance(thresholds, DataFrame):
        row = rules_row(thresholds)
        return {s: row[s] for s in SIGNAL_NAMES}
    best = _best_rules(thresholds)
    return {s: _literal_rule(best.get(s)) for s in SIGNAL_NAMES}


def rule_by_name(rules: dict[str, Column], signal: Column) -> Column:
    """The rule of a signal given as a column (long form)."""
    out = F.when(signal == SIGNAL_NAMES[0], rules[SIGNAL_NAMES[0]])
    for s in SIGNAL_NAMES[1:]:
        out = out.when(signal == s, rules[s])
    return out


def is_valid(messages: DataFrame) -> Column:
    """A decodable message has a measurement id or a patient id; the rest is rejected."""
    return F.col("mesure_id").isNotNull() | F.col("patient_id").isNotNull()


def with_patient_key(messages: DataFrame) -> DataFrame:
    """Keep the raw id as ``patient_id_brut``; ``patient_id`` becomes the normalised one
    (appended last)."""
    others = [F.col(c) if c != "patient_id" else F.col(c).alias("patient_id_brut")
              for c in messages.columns]
    return messages.select(*others, normalise_patient_id(F.col("patient_id")).alias("patient_id"))


def compact_alert(signal: str, value: Column, rule: Column, level: Column) -> Column:
    """Alert as carried inside a patient update (signal, rounded value, unit,
    warning bounds, level); the measurement fields live on the update row."""
    return F.struct(
        F.lit(signal).alias("signal"),
        F.bround(value.cast("double"), 2).alias("valeur_mesuree"),
        rule["unite"].alias("unite"),
        rule["seuil_warning_min"].alias("seuil_warn_min"),
        rule["seuil_warning_max"].alias("seuil_warn_max"),
        level.alias("niveau_alerte"),
    )


COMPACT_ALERTS = ("array<struct<signal:string,valeur_mesuree:double,unite:string,seuil_warn_min:float,"
                  "seuil_warn_max:float,niveau_alerte:string>>")


def with_alerts(messages: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Messages (normalised id) plus ``alertes`` (abnormal signals in signal order,
    F4 + F5), ``nb_alertes`` (A7) and ``niveau_max`` (A8). No lambda, no generator:
    the projection stays inside whole-stage codegen."""
    return add_alerts(with_patient_key(messages), thresholds)


def level_columns(thresholds: Thresholds) -> list[Column]:
    """One level column ``_l_<signal>`` per monitored signal."""
    rules = rules_of(thresholds)
    return [classify(c, rules[s]).alias(f"_l_{s}") for s, c in SIGNAL_COLUMNS]


def level_counts() -> dict[str, Column]:
    """Per-row counts over the ``_l_*`` columns: abnormal, critical, warning."""
    lvl = [F.col(f"_l_{s}") for s in SIGNAL_NAMES]
    count = lambda cond: sum((F.when(cond(x), 1).otherwise(0) for x in lvl), F.lit(0))
    return {"nb_alertes": count(lambda x: x != NORMAL),
            "nb_critiques": count(lambda x: x == CRITIQUE),
            "nb_warnings": count(lambda x: x == WARNING)}


def add_alerts(m: DataFrame, thresholds: Thresholds) -> DataFrame:
    """``alertes``, ``nb_alertes`` and ``niveau_max`` computed from the seven vital
    columns of any frame that carries them (e.g. messages already joined to a
    profile)."""
    rules = rules_of(thresholds)
    base = m.columns
    m = m.select("*", *level_columns(thresholds))
    lvl = {s: F.col(f"_l_{s}") for s in SIGNAL_NAMES}
    # concat of one-element / empty arrays keeps signal order and stays in codegen
    # (array_compact would be a lambda, which falls back to interpreted evaluation).
    recs = [F.when(lvl[s] != NORMAL, F.array(compact_alert(s, F.col(c), rules[s], lvl[s])))
            .otherwise(F.array().cast(COMPACT_ALERTS)) for s, c in SIGNAL_COLUMNS]
    n = F.lit(0)
    any_crit = F.lit(False)
    for s in SIGNAL_NAMES:
        n = n + F.when(lvl[s] != NORMAL, 1).otherwise(0)
        any_crit = any_crit | (lvl[s] == CRITIQUE)
    worst = F.when(any_crit, CRITIQUE).when(n > 0, WARNING).otherwise(NORMAL)
    return m.select(*base, F.concat(*recs).alias("alertes"),
                    n.alias("nb_alertes"), worst.alias("niveau_max"))


def vitals_long(messages: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """One row per (measurement, signal) with the value as double (P3): an unpivot."""
    ids = ids or ["mesure_id"]
    return messages.unpivot(ids, [F.col(c).cast("double").alias(s) for s, c in SIGNAL_COLUMNS],
                            "signal", "valeur")


def classify_levels(messages: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Level of every (measurement, signal) pair (X15 applied to P3)."""
    rules = rules_of(thresholds)
    long = vitals_long(with_patient_key(messages), ["mesure_id", "patient_id"])
    return (long.withColumn("_r", rule_by_name(rules, F.col("signal")))
            .withColumn("niveau", classify(F.col("valeur"), F.col("_r"))).drop("_r"))


def alerts(messages: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Alert events, one per abnormal signal (K4)."""
    rules = rules_of(thresholds)
    long = vitals_long(with_patient_key(messages), MESSAGE_KEYS)
    rule = rule_by_name(rules, F.col("signal"))
    lv = (long.withColumn("_r", rule)
          .withColumn("niveau_alerte", classify(F.col("valeur"), F.col("_r")))
          .filter(F.col("niveau_alerte") != NORMAL))
    return lv.select(
        F.concat(F.coalesce(F.col("mesure_id"), F.lit("None")), F.lit("_"), F.col("signal")).alias("alerte_id"),
        "patient_id", "mesure_id", "timestamp", "date", "heure", "signal",
        F.bround(F.col("valeur"), 2).alias("valeur_mesuree"),
        F.col("_r.unite").alias("unite"),
        F.col("_r.seuil_warning_min").alias("seuil_warn_min"),
        F.col("_r.seuil_warning_max").alias("seuil_warn_max"),
        "niveau_alerte",
        default_source().alias("source"),
    )


def to_history(alert_events: DataFrame) -> DataFrame:
    """Alert events in the persistent history layout (K6 field names, FLOAT value)."""
    return alert_events.select(
        "alerte_id", "patient_id", "mesure_id",
        F.col("timestamp").alias("timestamp_alerte"),
        F.col("date").alias("date_alerte"),
        F.col("heure").alias("heure_alerte"),
        "signal",
        F.col("valeur_mesuree").cast("float").alias("valeur_mesuree"),
        "unite",
        F.col("seuil_warn_min").alias("seuil_warning_min"),
        F.col("seuil_warn_max").alias("seuil_warning_max"),
        "niveau_alerte", "source",
    )


def _count_level(level: str) -> Column:
    return F.sum(F.when(F.col("niveau_alerte") == level, 1).otherwise(0))


def alert_summary_patient_day(history: DataFrame) -> DataFrame:
    """Per patient and day: totals, criticals, warnings, distinct signals, first and
    last hour, overall level (A5)."""
    g = history.groupBy("patient_id", "date_alerte").agg(
        F.count(F.lit(1)).alias("total_alertes"),
        _count_level(CRITIQUE).alias("nb_critiques"),
        _count_level(WARNING).alias("nb_warnings"),
        # distinct signals of a patient-day: a set bounded by the monitored signal
        # names, merged map-side (one shuffle, where a distinct count needs two)
        F.size(F.collect_set("signal")).cast("long").alias("nb_signaux_alertes"),
        F.min("heure_alerte").alias("premiere_alerte"),
        F.max("heure_alerte").alias("derniere_alerte"),
    )
    return g.withColumn(
        "niveau_global",
        F.when(F.col("nb_critiques") > 0, CRITIQUE).when(F.col("nb_warnings") > 0, WARNING)
        .otherwise(NORMAL))


def alert_stats_by_signal(history: DataFrame) -> DataFrame:
    """Per signal, level and unit: occurrences, distinct patients, mean/min/max value."""
    v = F.col("valeur_mesuree").cast("double")
    return history.groupBy("signal", "niveau_alerte", "unite").agg(
        F.count(F.lit(1)).alias("nb_occurrences"),
        F.countDistinct("patient_id").alias("nb_patients_touches"),
        F.round(F.avg(v), 2).alias("valeur_moyenne"),
        F.round(F.min(v), 2).alias("valeur_min"),
        F.round(F.max(v), 2).alias("valeur_max"),
    ).select("signal", "niveau_alerte", "nb_occurrences", "nb_patients_touches",
             "valeur_moyenne", "valeur_min", "valeur_max", "unite")


def summary_order() -> list[Column]:
    """Presentation order of the summary: newest day first, most criticals first."""
    return [F.col("date_alerte").desc(), F.col("nb_critiques").desc()]


def stats_order() -> list[Column]:
    """Presentation order of the signal statistics: most frequent first."""
    return [F.col("nb_occurrences").desc()]
