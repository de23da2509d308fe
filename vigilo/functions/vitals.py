"""Column expressions over vital signs: batch flags, threshold levels, alert records.

Everything here is a JVM-side expression (whole-stage codegen); nothing runs
in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CRITIQUE, WARNING, NORMAL = "CRITIQUE", "WARNING", "NORMAL"

# ---------------------------------------------------------------------------
# The seven monitored signals, in evaluation order, with the
# stream-message column that carries each of them.
# ---------------------------------------------------------------------------
SIGNAL_COLUMNS = [
    ("frequence_cardiaque", "frequence_cardiaque_bpm"),
    ("spo2", "spo2_pct"),
    ("temperature_C", "temperature_C"),
    ("tension_systolique", "tension_systolique_mmHg"),
    ("tension_diastolique", "tension_diastolique_mmHg"),
    ("glycemie", "glycemie_g_L"),
    ("frequence_respiratoire", "frequence_respiratoire_rpm"),
]
SIGNAL_NAMES = [s for s, _ in SIGNAL_COLUMNS]

# Fixed value: the source recorded when a message carries none (and the
# producer's constant).
DEFAULT_SOURCE = "smartwatch"

# ---------------------------------------------------------------------------
# Batch clinical limits of the derived flags (inclusive where
# written >=, strict otherwise), the reference heart rate and the battery floor.
# ---------------------------------------------------------------------------
HYPERTENSION_SYSTOLIC_MIN = 140      # flag if systolic >= 140
HYPERTENSION_DIASTOLIC_MIN = 90      # ... or diastolic >= 90
TACHYCARDIA_ABOVE = 100              # heart rate > 100
BRADYCARDIA_BELOW = 60               # heart rate < 60
HYPOXIA_BELOW = 94.0                 # SpO2 < 94.0
CRITICAL_HYPOXIA_BELOW = 90.0        # SpO2 < 90.0
FEVER_ABOVE = 37.8                   # temperature > 37.8
HYPOGLYCAEMIA_BELOW = 0.70           # glycaemia < 0.70
HYPERGLYCAEMIA_ABOVE = 1.10          # glycaemia > 1.10
OXYGENATION_ZERO, OXYGENATION_SPAN = 90.0, 10.0   # index = (SpO2 - 90) / 10
REFERENCE_HEART_RATE = 75.0          # deviation = |heart rate - 75| / 75
LOW_BATTERY_BELOW = 20               # battery < 20 (sensor filter keeps >= 20)

# The seven vitals that must be present for a batch measurement to be kept.
REQUIRED_VITALS = [
    "frequence_cardiaque_bpm", "spo2_pct", "temperature_C", "tension_systolique_mmHg",
    "tension_diastolique_mmHg", "glycemie_g_L", "frequence_respiratoire_rpm",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(x) -> Column:
    """Widen to double before any comparison with a decimal bound (float32 0.7f < 0.70)."""
    return _c(x).cast("double")


def flag(cond: Column) -> Column:
    """0/1 flag; a null condition stays null (conditional semantics of the batch ETL)."""
    return cond.cast("int")


def derived_map(sys="tension_systolique_mmHg", dia="tension_diastolique_mmHg",
                fc="frequence_cardiaque_bpm", spo2="spo2_pct", temp="temperature_C",
                gly="glycemie_g_L", battery="batterie_pct") -> dict[str, Column]:
    """The twelve derived ETL columns (D1–D12), by output name, in output order."""
    sys_, dia_, fc_ = _c(sys), _c(dia), _c(fc)
    return {
        "pression_pulsee": sys_ - dia_,
        "flag_hypertension": flag((sys_ >= HYPERTENSION_SYSTOLIC_MIN) | (dia_ >= HYPERTENSION_DIASTOLIC_MIN)),
        "flag_tachycardie": flag(fc_ > TACHYCARDIA_ABOVE),
        "flag_bradycardie": flag(fc_ < BRADYCARDIA_BELOW),
        "flag_hypoxie": flag(_d(spo2) < HYPOXIA_BELOW),
        "flag_hypoxie_critique": flag(_d(spo2) < CRITICAL_HYPOXIA_BELOW),
        "flag_fievre": flag(_d(temp) > FEVER_ABOVE),
        "flag_hypoglycemie": flag(_d(gly) < HYPOGLYCAEMIA_BELOW),
        "flag_hyperglycemie": flag(_d(gly) > HYPERGLYCAEMIA_ABOVE),
        "indice_oxygenation": ((_d(spo2) - OXYGENATION_ZERO) / OXYGENATION_SPAN).cast("float"),
        "ecart_fc_normale": (F.abs(_d(fc_) - REFERENCE_HEART_RATE) / REFERENCE_HEART_RATE).cast("float"),
        "flag_batterie_critique": flag(_c(battery) < LOW_BATTERY_BELOW),
    }


def derived_columns(**cols) -> list[Column]:
    """``derived_map`` as aliased columns."""
    return [c.alias(n) for n, c in derived_map(**cols).items()]


def classify(value, rule: Column) -> Column:
    """Level of one value against one threshold rule (struct with
    ``seuil_warning_min/max, seuil_critique_min/max``).

    Strict bounds, critical checked first. Null value, NaN, missing rule or
    null bound → NORMAL (a comparison with null is not true).
    """
    v = _d(value)
    cmin, cmax = _d(rule["seuil_critique_min"]), _d(rule["seuil_critique_max"])
    wmin, wmax = _d(rule["seuil_warning_min"]), _d(rule["seuil_warning_max"])
    return (
        F.when(v.isNull() | F.isnan(v) | rule.isNull(), F.lit(NORMAL))
        .when((v < cmin) | (v > cmax), F.lit(CRITIQUE))
        .when((v < wmin) | (v > wmax), F.lit(WARNING))
        .otherwise(F.lit(NORMAL))
    )


def default_source(col="source") -> Column:
    """Empty or null source → ``smartwatch``."""
    s = _c(col)
    return F.when(s.isNull() | (s == ""), F.lit(DEFAULT_SOURCE)).otherwise(s)


def severity_rank(level: Column) -> Column:
    """Sort rank CRITIQUE 0 < WARNING 1 < NORMAL/other 2 (intended dashboard order)."""
    return F.when(level == CRITIQUE, 0).when(level == WARNING, 1).otherwise(2)
