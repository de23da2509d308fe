"""Quality filters (F1–F3) and header-row removal.

Plain predicates: Catalyst pushes them into the Parquet scan where the
column is a stored one (``PushedFilters``) and keeps them ahead of the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions.vitals import LOW_BATTERY_BELOW, REQUIRED_VITALS

# The sensor status kept and the signal quality rejected.
ACTIVE_STATUS = "Actif"
BAD_QUALITY = "mauvais"


def drop_header_rows(df: DataFrame, key: str) -> DataFrame:
    """Remove a header line read as data (``key == 'key'``); null keys go too,
    since the comparison with null is not true."""
    return df.filter(F.col(key) != F.lit(key))


def sensors_ok(sensors: DataFrame) -> DataFrame:
    """Active sensors with at least 20 % battery (F1). Null status or battery drops."""
    return sensors.filter((F.col("statut_capteur") == ACTIVE_STATUS)
                          & (F.col("batterie_pct") >= LOW_BATTERY_BELOW))


def signals_ok(signals: DataFrame) -> DataFrame:
    """Signal quality not ``mauvais`` (null quality drops) and all seven vitals present."""
    cond = F.col("qualite_signal") != BAD_QUALITY
    for c in REQUIRED_VITALS:
        cond = cond & F.col(c).isNotNull()
    return signals.filter(cond)
