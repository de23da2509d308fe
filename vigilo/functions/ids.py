"""Identifier expressions: zero padding that never truncates, patient-id normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def zfill(col, width: int) -> Column:
    """Python ``str.zfill``: pad with zeros to ``width``, keep a leading sign in front,
    never truncate (``lpad`` alone would cut ``'12345'`` to ``'1234'``)."""
    s = _c(col).cast("string")
    signed = s.startswith("-") | s.startswith("+")
    return (
        F.when(F.length(s) >= width, s)
        .when(signed, F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0")))
        .otherwise(F.lpad(s, width, "0"))
    )


def normalise_patient_id(col) -> Column:
    """``P003`` → ``PAT0003``; ids starting with ``PAT``, not starting with ``P``,
    or null pass through unchanged."""
    pid = _c(col)
    digits = F.substring(pid, 2, 1 << 30)
    return F.when(
        pid.startswith("P") & ~pid.startswith("PAT"),
        F.concat(F.lit("PAT"), zfill(digits, 4)),
    ).otherwise(pid)
