"""Display renderings used by the patient views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signal_label(signal: Column) -> Column:
    """``tension_systolique`` → ``tension systolique``."""
    return F.translate(signal, "_", " ")


def js_number(x: Column) -> Column:
    """Number as a browser prints it: whole values without a fraction part,
    others in shortest decimal form, in plain digits."""
    d = x.cast("double")
    whole = (d == F.floor(d)) & (F.abs(d) < 1e15)
    shortest = d.cast("string")      # may have an exponent: 1.23456789E7
    plain = F.rtrim(shortest.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    return (F.when(whole, d.cast("long").cast("string"))
            .when(shortest.contains("E") & (F.abs(d) >= 1e-6) & (F.abs(d) < 1e15), plain)
            .otherwise(shortest))


def initials(name: Column) -> Column:
    """First letter of each space-separated word, first two, upper case."""
    words = F.split(name, " ")
    return F.upper(F.substring(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""), 1, 2))


def fixed(x: Column, decimals: int) -> Column:
    """Fixed-point rendering with ``decimals`` digits; a missing value shows ``—``."""
    return F.when(x.isNull(), F.lit("—")).otherwise(
        F.format_string(f"%.{decimals}f", x.cast("double")))
