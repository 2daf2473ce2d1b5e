"""Integer encodings of readings for the management export."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tenths(value: Column) -> Column:
    """Float -> tenths as an integer: negative values clamp to 0, others round half up in float32."""
    scaled = value.cast("float") * F.lit(10.0).cast("float") + F.lit(0.5).cast("float")
    return F.when(value < 0, F.lit(0)).when(value.isNotNull(), scaled.cast("int"))


def gas_or_null(gas: Column) -> Column:
    """Preheating (-1) counts as no data."""
    return F.when(gas >= 0, gas)


def flag(value: Column) -> Column:
    return value.cast("int")
