"""Status and sensor-type vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wire text -> device status (case-sensitive; anything else is UNKNOWN).
STATUS_BY_TEXT = {
    "OPERATIONAL": "OPERATIONAL",
    "WARNING": "WARNING",
    "CRITICAL": "CRITICAL",
    "NOT_OPERATING": "NOT_OPERATING",
    "alarm": "ALARM",
    "warn": "WARNING",
    "ok": "OPERATIONAL",
}

# Device status -> exported ordinal.
STATUS_ORDINAL = {
    "OPERATIONAL": 0,
    "WARNING": 1,
    "CRITICAL": 2,
    "NOT_OPERATING": 3,
    "OFFLINE": 4,
    "FAULTY": 5,
    "ALARM": 6,
    "UNKNOWN": 255,
}

# Wire text -> sensor type (anything else is UNKNOWN).
SENSOR_BY_TEXT = {
    "ENV_MONITOR": "ENV_MONITOR",
    "SECURITY": "SECURITY",
    "DHT11+MQ2": "ENV_MONITOR_GAS",
    "ENV_MONITOR_GAS": "ENV_MONITOR_GAS",
}

# Sensor type -> ordinal.
SENSOR_ORDINAL = {"ENV_MONITOR": 0, "SECURITY": 1, "ENV_MONITOR_GAS": 2, "UNKNOWN": 255}


def translate(col: Column, mapping: dict, default) -> Column:
    """Literal lookup as a CASE chain, which stays inside generated code."""
    chain = None
    for key, value in mapping.items():
        chain = F.when(col == key, F.lit(value)) if chain is None else chain.when(col == key, F.lit(value))
    return chain.otherwise(F.lit(default))


def parse_status(text: Column) -> Column:
    return translate(text, STATUS_BY_TEXT, "UNKNOWN")


def parse_sensor_type(text: Column) -> Column:
    return translate(text, SENSOR_BY_TEXT, "UNKNOWN")


def status_ordinal(status: Column) -> Column:
    return translate(status, STATUS_ORDINAL, STATUS_ORDINAL["UNKNOWN"])


def sensor_ordinal(sensor_type: Column) -> Column:
    return translate(sensor_type, SENSOR_ORDINAL, SENSOR_ORDINAL["UNKNOWN"])


def has_gas_sensor(sensor_type: Column) -> Column:
    return sensor_type == "ENV_MONITOR_GAS"


def has_env_sensors(sensor_type: Column) -> Column:
    return sensor_type.isin("ENV_MONITOR", "ENV_MONITOR_GAS")
