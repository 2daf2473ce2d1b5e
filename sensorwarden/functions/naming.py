"""Canonical device names and the short names the dashboard uses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorwarden.functions.enums import translate

# Canonical device name -> dashboard name.
DASHBOARD_NAME = {
    "ESP32_SEC_01": "node_01",
    "ESP8266_SEC_02": "node_02",
    "ESP8266_SEC_03": "node_03",
}
CANONICAL_NAME = {short: full for full, short in DASHBOARD_NAME.items()}

# Dashboard nodes that take commands and thresholds.
COMMAND_NODES = ("node_02", "node_03")


def dashboard_name(node_id: Column) -> Column:
    """Known names first, then the platform prefix, then the number suffix; NULL when none applies."""
    return F.coalesce(
        translate(node_id, DASHBOARD_NAME, None),
        F.when(node_id.startswith("ESP32"), F.lit("node_01"))
        .when(node_id.endswith("_02"), F.lit("node_02"))
        .when(node_id.endswith("_03"), F.lit("node_03")),
    )


def canonical_name(name: Column) -> Column:
    """Dashboard or canonical name -> canonical name; empty -> first device, unknown names unchanged."""
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit("ESP32_SEC_01")).otherwise(
        F.coalesce(translate(name, CANONICAL_NAME, None), name)
    )
