"""Static and per-node thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.enums import has_env_sensors, has_gas_sensor
from sensorwarden.functions.requests import THRESHOLD_TYPES
from sensorwarden.operators.skew import lookup


def threshold_alerts(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Readings above a static threshold, one row per metric; strict comparisons."""
    gas, temp = F.col("gas"), F.col("temperature")
    gas_level = F.when(
        has_gas_sensor(F.col("sensor_type")) & (gas >= 0),
        F.when(gas > rules.gas_crit, F.lit("CRITICAL")).when(gas > rules.gas_warn, F.lit("WARNING")),
    )
    temp_level = F.when(
        has_env_sensors(F.col("sensor_type")),
        F.when(temp > F.lit(rules.temp_crit).cast("float"), F.lit("CRITICAL")).when(
            temp > F.lit(rules.temp_warn).cast("float"), F.lit("WARNING")
        ),
    )

    def alert(metric: str, level: Column, value: Column) -> Column:
        return F.when(
            level.isNotNull(),
            F.struct(F.lit(metric).alias("metric"), level.alias("severity"), value.cast("double").alias("value")),
        )

    return readings.select(
        "seq",
        "node_id",
        "received_at",
        F.explode(F.array(alert("gas", gas_level, gas), alert("temperature", temp_level, temp))).alias("a"),
    ).filter(F.col("a").isNotNull()).select("seq", "node_id", "received_at", "a.metric", "a.severity", "a.value")


def with_thresholds(rows: DataFrame, thresholds: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The node's thresholds on every row, the default set for nodes without a row of their own."""
    table = thresholds.select("node_id", *THRESHOLD_TYPES, F.lit(True).alias("_own"))
    joined = lookup(rows, table, "node_id", rules.broadcast_rows)
    own = F.coalesce(F.col("_own"), F.lit(False))
    defaults = {
        "gas_warn": F.lit(rules.default_gas_warn),
        "gas_crit": F.lit(rules.default_gas_crit),
        "temp_warn": F.lit(rules.default_temp_warn),
        "temp_crit": F.lit(rules.default_temp_crit),
    }
    return joined.withColumns({name: F.when(own, F.col(name)).otherwise(value) for name, value in defaults.items()}).drop(
        "_own"
    )


def classify(value: Column, warn: Column, crit: Column) -> Column:
    return (
        F.when(value > crit, F.lit("crit"))
        .when(value > warn, F.lit("warn"))
        .when(value.isNotNull(), F.lit("ok"))
    )


def node_threshold_class(readings: DataFrame, thresholds: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """ok/warn/crit per reading and metric; NULL where there is no value."""
    rows = with_thresholds(readings, thresholds, rules)
    gas = F.when(F.col("gas") >= 0, F.col("gas"))
    return rows.select(
        "seq",
        "node_id",
        classify(gas, F.col("gas_warn"), F.col("gas_crit")).alias("gas_class"),
        classify(F.col("temperature").cast("double"), F.col("temp_warn"), F.col("temp_crit")).alias("temp_class"),
    )


def apply_threshold_requests(thresholds: DataFrame, requests: DataFrame, now: Column | int) -> DataFrame:
    """Last valid request per node and type replaces the stored value; other nodes stay as they are."""
    now = now if isinstance(now, Column) else F.lit(now).cast("bigint")
    newest = (
        requests.filter("is_valid")
        .groupBy("node_id")
        .agg(
            *[
                F.max_by("value", F.when(F.col("threshold_type") == kind, F.col("seq"))).alias(f"new_{kind}")
                for kind in THRESHOLD_TYPES
            ]
        )
    )
    types = {field.name: field.dataType for field in thresholds.schema.fields}
    joined = thresholds.join(newest, "node_id", "left")
    touched = F.coalesce(*[F.col(f"new_{kind}") for kind in THRESHOLD_TYPES]).isNotNull()
    return joined.select(
        "node_id",
        *[F.coalesce(F.col(f"new_{kind}").cast(types[kind]), F.col(kind)).alias(kind) for kind in THRESHOLD_TYPES],
        "created_at",
        F.when(touched, F.timestamp_seconds(now)).otherwise(F.col("updated_at")).alias("updated_at"),
    )
