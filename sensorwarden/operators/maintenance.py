"""Stored tables: log rows, schema alignment, device upserts, marks, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.encode import flag, gas_or_null
from sensorwarden.functions.text import calendar_time, event_date
from sensorwarden.operators.skew import ranked
from sensorwarden.session import cut_lineage


def log_rows(traced: DataFrame) -> DataFrame:
    """Accepted readings as sensor_logs rows; the id is the arrival number."""
    return traced.filter("accepted").select(
        F.col("seq").alias("id"),
        "device_id",
        F.col("temperature").cast("double").alias("temp"),
        F.col("humidity").cast("double").alias("humi"),
        gas_or_null(F.col("gas")).alias("gas"),
        "light_level",
        flag(F.col("buzzer_active")).alias("buzzer_active"),
        flag(F.col("is_muted")).alias("is_muted"),
        "status",
        "msg_id",
        "timestamp",
        calendar_time(F.col("received_at")).alias("captured_at"),
    )


def event_rows(events: DataFrame) -> DataFrame:
    """Events as system_events rows."""
    return events.select(
        "id", "node_id", "severity", "description", "timestamp", calendar_time(F.col("timestamp")).alias("created_at")
    )


def aligned(table: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Adds the columns a table lacks; existing columns are left alone."""
    return table.withColumns({name: value for name, value in defaults.items() if name not in table.columns})


def appended(table: DataFrame, more: DataFrame) -> DataFrame:
    """Union of two versions of a table, missing columns as NULL."""
    return table.unionByName(more, allowMissingColumns=True)


# --- devices -------------------------------------------------------------------------------------------


def provisioned(devices: DataFrame, nodes: DataFrame, now: Column | int) -> DataFrame:
    """Whitelist upsert: new nodes with mark 0, known nodes get new metadata and keep their mark.

    ``nodes`` is (position, node_id, location, sensor_type, has_gas); the last entry of a node wins.
    """
    now = now if isinstance(now, Column) else F.lit(now).cast("bigint")
    listed = (
        nodes.groupBy("node_id")
        .agg(
            F.max_by(F.struct("location", "sensor_type", "has_gas"), "position").alias("n"),
            F.min("position").alias("position"),
        )
        .select("node_id", "position", "n.*")
    )
    both = devices.alias("d").join(listed.alias("n"), "node_id", "full_outer").select(
        "d.id",
        "node_id",
        "position",
        F.coalesce("n.location", "d.location").alias("location"),
        F.coalesce("n.sensor_type", "d.sensor_type").alias("sensor_type"),
        F.coalesce("n.has_gas", "d.has_gas").alias("has_gas"),
        "d.last_msg_id",
        "d.created_at",
    )
    both = cut_lineage(both)
    known = both.filter(F.col("id").isNotNull())
    return known.drop("position").unionByName(_numbered(both.filter(F.col("id").isNull()), "position", known, now))


def provisioned_count(nodes: DataFrame) -> DataFrame:
    """Entries taken over by ``provisioned``; repeated nodes count each time."""
    return nodes.agg(F.count(F.lit(1)).alias("provisioned"))


def registered(devices: DataFrame, seen: DataFrame, now: Column | int) -> DataFrame:
    """Insert-if-absent: ``seen`` is (node_id, seq); new nodes are numbered in order of first appearance."""
    now = now if isinstance(now, Column) else F.lit(now).cast("bigint")
    first = seen.groupBy("node_id").agg(F.min("seq").alias("position"))
    new = first.join(devices.select("node_id"), "node_id", "left_anti").select(
        "node_id",
        "position",
        F.lit("AUTO_REGISTERED").alias("location"),
        F.lit("UNKNOWN").alias("sensor_type"),
        F.lit(False).alias("has_gas"),
    )
    return devices.unionByName(_numbered(new, "position", devices, now))


def _numbered(new: DataFrame, order: str, devices: DataFrame, now: Column) -> DataFrame:
    last_id = F.coalesce(devices.agg(F.max("id").alias("id")).scalar(), F.lit(0))
    return ranked(new, order, "_rank").select(
        (last_id + F.col("_rank")).alias("id"),
        "node_id",
        "location",
        "sensor_type",
        "has_gas",
        F.lit(0).cast("bigint").alias("last_msg_id"),
        F.timestamp_seconds(now).alias("created_at"),
    )


def advanced_marks(devices: DataFrame, traced: DataFrame) -> DataFrame:
    """Highest accepted id per node, stored only where it is greater."""
    highest = traced.filter("accepted").groupBy("node_id").agg(F.max("msg_id").alias("_highest"))
    return devices.join(highest, "node_id", "left").select(
        "id", "node_id", "location", "sensor_type", "has_gas",
        F.greatest("last_msg_id", "_highest").alias("last_msg_id"), "created_at",
    )


# --- retention -----------------------------------------------------------------------------------------


def cutoff(as_of: Column | int, rules: Rules = Rules()) -> Column | int:
    return as_of - rules.retention_days * 86400


def retained(logs: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """Rows young enough to stay, by device clock; rows without a clock value stay."""
    limit = cutoff(as_of, rules)
    return logs.filter(F.col("timestamp").isNull() | (F.col("timestamp") >= limit))


def purge_counts(logs: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    limit = cutoff(as_of, rules)
    return logs.agg(
        F.count_if(F.col("timestamp") < limit).alias("deleted"),
        (F.count(F.lit(1)) - F.count_if(F.col("timestamp") < limit)).alias("kept"),
    )


def with_event_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", event_date(F.col("timestamp")))
