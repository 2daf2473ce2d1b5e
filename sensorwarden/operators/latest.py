"""Latest values, history and reports over stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.text import clock, event_date
from sensorwarden.operators.skew import is_small, ranked, sliced_join

LOG_VALUES = ("temp", "humi", "gas", "light_level", "buzzer_active", "is_muted", "status", "msg_id", "timestamp")


def attach_device(logs: DataFrame, devices: DataFrame, rules: Rules, how: str = "inner") -> DataFrame:
    """node_id and sensor_type of each log row; the device table is broadcast while it is small.

    Beyond that the log rows of a device that owns many would meet in one task, so those are sliced.
    """
    names = devices.select(F.col("id").alias("device_id"), "node_id", "sensor_type")
    if is_small(names, rules.broadcast_rows):
        return logs.join(F.broadcast(names), "device_id", how)
    return sliced_join(logs, names, "device_id", "id", rules.chunk_rows, how)


def latest_by_device_clock(logs: DataFrame, devices: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Last row per device by device clock, ties to the highest id; combined map-side, no sort."""
    newest = (
        logs.groupBy("device_id")
        .agg(F.max_by(F.struct("id", *LOG_VALUES), F.struct("timestamp", "id")).alias("r"))
        .select("device_id", "r.*")
    )
    return attach_device(newest, devices, rules).orderBy("node_id")


def latest_with_ties(logs: DataFrame, devices: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows whose device clock is their device's maximum; ties give several rows.

    One pass: each task drops what is below the maximum of its own rows before the shuffle.
    """
    newest = Window.partitionBy("device_id").orderBy(F.col("timestamp").desc())
    tied = logs.filter(F.col("timestamp").isNotNull()).withColumn("_rank", F.rank().over(newest)).filter("_rank = 1").drop("_rank")
    return attach_device(tied, devices, rules)


CACHED = (
    "seq", "sensor_type", "temperature", "humidity", "gas", "light_level", "buzzer_active", "is_muted",
    "status", "msg_id", "timestamp", "received_at",
)


def latest_cached(traced: DataFrame) -> DataFrame:
    """Last accepted reading per node by arrival."""
    return (
        traced.filter("accepted").groupBy("node_id").agg(F.max_by(F.struct(*CACHED), "seq").alias("r"))
        .select("node_id", "r.*")
    )


def node_index(first_seen: DataFrame) -> DataFrame:
    """(node_id, seq) rows -> (node_id, node_index), 1-based in order of first appearance."""
    nodes = first_seen.groupBy("node_id").agg(F.min("seq").alias("first_seq"))
    return ranked(nodes, "first_seq", "node_index")


def last_readings(logs: DataFrame, n: int) -> DataFrame:
    """Last n rows per device, newest first; each task keeps at most n rows per device before the shuffle."""
    order = Window.partitionBy("device_id").orderBy(F.col("timestamp").desc(), F.col("id").desc())
    return logs.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= n)


def node_history(logs: DataFrame, device_id: Column | int, since: int, until: int) -> DataFrame:
    """Rows of one device with a device clock in [since, until], oldest first.

    Stored logs are partitioned by event_date; the date bounds prune partitions before the clock filter.
    """
    rows = logs.filter((F.col("device_id") == device_id) & F.col("timestamp").between(since, until))
    if "event_date" in logs.columns:
        first, last = event_date(F.lit(since)), event_date(F.lit(until))
        rows = rows.filter(F.col("event_date").between(first, last))
    return rows.orderBy("timestamp", "id")


def recent_events(events: DataFrame, now: Column | int, rules: Rules = Rules()) -> DataFrame:
    """Newest events for the event list; one startup row when there is none.

    The startup row ranks behind every event, so one pass over the events tells whether it is needed.
    """
    now = now if isinstance(now, Column) else F.lit(now).cast("bigint")
    told = events.select(F.lit(1).alias("real"), "timestamp", "id", "description", F.lower("severity").alias("type"))
    startup = events.sparkSession.range(1).select(
        F.lit(0).alias("real"),
        now.alias("timestamp"),
        F.lit(0).cast("bigint").alias("id"),
        F.lit("System started and dashboard initialized").alias("description"),
        F.lit("startup").alias("type"),
    )
    newest = [F.col(name).desc() for name in ("real", "timestamp", "id")]
    rows = told.unionByName(startup).orderBy(*newest).limit(rules.event_limit)
    return (
        rows.withColumn("position", F.row_number().over(Window.orderBy(*newest)))
        .filter((F.col("real") == 1) | (F.col("position") == 1))
        .select("position", clock(F.col("timestamp")).alias("time"), "description", "type")
    )


def events_by_severity(events: DataFrame) -> DataFrame:
    """Daily event counts per severity, by gateway clock."""
    return (
        events.groupBy(event_date(F.col("timestamp")).alias("event_date"), "severity")
        .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("node_id").alias("nodes"))
    )


def events_on(events: DataFrame, first: int, last: int, severity: str | None = None) -> DataFrame:
    rows = events.filter(F.col("timestamp").between(first, last))
    return rows if severity is None else rows.filter(F.col("severity") == severity)
