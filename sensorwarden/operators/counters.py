"""Pipeline and table counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.parsing import READING_COLUMNS
from sensorwarden.operators.detect import events_of_message
from sensorwarden.operators.health import offline_at


def pipeline_counters(
    traced: DataFrame, as_of: Column | int, rules: Rules = Rules(), received: DataFrame | None = None
) -> DataFrame:
    """One status row over all counted messages; summed per node first, then over the nodes.

    Messages that were not parsed may be among ``traced`` without a node (``with_rejects``), so that everything is counted
    in one pass; else ``received`` holds the counted raw messages. What was received and not accepted was rejected.
    """
    named = F.col("node_id").isNotNull()
    per_node = traced.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("traced"),
        F.count_if("accepted").alias("accepted"),
        F.sum(F.when(named, events_of_message(rules))).alias("security_events"),
        F.count(offline_at(as_of, rules)).alias("offline_events"),
        F.max(F.col("fresh").cast("int")).alias("seen"),
    )
    totals = per_node.agg(
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("traced", "accepted", "security_events", "offline_events", "seen")
        ]
    )
    counted = F.col("traced") if received is None else received.agg(F.count(F.lit(1))).scalar()
    return totals.select(
        counted.alias("received"),
        "accepted",
        (counted - F.col("accepted")).alias("rejected"),
        "security_events",
        "offline_events",
        F.col("seen").alias("nodes"),
    )


def with_rejects(parsed: DataFrame) -> DataFrame:
    """All parsed messages as readings; rejected ones lose their node and take no part in any sequence."""
    node = F.when(F.col("reject_reason").isNull(), F.col("node_id")).alias("node_id")
    return parsed.select(*[node if name == "node_id" else name for name in READING_COLUMNS])


def batch_metrics(rules: Rules = Rules()) -> list[Column]:
    """Counters of traced messages as metrics that are observed while these are written."""
    return [
        F.count_if("accepted").alias("accepted"),
        F.coalesce(F.sum(events_of_message(rules)), F.lit(0)).cast("bigint").alias("security_events"),
    ]


def stored_counts(traced: DataFrame, devices: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """(table_name, n) of the device table and of the log and event rows that traced messages give, from one pass."""
    counts = pipeline_counters(traced, as_of, rules).select(
        F.col("accepted").alias("logs"), (F.col("security_events") + F.col("offline_events")).alias("events")
    )
    rows = F.array(
        F.struct(F.lit("sensor_logs").alias("table_name"), F.col("logs").alias("n")),
        F.struct(F.lit("system_events").alias("table_name"), F.col("events").alias("n")),
    )
    return table_counts(devices=devices).unionByName(counts.select(F.explode(rows).alias("row")).select("row.*"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, n) of each table as a distinct union."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.union, counts).distinct()
