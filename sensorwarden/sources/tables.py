"""Stored tables and the configuration file."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.operators.maintenance import with_event_date

# Devices and thresholds of an empty installation.
DEFAULT_DEVICES = (
    ("ESP32_SEC_01", "ENV_MONITOR", "Factory Floor - Sector 01"),
    ("ESP8266_SEC_02", "DHT11+MQ2", "Factory Floor - Sector 02"),
    ("ESP8266_SEC_03", "DHT11+MQ2", "Factory Floor - Sector 03"),
)
DEFAULT_THRESHOLDS = (
    ("node_02", 250, 400, 35.0, 45.0),
    ("node_03", 250, 400, 35.0, 45.0),
)

WHITELIST = (
    "authorized_nodes struct<nodes: array<"
    "struct<node_id: string, sensor_type: string, location: string, has_gas: boolean>>>"
)


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """authorized_nodes.nodes[] of the JSON configuration as (position, node_id, location, sensor_type, has_gas)."""
    config = spark.read.schema(WHITELIST).json(path, multiLine=True)
    return config.select(F.posexplode("authorized_nodes.nodes").alias("position", "n")).select(
        F.col("position").cast("bigint"), "n.node_id", "n.location", "n.sensor_type", "n.has_gas"
    )


def default_devices(spark: SparkSession, now: int) -> DataFrame:
    rows = spark.createDataFrame(list(DEFAULT_DEVICES), "node_id string, sensor_type string, location string")
    return rows.select(
        F.regexp_extract("node_id", r"(\d+)$", 1).cast("bigint").alias("id"),
        "node_id",
        "location",
        "sensor_type",
        F.lit(False).alias("has_gas"),
        F.lit(0).cast("bigint").alias("last_msg_id"),
        F.timestamp_seconds(F.lit(now)).alias("created_at"),
    )


def default_thresholds(spark: SparkSession, now: int) -> DataFrame:
    rows = spark.createDataFrame(
        list(DEFAULT_THRESHOLDS), "node_id string, gas_warn int, gas_crit int, temp_warn double, temp_crit double"
    )
    stamp = F.timestamp_seconds(F.lit(now))
    return rows.withColumns({"created_at": stamp, "updated_at": stamp})


def insert_absent(table: DataFrame, rows: DataFrame, key: str = "node_id") -> DataFrame:
    """Rows whose key the table lacks are added; existing rows win."""
    return table.unionByName(rows.join(table.select(key), key, "left_anti"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_logs(rows: DataFrame, path: str) -> None:
    """Appends log rows, one directory per device-clock date, rows of a device close together.

    The rows arrive partitioned by node and span, so every task writes few devices and a busy day is
    spread over all tasks.
    """
    (
        with_event_date(rows)
        .sortWithinPartitions("event_date", "device_id", "timestamp")
        .write.mode("append")
        .partitionBy("event_date")
        .parquet(path)
    )


def append_events(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_log_lines(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("append").text(path)


def purge_logs(spark: SparkSession, table: str, as_of: int, retention_days: int, staging: str) -> int:
    """Deletes rows with a device clock before the cutoff from a managed table partitioned by event_date.

    Whole dates are dropped as partitions; only the date the cutoff falls into is rewritten, by way of
    ``staging``, a new directory on the shared file system. Returns the number of deleted rows.
    """
    limit = as_of - retention_days * 86400
    boundary = datetime.fromtimestamp(limit, UTC).date()
    logs = spark.table(table)
    day = logs.filter(F.col("event_date") == F.lit(boundary))
    whole_days = logs.filter(F.col("event_date") < F.lit(boundary)).count()
    partial = day.filter(F.col("timestamp") < limit).count()
    if partial:
        day.filter(F.col("timestamp") >= limit).write.parquet(staging)
        left = spark.read.schema(logs.schema).parquet(staging)
        if left.isEmpty():
            _drop_dates(spark, table, [boundary.isoformat()])
        else:
            left.createOrReplaceTempView("purge_staged_rows")
            columns = ", ".join(f"`{name}`" for name in logs.columns if name != "event_date")
            spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION (event_date = DATE'{boundary.isoformat()}') "
                f"SELECT {columns} FROM purge_staged_rows"
            )
            spark.catalog.dropTempView("purge_staged_rows")
    names = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    # dates as ISO text compare like dates; the partition of rows without a date stays
    _drop_dates(spark, table, [name for name in names if name[:1].isdigit() and name < boundary.isoformat()])
    return whole_days + partial


def _drop_dates(spark: SparkSession, table: str, dates: list[str]) -> None:
    for date in dates:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (event_date = DATE'{date}')")
