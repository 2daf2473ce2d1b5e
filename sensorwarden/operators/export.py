"""Export shapes: management OID rows, trap records, alert state, dashboard document, alert log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.encode import gas_or_null, tenths
from sensorwarden.functions.enums import status_ordinal
from sensorwarden.functions.naming import COMMAND_NODES, DASHBOARD_NAME, dashboard_name
from sensorwarden.functions.text import cut, log_line
from sensorwarden.operators.detect import is_humi_jump, is_temp_jump, is_ts_regression
from sensorwarden.operators.health import effective_status, offline_at
from sensorwarden.operators.thresholds import with_thresholds

# Event name -> trap type number.
TRAP_TYPE = {
    "device_offline": 1,
    "timestamp_regression": 2,
    "temp_jump": 2,
    "humi_jump": 2,
    "unauthorized_device": 3,
    "replay_attack": 4,
}
# Trap type number -> label.
TRAP_LABEL = {1: "DEVICE_OFFLINE", 2: "ANOMALY_DETECTED", 3: "UNAUTHORIZED_DEVICE", 4: "REPLAY_ATTACK"}

# Export column number -> (name, value type).
OID_COLUMNS = {
    1: ("status", "INTEGER"),
    2: ("temperature", "GAUGE"),
    3: ("humidity", "GAUGE"),
    4: ("alert", "INTEGER"),
    5: ("gas", "GAUGE"),
}


def _case(col: Column, mapping: dict) -> Column:
    chain = None
    for key, value in mapping.items():
        chain = F.when(col == key, F.lit(value)) if chain is None else chain.when(col == key, F.lit(value))
    return chain


def trap_type(event: Column) -> Column:
    """Trap number of an event, NULL for events without a trap."""
    return _case(event, TRAP_TYPE)


def trap_records(events: DataFrame, started_at: Column | int, rules: Rules = Rules()) -> DataFrame:
    """Events of a trap class as notification records."""
    started_at = started_at if isinstance(started_at, Column) else F.lit(started_at).cast("bigint")
    typed = events.withColumn("trap_type", trap_type(F.col("event"))).filter(F.col("trap_type").isNotNull())
    return typed.select(
        "id",
        "trap_type",
        _case(F.col("trap_type"), TRAP_LABEL).alias("trap_name"),
        F.concat(F.lit(rules.enterprise_oid + ".2."), F.col("trap_type").cast("string")).alias("trap_oid"),
        ((F.col("timestamp") - started_at) * 100).alias("uptime_cs"),
        "node_id",
        cut(F.col("description"), rules.detail_limit).alias("detail"),
        "timestamp",
    )


def _alert_change(as_of: Column | int, rules: Rules) -> Column:
    """Last alert change around a message: its highest step, so no row is multiplied."""

    def step(condition: Column, number: int, alert: int) -> Column:
        return F.when(condition, F.struct(F.lit(number).alias("step"), F.lit(alert).alias("alert")))

    anomaly = is_ts_regression() | is_temp_jump(rules) | is_humi_jump(rules)
    update = F.col("accepted") & (effective_status() == "OPERATIONAL")
    return F.greatest(
        step(~F.col("known") | F.col("replay") | anomaly, 0, 1),
        step(update, 1, 0),
        step(offline_at(as_of, rules).isNotNull(), 2, 1),
    )


def alert_state(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """Alert flag per node: set by a trap-class event, cleared by the next OPERATIONAL update.

    Within one message the checks (set) run before the update (clear), and the offline scan after it.
    """
    return (
        traced.withColumn("_change", _alert_change(as_of, rules))
        .groupBy("node_id")
        .agg(F.max_by("_change.alert", F.when(F.col("_change").isNotNull(), F.col("seq"))).alias("alert"))
        .select("node_id", F.coalesce("alert", F.lit(0)).alias("alert"))
    )


def node_export(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """One row per node with integer-encoded latest values, status and alert; one map-side combined pass."""
    status = F.when(offline_at(as_of, rules).isNotNull(), F.lit("OFFLINE")).otherwise(effective_status())
    values = F.struct(
        tenths(F.col("temperature")).alias("temperature"),
        tenths(F.col("humidity")).alias("humidity"),
        gas_or_null(F.col("gas")).alias("gas"),
    )
    return (
        traced.withColumn("_change", _alert_change(as_of, rules))
        .groupBy("node_id")
        .agg(
            F.min(F.when(F.col("fresh"), F.col("seq"))).alias("first_seq"),
            F.max_by(status, F.when(F.col("fresh"), F.col("seq"))).alias("status"),
            F.max_by(values, F.when(F.col("accepted"), F.col("seq"))).alias("v"),
            F.max_by("_change.alert", F.when(F.col("_change").isNotNull(), F.col("seq"))).alias("alert"),
        )
        .filter(F.col("first_seq").isNotNull())
        .select(
            "node_id",
            "first_seq",
            status_ordinal(F.col("status")).alias("status"),
            "v.temperature",
            "v.humidity",
            F.coalesce("alert", F.lit(0)).alias("alert"),
            "v.gas",
        )
    )


def oid_rows(exported: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Five OID rows for each of the fixed slots; slots are given out in order of first appearance.

    Nodes beyond the last slot are not exported, and an empty slot or missing sensor shows the no-data
    value.
    """
    # only the first slots can be exported: those few rows are numbered in one task
    first = exported.orderBy("first_seq").limit(rules.export_slots)
    slotted = first.withColumn("node_index", F.row_number().over(Window.orderBy("first_seq")).cast("bigint"))
    slots = exported.sparkSession.range(1, rules.export_slots + 1).select(F.col("id").alias("node_index"))
    rows = slots.join(slotted, "node_index", "left")
    cells = [
        F.struct(
            F.lit(number).alias("column"),
            F.lit(kind).alias("value_type"),
            F.coalesce(F.col(name).cast("bigint"), F.lit(rules.no_data).cast("bigint")).alias("value"),
        )
        for number, (name, kind) in OID_COLUMNS.items()
    ]
    return rows.select("node_index", F.explode(F.array(*cells)).alias("c")).select(
        F.concat(
            F.lit(rules.enterprise_oid + ".1."),
            F.col("node_index").cast("string"),
            F.lit("."),
            F.col("c.column").cast("string"),
        ).alias("oid"),
        "c.value_type",
        "c.value",
    )


DASHBOARD_FIELDS = ("temperature", "humidity", "gas", "light_level", "buzzer_active", "is_muted", "status", "msg_id", "timestamp")


def dashboard_rows(latest: DataFrame) -> DataFrame:
    """Latest log rows under their dashboard names; of several rows for one name the last one counts."""
    false = F.lit(False)
    return (
        latest.withColumn("node", dashboard_name(F.col("node_id")))
        .filter(F.col("node").isNotNull())
        .withColumns(
            {
                "temperature": F.col("temp"),
                "humidity": F.col("humi"),
                "buzzer_active": F.coalesce(F.col("buzzer_active").cast("boolean"), false),
                "is_muted": F.coalesce(F.col("is_muted").cast("boolean"), false),
            }
        )
        .groupBy("node")
        .agg(F.max_by(F.struct(*DASHBOARD_FIELDS), F.struct("timestamp", "id")).alias("r"))
        .select("node", "r.*")
    )


def dashboard_document(latest: DataFrame, thresholds: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One JSON document: every dashboard node with its latest values, and the thresholds in force."""
    spark = latest.sparkSession
    keep_nulls = {"ignoreNullFields": "false"}
    nodes = dashboard_rows(latest).select(
        "node", F.to_json(F.struct(*DASHBOARD_FIELDS), keep_nulls).alias("json")
    )
    names = spark.createDataFrame([(n,) for n in DASHBOARD_NAME.values()], "node string")
    full = names.join(nodes, "node", "left").select("node", F.coalesce("json", F.lit("{}")).alias("json"))
    limits = with_thresholds(
        spark.createDataFrame([(n,) for n in COMMAND_NODES], "node_id string"), thresholds, rules
    ).select("node_id", F.to_json(F.struct("gas_warn", "gas_crit", "temp_warn", "temp_crit"), keep_nulls).alias("json"))
    # a handful of dashboard names, never more
    part = lambda key, value: F.concat(F.lit('"'), key, F.lit('":'), value)
    left = full.agg(F.array_join(F.array_sort(F.collect_list(part(F.col("node"), F.col("json")))), ",").alias("nodes"))
    right = limits.agg(
        F.array_join(F.array_sort(F.collect_list(part(F.col("node_id"), F.col("json")))), ",").alias("limits")
    )
    return left.select(
        F.concat(
            F.lit("{"), F.col("nodes"), F.lit(',"thresholds":{'), right.scalar(), F.lit("}}")
        ).alias("document")
    )


def alert_log_lines(events: DataFrame) -> DataFrame:
    """Events as lines of the alert log."""
    return events.select(
        "id",
        log_line(F.col("timestamp"), F.col("severity"), F.col("node_id"), F.col("description")).alias("line"),
    )
