"""Registered queries: every operator over the whole fleet of the ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.functions import encode, enums, naming, parsing, requests, text, topics
from sensorwarden.operators import counters, detect, export, health, latest, maintenance, sequence, thresholds
from sensorwarden.plans import fleet
from sensorwarden.session import apply_engine_conf
from sensorwarden.sources import messages, tables

RULES = fleet.rules()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_engine_conf(spark)
        return function(spark, sf_dir)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


def _screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.screen(fleet.readings(spark, sf_dir), fleet.devices(spark), RULES)


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.replays(fleet.readings(spark, sf_dir), fleet.devices(spark), RULES)


def _traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.trace(fleet.readings(spark, sf_dir), fleet.devices(spark), RULES)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.security_events(_traced(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.log_rows(_marked_logs(spark, sf_dir))


def _marked_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted flag without the follow-up windows, which stored readings do not need."""
    marked = _marked(spark, sf_dir)
    return marked.withColumn("accepted", F.col("fresh") & (F.col("status") != "NOT_OPERATING"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parse_messages(messages.counted(fleet.raw_messages(spark, sf_dir)), RULES)


# --- messages and parsing ------------------------------------------------------------------------------


@query
def counted_messages(spark, sf_dir):
    """Topic subscription and guards, alert topic included, counted per topic kind."""
    counted = messages.counted(fleet.raw_messages(spark, sf_dir), alerts=True)
    kind = F.split_part("topic", F.lit("/"), F.lit(4))
    return counted.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.length("payload")).alias("chars")
    )


@query
def parse_readings(spark, sf_dir):
    return parsing.valid_readings(_parsed(spark, sf_dir))


@query
def parse_rejects(spark, sf_dir):
    return parsing.rejects(_parsed(spark, sf_dir), RULES).select("seq", "topic", "reject_reason", "preview")


@query
def topic_node(spark, sf_dir):
    topic = F.col("topic")
    return fleet.raw_messages(spark, sf_dir).select(
        "seq",
        topics.node_from_topic(topic).alias("live_node"),
        topics.node_from_topic_prefix(topic).alias("prefix_node"),
    )


@query
def status_map(spark, sf_dir):
    """Reported status text -> status and ordinal, and sensor text -> type, ordinal, capabilities."""
    typed = fleet.events(spark, sf_dir).selectExpr(
        f"{fleet.MESSAGE['status_text']} as status_text", f"{fleet.MESSAGE['sensor_text']} as sensor_text"
    )
    status, sensor = enums.parse_status(F.col("status_text")), enums.parse_sensor_type(F.col("sensor_text"))
    return typed.groupBy("status_text", "sensor_text").agg(F.count(F.lit(1)).alias("messages")).select(
        "status_text",
        "sensor_text",
        status.alias("status"),
        enums.status_ordinal(status).alias("status_ordinal"),
        sensor.alias("sensor_type"),
        enums.sensor_ordinal(sensor).alias("sensor_ordinal"),
        enums.has_gas_sensor(sensor).alias("has_gas"),
        enums.has_env_sensors(sensor).alias("has_env"),
        "messages",
    )


@query
def node_naming(spark, sf_dir):
    """Dashboard names of the nodes and back."""
    nodes = fleet.readings(spark, sf_dir).groupBy("node_id").agg(F.count(F.lit(1)).alias("messages"))
    short = naming.dashboard_name(F.col("node_id"))
    return nodes.select("node_id", short.alias("node"), naming.canonical_name(short).alias("canonical"), "messages")


@query
def fixed_point(spark, sf_dir):
    """Integer encoding of every reading."""
    return fleet.readings(spark, sf_dir).select(
        "seq",
        encode.tenths(F.col("temperature")).alias("temperature10"),
        encode.tenths(F.col("humidity")).alias("humidity10"),
        encode.gas_or_null(F.col("gas")).alias("gas"),
        enums.status_ordinal(F.col("status")).alias("status_ordinal"),
    )


@query
def duration_text(spark, sf_dir):
    """Silence before every accepted message as text."""
    traced = _traced(spark, sf_dir).filter("accepted and prev is not null")
    gap = F.col("received_at") - F.col("prev.received_at")
    return traced.select("seq", gap.alias("silence_s"), text.duration(gap * 61).alias("silence_text"))


# --- detection -----------------------------------------------------------------------------------------


@query
def unauthorized_events(spark, sf_dir):
    return detect.unauthorized_events(_screened(spark, sf_dir))


@query
def replay_events(spark, sf_dir):
    return detect.replay_events(_marked(spark, sf_dir))


@query
def not_operating_events(spark, sf_dir):
    return detect.events_of(_traced(spark, sf_dir), detect.NOT_OPERATING, rules=RULES)


@query
def ts_regression(spark, sf_dir):
    return detect.events_of(_traced(spark, sf_dir), detect.TS_REGRESSION, rules=RULES)


@query
def temp_jump(spark, sf_dir):
    return detect.events_of(_traced(spark, sf_dir), detect.TEMP_JUMP, rules=RULES)


@query
def humi_jump(spark, sf_dir):
    return detect.events_of(_traced(spark, sf_dir), detect.HUMI_JUMP, rules=RULES)


@query
def gas_jump(spark, sf_dir):
    return detect.gas_jumps(_traced(spark, sf_dir), RULES)


@query
def security_events(spark, sf_dir):
    return _events(spark, sf_dir)


@query
def accepted_readings(spark, sf_dir):
    """Accepted readings with the values of the reading before them."""
    return _traced(spark, sf_dir).filter("accepted").select(
        "seq", "node_id", "status", "temperature", "msg_id", "mark", "received_at",
        F.col("prev.seq").alias("prev_seq"),
        F.col("prev.temperature").alias("prev_temperature"),
        F.col("prev.msg_id").alias("prev_msg_id"),
    )


# --- health --------------------------------------------------------------------------------------------


@query
def recovery_events(spark, sf_dir):
    return detect.events_of(_traced(spark, sf_dir), detect.RECOVERED, rules=RULES)


@query
def offline_events(spark, sf_dir):
    return detect.offline_events(_traced(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)


@query
def liveness_sessions(spark, sf_dir):
    readings = fleet.readings(spark, sf_dir)
    hot = sequence.count_hot(readings, RULES)
    return health.liveness_sessions(sequence.trace(readings, fleet.devices(spark), RULES, hot=hot), RULES, hot is not False)


@query
def spanned_events(spark, sf_dir):
    """All security events with every node above 200 messages cut into spans of about 97 rows."""
    rules = replace(RULES, hot_rows=200, chunk_rows=97)
    traced = sequence.trace(fleet.readings(spark, sf_dir), fleet.devices(spark), rules)
    return detect.security_events(traced, fleet.last_arrival(spark, sf_dir), rules)


@query
def status_timeline(spark, sf_dir):
    return health.status_timeline(_traced(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)


@query
def status_as_of(spark, sf_dir):
    """Status of every node two thirds into the recorded time."""
    timeline = status_timeline(spark, sf_dir)
    moment = fleet.events(spark, sf_dir).agg((F.floor(F.max("event_id") * 2 / 3) + fleet.START).alias("m")).scalar()
    return health.status_as_of(timeline, moment)


@query
def pipeline_counters(spark, sf_dir):
    """Counters of the whole run from raw messages on, rejected ones in the same pass."""
    received = messages.counted(fleet.raw_messages(spark, sf_dir))
    hot = sequence.count_hot(messages.named(received), RULES)
    everything = counters.with_rejects(parsing.parse_messages(received, RULES))
    traced = sequence.trace(everything, fleet.devices(spark), RULES, hot=hot)
    return counters.pipeline_counters(traced, fleet.last_arrival(spark, sf_dir), RULES)


@query
def node_metrics(spark, sf_dir):
    return health.node_metrics(_traced(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)


# --- stored readings -----------------------------------------------------------------------------------


@query
def sensor_log_rows(spark, sf_dir):
    return _logs(spark, sf_dir)


@query
def latest_by_device_ts(spark, sf_dir):
    return latest.latest_by_device_clock(_logs(spark, sf_dir), fleet.devices(spark), RULES)


@query
def latest_join_max(spark, sf_dir):
    """Ties included: the device clock is cut to minutes so that they occur."""
    minutes = _logs(spark, sf_dir).withColumn("timestamp", F.col("timestamp") - F.col("timestamp") % 60)
    return latest.latest_with_ties(minutes, fleet.devices(spark), RULES).select(
        "id", "node_id", "temp", "humi", "gas", "status", "msg_id", "timestamp"
    )


@query
def latest_cached(spark, sf_dir):
    return latest.latest_cached(_marked_logs(spark, sf_dir))


@query
def node_index(spark, sf_dir):
    fresh = _marked(spark, sf_dir).filter("fresh")
    return latest.node_index(fresh.select("node_id", "seq"))


@query
def last_n_readings(spark, sf_dir):
    return latest.last_readings(_logs(spark, sf_dir), 100).select("device_id", "rn", "id", "timestamp", "status")


@query
def node_history(spark, sf_dir):
    """One device over the middle of the first recorded hours."""
    logs = maintenance.with_event_date(_logs(spark, sf_dir))
    rows = latest.node_history(logs, 3, fleet.START + 300, fleet.START + 7200)
    return rows.select("id", "temp", "humi", "status", "msg_id", "timestamp")


@query
def retention_kept(spark, sf_dir):
    """Retention at a moment at which a third of the rows has expired."""
    as_of = fleet.events(spark, sf_dir).agg(
        (F.floor(F.max("event_id") / 3) + fleet.START + RULES.retention_days * 86400).alias("t")
    ).scalar()
    return maintenance.retained(_logs(spark, sf_dir), as_of, RULES).select("id", "device_id", "timestamp")


@query
def purge_counts(spark, sf_dir):
    as_of = fleet.events(spark, sf_dir).agg(
        (F.floor(F.max("event_id") / 3) + fleet.START + RULES.retention_days * 86400).alias("t")
    ).scalar()
    return maintenance.purge_counts(_logs(spark, sf_dir), as_of, RULES)


@query
def schema_alignment(spark, sf_dir):
    """Old log rows without the newer columns next to current ones."""
    logs = _logs(spark, sf_dir)
    old = logs.filter(F.col("id") % 2 == 0).drop("light_level", "buzzer_active", "is_muted")
    new = logs.filter(F.col("id") % 2 == 1)
    filled = maintenance.aligned(
        old,
        {
            "light_level": F.lit(None).cast("int"),
            "buzzer_active": F.lit(0),
            "is_muted": F.lit(0),
        },
    )
    return maintenance.appended(new, filled).select("id", "light_level", "buzzer_active", "is_muted")


# --- events --------------------------------------------------------------------------------------------


@query
def recent_events(spark, sf_dir):
    return latest.recent_events(_events(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)


@query
def events_by_severity(spark, sf_dir):
    return latest.events_by_severity(_events(spark, sf_dir))


@query
def system_event_rows(spark, sf_dir):
    return maintenance.event_rows(_events(spark, sf_dir))


@query
def critical_events_of_first_day(spark, sf_dir):
    events = latest.events_on(_events(spark, sf_dir), fleet.START, fleet.START + 86399, "CRITICAL")
    return events.groupBy("node_id", "event").agg(F.count(F.lit(1)).alias("events"))


@query
def trap_records(spark, sf_dir):
    return export.trap_records(_events(spark, sf_dir), fleet.START - 100, RULES)


@query
def alert_state(spark, sf_dir):
    return export.alert_state(_traced(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)


@query
def security_log_lines(spark, sf_dir):
    return export.alert_log_lines(_events(spark, sf_dir))


@query
def table_counts(spark, sf_dir):
    return counters.stored_counts(_traced(spark, sf_dir), fleet.devices(spark), fleet.last_arrival(spark, sf_dir), RULES)


@query
def oid_export(spark, sf_dir):
    exported = export.node_export(_traced(spark, sf_dir), fleet.last_arrival(spark, sf_dir), RULES)
    return export.oid_rows(exported, RULES)


@query
def dashboard_json(spark, sf_dir):
    newest = latest.latest_by_device_clock(_logs(spark, sf_dir), fleet.devices(spark), RULES)
    return export.dashboard_document(newest, tables.default_thresholds(spark, fleet.START), RULES)


# --- thresholds and devices ----------------------------------------------------------------------------


@query
def threshold_alerts(spark, sf_dir):
    return thresholds.threshold_alerts(fleet.readings(spark, sf_dir), RULES)


@query
def node_threshold_class(spark, sf_dir):
    named = fleet.readings(spark, sf_dir).withColumn("node_id", fleet.threshold_node())
    return thresholds.node_threshold_class(named, tables.default_thresholds(spark, fleet.START), RULES)


@query
def threshold_requests(spark, sf_dir):
    return requests.threshold_requests(fleet.threshold_bodies(spark, sf_dir))


@query
def mute_requests(spark, sf_dir):
    return requests.mute_requests(fleet.mute_bodies(spark, sf_dir))


@query
def command_messages(spark, sf_dir):
    asked = requests.threshold_requests(fleet.threshold_bodies(spark, sf_dir))
    muted = requests.mute_requests(fleet.mute_bodies(spark, sf_dir))
    return requests.threshold_commands(asked).unionByName(requests.mute_commands(muted))


@query
def threshold_apply(spark, sf_dir):
    asked = requests.threshold_requests(fleet.threshold_bodies(spark, sf_dir))
    stored = tables.default_thresholds(spark, fleet.START)
    return thresholds.apply_threshold_requests(stored, asked, fleet.last_arrival(spark, sf_dir))


@query
def provision_devices(spark, sf_dir):
    """Upsert of a node list taken from the fleet's own messages into the device table."""
    return maintenance.provisioned(
        fleet.devices(spark), fleet.node_list(spark, sf_dir), fleet.last_arrival(spark, sf_dir)
    )


@query
def provision_count(spark, sf_dir):
    return maintenance.provisioned_count(fleet.node_list(spark, sf_dir))


@query
def register_absent(spark, sf_dir):
    seen = fleet.readings(spark, sf_dir).select("node_id", "seq")
    return maintenance.registered(fleet.devices(spark), seen, fleet.last_arrival(spark, sf_dir))


@query
def last_msg_id_update(spark, sf_dir):
    return maintenance.advanced_marks(fleet.devices(spark), _marked_logs(spark, sf_dir))
