"""Streaming ingest: each micro-batch runs the batch operators, seeded with the state of the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorwarden.config import Rules
from sensorwarden.functions.parsing import parse_messages, rejects, valid_readings
from sensorwarden.operators.counters import batch_metrics
from sensorwarden.operators.detect import OFFLINE, events_of, message_events
from sensorwarden.operators.health import closed_silences
from sensorwarden.operators.maintenance import event_rows, log_rows
from sensorwarden.operators.sequence import node_state, trace
from sensorwarden.sources.messages import counted
from sensorwarden.sources.versioned import Files, LogTable, SnapshotTable
from sensorwarden.streaming.heartbeat import beats_of
from sensorwarden.streaming.state import NodeStateTable

#: Directories of a date after which its log rows are compacted.
MOST_PARTS = 16


@dataclass(frozen=True)
class Landing:
    """Places of one ingest, on a file system all executors share."""

    root: str
    state_buckets: int = 64

    def table(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch_id={batch_id}"

    def states(self, spark: SparkSession) -> NodeStateTable:
        return NodeStateTable(spark, f"{self.root}/node_state", self.state_buckets)

    def logs(self, spark: SparkSession) -> LogTable:
        return LogTable(spark, f"{self.root}/sensor_logs")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}")


def process_batch(
    raw: DataFrame,
    batch_id: int,
    devices: DataFrame,
    landing: Landing,
    rules: Rules = Rules(),
    initial: DataFrame | None = None,
) -> None:
    """One micro-batch. Every output belongs to the batch id and is replaced when the batch comes again, so each message
    takes effect once.

    Messages are parsed and traced once each; both results are written for the outputs that read them and deleted when
    the batch is done. The state is committed last: it also holds the counters.
    """
    spark = raw.sparkSession
    states, logs = landing.states(spark), landing.logs(spark)
    received = Observation()
    parsed = parse_messages(counted(raw), rules).observe(received, F.count(F.lit(1)).alias("received"))
    parsed.write.mode("overwrite").parquet(landing.table("parsed", batch_id))
    parsed = spark.read.schema(parsed.schema).parquet(landing.table("parsed", batch_id))
    rejects(parsed, rules).write.mode("overwrite").parquet(landing.table("quarantine", batch_id))

    # only buckets that hold nodes of this batch are read and written
    nodes = parsed.select("node_id").distinct()
    wanted = states.touched(nodes)
    old = states.of_buckets(batch_id, wanted)
    if initial is not None and batch_id == 0:
        old = initial
        wanted |= states.touched(initial)
    met = old.join(nodes, "node_id", "left_semi")
    metrics = Observation()
    traced = trace(valid_readings(parsed), devices, rules, state=met).observe(metrics, *batch_metrics(rules))
    traced.write.mode("overwrite").parquet(landing.table("traced", batch_id))
    traced = spark.read.schema(traced.schema).parquet(landing.table("traced", batch_id))
    logs.append(log_rows(traced), batch_id)
    silences = event_rows(events_of(closed_silences(traced, rules), OFFLINE, rules=rules))
    events = event_rows(message_events(traced, rules)).unionByName(silences)
    events.write.mode("overwrite").parquet(landing.table("system_events", batch_id))
    beats_of(traced).write.mode("overwrite").parquet(landing.table("beats", batch_id))
    states.commit(node_state(traced, old), batch_id, wanted, {**received.get, **metrics.get})
    for name in ("parsed", "traced"):
        Files(spark).delete(landing.table(name, batch_id))


def keep_tidy(spark: SparkSession, landing: Landing) -> None:
    """Bounds files and versions; between batches, by the one that runs them."""
    logs, states = landing.logs(spark), landing.states(spark)
    logs.compact(MOST_PARTS)
    logs.vacuum()
    states.vacuum()


def start_ingest(
    raw: DataFrame,
    devices,
    landing: Landing,
    checkpoint: str,
    rules: Rules = Rules(),
    initial: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Starts the ingest of a streaming ``raw`` frame.

    ``devices`` is a function of the session, called for every batch, so the whitelist may change while the
    stream runs. ``trigger`` goes to ``DataStreamWriter.trigger``, e.g. ``availableNow=True``. How much a batch holds is
    bounded by the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, devices(batch.sparkSession), landing, rules, initial)
        if batch_id % MOST_PARTS == MOST_PARTS - 1:
            keep_tidy(batch.sparkSession, landing)

    return (
        raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def stream_counters(spark: SparkSession, landing: Landing) -> dict[str, int]:
    """received, accepted, rejected and security_events of all batches, offline events apart: what ``pipeline_counters``
    counts for a batch. Each batch counts once however often it ran.
    """
    total = landing.states(spark).counters()
    counted = {name: total.get(name, 0) for name in ("received", "accepted", "security_events")}
    return {**counted, "rejected": counted["received"] - counted["accepted"]}


def device_marks(devices: DataFrame, state: DataFrame) -> DataFrame:
    """Device table with the marks of the stream's state, for the next cold start."""
    marks = state.select("node_id", F.col("mark").alias("_mark"))
    return devices.join(marks, "node_id", "left").select(
        *[c for c in devices.columns if c != "last_msg_id"],
        F.greatest("last_msg_id", "_mark").alias("last_msg_id"),
    )


def store_marks(spark: SparkSession, landing: Landing, devices: SnapshotTable) -> None:
    """After a stop: the marks of the stream go back to the stored device table as a new version."""
    state = landing.states(spark).read()
    devices.update(lambda table: device_marks(table, state).select(table.columns))
