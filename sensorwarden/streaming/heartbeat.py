"""Offline detection of a stream: the silences between its batches, and a timer per node for the open one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sensorwarden.config import Rules
from sensorwarden.operators.detect import OFFLINE as OFFLINE_KIND
from sensorwarden.operators.detect import events_of
from sensorwarden.operators.maintenance import event_rows
from sensorwarden.schemas import LAST_READING

_READING = "status STRING, msg_id BIGINT, timestamp BIGINT, temperature FLOAT, humidity FLOAT"
BEAT = f"node_id STRING, first_seq BIGINT, first_at BIGINT, seq BIGINT, silent BOOLEAN, received_at BIGINT, {_READING}"
OFFLINE = f"seq BIGINT, node_id STRING, received_at BIGINT, {_READING}, offline_at BIGINT"
_STATE = f"seq BIGINT, silent BOOLEAN, received_at BIGINT, {_READING}"
_LAST = [part.split()[0] for part in _STATE.split(", ")]
_KEPT = [name for name in _LAST if name != "silent"]


def _plain(value):
    """A cell of pandas as the state store takes it."""
    if pd.isna(value):
        return None
    return value.item() if hasattr(value, "item") else value


class HeartbeatProcessor(StatefulProcessor):
    """Keeps the newest fresh message of a node and, while it may fall silent, a timer at the scan after the timeout.

    A node comes with one row per ingested batch (``beats_of``): its first arrival, which ends the silence before it, and
    its newest message. Silences inside a batch were found by a window over it. Timers run on the processing clock;
    ``received_at`` is the gateway clock, so both are wall clock times.
    """

    def __init__(self, rules: Rules = Rules()) -> None:
        self.timeout_s = rules.offline_timeout_s
        self.interval_s = rules.scan_interval_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def _scan(self, received_at: int) -> int:
        return ((received_at + self.timeout_s) // self.interval_s + 1) * self.interval_s

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = dict(zip(_LAST, self.last.get(), strict=True)) if self.last.exists() else None
        beats = sorted((row for part in rows for row in part.to_dict("records")), key=lambda row: row["seq"])
        found = []
        for beat in beats:
            if known and beat["seq"] <= known["seq"]:
                continue  # a batch that came again
            if known and known["silent"] and self._scan(known["received_at"]) < beat["first_at"]:
                found.append(known)
            known = {name: _plain(beat[name]) for name in _LAST}
        if known is None or not beats:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update(tuple(known[name] for name in _LAST))
        if known["silent"]:
            self.handle.registerTimer(self._scan(known["received_at"]) * 1000)
        if found:
            yield self._found(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = dict(zip(_LAST, self.last.get(), strict=True)) if self.last.exists() else None
        if known is None or not known["silent"]:
            return
        self.last.update(tuple({**known, "silent": False}[name] for name in _LAST))
        yield self._found(key, [known])

    def _found(self, key, beats: list[dict]) -> pd.DataFrame:
        rows = [{**{n: b[n] for n in _KEPT}, "node_id": key[0], "offline_at": self._scan(b["received_at"])} for b in beats]
        return pd.DataFrame(rows)[["seq", "node_id", *_KEPT[1:], "offline_at"]]

    def close(self) -> None:
        pass


def heartbeats(beats: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Streaming beats (columns of BEAT) -> offline transitions (columns of OFFLINE).

    Needs the RocksDB state store. The state is one row per node.
    """
    return beats.groupBy("node_id").transformWithStateInPandas(
        statefulProcessor=HeartbeatProcessor(rules),
        outputStructType=OFFLINE,
        outputMode="append",
        timeMode="processingTime",
    )


def beats_of(traced: DataFrame) -> DataFrame:
    """What the processor needs of a batch: one row per node with fresh messages; combined map-side."""
    silent = F.col("accepted") & ~F.col("faulty") & (F.col("received_at") > 0)
    newest = F.struct("seq", silent.alias("silent"), *_KEPT[1:])
    return (
        traced.filter("fresh")
        .groupBy("node_id")
        .agg(F.min(F.struct("seq", "received_at")).alias("first"), F.max_by(newest, "seq").alias("newest"))
        .select("node_id", F.col("first.seq").alias("first_seq"), F.col("first.received_at").alias("first_at"), "newest.*")
    )


def offline_event_rows(offline: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Offline transitions as system_events rows, with the ids and texts of the batch."""
    rows = offline.withColumn("prev", F.lit(None).cast(f"struct<{LAST_READING}>"))
    return event_rows(events_of(rows, OFFLINE_KIND, rules=rules))


def start_heartbeats(
    spark: SparkSession,
    beats_path: str,
    events_path: str,
    checkpoint: str,
    rules: Rules = Rules(),
    files_per_batch: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Follows the beats an ingest writes and appends the offline events it could not know to ``events_path``.

    A micro-batch takes at most ``files_per_batch`` files, so a backlog comes in portions. Each batch writes a directory
    of its own, so a repeated one changes nothing.
    """
    reader = spark.readStream.schema(BEAT).option("recursiveFileLookup", "true")
    beats = reader.option("maxFilesPerTrigger", files_per_batch).parquet(beats_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        offline_event_rows(batch, rules).write.mode("overwrite").parquet(f"{events_path}/offline_batch={batch_id}")

    return (
        heartbeats(beats, rules)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
