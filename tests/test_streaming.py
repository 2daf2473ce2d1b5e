"""The stream gives what the batch gives; silence is noticed without data."""

import json
import time

from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.parsing import parse_messages, valid_readings
from sensorwarden.operators import detect, latest, maintenance, sequence
from sensorwarden.operators.counters import pipeline_counters
from sensorwarden.sources.messages import counted, read_messages
from sensorwarden.sources.versioned import LogTable, SnapshotTable
from sensorwarden.streaming import heartbeat, ingest
from test_sequence import frames, make_messages


def write_files(messages, folder, cuts):
    folder.mkdir()
    for n, (start, end) in enumerate(zip([0, *cuts], [*cuts, len(messages)])):
        lines = []
        for m in messages[start:end]:
            body = {
                "node_id": m["node_id"], "sensor_type": m["sensor_type"],
                "payload": {"temp": m["temperature"], "humi": m["humidity"], "gas": m["gas"]},
                "status": m["status"], "msg_id": m["msg_id"], "timestamp": m["timestamp"],
            }
            row = {"seq": m["seq"], "topic": f"factory/sensors/{m['node_id']}/data", "payload": json.dumps(body),
                   "retain": False, "received_at": m["received_at"]}
            lines.append(json.dumps(row))
        path = folder / f"part-{n}.json"
        path.write_text("\n".join(lines))
        stamp = 1_700_000_000 + n * 10
        import os

        os.utime(path, (stamp, stamp))


def event_cells(frame):
    return sorted(tuple(r) for r in frame.select("id", "node_id", "severity", "description", "timestamp").collect())


def test_stream_equals_batch(spark, tmp_path):
    messages = make_messages(11, 240)
    write_files(messages, tmp_path / "in", [60, 61, 150])
    _, devices = frames(spark, messages)
    rules = Rules(hot_rows=60, chunk_rows=25)
    landing = ingest.Landing(str(tmp_path / "out"))
    stored = SnapshotTable(spark, str(tmp_path / "devices"))
    stored.write(devices)

    raw = read_messages(spark, str(tmp_path / "in"), stream=True, maxFilesPerTrigger=1)
    query = ingest.start_ingest(
        raw, lambda session: stored.read(), landing, str(tmp_path / "checkpoint"), rules, availableNow=True
    )
    query.awaitTermination(600)
    assert query.exception() is None

    batch = read_messages(spark, str(tmp_path / "in"))
    traced = sequence.trace(valid_readings(parse_messages(counted(batch))), devices, rules)
    columns = ("id", "device_id", "temp", "status", "timestamp")
    expected = sorted(maintenance.log_rows(traced).select(*columns).collect(), key=repr)

    def logged():
        return sorted(landing.logs(spark).read().select(*columns).collect(), key=repr)

    def events():
        return event_cells(landing.read(spark, "system_events").filter(F.col("id") % 8 != detect.OFFLINE))

    wanted = event_cells(detect.message_events(traced, rules))
    assert (logged(), events()) == (expected, wanted)
    totals = pipeline_counters(traced, 0, rules, counted(batch)).first()
    counters = {"received": totals.received, "accepted": totals.accepted, "rejected": totals.rejected, "security_events": totals.security_events}
    assert ingest.stream_counters(spark, landing) == counters

    # repeating the last batch changes nothing
    ingest.process_batch(batch.filter("seq >= 150"), 3, stored.read(), landing, rules)
    assert (logged(), events()) == (expected, wanted)
    assert ingest.stream_counters(spark, landing) == counters
    assert not (tmp_path / "out" / "traced" / "batch_id=3").exists()

    # history, compaction and retention work on what the stream wrote
    logs = landing.logs(spark)
    low, high = min(m["timestamp"] for m in messages), max(m["timestamp"] for m in messages)
    history = latest.node_history(logs.read(low, high), 1, low, high).select("id").collect()
    assert [r.id for r in history] == [r.id for r in latest.node_history(maintenance.with_event_date(maintenance.log_rows(traced)), 1, low, high).select("id").collect()]
    assert max(logs.parts_per_date().values()) > 2
    assert logs.compact(most=2) >= 1 and max(logs.parts_per_date().values()) == 2
    ingest.keep_tidy(spark, landing)
    assert logged() == expected
    ingest.process_batch(batch.filter("seq >= 150"), 3, stored.read(), landing, rules)  # also after compaction
    assert logged() == expected
    limit = sorted(m["timestamp"] for m in messages)[100]
    deleted = logs.purge(limit + 7 * 86400, 7)
    assert deleted == sum(r.timestamp < limit for r in expected) > 0
    assert logged() == [r for r in expected if r.timestamp >= limit]

    # the marks of the stream go back to the device table
    ingest.store_marks(spark, landing, stored)
    marks = {r.node_id: r.last_msg_id for r in stored.read().collect()}
    assert {node: marks[node] for node in ("A", "B", "C")} == {
        r.node_id: max(r.mark, {"B": 3}.get(r.node_id, 0)) for r in sequence.node_state(traced).collect()
    }
    assert stored.read().columns == devices.columns


def test_only_buckets_of_the_batch_are_written(spark, tmp_path):
    messages = make_messages(13, 120)
    _, devices = frames(spark, messages)
    landing = ingest.Landing(str(tmp_path / "out"), state_buckets=16)

    def process(part, batch_id):
        folder = tmp_path / f"in{len(list(tmp_path.iterdir()))}"
        write_files(part, folder, [])
        ingest.process_batch(read_messages(spark, str(folder)), batch_id, devices, landing)

    states = landing.states(spark)
    process(messages[:80], 0)
    before = states._before(None)["buckets"]
    only = [m for m in messages[80:] if m["node_id"] == "B"]
    process(only, 1)
    after = states._before(None)["buckets"]
    own = str(states.touched(spark.createDataFrame([("B",)], "node_id string")).pop())
    assert {b for b in after if after[b] != before.get(b)} == {own} and set(before) <= set(after)
    readings, _ = frames(spark, messages[:80] + only)
    whole = sequence.node_state(sequence.trace(readings, devices))
    assert sorted(states.read().collect(), key=repr) == sorted(whole.collect(), key=repr)
    assert sorted(states.read(before_batch=1).collect(), key=repr) != sorted(whole.collect(), key=repr)
    states.vacuum()
    assert sorted(states.read().collect(), key=repr) == sorted(whole.collect(), key=repr)
    process(only, 1)
    assert sorted(states.read().collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_versions_appear_whole(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.write(spark.range(3))
    spark.range(9).write.parquet(table.manifest.data(2))  # data of a commit that never happened
    assert table.read().count() == 3
    table.update(lambda old: old.unionByName(spark.range(3, 5)))
    assert table.read().count() == 5 and table.manifest.versions() == [1, 2]
    table.write(spark.range(1))
    table.vacuum(keep=1)
    assert table.manifest.versions() == [3] and table.read().count() == 1
    assert table.manifest.files.names(str(tmp_path / "t" / "data")) == ["commit=3"]


def test_log_table_keeps_rows_without_a_clock(spark, tmp_path):
    logs = LogTable(spark, str(tmp_path / "logs"))
    assert logs.read().collect() == [] and logs.compact() == 0 and logs.purge(10**9, 7) == 0
    day = 86400
    rows = [(i, 1, None if i % 5 == 0 else i * day // 4) for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, device_id long, timestamp long")
    for batch in range(4):
        logs.append(frame.filter(F.col("id") % 4 == batch), batch)
    assert sorted(r.id for r in logs.read().collect()) == list(range(40))
    assert {r.id for r in logs.read(2 * day, 3 * day - 1).collect()} == {8, 9, 11}
    plan = logs.read(2 * day, 3 * day - 1)._jdf.queryExecution().toString()
    assert "1970-01-05" not in plan
    assert logs.purge(12 * day + 100, 7) == sum(t is not None and t < 5 * day + 100 for _, _, t in rows)
    assert {r.id for r in logs.read().collect()} == {i for i, _, t in rows if t is None or t >= 5 * day + 100}
    logs.vacuum()
    assert {r.id for r in logs.read().collect()} == {i for i, _, t in rows if t is None or t >= 5 * day + 100}


def test_heartbeats_equal_batch(spark, tmp_path):
    """Closed silences in and between batches, faults, the open silence at the end: the offline events of the batch."""
    messages = make_messages(11, 240)
    _, devices = frames(spark, messages)
    write_files(messages, tmp_path / "in", [100, 101])
    parsed = valid_readings(parse_messages(counted(read_messages(spark, str(tmp_path / "in")))))
    traced = sequence.trace(parsed, devices)
    wanted = detect.offline_events(traced, int(time.time())).select("id", "node_id", "severity", "description", "timestamp").collect()
    assert len(wanted) > 5
    landing = ingest.Landing(str(tmp_path / "out"))
    for n, (low, high) in enumerate([(0, 100), (100, 101), (101, 10**9)]):
        batch = read_messages(spark, str(tmp_path / "in")).filter(f"seq >= {low} and seq < {high}")
        ingest.process_batch(batch, n, devices, landing)
    inside = event_cells(landing.read(spark, "system_events").filter(F.col("id") % 8 == detect.OFFLINE))
    assert 0 < len(inside) < len(wanted)
    query = heartbeat.start_heartbeats(
        spark, f"{landing.root}/beats", str(tmp_path / "events"), str(tmp_path / "checkpoint"), files_per_batch=5, processingTime="1 second"
    )
    try:
        deadline, got = time.time() + 150, []
        while time.time() < deadline and len(got) < len(wanted) - len(inside) and query.isActive:
            time.sleep(2)
            if query.lastProgress:
                got = spark.read.parquet(str(tmp_path / "events")).collect()
        assert query.exception() is None
    finally:
        query.stop()
    between = [(r.id, r.node_id, r.severity, r.description, r.timestamp) for r in got]
    assert sorted(inside + between) == sorted(map(tuple, wanted))
