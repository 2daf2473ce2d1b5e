"""The window operators against the sequential interpreter, whole, cut into spans and in micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from interpreter import Gateway
from sensorwarden.config import Rules
from sensorwarden.operators import detect, health, sequence
from sensorwarden.operators.skew import with_span
from sensorwarden.schemas import DEVICE, READING

NODES = ["A", "B", "C", "X"]
LISTED = {"A": 0, "B": 3, "C": 0}


def make_messages(seed: int, n: int = 400) -> list[dict]:
    rng = random.Random(seed)
    out, clock = [], 1_700_000_000
    counter = dict.fromkeys(NODES, 1)
    for seq in range(n):
        # A sends most of the messages
        node = rng.choice(["A", "A", "A", "A", "B", "C", "X"])
        clock += rng.choice([0, 0, 1, 1, 2, 5, 6, 12, 31, 44])
        counter[node] += rng.choice([1, 1, 1, 2, 0])
        msg_id = max(0, counter[node] - (rng.choice([0, 1, 5]) if rng.random() < 0.2 else 0))
        status = rng.choices(["OPERATIONAL", "WARNING", "NOT_OPERATING", "ALARM"], [8, 1, 1, 1])[0]
        out.append(
            {
                "seq": seq,
                "node_id": node,
                "sensor_type": "ENV_MONITOR",
                "temperature": rng.choice([None, 10.0, 20.5, 30.5, 41.25, 55.0]),
                "humidity": rng.choice([None, 5.0, 45.0, 46.0, 90.0]),
                "gas": rng.choice([None, -1, 100, 310, 700]),
                "light_level": None,
                "buzzer_active": None,
                "is_muted": None,
                "status": status,
                "msg_id": msg_id,
                "timestamp": clock - rng.choice([0, 0, 0, 7]),
                "received_at": clock,
                "topic_node": node,
            }
        )
    return out


def frames(spark, messages):
    readings = spark.createDataFrame([tuple(m.values()) for m in messages], READING)
    devices = spark.createDataFrame(
        [(i + 1, node, "hall", "ENV_MONITOR", False, mark, None) for i, (node, mark) in enumerate(LISTED.items())],
        DEVICE,
    )
    return readings, devices


def expected(messages):
    gateway = Gateway(dict(LISTED))
    as_of = messages[-1]["received_at"]
    gateway.run_all(messages, as_of)
    return gateway, as_of


def outcome(traced, as_of, rules):
    rows = detect.security_events(traced, as_of, rules).select("id", "node_id", "event", "timestamp").collect()
    events = sorted((r.id // 8, r.node_id, r.event) for r in rows if r.event != "device_offline")
    offline = sorted((r.id // 8, r.node_id, r.timestamp) for r in rows if r.event == "device_offline")
    accepted = sorted(r.seq for r in traced.filter("accepted").select("seq").collect())
    return events, offline, accepted


@pytest.mark.parametrize(
    "seed,hot_rows,chunk_rows", [(1, 4_000_000, 1_000_000), (2, 20, 7), (3, 20, 61), (1, 0, 3), (12, 100, 29)]
)
def test_matches_interpreter(spark, seed, hot_rows, chunk_rows):
    messages = make_messages(seed)
    readings, devices = frames(spark, messages)
    rules = Rules(hot_rows=hot_rows, chunk_rows=chunk_rows)
    gateway, as_of = expected(messages)
    events, offline, accepted = outcome(sequence.trace(readings, devices, rules), as_of, rules)
    assert accepted == sorted(gateway.accepted)
    assert events == sorted(gateway.events)
    assert offline == sorted(gateway.offline)


@pytest.mark.parametrize("seed,cuts,hot_rows", [(4, [100, 101, 250], 4_000_000), (5, [37, 300], 20), (6, [200], 0)])
def test_state_carries_over_batches(spark, seed, cuts, hot_rows):
    messages = make_messages(seed)
    rules = Rules(hot_rows=hot_rows, chunk_rows=11)
    gateway, _ = expected(messages)
    state, events, accepted = None, [], []
    for start, end in zip([0, *cuts], [*cuts, len(messages)]):
        readings, devices = frames(spark, messages[start:end])
        traced = sequence.trace(readings, devices, rules, state=state)
        rows = detect.message_events(traced, rules).collect()
        events += [(r.id // 8, r.node_id, r.event) for r in rows]
        accepted += [r.seq for r in traced.filter("accepted").collect()]
        new = sequence.node_state(traced, state)
        state = spark.createDataFrame(new.collect(), new.schema)
    assert sorted(accepted) == sorted(gateway.accepted)
    assert sorted(events) == sorted(gateway.events)


@pytest.mark.parametrize("hot_rows,chunk_rows", [(10, 5)])
def test_replays_alone_agree_with_trace(spark, hot_rows, chunk_rows):
    readings, devices = frames(spark, make_messages(7))
    rules = Rules(hot_rows=hot_rows, chunk_rows=chunk_rows)
    alone = sequence.replays(readings, devices, rules).select("seq", "mark", "replay", "fresh")
    full = sequence.trace(readings, devices, rules).select("seq", "mark", "replay", "fresh")
    assert sorted(alone.collect()) == sorted(full.collect())


@pytest.mark.parametrize("hot_rows,chunk_rows", [(4_000_000, 1), (0, 2)])
def test_sessions(spark, hot_rows, chunk_rows):
    messages = make_messages(8)
    readings, devices = frames(spark, messages)
    rules = Rules(hot_rows=hot_rows, chunk_rows=chunk_rows)
    gateway, _ = expected(messages)
    sessions, last = [], {}
    for seq in sorted(gateway.accepted):
        m = messages[seq]
        current = last.get(m["node_id"])
        if current is None or m["received_at"] - current[3] > 30:
            current = [m["node_id"], seq, m["received_at"], m["received_at"], 0]
            sessions.append(current)
            last[m["node_id"]] = current
        current[3], current[4] = m["received_at"], current[4] + 1
    got = health.liveness_sessions(sequence.trace(readings, devices, rules), rules)
    rows = got.select("node_id", "first_seq", "started_at", "last_at", "messages").collect()
    assert sorted(tuple(r) for r in rows) == sorted(tuple(s) for s in sessions)


def test_large_device_table_is_not_broadcast(spark):
    messages = make_messages(9)
    readings, devices = frames(spark, messages)
    gateway, as_of = expected(messages)
    for hot_rows in (4_000_000, 20):
        rules = Rules(broadcast_rows=1, hot_rows=hot_rows, chunk_rows=13)
        events, offline, accepted = outcome(sequence.trace(readings, devices, rules), as_of, rules)
        assert (events, offline) == (sorted(gateway.events), sorted(gateway.offline))
        assert accepted == sorted(gateway.accepted)


def small(spark, rows, mark=0, rules=Rules()):
    """rows: (msg_id, status, temperature, device_ts, received_at)"""
    messages = [
        (i, "A", "ENV_MONITOR", t, None, None, None, None, None, status, msg_id, ts, at, "A")
        for i, (msg_id, status, t, ts, at) in enumerate(rows)
    ]
    readings = spark.createDataFrame(messages, READING)
    devices = spark.createDataFrame([(1, "A", "hall", "ENV_MONITOR", False, mark, None)], DEVICE)
    return sequence.trace(readings, devices, rules)


def ok(*ids):
    return [(i, "OPERATIONAL", None, 100 + n, 1000 + n) for n, i in enumerate(ids)]


def test_replay_goldens(spark):
    traced = small(spark, ok(1, 2, 2, 1, 5, 3)).orderBy("seq").collect()
    assert [r.msg_id for r in traced if r.accepted] == [1, 2, 5]
    assert [r.msg_id - r.mark for r in traced if r.replay] == [0, -1, -2]
    traced = small(spark, ok(0, 0, 1, 0)).orderBy("seq").collect()
    assert [r.accepted for r in traced] == [True, True, True, False]
    traced = small(spark, ok(9, 10, 11), mark=10).orderBy("seq").collect()
    assert [r.accepted for r in traced] == [False, False, True]
    traced = small(spark, ok(2, 1), rules=Rules(replay_detection=False)).collect()
    assert all(r.accepted for r in traced)


def test_fault_advances_the_mark(spark):
    rows = [(7, "NOT_OPERATING", None, 1, 1), (7, "OPERATIONAL", None, 2, 2)]
    got = [r.event for r in detect.message_events(small(spark, rows)).orderBy("id").collect()]
    assert got == ["device_not_operating", "replay_attack"]


def test_jump_goldens(spark):
    rows = [
        (1, "OPERATIONAL", 20.0, 1, 100),
        (2, "OPERATIONAL", 40.0, 2, 105),
        (3, "OPERATIONAL", 60.5, 3, 110),
        (4, "OPERATIONAL", 0.0, 4, 116),
    ]
    got = detect.message_events(small(spark, rows)).collect()
    assert [(r.id // 8, r.event) for r in got] == [(2, "temp_jump")]
    assert got[0].description == (
        "anomaly_detected [TEMP_JUMP] | node=A | T_new=60.500000°C | T_old=40.000000°C | delta=20.500000°C"
        " | threshold=20.000000°C | wall_dt=5s | device_dt=1s | msg_id=3"
    )


def test_regression_is_kept(spark):
    rows = [(1, "OPERATIONAL", None, 100, 100), (2, "OPERATIONAL", None, 90, 160)]
    traced = small(spark, rows)
    got = detect.message_events(traced).collect()
    assert got[0].description == (
        "anomaly_detected [TIMESTAMP_REGRESSION] | node=A | ts_new=90 | ts_old=100 | regression_s=10"
        " | msg_id_new=2 | msg_id_old=1"
    )
    assert traced.filter("accepted").count() == 2


def test_recovery_goldens(spark):
    def recovered(statuses):
        rows = [(i + 1, status, None, i, 1000 + i) for i, status in enumerate(statuses)]
        return [r.seq for r in health.recoveries(small(spark, rows)).collect()]

    assert recovered(["NOT_OPERATING"] + ["OPERATIONAL"] * 4) == [3]
    assert recovered(["NOT_OPERATING", "OPERATIONAL", "WARNING"] + ["OPERATIONAL"] * 3) == [5]
    assert recovered(["OPERATIONAL"] * 5) == []


def test_offline_goldens(spark):
    def offline(rows, as_of):
        ids = [(i + 1, status, None, i, at) for i, (status, at) in enumerate(rows)]
        return [r.offline_at for r in health.offline_rows(small(spark, ids), as_of).orderBy("seq").collect()]

    base = 1000
    up, down = "OPERATIONAL", "NOT_OPERATING"
    assert offline([(up, base), (up, base + 30)], base + 31) == []
    assert offline([(up, base), (up, base + 36)], base + 37) == [base + 35]
    assert offline([(up, base), (down, base + 10)], base + 500) == []
    assert offline([(down, base), (up, base + 5)], base + 500) == []


def test_plan_has_one_shuffle_and_one_sort(spark):
    messages = make_messages(10)
    readings, devices = frames(spark, messages)
    traced = sequence.trace(readings, devices, Rules(), hot=False)
    plan = detect.security_events(traced, 2_000_000_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "Python" not in plan


def test_timeline_status_as_of(spark):
    rows = [
        (1, "OPERATIONAL", None, 1, 1000),
        (2, "NOT_OPERATING", None, 2, 1100),
        (3, "OPERATIONAL", None, 3, 1101),
        (4, "OPERATIONAL", None, 4, 1102),
        (5, "OPERATIONAL", None, 5, 1103),
    ]
    timeline = health.status_timeline(small(spark, rows), 1200)
    got = [(r.at, r.status) for r in timeline.orderBy("seq", "step").collect()]
    assert got == [
        (1000, "OPERATIONAL"),
        (1035, "OFFLINE"),
        (1100, "FAULTY"),
        (1101, "FAULTY"),
        (1102, "FAULTY"),
        (1103, "OPERATIONAL"),
        (1135, "OFFLINE"),
    ]
    assert health.status_as_of(timeline, 1102).first().status == "FAULTY"
    assert timeline.filter(F.col("step") == 1).count() == 2


@pytest.mark.parametrize("seed", range(20, 26))
def test_cuts_never_show(spark, seed):
    """Faults, runs and replays across spans of a few rows, on top of the state of an earlier batch."""
    rng = random.Random(seed)
    messages, top = [], 0
    for seq in range(160):
        top += rng.choice([0, 1, 1, 1, 1, 40 if seq % 37 == 0 else 1])
        message = dict(make_messages(1, 1)[0], seq=seq * rng.choice([3, 5]) * 100 + seq, node_id="A", received_at=1_700_000_000 + seq * 9)
        message["msg_id"] = max(0, top - rng.choice([0, 0, 0, 0, 3, 30, 90]))
        message["status"] = rng.choices(["OPERATIONAL", "WARNING", "NOT_OPERATING"], [9, 1, 1])[0]
        message["topic_node"] = "A"
        messages.append(message)
    messages.sort(key=lambda m: m["seq"])
    readings, devices = frames(spark, messages)
    columns = ["seq", "mark", "replay", "fresh", "accepted"]
    around = ["prev.seq", "next_at", "streak", "recovered", "faulty"]
    first = sequence.trace(readings.filter("seq < 9000"), devices, hot=False)
    state = sequence.node_state(first)
    for low, before in ((0, None), (9000, state)):
        rows = readings.filter(F.col("seq") >= low)
        whole = sequence.trace(rows, devices, Rules(), state=before, hot=False)
        wanted, fresh = sorted(whole.select(*columns).collect()), sorted(whole.filter("fresh").select("seq", *around).collect(), key=repr)
        for chunk in (2, 5, 23):
            rules = Rules(hot_rows=0, chunk_rows=chunk)
            cut = sequence.trace(rows, devices, rules, state=before)
            assert cut.select("span").distinct().count() > 160 * (1 if low == 0 else 0.3) / chunk / 2
            assert sorted(cut.select(*columns).collect()) == wanted
            assert sorted(cut.filter("fresh").select("seq", *around).collect(), key=repr) == fresh


def test_hot_nodes_cost_one_shuffle_of_rows(spark, monkeypatch):
    """The rows are shuffled and sorted once and then kept; everything after that is a row per span."""
    plans = []
    write = sequence.cut_lineage

    def kept(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        physical = frame._jdf.queryExecution().executedPlan().toString()
        plans[-1] = (plans[-1], physical)
        return write(frame)

    monkeypatch.setattr(sequence, "cut_lineage", kept)
    readings, devices = frames(spark, make_messages(10))
    traced = sequence.trace(readings, devices, Rules(hot_rows=20, chunk_rows=11))
    rows = [physical for _, physical in plans if "temperature" in physical and "Window" in physical and "opens" in physical]
    assert rows[0].count("Exchange hashpartitioning") == 1 and rows[0].count("Sort [") == 1
    result = detect.security_events(traced, 2_000_000_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in result and "Window" not in result and "Sort [" not in result


def test_small_tables_are_not_counted(spark, tmp_path):
    readings, devices = frames(spark, make_messages(10))
    readings.write.parquet(str(tmp_path / "readings"))
    stored = spark.read.parquet(str(tmp_path / "readings"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no job", "")
    assert sequence.count_hot(stored, Rules()) is False
    assert list(tracker.getJobIdsForGroup("no job")) == []
    spark.sparkContext.setJobGroup("other", "")


def test_spans_of_bunched_seqs_hold_rows(spark):
    """One early stray message does not put all others into one span."""
    rows = spark.range(1000).select(F.when(F.col("id") == 0, -(2**40)).otherwise(F.col("id")).alias("seq"), F.lit("n").alias("node_id"))
    hot = sequence.count_hot(rows, Rules(hot_rows=500, chunk_rows=100))
    cut = with_span(rows, "node_id", "seq", hot, 10).groupBy("span").count().collect()
    assert len(cut) == 10 and max(r["count"] for r in cut) <= 200
    many = spark.range(30_000).select((F.col("id") * F.col("id")).alias("seq"), F.lit("n").alias("node_id"))
    hot = sequence.count_hot(many, Rules(hot_rows=500, chunk_rows=40))
    cut = with_span(many, "node_id", "seq", hot, 10).groupBy("span").agg(F.count("*").alias("n"), F.min("seq"), F.max("seq")).orderBy("span").collect()
    assert len(cut) > 700 and max(r["n"] for r in cut) <= 80
    assert all(a[3] < b[2] for a, b in zip(cut, cut[1:]))


def test_spans_of_sparse_seqs_hold_rows(spark):
    """Message offsets leave gaps in seq; spans are cut by rows all the same."""
    rows = spark.range(1000).select((F.col("id") * 65536 + 7).alias("seq"), F.lit("n").alias("node_id"))
    hot = sequence.count_hot(rows, Rules(hot_rows=500, chunk_rows=100))
    cut = with_span(rows, "node_id", "seq", hot, 10).groupBy("span").count().collect()
    assert len(cut) == 10 and max(r["count"] for r in cut) <= 101
    assert sequence.count_hot(rows, Rules(hot_rows=1000)) is False
