"""Table maintenance, requests, reports and exports on small fixtures."""

import json

from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions import requests
from sensorwarden.operators import counters, export, latest, maintenance, skew, thresholds
from sensorwarden.schemas import DEVICE, SENSOR_LOG, SYSTEM_EVENT
from sensorwarden.sources import tables

NOW = 1_700_000_000


def device_rows(spark):
    return spark.createDataFrame(
        [(1, "A", "old", "ENV_MONITOR", False, 7, None), (4, "B", "old", "SECURITY", False, 0, None)], DEVICE
    )


def logs(spark, rows):
    """rows: (id, device_id, timestamp)"""
    full = [(i, d, 20.0, None, None, None, None, None, "OPERATIONAL", i, ts, None) for i, d, ts in rows]
    return spark.createDataFrame(full, SENSOR_LOG)


def test_provisioning(spark):
    nodes = spark.createDataFrame(
        [(0, "C", "hall", "DHT11+MQ2", True), (1, "A", "x", "y", True), (2, "A", "new", "ENV", True), (3, "D", "z", "w", False)],
        "position bigint, node_id string, location string, sensor_type string, has_gas boolean",
    )
    got = {r.node_id: r for r in maintenance.provisioned(device_rows(spark), nodes, NOW).collect()}
    assert (got["A"].location, got["A"].sensor_type, got["A"].has_gas, got["A"].last_msg_id) == ("new", "ENV", True, 7)
    assert (got["B"].location, got["B"].id) == ("old", 4)
    assert (got["C"].id, got["D"].id, got["C"].last_msg_id) == (5, 6, 0)
    assert len(got) == 4


def test_registration(spark):
    seen = spark.createDataFrame([("Z", 9), ("A", 1), ("Y", 3), ("Z", 2)], "node_id string, seq bigint")
    got = {r.node_id: r for r in maintenance.registered(device_rows(spark), seen, NOW).collect()}
    assert (got["Z"].id, got["Y"].id, got["Z"].location) == (5, 6, "AUTO_REGISTERED")
    assert got["A"].location == "old"


def test_rank_over_spans(spark):
    rows = spark.createDataFrame([(i * 7 % 101,) for i in range(1, 101)], "v bigint")
    got = skew.ranked(rows, "v", "rank").orderBy("v").collect()
    assert [r["rank"] for r in got] == list(range(1, 101))
    sparse = spark.range(500).select((F.col("id") * F.col("id") * 10**12 - 10**15).alias("v"))
    ranks = skew.ranked(sparse, "v", "rank")
    assert [r["rank"] for r in ranks.orderBy("v").collect()] == list(range(1, 501))
    assert skew.ranked(rows.filter("v < 0"), "v", "rank").collect() == []
    # one row per range meets in one task, nothing else
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and plan.index("SinglePartition") > plan.index("_size")


def test_whitelist_config(spark, tmp_path):
    config = {"_comment": "x", "authorized_nodes": {"nodes": [
        {"node_id": "A", "sensor_type": "S", "platform": "p", "location": "L", "has_gas": True},
        {"node_id": "B", "sensor_type": "T", "location": "M", "has_gas": False}]}}
    path = tmp_path / "gateway.json"
    path.write_text(json.dumps(config, indent=1))
    got = tables.read_whitelist(spark, str(path)).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(0, "A", "L", "S", True), (1, "B", "M", "T", False)]


def test_seeds_do_not_replace_rows(spark):
    seeded = tables.insert_absent(tables.default_devices(spark, NOW).filter("id > 1"), tables.default_devices(spark, 0))
    got = seeded.orderBy("id").collect()
    assert [r.node_id for r in got] == ["ESP32_SEC_01", "ESP8266_SEC_02", "ESP8266_SEC_03"]
    assert got[0].created_at != got[1].created_at


def test_schema_alignment(spark):
    table = spark.createDataFrame([(1,)], "id int")
    got = maintenance.aligned(table, {"id": F.lit(5), "gas": F.lit(None).cast("int"), "flag": F.lit(0)}).first()
    assert tuple(got) == (1, None, 0)


def test_retention(spark):
    as_of = 8 * 86400
    table = logs(spark, [(1, 1, 86399), (2, 1, 86400), (3, 1, 999999)])
    assert [r.id for r in maintenance.retained(table, as_of).orderBy("id").collect()] == [2, 3]
    assert tuple(maintenance.purge_counts(table, as_of).first()) == (1, 2)


def test_purge_of_a_partitioned_table(spark, tmp_path):
    day = 86400
    table = logs(spark, [(1, 1, 10), (2, 1, day + 5), (3, 1, day + 500), (4, 1, 2 * day), (5, 1, 9 * day)])
    rows = maintenance.with_event_date(table)
    spark.sql(f"create database if not exists purge_db location '{tmp_path / 'db'}'")
    rows.write.partitionBy("event_date").saveAsTable("purge_db.logs")
    try:
        deleted = tables.purge_logs(spark, "purge_db.logs", 8 * day + 100, 7, str(tmp_path / "stage"))
        assert deleted == 2
        assert sorted(r.id for r in spark.table("purge_db.logs").collect()) == [3, 4, 5]
        # a second purge with nothing to do, and one that empties its boundary date
        assert tables.purge_logs(spark, "purge_db.logs", 8 * day + 100, 7, str(tmp_path / "stage2")) == 0
        assert tables.purge_logs(spark, "purge_db.logs", 9 * day + 1, 7, str(tmp_path / "stage3")) == 2
        assert sorted(r.id for r in spark.table("purge_db.logs").collect()) == [5]
    finally:
        spark.sql("drop database purge_db cascade")


def test_append_and_prune(spark, tmp_path):
    path = str(tmp_path / "logs")
    tables.append_logs(logs(spark, [(1, 1, 10), (2, 2, 86400 * 3)]), path)
    tables.append_logs(logs(spark, [(3, 1, 20)]), path)
    stored = tables.read_table(spark, path)
    history = latest.node_history(stored, 1, 0, 86399)
    assert [r.id for r in history.collect()] == [1, 3]
    assert "PartitionFilters: [isnotnull(event_date" in history._jdf.queryExecution().executedPlan().toString()


def test_latest_with_ties(spark):
    table = logs(spark, [(1, 1, 5), (2, 1, 5), (3, 4, 1)])
    got = latest.latest_with_ties(table, device_rows(spark)).collect()
    assert sorted(r.id for r in got) == [1, 2, 3]
    one = latest.latest_by_device_clock(table, device_rows(spark)).collect()
    assert [(r.node_id, r.id) for r in one] == [("A", 2), ("B", 3)]


def test_device_join_without_broadcast(spark):
    table = logs(spark, [(i, 1 if i % 3 else 4, i) for i in range(50)])
    wide = latest.attach_device(table, device_rows(spark), Rules(broadcast_rows=1, chunk_rows=5))
    close = latest.attach_device(table, device_rows(spark), Rules())
    assert sorted(wide.select("id", "node_id").collect()) == sorted(close.select("id", "node_id").collect())


def test_only_heavy_devices_are_sliced(spark):
    """One device owns half of the rows; the others keep one slice."""
    table = logs(spark, [(i, 1 if i % 2 else 100 + i, i) for i in range(2000)])
    heavy = {r.device_id: r.slices for r in skew.heavy_keys(table, "device_id", 50).collect()}
    assert heavy == {1: 20}
    names = table.select("device_id").distinct().withColumn("node_id", F.concat(F.lit("N"), F.col("device_id").cast("string")))
    joined = skew.sliced_join(table, names, "device_id", "id", 50)
    assert joined.count() == 2000 and joined.filter("node_id <> concat('N', device_id)").count() == 0
    kept = skew.sliced_join(table, names.filter("device_id <> 1"), "device_id", "id", 50, "left")
    assert kept.count() == 2000 and kept.filter("node_id is null").count() == 1000
    empty = skew.sliced_join(table.filter("id < 0"), names, "device_id", "id", 50)
    assert empty.collect() == []




def test_queries_read_the_messages_once(spark):
    from sensorwarden.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    for name in ("pipeline_counters", "table_counts", "latest_join_max", "liveness_sessions", "security_events"):
        frame = QUERIES[name](spark, sf)
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        messages = [line for line in plan.splitlines() if "Relation [" in line]
        assert len(messages) <= 2, (name, plan)  # the other one is the moment of the report
    sessions = QUERIES["liveness_sessions"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert sessions.count("Exchange hashpartitioning") == 1


def test_recent_events_fallback(spark):
    empty = spark.createDataFrame([], SYSTEM_EVENT)
    got = latest.recent_events(empty, 3661).collect()
    assert [tuple(r) for r in got] == [(1, "01:01:01", "System started and dashboard initialized", "startup")]
    some = spark.createDataFrame([(i, "A", "ERROR", f"d{i}", 100 + i // 2, None) for i in range(60)], SYSTEM_EVENT)
    got = latest.recent_events(some, 0).orderBy("position").collect()
    assert len(got) == 50 and got[0].description == "d59" and got[0].type == "error"


THRESHOLD_CASES = [
    ('{"node_id":"node_02","threshold_type":"gas_warn","value":300}', None, 300.0),
    ('{"node_id":"node_02","threshold_type":"gas_warn","value":300.7}', None, 300.0),
    ('{"node_id":"node_02","threshold_type":"gas_warn","value":-0.5}', None, 0.0),
    ('{"node_id":"node_02","threshold_type":"gas_warn","value":"300"}', None, 300.0),
    ('{"node_id":"node_02","threshold_type":"gas_warn","value":"300.5"}', requests.BAD_VALUE, None),
    ('{"node_id":"node_02","threshold_type":"gas_warn","value":"1e3"}', requests.BAD_VALUE, None),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":"1e1"}', None, 10.0),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":" 45.5 "}', None, 45.5),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":100}', None, 100.0),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":100.1}', requests.TEMP_RANGE, None),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":"inf"}', requests.TEMP_RANGE, None),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":"nan"}', requests.BAD_VALUE, None),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":"5d"}', requests.BAD_VALUE, None),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":[1]}', requests.BAD_VALUE, None),
    ('{"node_id":"node_03","threshold_type":"temp_crit","value":true}', None, 1.0),
    ('{"node_id":"node_02","threshold_type":"gas_crit","value":10001}', requests.GAS_RANGE, None),
    ('{"node_id":"node_02","threshold_type":"gas_crit","value":"99999999999999999999"}', requests.GAS_RANGE, None),
    ('{"node_id":"node_02","threshold_type":"gas_crit","value":0}', None, 0.0),
    ('{"node_id":"node_02","threshold_type":"gas_crit","value":null}', requests.MISSING, None),
    ('{"node_id":"node_02","threshold_type":"gas_crit"}', requests.MISSING, None),
    ('{"node_id":"","threshold_type":"gas_crit","value":1}', requests.MISSING, None),
    ('{"node_id":0,"threshold_type":"gas_crit","value":1}', requests.MISSING, None),
    ('{"node_id":{},"threshold_type":"gas_crit","value":1}', requests.MISSING, None),
    ('{"node_id":[null],"threshold_type":"gas_crit","value":1}', requests.UNKNOWN_NODE, None),
    ('{"node_id":"node_01","threshold_type":"gas_crit","value":1}', requests.UNKNOWN_NODE, None),
    ('{"node_id":"node_01","threshold_type":"light","value":1}', requests.BAD_TYPE, None),
    ('{"node_id":"node_01","threshold_type":5,"value":1}', requests.BAD_TYPE, None),
    ("nonsense", requests.BAD_BODY, None),
]


def test_threshold_requests(spark):
    bodies = spark.createDataFrame([(i, c[0]) for i, c in enumerate(THRESHOLD_CASES)], "seq bigint, body string")
    got = requests.threshold_requests(bodies).orderBy("seq").collect()
    assert [(c[0], r.error, r.value) for c, r in zip(THRESHOLD_CASES, got)] == THRESHOLD_CASES
    commands = requests.threshold_commands(requests.threshold_requests(bodies)).orderBy("seq").collect()
    assert tuple(commands[0]) == (0, "factory/sensors/ESP8266_SEC_02/cmd", '{"cmd": "set_threshold", "gas_warn": 300}')
    assert commands[4].payload == '{"cmd": "set_threshold", "temp_crit": 10.0}'


def test_mute_requests(spark):
    cases = [
        ('{"node_id":"node_02","type":"gas"}', None),
        ('{"node_id":"node_02","type":"light"}', requests.BAD_BUZZER),
        ('{"node_id":"node_01","type":"gas"}', requests.BAD_BUZZER),
        ('{"node_id":"node_01"}', requests.MISSING),
        ("[]", requests.BAD_BODY),
    ]
    bodies = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "seq bigint, body string")
    asked = requests.mute_requests(bodies)
    assert [(c[0], r.error) for c, r in zip(cases, asked.orderBy("seq").collect())] == cases
    assert [tuple(r) for r in requests.mute_commands(asked).collect()] == [
        (0, "factory/sensors/ESP8266_SEC_02/cmd", '{"cmd": "mute_gas"}')
    ]


def test_threshold_update(spark):
    asked = spark.createDataFrame(
        [(1, "node_02", "gas_warn", 5.0, True), (2, "node_02", "gas_warn", 6.0, True), (3, "node_02", "gas_warn", 7.0, False),
         (4, "node_09", "gas_warn", 8.0, True)],
        "seq bigint, node_id string, threshold_type string, value double, is_valid boolean",
    )
    stored = tables.default_thresholds(spark, 0)
    got = {r.node_id: r for r in thresholds.apply_threshold_requests(stored, asked, NOW).collect()}
    assert (got["node_02"].gas_warn, got["node_02"].gas_crit) == (6, 400)
    assert got["node_02"].updated_at != got["node_02"].created_at
    assert got["node_03"].updated_at == got["node_03"].created_at
    assert set(got) == {"node_02", "node_03"}


def test_thresholds_and_defaults(spark):
    readings = spark.createDataFrame(
        [(1, "node_02", 300, 36.0), (2, "other", 300, 46.0), (3, "other", -1, None)],
        "seq bigint, node_id string, gas int, temperature float",
    )
    got = thresholds.node_threshold_class(readings, tables.default_thresholds(spark, 0)).orderBy("seq").collect()
    assert [tuple(r)[2:] for r in got] == [("warn", "warn"), ("ok", "crit"), (None, None)]


def test_dashboard_document(spark):
    table = logs(spark, [(1, 1, 5)]).withColumn("buzzer_active", F.lit(1))
    devices = device_rows(spark).withColumn("node_id", F.when(F.col("id") == 1, "ESP32_SEC_01").otherwise("B"))
    newest = latest.latest_by_device_clock(table, devices)
    body = json.loads(export.dashboard_document(newest, tables.default_thresholds(spark, 0)).first().document)
    assert body["node_01"] == {
        "temperature": 20.0, "humidity": None, "gas": None, "light_level": None, "buzzer_active": True,
        "is_muted": False, "status": "OPERATIONAL", "msg_id": 1, "timestamp": 5,
    }
    assert body["node_02"] == {}
    assert body["thresholds"]["node_03"] == {"gas_warn": 250, "gas_crit": 400, "temp_warn": 35.0, "temp_crit": 45.0}


def test_oid_rows(spark):
    exported = spark.createDataFrame(
        [(f"N{i:02d}", 100 - i, 0, 255, None, 1, None) for i in range(20)],
        "node_id string, first_seq bigint, status int, temperature int, humidity int, alert int, gas int",
    )
    got = {r.oid: (r.value_type, r.value) for r in export.oid_rows(exported).collect()}
    assert len(got) == 80
    assert got["1.3.6.1.4.1.9999.1.1.2"] == ("GAUGE", 255)
    assert got["1.3.6.1.4.1.9999.1.16.3"] == ("GAUGE", 238)
    few = {r.oid: r.value for r in export.oid_rows(exported.limit(1)).collect()}
    assert few["1.3.6.1.4.1.9999.1.2.1"] == 238


def test_table_counts(spark):
    got = counters.table_counts(a=spark.range(3), b=spark.range(0)).collect()
    assert sorted(tuple(r) for r in got) == [("a", 3), ("b", 0)]


def test_trap_detail_is_cut(spark):
    events = spark.createDataFrame(
        [(1, "A", "replay_attack", "CRITICAL", "x" * 300, 110), (2, "A", "device_recovered", "WARNING", "y", 111)],
        "id bigint, node_id string, event string, severity string, description string, timestamp bigint",
    )
    got = export.trap_records(events, 100, Rules()).collect()
    assert [(r.trap_type, r.trap_oid, r.uptime_cs, len(r.detail)) for r in got] == [(4, "1.3.6.1.4.1.9999.2.4", 1000, 255)]
