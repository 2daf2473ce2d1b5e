"""Sources, parsing and text helpers on the edge cases of the message format."""

import json

import pytest
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions import encode, naming, parsing, requests, text, topics
from sensorwarden.schemas import RAW_MESSAGE
from sensorwarden.sources import messages

GOOD = {
    "node_id": "N1",
    "sensor_type": "ENV_MONITOR",
    "payload": {"temp": 25.5, "humi": 45.2},
    "status": "OPERATIONAL",
    "msg_id": 1,
    "timestamp": 1715432000,
}


def doc(**changes):
    body = {**GOOD, **changes}
    return json.dumps({key: value for key, value in body.items() if value is not ...})


def parse(spark, payloads):
    rows = [(i, "factory/sensors/N1/data", p, False, 100) for i, p in enumerate(payloads)]
    return parsing.parse_messages(spark.createDataFrame(rows, RAW_MESSAGE)).orderBy("seq").collect()


REJECTS = [
    ("plain", "not_json"),
    ("   ", "not_json"),
    (doc() + " x", "not_json"),
    (doc() + "] {}", "not_json"),
    (doc() + "] [", "not_json"),
    (doc() + "," + doc(), "not_json"),
    (doc() + ",", "not_json"),
    (doc()[:-1], "not_json"),
    (doc()[:-1] + ',"x":NaN}', "not_json"),
    (doc().replace('"', "'"), "not_json"),
    ("[1]", "missing_node_id"),
    ("7", "missing_node_id"),
    ("null", "missing_node_id"),
    (doc(node_id=...), "missing_node_id"),
    (doc(sensor_type=...), "missing_sensor_type"),
    (doc(payload=...), "missing_payload"),
    (doc(status=...), "missing_status"),
    (doc(msg_id=...), "missing_msg_id"),
    (doc(timestamp=...), "missing_timestamp"),
    (doc(node_id=..., timestamp=...), "missing_node_id"),
    (doc(node_id=""), "bad_node_id"),
    (doc(node_id=7), "bad_node_id"),
    (doc(node_id=None), "bad_node_id"),
    (doc(msg_id=-1), "bad_msg_id"),
    (doc(msg_id=5.0), "bad_msg_id"),
    (doc(msg_id=True), "bad_msg_id"),
    (doc(msg_id="1"), "bad_msg_id"),
    (doc(msg_id=None), "bad_msg_id"),
    (doc(msg_id=2**64), "bad_msg_id"),
    (doc(msg_id=2**32), "msg_id_range"),
    (doc(msg_id=2**63), "msg_id_range"),
    (doc(timestamp="x"), "bad_timestamp"),
    (doc(timestamp=None), "bad_timestamp"),
    (doc(timestamp=1e300), "timestamp_range"),
    (doc(payload=[]), "bad_payload"),
    (doc(payload=None), "bad_payload"),
    (doc(payload="x"), "bad_payload"),
    (doc(status=5), "bad_type"),
    (doc(status=None), "bad_type"),
    (doc(sensor_type=5), "bad_type"),
    (doc(msg_id=-1, timestamp="x"), "bad_msg_id"),
    (doc(node_id=["N1"]), "bad_node_id"),
    (doc(node_id={"a": 1}), "bad_node_id"),
    (doc(payload={"temp": 1})[:-1] + ',"payload":3}', "bad_payload"),
    (doc()[:-1] + ',"msg_id":"x"}', "bad_msg_id"),
    (doc()[:-1] + ',"z":01}', "not_json"),
    (doc() + " // end", "not_json"),
]


def test_reject_reasons(spark):
    got = parse(spark, [payload for payload, _ in REJECTS])
    assert [(r.payload, r.reject_reason) for r in got] == REJECTS


ACCEPTED = [
    (doc(), {"temperature": 25.5, "status": "OPERATIONAL", "msg_id": 1, "timestamp": 1715432000}),
    (" " + doc() + "\n", {"msg_id": 1}),
    (doc(extra=[1, [2]]), {"msg_id": 1}),
    (doc(msg_id=2**32 - 1), {"msg_id": 2**32 - 1}),
    (doc(msg_id=0), {"msg_id": 0}),
    (doc(timestamp=1715432000.9), {"timestamp": 1715432000}),
    (doc(timestamp=-1.9), {"timestamp": -1}),
    (doc(timestamp=1715432000123456), {"timestamp": 1715432000123456}),
    (doc(timestamp=90071992547409931), {"timestamp": 90071992547409931}),
    (doc(status="alarm"), {"status": "ALARM"}),
    (doc(status="warn"), {"status": "WARNING"}),
    (doc(status="ok"), {"status": "OPERATIONAL"}),
    (doc(status="Ok"), {"status": "UNKNOWN"}),
    (doc(status="OFFLINE"), {"status": "UNKNOWN"}),
    (doc(sensor_type="DHT11+MQ2"), {"sensor_type": "ENV_MONITOR_GAS"}),
    (doc(sensor_type="x"), {"sensor_type": "UNKNOWN"}),
    (doc(payload={}), {"temperature": None, "humidity": None, "gas": None, "is_muted": None}),
    (doc(payload={"temp": "25", "humi": True, "gas": 300.0}), {"temperature": None, "humidity": None, "gas": None}),
    (doc(payload={"temp": None, "humi": 45, "gas": -1}), {"temperature": None, "humidity": 45.0, "gas": -1}),
    (doc(payload={"temp": "NaN", "humi": "Infinity"}), {"temperature": None, "humidity": None}),
    (doc(node_id="", msg_id=5)[:-1] + ',"node_id":"N2"}', {"node_id": "N2", "msg_id": 5}),
    (doc(payload={"temp": 1, "x": {"temp": 2, "y": "]"}}), {"temperature": 1.0}),
    (doc(timestamp=-0.5), {"timestamp": 0}),
    (doc(payload={"gas": 2**40, "light_level": 1e2}), {"gas": None, "light_level": None}),
    (doc(payload={"gas": "7", "light_level": 12}), {"gas": None, "light_level": 12}),
    (doc(payload={"buzzer_active": True, "is_muted": 1}), {"buzzer_active": True, "is_muted": None}),
    (doc(payload={"buzzer_active": "true", "is_muted": False}), {"buzzer_active": None, "is_muted": False}),
    (doc(node_id="ESP32_SEC_01", payload={"gas": 5}), {"gas": None}),
    (doc(node_id="Ünïcode ☃", payload={"gas": 5}), {"node_id": "Ünïcode ☃", "gas": 5}),
    (doc()[:-1] + ',"msg_id":9}', {"msg_id": 9}),
]


def test_accepted_values(spark):
    got = parse(spark, [payload for payload, _ in ACCEPTED])
    for row, (payload, values) in zip(got, ACCEPTED):
        assert row.reject_reason is None, payload
        assert {key: row[key] for key in values} == values, payload


def test_invalid_utf8_is_rejected(spark):
    rows = spark.createDataFrame([(0, "factory/sensors/N1/data", doc(), False, 1)], RAW_MESSAGE)
    broken = rows.withColumn(
        "payload", F.decode(F.lit("x"), "UTF-8") if False else F.expr("cast(unhex(concat(hex('{\"a\":\"'), 'FF', hex('\"}'))) as string)")
    )
    assert parsing.parse_messages(broken).first().reject_reason == "not_json"


def test_readings_and_rejects_split(spark):
    rows = [(0, "factory/sensors/N9/data", doc(), False, 5), (1, "factory/sensors/N1/data", "x" * 300, False, 6)]
    parsed = parsing.parse_messages(spark.createDataFrame(rows, RAW_MESSAGE))
    reading = parsing.valid_readings(parsed).first()
    assert (reading.node_id, reading.topic_node, reading.received_at) == ("N1", "N9", 5)
    reject = parsing.rejects(parsed).first()
    assert (len(reject.preview), len(reject.payload)) == (120, 300)


def test_guards_and_topics(spark):
    rows = [
        (0, "factory/sensors/A/data", "x", False, 1),
        (1, "factory/sensors//data", "x", False, 1),
        (2, "factory/sensors/A/data", "x", True, 1),
        (3, "factory/sensors/A/data", "", False, 1),
        (4, "", "x", False, 1),
        (5, "factory/sensors/A/B/data", "x", False, 1),
        (6, "factory/sensors/A/alert", "x", False, 1),
        (7, "factory/sensors/A/data", None, False, 1),
        (8, "factory/sensors/A/data", "x", None, 1),
    ]
    raw = spark.createDataFrame(rows, RAW_MESSAGE)
    assert sorted(r.seq for r in messages.counted(raw).collect()) == [0, 1, 8]
    assert sorted(r.seq for r in messages.counted(raw, alerts=True).collect()) == [0, 1, 6, 8]
    assert topics.filter_to_regex("a/+/#") == r"^\Qa\E/[^/]*/.*$"


@pytest.mark.parametrize(
    "topic,live,prefix",
    [("a/b/c/d", "c", "c"), ("a/b/c", "", "c"), ("a/b", "", ""), ("a/b/c/d/e", "c", "c"), ("", "", "")],
)
def test_node_from_topic(spark, topic, live, prefix):
    row = spark.range(1).select(
        topics.node_from_topic(F.lit(topic)).alias("a"), topics.node_from_topic_prefix(F.lit(topic)).alias("b")
    )
    assert tuple(row.first()) == (live, prefix)


def test_text_helpers(spark):
    cases = [(0, "0s"), (45, "45s"), (90, "1m 30s"), (3600, "1h 0m 0s"), (3700, "1h 1m 40s"), (-5, "-5s"), (90061, "25h 1m 1s")]
    rows = spark.createDataFrame(cases, "s bigint, expected string")
    assert rows.filter(text.duration(F.col("s")) != F.col("expected")).count() == 0
    one = spark.range(1)
    assert one.select(text.fixed6(F.lit(0.0078125))).first()[0] == "0.007812"
    assert one.select(text.fixed6(F.lit(25.1).cast("float"))).first()[0] == "25.100000"
    assert one.select(text.fixed6(F.lit(-1234567.25))).first()[0] == "-1234567.250000"
    assert one.select(text.utc_stamp(F.lit(1715675401))).first()[0] == "[2024-05-14 08:30:01 UTC]"
    assert one.select(text.event_date(F.lit(10**17))).first()[0] is None
    line = one.select(text.log_line(F.lit(1715675401), F.lit("ERROR"), F.lit("N"), F.lit("d"))).first()[0]
    assert line == "[2024-05-14 08:30:01 UTC] [ERROR] N — d"


def test_encoding(spark):
    cases = [(25.5, 255), (45.2, 452), (-3.0, 0), (23.75, 238), (0.0, 0), (None, None)]
    rows = spark.createDataFrame(cases, "v float, expected int")
    assert rows.filter(~encode.tenths(F.col("v")).eqNullSafe(F.col("expected"))).count() == 0
    gas = spark.createDataFrame([(-1, None), (0, 0), (7, 7), (None, None)], "v int, expected int")
    assert gas.filter(~encode.gas_or_null(F.col("v")).eqNullSafe(F.col("expected"))).count() == 0


def test_naming(spark):
    cases = [
        ("ESP32_SEC_01", "node_01"),
        ("ESP8266_SEC_02", "node_02"),
        ("ESP32_X", "node_01"),
        ("other_03", "node_03"),
        ("other", None),
    ]
    rows = spark.createDataFrame(cases, "n string, expected string")
    assert rows.filter(~naming.dashboard_name(F.col("n")).eqNullSafe(F.col("expected"))).count() == 0
    back = [("node_02", "ESP8266_SEC_02"), ("", "ESP32_SEC_01"), (None, "ESP32_SEC_01"), ("zzz", "zzz"), ("ESP32_SEC_01", "ESP32_SEC_01")]
    rows = spark.createDataFrame(back, "n string, expected string")
    assert rows.filter(~naming.canonical_name(F.col("n")).eqNullSafe(F.col("expected"))).count() == 0


def test_kafka_shape(spark):
    records = spark.createDataFrame(
        [(5, 2, b"factory/sensors/A/data", b"{}")], "offset bigint, partition int, key binary, value binary"
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(77)))
    row = messages.from_kafka(records).first()
    assert (row.seq, row.topic, row.payload, row.retain, row.received_at) == (
        5 * 65536 + 2, "factory/sensors/A/data", "{}", False, 77,
    )


def test_kafka_partitions_beyond_the_seq_bits_fail(spark):
    records = spark.createDataFrame(
        [(b"t", b"{}", 65536, 1)], "key binary, value binary, partition int, offset bigint"
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(1)))
    with pytest.raises(Exception, match="repeat seq values"):
        messages.from_kafka(records).collect()


@pytest.mark.parametrize("text, valid", [("1_000", True), ("1__0", False), ("_1", False), (" 42 ", True)])
def test_underscores_in_numbers(spark, text, valid):
    body = json.dumps({"node_id": "node_02", "threshold_type": "gas_warn", "value": text})
    row = requests.threshold_requests(spark.createDataFrame([(1, body)], "seq bigint, body string")).first()
    assert row.is_valid == valid and (not valid or row.value == float(text))


def test_small_numbers_in_commands(spark):
    values = [0.0005, 0.00012345, 5e-5, 1.5e-7, 0.001, 1.0, 99.5, 0.0]
    bodies = [(i, json.dumps({"node_id": "node_02", "threshold_type": "temp_warn", "value": v})) for i, v in enumerate(values)]
    frame = requests.threshold_requests(spark.createDataFrame(bodies, "seq bigint, body string"))
    got = {r.seq: r.payload for r in requests.threshold_commands(frame).collect()}
    assert got == {i: '{"cmd": "set_threshold", "temp_warn": %r}' % v for i, v in enumerate(values)}


def test_file_source(spark, tmp_path):
    line = {"seq": 1, "topic": "factory/sensors/N1/data", "payload": doc(), "retain": False, "received_at": 9}
    (tmp_path / "a.json").write_text(json.dumps(line))
    reading = parsing.valid_readings(parsing.parse_messages(messages.read_messages(spark, str(tmp_path)))).first()
    assert (reading.node_id, reading.received_at) == ("N1", 9)


def test_rules_are_values():
    assert Rules(temp_jump=5.0) == Rules(temp_jump=5.0) != Rules()
