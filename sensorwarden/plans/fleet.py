"""A sensor fleet seen in the generic ``events`` table: the inputs of all registered queries.

Users are folded into 20 nodes and every event is one message, one second after the one before. The
expressions are plain SQL that also runs unchanged in other engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.enums import parse_sensor_type, parse_status
from sensorwarden.functions.parsing import READING_COLUMNS
from sensorwarden.functions.staging import evaluated_once
from sensorwarden.sources.messages import spread

START = 1704067200  # arrival second of event 0
UNLISTED = (3, 17)  # nodes missing from the whitelist

NODE = "concat('NODE_', lpad(cast(user_id%20 as varchar(3)),2,'0'))"

MESSAGE = {
    "seq": "event_id",
    "node_id": NODE,
    "sensor_text": (
        "case when user_id%20 < 8 then 'ENV_MONITOR' when user_id%20 < 16 then 'DHT11+MQ2' else 'SECURITY' end"
    ),
    "temperature": "cast(case when user_id%20 < 16 then value end as float)",
    "humidity": "cast(case when user_id%20 < 16 then cast(event_id*13%100 as double) end as float)",
    "gas": (
        "cast(case when user_id%20 between 8 and 15 then case when event_id%41=0 then -1 else event_id*37%1024 end end"
        " as int)"
    ),
    "light_level": "cast(case when user_id%20 < 8 then event_id*53%4096 end as int)",
    "buzzer_active": "case when user_id%20 < 8 then event_id%3=0 end",
    "is_muted": "case when user_id%20 < 8 then event_id%7=0 end",
    "status_text": (
        "case when event_id%29=0 then 'NOT_OPERATING' when event_type='error' then 'alarm'"
        " when event_type='signup' then 'warn' when event_type='click' then 'ok' else 'OPERATIONAL' end"
    ),
    "msg_id": "greatest(event_id+1-case when event_id%23=0 then 200 else 0 end, 1)",
    "timestamp": f"{START}+event_id-case when event_id%31=0 then 60 else 0 end",
    "received_at": f"{START}+event_id",
}

_R = "event_id%97"


def _part(key: str, normal: str, odd: dict[int, str]) -> str:
    """One member of the JSON text; ``odd`` replaces it for some remainders, '' leaves it out."""
    cases = " ".join(
        f"when {r} then '" + (f'"{key}":{text},' if text else "") + "'" for r, text in odd.items()
    )
    return f"case {_R} {cases} else concat('\"{key}\":', {normal}, ',') end"


def _measure(key: str, expression: str, odd: dict[int, str] | None = None) -> str:
    """One measurement; sensors a node lacks are left out."""
    text = f"coalesce('\"{key}\":' || cast({expression} as varchar(40)) || ',', '')"
    if not odd:
        return text
    cases = " ".join(f"when {r} then '\"{key}\":{other},'" for r, other in odd.items())
    return f"case {_R} {cases} else {text} end"


def _object(*members: str) -> str:
    return "concat('{', trim(trailing ',' from concat(" + ", ".join(members) + ")), '}')"


_MEASURES = _object(
    _measure("temp", "case when user_id%20 < 16 then value end", {9: '"25"', 31: "true"}),
    _measure("humi", "case when user_id%20 < 16 then event_id*13%100 end"),
    _measure("gas", MESSAGE["gas"], {10: "300.0"}),
    _measure("light_level", MESSAGE["light_level"]),
    _measure("buzzer_active", MESSAGE["buzzer_active"], {11: "1"}),
    _measure("is_muted", MESSAGE["is_muted"], {37: "null"}),
)

_DOCUMENT = _object(
    _part("node_id", f"'\"', {NODE}, '\"'", {1: "", 2: '""', 3: "7"}),
    _part("sensor_type", f"'\"', {MESSAGE['sensor_text']}, '\"'", {4: "", 5: "5", 30: "null"}),
    _part("payload", _MEASURES, {6: "", 7: "[]", 8: "null"}),
    _part("status", f"'\"', {MESSAGE['status_text']}, '\"'", {12: "", 13: "null"}),
    _part(
        "msg_id",
        f"cast({MESSAGE['msg_id']} as varchar(20))",
        {14: "", 15: "-1", 16: "5.0", 17: "true", 18: '"1"', 19: "4294967296", 20: "null"},
    ),
    _part("timestamp", f"cast({MESSAGE['timestamp']} as varchar(20))", {21: "", 22: '"x"', 23: "1704067200.9"}),
    f"case when {_R}=38 then '\"v\":\"x:1\",' else '' end",
)

RAW = {
    "seq": "event_id",
    "topic": (
        f"case {_R} when 32 then concat('factory/sensors/', {NODE}, '/alert') when 33 then ''"
        f" when 34 then 'factory/sensors/a/b/data' when 36 then 'factory/sensors'"
        f" else concat('factory/sensors/', {NODE}, '/data') end"
    ),
    "payload": (
        f"case {_R} when 24 then '[1]' when 27 then '' when 28 then 'plain text' else concat({_DOCUMENT},"
        f" case {_R} when 25 then ' x' when 26 then '] {{}}' when 29 then ',' else '' end) end"
    ),
    "retain": f"{_R}=35",
    "received_at": f"{START}+event_id",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_messages(seq, topic, payload, retain, received_at) with a share of malformed messages."""
    columns = [F.expr(text).alias(name) for name, text in RAW.items()]
    return evaluated_once(spread(events(spark, sf_dir)), *columns)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fleet as typed readings, as the parser would deliver well-formed messages."""
    typed = events(spark, sf_dir).selectExpr(*[f"{text} as {name}" for name, text in MESSAGE.items()])
    return (
        typed.withColumn("sensor_type", parse_sensor_type(F.col("sensor_text")))
        .withColumn("status", parse_status(F.col("status_text")))
        .withColumn("topic_node", F.col("node_id"))
        .select(*READING_COLUMNS)
    )


def devices(spark: SparkSession) -> DataFrame:
    n = F.col("id")
    return (
        spark.range(20)
        .filter(~n.isin(*UNLISTED))
        .select(
            (n + 1).alias("id"),
            F.concat(F.lit("NODE_"), F.lpad(n.cast("string"), 2, "0")).alias("node_id"),
            F.concat(F.lit("Line "), (n % 4).cast("string")).alias("location"),
            F.when(n < 8, "ENV_MONITOR").when(n < 16, "DHT11+MQ2").otherwise("SECURITY").alias("sensor_type"),
            n.between(8, 15).alias("has_gas"),
            F.when(n % 5 == 4, 300).otherwise(0).cast("bigint").alias("last_msg_id"),  # some start with a mark
            F.timestamp_seconds(F.lit(START)).alias("created_at"),
        )
    )


def last_arrival(spark: SparkSession, sf_dir: str) -> Column:
    """Arrival second of the last message, the moment reports are made for."""
    return events(spark, sf_dir).agg((F.max("event_id") + START).alias("as_of")).scalar()


# Operator requests as posted, with a share of invalid ones.
THRESHOLD_BODY = (
    "concat('{', case when event_id%19=0 then '' when event_id%19=1 then '\"node_id\":\"\",'"
    " else concat('\"node_id\":\"node_0', cast(user_id%4 as varchar(3)), '\",') end,"
    " case when event_id%17=0 then '\"threshold_type\":\"light\",' when event_id%5=0 then '\"threshold_type\":\"gas_warn\",'"
    " when event_id%5=1 then '\"threshold_type\":\"gas_crit\",' when event_id%5=2 then '\"threshold_type\":\"temp_warn\",'"
    " else '\"threshold_type\":\"temp_crit\",' end,"
    " case when event_id%23=0 then '\"v\":1' when event_id%23=1 then '\"value\":null' when event_id%23=2 then '\"value\":\"high\"'"
    " when event_id%23=3 then '\"value\":\"300.5\"' when event_id%23=4 then '\"value\":\" 42 \"' when event_id%23=5 then '\"value\":-1'"
    " when event_id%23=6 then '\"value\":20000' when event_id%23=7 then '\"value\":[1]' when event_id%23=8 then '\"value\":true'"
    " else concat('\"value\":', cast(value as varchar(40))) end, '}')"
)
MUTE_BODY = (
    "concat('{', case when event_id%13=0 then '' else concat('\"node_id\":\"node_0', cast(user_id%4 as varchar(3)), '\",') end,"
    " case when event_id%11=0 then '\"type\":\"\"' when event_id%3=0 then '\"type\":\"gas\"' when event_id%3=1 then '\"type\":\"temp\"'"
    " else '\"type\":\"light\"' end, '}')"
)


def threshold_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.expr(THRESHOLD_BODY).alias("body"))


def mute_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.expr(MUTE_BODY).alias("body"))


def threshold_node() -> Column:
    """Nodes 8-15 share the two nodes that have thresholds of their own, the others have none."""
    number = F.substring("node_id", 6, 2).cast("int")
    return F.when(number.between(8, 11), "node_02").when(number.between(12, 15), "node_03").otherwise(F.col("node_id"))


def node_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(position, node_id, location, sensor_type, has_gas) of every node that sent a signup event."""
    return readings(spark, sf_dir).filter("status = 'WARNING'").select(
        F.col("seq").alias("position"),
        "node_id",
        F.concat(F.lit("Hall "), (F.col("seq") % 3).cast("string")).alias("location"),
        "sensor_type",
        (F.col("seq") % 2 == 0).alias("has_gas"),
    )


def rules() -> Rules:
    return Rules()
