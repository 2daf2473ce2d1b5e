"""ANSI SQL for every registered query, over the same tables.

The rules are written down a second time here, as whole-node windows, islands and joins; the engine's
DataFrame code shares only the expressions that shape ``events`` into messages.
"""

from __future__ import annotations

from sensorwarden.plans.fleet import MESSAGE, MUTE_BODY, RAW, START, THRESHOLD_BODY, UNLISTED

STATUS = """case status_text when 'OPERATIONAL' then 'OPERATIONAL' when 'WARNING' then 'WARNING'
  when 'CRITICAL' then 'CRITICAL' when 'NOT_OPERATING' then 'NOT_OPERATING' when 'alarm' then 'ALARM'
  when 'warn' then 'WARNING' when 'ok' then 'OPERATIONAL' else 'UNKNOWN' end"""
SENSOR = """case sensor_text when 'ENV_MONITOR' then 'ENV_MONITOR' when 'SECURITY' then 'SECURITY'
  when 'DHT11+MQ2' then 'ENV_MONITOR_GAS' when 'ENV_MONITOR_GAS' then 'ENV_MONITOR_GAS' else 'UNKNOWN' end"""
ORDINAL = """case {0} when 'OPERATIONAL' then 0 when 'WARNING' then 1 when 'CRITICAL' then 2 when 'NOT_OPERATING' then 3
  when 'OFFLINE' then 4 when 'FAULTY' then 5 when 'ALARM' then 6 else 255 end"""

_messages = ", ".join(f'{text} as "{name}"' for name, text in MESSAGE.items())
AS_OF = f"(select max(event_id) + {START} from events)"

# Steps of the pipeline as common table expressions; each query names the ones it builds on.
STEPS = {
    "msgs": f"""msgs as (select seq, node_id, {SENSOR} as sensor_type, temperature, humidity, gas, light_level,
      buzzer_active, is_muted, {STATUS} as status, msg_id, "timestamp", received_at from (select {_messages} from events))""",
    "devices": f"""devices as (select i + 1 as id, concat('NODE_', lpad(cast(i as varchar), 2, '0')) as node_id,
      concat('Line ', cast(i % 4 as varchar)) as location,
      case when i < 8 then 'ENV_MONITOR' when i < 16 then 'DHT11+MQ2' else 'SECURITY' end as sensor_type,
      i between 8 and 15 as has_gas, cast(case when i % 5 = 4 then 300 else 0 end as bigint) as last_msg_id, timestamp '2024-01-01 00:00:00' as created_at
      from range(20) as t(i) where i not in {UNLISTED})""",
    "judged": """judged as (select *, known and mark <> 0 and msg_id <= mark as replay,
        known and not (mark <> 0 and msg_id <= mark) as fresh
      from (select *, greatest(coalesce(max(case when known then msg_id end) over (partition by node_id order by seq
          rows between unbounded preceding and 1 preceding), 0), coalesce(seed, 0)) as mark
        from (select m.*, d.id as device_id, d.last_msg_id as seed, d.id is not null as known
          from msgs m left join devices d on d.node_id = m.node_id)))""",
    "accepted": """accepted as (select *,
        lag(seq) over w as p_seq, lag(temperature) over w as p_temp, lag(humidity) over w as p_humi,
        lag(gas) over w as p_gas, lag(msg_id) over w as p_msg, lag("timestamp") over w as p_ts,
        lag(received_at) over w as p_at, lead(received_at) over w as n_at
      from judged where fresh and status <> 'NOT_OPERATING' window w as (partition by node_id order by seq))""",
    "fresh": """fresh0 as (select *, sum(case when status = 'NOT_OPERATING' then 1 else 0 end) over (partition by node_id
          order by seq) as episode from judged where fresh),
      fresh1 as (select *, sum(case when status <> 'OPERATIONAL' then 1 else 0 end) over (partition by node_id, episode
          order by seq) as run from fresh0),
      fresh2 as (select *, sum(case when status = 'OPERATIONAL' then 1 else 0 end) over (partition by node_id, episode,
          run order by seq) as k from fresh1),
      fresh as (select *, episode > 0 and (rec_seq is null or seq < rec_seq) as faulty, coalesce(seq = rec_seq, false) as recovered
        from (select *, min(case when episode > 0 and status = 'OPERATIONAL' and k = 3 then seq end)
            over (partition by node_id, episode) as rec_seq,
          min(case when status = 'NOT_OPERATING' then received_at end) over (partition by node_id order by seq
            rows between 1 following and unbounded following) as next_fault from fresh2))""",
    "offline": f"""offline as (select a.*, (((a.received_at + 30) // 5) + 1) * 5 as offline_at
      from accepted a join fresh f on f.seq = a.seq
      where not f.faulty and (((a.received_at + 30) // 5) + 1) * 5 < coalesce(a.n_at, {AS_OF} + 1)
        and (f.next_fault is null or f.next_fault > (((a.received_at + 30) // 5) + 1) * 5))""",
}

_GATE = "received_at - p_at between 0 and 5"
IS_REGRESSION = '"timestamp" < p_ts'
IS_TEMP = f"({_GATE} and abs(temperature - p_temp) > 20)"
IS_HUMI = f"({_GATE} and abs(humidity - p_humi) > 40)"

_KIND = {
    "unauthorized_device": 0, "replay_attack": 1, "device_not_operating": 2, "timestamp_regression": 3,
    "temp_jump": 4, "humi_jump": 5, "device_recovered": 6, "device_offline": 7,
}


def _select(event: str, severity: str, description: str, source: str, at: str = "received_at") -> str:
    return (
        f"select seq * 8 + {_KIND[event]} as id, node_id, '{event}' as event, '{severity}' as severity, "
        f'{description} as description, {at} as "timestamp" from {source}'
    )


def _text(prefix: str, *fields: tuple[str, str]) -> str:
    parts = [f"'{prefix}'"]
    for key, value in fields:
        parts += [f"' | {key}='", value]
    return "concat(" + ", ".join(parts) + ")"


def _unit(value: str, unit: str) -> str:
    return f"concat(printf('%.6f', {value}), '{unit}')"


EVENT_SQL = {
    "unauthorized_device": _select(
        "unauthorized_device", "CRITICAL",
        _text("unauthorized_device", ("node_id", "node_id"), ("msg_id", "msg_id"), ("sensor_type", "sensor_type"),
              ("reported_status", "status"), ("device_ts", '"timestamp"'), ("gateway_ts", "received_at")),
        "judged where not known"),
    "replay_attack": _select(
        "replay_attack", "CRITICAL",
        _text("replay_attack", ("node", "node_id"), ("rx_msg_id", "msg_id"), ("last_msg_id", "mark"),
              ("gap", "msg_id - mark"), ("device_ts", '"timestamp"')),
        "judged where replay"),
    "device_not_operating": _select(
        "device_not_operating", "ERROR",
        "concat('device_not_operating: device reported NOT_OPERATING status. Marked FAULTY in cache. msg_id=', msg_id)",
        "judged where fresh and status = 'NOT_OPERATING'"),
    "timestamp_regression": _select(
        "timestamp_regression", "ERROR",
        _text("anomaly_detected [TIMESTAMP_REGRESSION]", ("node", "node_id"), ("ts_new", '"timestamp"'),
              ("ts_old", "p_ts"), ("regression_s", 'p_ts - "timestamp"'), ("msg_id_new", "msg_id"),
              ("msg_id_old", "p_msg")),
        f"accepted where {IS_REGRESSION}"),
    "temp_jump": _select(
        "temp_jump", "CRITICAL",
        _text("anomaly_detected [TEMP_JUMP]", ("node", "node_id"), ("T_new", _unit("temperature", "°C")),
              ("T_old", _unit("p_temp", "°C")), ("delta", _unit("abs(temperature - p_temp)", "°C")),
              ("threshold", "'20.000000°C'"), ("wall_dt", "concat(received_at - p_at, 's')"),
              ("device_dt", "concat(\"timestamp\" - p_ts, 's')"), ("msg_id", "msg_id")),
        f"accepted where {IS_TEMP}"),
    "humi_jump": _select(
        "humi_jump", "ERROR",
        _text("anomaly_detected [HUMI_JUMP]", ("node", "node_id"), ("H_new", _unit("humidity", "%")),
              ("H_old", _unit("p_humi", "%")), ("delta", _unit("abs(humidity - p_humi)", "%")),
              ("threshold", "'40.000000%'"), ("wall_dt", "concat(received_at - p_at, 's')"),
              ("device_dt", "concat(\"timestamp\" - p_ts, 's')"), ("msg_id", "msg_id")),
        f"accepted where {IS_HUMI}"),
    "device_recovered": _select(
        "device_recovered", "WARNING",
        "'device_recovered: Status restored to OPERATIONAL after 3 consecutive valid packets. "
        "Device recovered - Status restored.'",
        "fresh where recovered"),
    "device_offline": _select(
        "device_offline", "CRITICAL",
        _text("device_offline", ("node", "node_id"),
              ("last_seen", "concat(offline_at - received_at, 's ago')"), ("silence_s", "offline_at - received_at"),
              ("threshold_s", "30"), ("last_msg_id", "msg_id"), ("last_status", "status"),
              ("last_temp", "case when temperature is null then 'N/A' else " + _unit("temperature", "°C") + " end"),
              ("last_humi", "case when humidity is null then 'N/A' else " + _unit("humidity", "%") + " end"),
              ("device_ts", '"timestamp"'), ("gateway_ts", "offline_at")),
        "offline", at="offline_at"),
}

STEPS["all_events"] = "all_events as (" + " union all ".join(EVENT_SQL.values()) + ")"
STEPS["logs"] = """logs as (select seq as id, device_id, cast(temperature as double) as temp, cast(humidity as double) as humi,
      case when gas >= 0 then gas end as gas, light_level, cast(buzzer_active as int) as buzzer_active,
      cast(is_muted as int) as is_muted, status, msg_id, "timestamp", make_timestamp(received_at * 1000000) as captured_at
      from judged where fresh and status <> 'NOT_OPERATING')"""
STEPS["timeline"] = """timeline as (
      select seq, node_id, received_at as "at", case when faulty then 'FAULTY' else status end as status, 0 as step from fresh
      union all select seq, node_id, offline_at, 'OFFLINE', 1 from offline)"""
STEPS["changes"] = f"""changes as (
      select seq, node_id, 0 as step, 1 as alert from judged where not known or replay
      union all select seq, node_id, 0, 1 from accepted where {IS_REGRESSION} or {IS_TEMP} or {IS_HUMI}
      union all select seq, node_id, 1, 0 from fresh where status = 'OPERATIONAL' and not faulty
      union all select seq, node_id, 2, 1 from offline)"""

_NEEDS = {
    "msgs": (),
    "devices": (),
    "judged": ("msgs", "devices"),
    "accepted": ("judged",),
    "fresh": ("judged",),
    "offline": ("accepted", "fresh"),
    "all_events": ("judged", "accepted", "fresh", "offline"),
    "logs": ("judged",),
    "timeline": ("fresh", "offline"),
    "changes": ("judged", "accepted", "fresh", "offline"),
}


def _with(*steps: str, extra: str = "") -> str:
    ordered: list[str] = []

    def add(step: str) -> None:
        for need in _NEEDS[step]:
            add(need)
        if step not in ordered:
            ordered.append(step)

    for step in steps:
        add(step)
    parts = [STEPS[step] for step in ordered] + ([extra] if extra else [])
    return "with " + ",\n".join(parts) + "\n"


def _event_query(event: str, *steps: str) -> str:
    return _with(*steps) + EVENT_SQL[event]


# --- raw messages --------------------------------------------------------------------------------------

_raw = ", ".join(f"{text} as {name}" for name, text in RAW.items())
RAW_SQL = f"raw as (select {_raw} from events)"


def _counted(kinds: str) -> str:
    return (
        f"{RAW_SQL}, counted as (select * from raw where not retain and length(topic) > 0 and length(payload) > 0 "
        f"and regexp_full_match(topic, 'factory/sensors/[^/]*/({kinds})'))"
    )


def _type(path: str) -> str:
    return f"json_type(j, '$.{path}')"


_missing = " ".join(
    f"when {_type(key)} is null then 'missing_{key}'"
    for key in ("node_id", "sensor_type", "payload", "status", "msg_id", "timestamp")
)
_NUMERIC = "('DOUBLE', 'UBIGINT', 'BIGINT')"
PARSED = f"""{_counted("data")},
  docs as (select *, case when json_valid(payload) then cast(payload as json) end as j from counted),
  parsed as (select *, case when j is null then 'not_json' {_missing}
    when {_type("node_id")} <> 'VARCHAR' or json_extract_string(j, '$.node_id') = '' then 'bad_node_id'
    when {_type("msg_id")} <> 'UBIGINT' then 'bad_msg_id'
    when {_type("timestamp")} not in {_NUMERIC} then 'bad_timestamp'
    when {_type("payload")} <> 'OBJECT' then 'bad_payload'
    when {_type("sensor_type")} <> 'VARCHAR' or {_type("status")} <> 'VARCHAR' then 'bad_type'
    when cast(json_extract_string(j, '$.msg_id') as hugeint) > 4294967295 then 'msg_id_range' end as reject_reason from docs)"""


def _measure(name: str, types: str, target: str) -> str:
    value = f"json_extract_string(j, '$.payload.{name}')"
    return f"case when {_type('payload.' + name)} in {types} then {value} end".join(
        ("cast(cast(", " as double) as float)") if target == "float" else ("cast(", f" as {target})")
    )


READINGS = f"""{PARSED},
  valid as (select seq, json_extract_string(j, '$.node_id') as node_id, json_extract_string(j, '$.sensor_type') as sensor_text,
    {_measure("temp", _NUMERIC, "float")} as temperature, {_measure("humi", _NUMERIC, "float")} as humidity,
    {_measure("gas", "('UBIGINT', 'BIGINT')", "int")} as gas,
    {_measure("light_level", "('UBIGINT', 'BIGINT')", "int")} as light_level,
    {_measure("buzzer_active", "('BOOLEAN')", "boolean")} as buzzer_active,
    {_measure("is_muted", "('BOOLEAN')", "boolean")} as is_muted,
    json_extract_string(j, '$.status') as status_text, cast(json_extract_string(j, '$.msg_id') as bigint) as msg_id,
    cast(trunc(cast(json_extract_string(j, '$.timestamp') as double)) as bigint) as "timestamp", received_at,
    split_part(topic, '/', 3) as topic_node from parsed where reject_reason is null)"""

# --- operator requests ---------------------------------------------------------------------------------

THRESHOLD_SQL = f"""bodies as (select event_id as seq, cast({THRESHOLD_BODY} as json) as j from events),
  fields as (select seq, json_extract_string(j, '$.node_id') as node_id,
    json_extract_string(j, '$.threshold_type') as threshold_type, json_type(j, '$.value') as kind,
    json_extract_string(j, '$.value') as txt from bodies),
  numbers as (select *, case when threshold_type like 'temp%' then
      case when kind in {_NUMERIC} or kind = 'VARCHAR' then try_cast(trim(txt) as double) when kind = 'BOOLEAN' then 1.0 end
    else case when kind in {_NUMERIC} then trunc(cast(txt as double))
      when kind = 'VARCHAR' and regexp_full_match(trim(txt), '[+-]?[0-9]+') then cast(trim(txt) as double)
      when kind = 'BOOLEAN' then 1.0 end end as number from fields),
  checked as (select *, case when coalesce(node_id, '') = '' or coalesce(threshold_type, '') = '' or kind is null or kind = 'NULL'
      then 'Missing required fields'
    when threshold_type not in ('gas_warn', 'gas_crit', 'temp_warn', 'temp_crit') then 'Invalid threshold type'
    when number is null then 'Invalid threshold value'
    when threshold_type like 'temp%' and not (number between 0 and 100)
      then 'Temperature threshold must be between 0 and 100°C'
    when threshold_type like 'gas%' and not (number between 0 and 10000) then 'Gas threshold must be between 0 and 10000 ppm'
    when node_id not in ('node_02', 'node_03') then 'Unknown node' end as error from numbers),
  asked as (select seq, node_id, threshold_type, case when error is null then number end as value,
    error is null as is_valid, error from checked)"""
MUTE_SQL = f"""mute_bodies as (select event_id as seq, cast({MUTE_BODY} as json) as j from events),
  mute_fields as (select seq, json_extract_string(j, '$.node_id') as node_id, json_extract_string(j, '$.type') as type from mute_bodies),
  muted as (select *, error is null as is_valid from (select *, case
      when coalesce(node_id, '') = '' or coalesce(type, '') = '' then 'Missing required fields'
      when node_id not in ('node_02', 'node_03') or type not in ('gas', 'temp') then 'Invalid node or buzzer type' end as error
    from mute_fields))"""
_CMD_TOPIC = """case node_id when 'node_02' then 'factory/sensors/ESP8266_SEC_02/cmd'
  when 'node_03' then 'factory/sensors/ESP8266_SEC_03/cmd' end"""
STORED = f"""stored as (select * from (values ('node_02', 250, 400, 35.0::double, 45.0::double),
    ('node_03', 250, 400, 35.0::double, 45.0::double)) t(node_id, gas_warn, gas_crit, temp_warn, temp_crit))"""
_STAMP = f"make_timestamp({AS_OF} * 1000000)"

_EXPIRY = f"(select max(event_id) // 3 + {START} from events)"


def _oid_cells() -> str:
    cells = (
        (1, "INTEGER", ORDINAL.format("status")),
        (2, "GAUGE", "temperature"),
        (3, "GAUGE", "humidity"),
        (4, "INTEGER", "alert"),
        (5, "GAUGE", "gas"),
    )
    return " union all ".join(
        f"select concat('1.3.6.1.4.1.9999.1.', s.slot, '.{n}') as oid, '{kind}' as value_type, "
        f"cast(case when node_id is null then 238 else coalesce({value}, 238) end as bigint) as value "
        "from slots s left join nodes on node_index = slot"
        for n, kind, value in cells
    )


def _tenths(value: str) -> str:
    return f"case when {value} < 0 then 0 else cast(trunc({value} * cast(10 as float) + cast(0.5 as float)) as int) end"


ORACLE = {
    "counted_messages": f"""with {_counted("data|alert")}
      select split_part(topic, '/', 4) as kind, count(*) as messages, sum(length(payload)) as chars from counted group by 1""",
    "parse_readings": f"""with {READINGS}
      select seq, node_id, {SENSOR} as sensor_type, temperature, humidity, gas, light_level, buzzer_active, is_muted,
        {STATUS} as status, msg_id, "timestamp", received_at, topic_node from valid""",
    "parse_rejects": f"""with {PARSED} select seq, topic, reject_reason, substring(payload, 1, 120) as preview
      from parsed where reject_reason is not null""",
    "topic_node": f"""with {RAW_SQL} select seq,
      case when length(topic) - length(replace(topic, '/', '')) >= 3 then split_part(topic, '/', 3) else '' end as live_node,
      split_part(topic, '/', 3) as prefix_node from raw""",
    "status_map": f"""with t as (select {MESSAGE['status_text']} as status_text, {MESSAGE['sensor_text']} as sensor_text from events),
      m as (select *, {STATUS} as status, {SENSOR} as sensor_type from t)
      select status_text, sensor_text, status, {ORDINAL.format('status')} as status_ordinal, sensor_type,
        case sensor_type when 'ENV_MONITOR' then 0 when 'SECURITY' then 1 when 'ENV_MONITOR_GAS' then 2 else 255 end as sensor_ordinal,
        sensor_type = 'ENV_MONITOR_GAS' as has_gas, sensor_type like 'ENV_MONITOR%' as has_env, count(*) as messages
      from m group by all""",
    "node_naming": _with("msgs") + """select node_id, case when node_id like '%#_02' escape '#' then 'node_02'
        when node_id like '%#_03' escape '#' then 'node_03' end as node,
      case when node_id like '%#_02' escape '#' then 'ESP8266_SEC_02' when node_id like '%#_03' escape '#' then 'ESP8266_SEC_03'
        else 'ESP32_SEC_01' end as canonical, count(*) as messages from msgs group by node_id""",
    "fixed_point": _with("msgs") + f"""select seq, {_tenths("temperature")} as temperature10, {_tenths("humidity")} as humidity10,
      case when gas >= 0 then gas end as gas, {ORDINAL.format("status")} as status_ordinal from msgs""",
    "duration_text": _with("accepted") + """, g as (select seq, received_at - p_at as silence_s, (received_at - p_at) * 61 as d
        from accepted where p_seq is not null)
      select seq, silence_s, concat(case when d >= 3600 then concat(d // 3600, 'h ') else '' end,
        case when d >= 60 then concat((d % 3600) // 60, 'm ') else '' end, d % 60, 's') as silence_text from g""",
    "unauthorized_events": _event_query("unauthorized_device", "judged"),
    "replay_events": _event_query("replay_attack", "judged"),
    "not_operating_events": _event_query("device_not_operating", "judged"),
    "ts_regression": _event_query("timestamp_regression", "accepted"),
    "temp_jump": _event_query("temp_jump", "accepted"),
    "humi_jump": _event_query("humi_jump", "accepted"),
    "gas_jump": _with("accepted") + """select seq, node_id, gas, p_gas as prev_gas, abs(gas - p_gas) as delta, received_at
      from accepted where gas >= 0 and p_gas >= 0 and abs(gas - p_gas) > 200""",
    "security_events": _with("all_events") + "select * from all_events",
    "spanned_events": _with("all_events") + "select * from all_events",
    "accepted_readings": _with("accepted") + """select seq, node_id, status, temperature, msg_id, mark, received_at,
      p_seq as prev_seq, p_temp as prev_temperature, p_msg as prev_msg_id from accepted""",
    "recovery_events": _event_query("device_recovered", "fresh"),
    "offline_events": _event_query("device_offline", "offline"),
    "liveness_sessions": _with("accepted") + """, s as (select *, sum(case when p_at is null or received_at - p_at > 30 then 1 else 0 end)
        over (partition by node_id order by seq) as n from accepted)
      select node_id, min(seq) as first_seq, min(received_at) as started_at, max(received_at) as last_at, count(*) as messages
      from s group by node_id, n""",
    "status_timeline": _with("timeline") + "select * from timeline",
    "status_as_of": _with("timeline") + f"""select node_id, arg_max(status, seq * 2 + step) as status,
        arg_max("at", seq * 2 + step) as since
      from timeline where "at" <= (select max(event_id) * 2 // 3 + {START} from events) group by node_id""",
    "pipeline_counters": None,
    "node_metrics": _with("timeline") + """, cur as (select node_id, arg_max(status, seq * 2 + step) as status from timeline group by node_id),
      gas as (select node_id, gas, p_gas from (select *, row_number() over (partition by node_id order by seq desc) as rn
        from accepted where gas is not null) where rn = 1)
      select j.node_id, max(greatest(j.msg_id, coalesce(j.seed, 0))) as last_msg_id, count(*) filter (where replay) as replay_count,
        coalesce(any_value(g.gas), -1) as gas, coalesce(any_value(g.p_gas), -1) as prev_gas, count(*) as total_packets,
        count(*) filter (where fresh and j.status <> 'NOT_OPERATING') as valid_packets,
        coalesce(any_value(c.status), 'UNKNOWN') as current_status, max(j.received_at) as last_seen_at
      from judged j left join cur c on c.node_id = j.node_id left join gas g on g.node_id = j.node_id group by j.node_id""",
    "sensor_log_rows": _with("logs") + "select * from logs",
    "latest_by_device_ts": _with("logs") + """select device_id, r.id, temp, humi, gas, light_level, buzzer_active, is_muted, status,
        msg_id, "timestamp", d.node_id, d.sensor_type
      from (select *, row_number() over (partition by device_id order by "timestamp" desc, id desc) as rn from logs) r
      join devices d on d.id = r.device_id where rn = 1""",
    "latest_join_max": _with("logs") + """, minutes as (select * replace ("timestamp" - "timestamp" % 60 as "timestamp") from logs)
      select l.id, d.node_id, l.temp, l.humi, l.gas, l.status, l.msg_id, l."timestamp" from minutes l
      join devices d on d.id = l.device_id
      join (select device_id, max("timestamp") as max_ts from minutes group by device_id) m
        on m.device_id = l.device_id and m.max_ts = l."timestamp" """,
    "latest_cached": _with("judged") + """select node_id, seq, sensor_type, temperature, humidity, gas, light_level, buzzer_active,
        is_muted, status, msg_id, "timestamp", received_at
      from (select *, row_number() over (partition by node_id order by seq desc) as rn
        from judged where fresh and status <> 'NOT_OPERATING') where rn = 1""",
    "node_index": _with("judged") + """select node_id, min(seq) as first_seq, row_number() over (order by min(seq)) as node_index
      from judged where fresh group by node_id""",
    "last_n_readings": _with("logs") + """select device_id, rn, id, "timestamp", status from (select *, row_number()
      over (partition by device_id order by "timestamp" desc, id desc) as rn from logs) where rn <= 100""",
    "node_history": _with("logs") + f"""select id, temp, humi, status, msg_id, "timestamp" from logs
      where device_id = 3 and "timestamp" between {START + 300} and {START + 7200}""",
    "retention_kept": _with("logs") + f'select id, device_id, "timestamp" from logs where "timestamp" >= {_EXPIRY}',
    "purge_counts": _with("logs") + f"""select count(*) filter (where "timestamp" < {_EXPIRY}) as deleted,
      count(*) filter (where not "timestamp" < {_EXPIRY}) as kept from logs""",
    "schema_alignment": _with("logs") + """select id, case when id % 2 = 1 then light_level end as light_level,
      case when id % 2 = 1 then buzzer_active else 0 end as buzzer_active, case when id % 2 = 1 then is_muted else 0 end as is_muted
      from logs""",
    "recent_events": _with("all_events") + """, newest as (select *, row_number() over (order by "timestamp" desc, id desc) as position
        from all_events)
      select position, strftime(make_timestamp("timestamp" * 1000000), '%H:%M:%S') as "time", description, lower(severity) as type
      from newest where position <= 50""",
    "events_by_severity": _with("all_events") + """select cast(make_timestamp("timestamp" * 1000000) as date) as event_date, severity,
      count(*) as events, count(distinct node_id) as nodes from all_events group by 1, 2""",
    "system_event_rows": _with("all_events") + """select id, node_id, severity, description, "timestamp",
      make_timestamp("timestamp" * 1000000) as created_at from all_events""",
    "critical_events_of_first_day": _with("all_events") + f"""select node_id, event, count(*) as events from all_events
      where severity = 'CRITICAL' and "timestamp" between {START} and {START + 86399} group by 1, 2""",
    "trap_records": _with("all_events") + f""", typed as (select *, case event when 'device_offline' then 1 when 'unauthorized_device' then 3
        when 'replay_attack' then 4 when 'temp_jump' then 2 when 'humi_jump' then 2 when 'timestamp_regression' then 2 end as trap_type
        from all_events)
      select id, trap_type, case trap_type when 1 then 'DEVICE_OFFLINE' when 2 then 'ANOMALY_DETECTED'
        when 3 then 'UNAUTHORIZED_DEVICE' when 4 then 'REPLAY_ATTACK' end as trap_name,
        concat('1.3.6.1.4.1.9999.2.', trap_type) as trap_oid, ("timestamp" - {START - 100}) * 100 as uptime_cs, node_id,
        substring(description, 1, 255) as detail, "timestamp" from typed where trap_type is not null""",
    "alert_state": _with("changes") + """select m.node_id, coalesce(any_value(c.alert), 0) as alert from msgs m left join
      (select node_id, arg_max(alert, seq * 4 + step) as alert from changes group by node_id) c on c.node_id = m.node_id
      group by m.node_id""",
    "security_log_lines": _with("all_events") + """select id, concat('[', strftime(make_timestamp("timestamp" * 1000000),
      '%Y-%m-%d %H:%M:%S'), ' UTC] [', severity, '] ', node_id, ' — ', description) as line from all_events""",
    "table_counts": _with("all_events", "logs") + """select 'devices' as table_name, count(*) as n from devices
      union select 'sensor_logs', count(*) from logs union select 'system_events', count(*) from all_events""",
    "oid_export": _with("changes", "timeline") + """, st as (select node_id, arg_max(status, seq * 2 + step) as status from timeline group by node_id),
      al as (select node_id, arg_max(alert, seq * 4 + step) as alert from changes group by node_id),
      la as (select *, row_number() over (partition by node_id order by seq desc) as rn from accepted),
      first_seen as (select node_id, row_number() over (order by min(seq)) as node_index from fresh group by node_id),
      nodes as (select f.node_id, node_index, st.status, """ + _tenths("la.temperature") + " as temperature, "
      + _tenths("la.humidity") + """ as humidity, coalesce(al.alert, 0) as alert, case when la.gas >= 0 then la.gas end as gas
        from first_seen f left join st on st.node_id = f.node_id left join al on al.node_id = f.node_id
        left join la on la.node_id = f.node_id and la.rn = 1),
      slots as (select i as slot from range(1, 17) t(i))
      """ + _oid_cells(),
    "dashboard_json": _with("logs") + """, r as (select *, row_number() over (order by "timestamp" desc, id desc) as rn
        from logs where device_id = 3)
      select concat('{"node_01":{},"node_02":', coalesce(max(concat('{"temperature":', temp, ',"humidity":', humi, ',"gas":',
        coalesce(cast(gas as varchar), 'null'), ',"light_level":', coalesce(cast(light_level as varchar), 'null'),
        ',"buzzer_active":', case when buzzer_active = 1 then 'true' else 'false' end,
        ',"is_muted":', case when is_muted = 1 then 'true' else 'false' end, ',"status":"', status, '","msg_id":', msg_id,
        ',"timestamp":', "timestamp", '}')), '{}'), ',"node_03":{},"thresholds":{"node_02":',
        '{"gas_warn":250,"gas_crit":400,"temp_warn":35.0,"temp_crit":45.0}', ',"node_03":',
        '{"gas_warn":250,"gas_crit":400,"temp_warn":35.0,"temp_crit":45.0}', '}}') as document from r where rn = 1""",
    "threshold_alerts": _with("msgs") + """select seq, node_id, received_at, 'gas' as metric,
        case when gas > 600 then 'CRITICAL' else 'WARNING' end as severity, cast(gas as double) as value
      from msgs where sensor_type = 'ENV_MONITOR_GAS' and gas > 400
      union all select seq, node_id, received_at, 'temperature', case when temperature > 50 then 'CRITICAL' else 'WARNING' end,
        cast(temperature as double) from msgs where sensor_type like 'ENV_MONITOR%' and temperature > 45""",
    "node_threshold_class": _with("msgs") + f""", {STORED}, named as (select *, case
        when substring(node_id, 6, 2) between '08' and '11' then 'node_02' when substring(node_id, 6, 2) between '12' and '15'
        then 'node_03' else node_id end as node from msgs),
      limited as (select n.*, s.node_id is not null as own, s.gas_warn, s.gas_crit, s.temp_warn, s.temp_crit
        from named n left join stored s on s.node_id = n.node)
      select seq, node as node_id, case when gas < 0 then null when gas > case when own then gas_crit else 400 end then 'crit'
          when gas > case when own then gas_warn else 350 end then 'warn' when gas is not null then 'ok' end as gas_class,
        case when temperature > case when own then temp_crit else 45 end then 'crit'
          when temperature > case when own then temp_warn else 35 end then 'warn'
          when temperature is not null then 'ok' end as temp_class from limited""",
    "threshold_requests": f"with {THRESHOLD_SQL} select * from asked",
    "mute_requests": f"with {MUTE_SQL} select seq, node_id, type, is_valid, error from muted",
    "command_messages": f"""with {THRESHOLD_SQL}, {MUTE_SQL}
      select seq, {_CMD_TOPIC} as topic, concat('{{"cmd": "set_threshold", "', threshold_type, '": ',
        case when threshold_type like 'temp%' then cast(value as varchar) else cast(cast(value as bigint) as varchar) end, '}}') as payload
      from asked where is_valid
      union all select seq, {_CMD_TOPIC}, concat('{{"cmd": "mute_', type, '"}}') from muted where is_valid""",
    "threshold_apply": f"""with {THRESHOLD_SQL}, {STORED},
      newest as (select node_id, arg_max(value, seq) filter (where threshold_type = 'gas_warn') as gw,
        arg_max(value, seq) filter (where threshold_type = 'gas_crit') as gc,
        arg_max(value, seq) filter (where threshold_type = 'temp_warn') as tw,
        arg_max(value, seq) filter (where threshold_type = 'temp_crit') as tc from asked where is_valid group by node_id)
      select s.node_id, cast(coalesce(gw, gas_warn) as int) as gas_warn, cast(coalesce(gc, gas_crit) as int) as gas_crit,
        coalesce(tw, temp_warn) as temp_warn, coalesce(tc, temp_crit) as temp_crit,
        timestamp '2024-01-01 00:00:00' as created_at,
        case when coalesce(gw, gc, tw, tc) is not null then {_STAMP} else timestamp '2024-01-01 00:00:00' end as updated_at
      from stored s left join newest n on n.node_id = s.node_id""",
    "provision_devices": _with("msgs", "devices") + f""", listed as (select node_id, min(seq) as first_pos,
          arg_max(concat('Hall ', seq % 3), seq) as location, arg_max(sensor_type, seq) as sensor_type,
          arg_max(seq % 2 = 0, seq) as has_gas from msgs where status = 'WARNING' group by node_id)
      select d.id, d.node_id, coalesce(l.location, d.location) as location, coalesce(l.sensor_type, d.sensor_type) as sensor_type,
        coalesce(l.has_gas, d.has_gas) as has_gas, d.last_msg_id, d.created_at
      from devices d left join listed l on l.node_id = d.node_id
      union all select 20 + row_number() over (order by first_pos), node_id, location, sensor_type, has_gas, 0, {_STAMP}
      from listed where node_id not in (select node_id from devices)""",
    "provision_count": _with("msgs") + "select count(*) as provisioned from msgs where status = 'WARNING'",
    "register_absent": _with("msgs", "devices") + f"""select * from devices
      union all select 20 + row_number() over (order by min(seq)), node_id, 'AUTO_REGISTERED', 'UNKNOWN', false, 0, {_STAMP}
      from msgs where node_id not in (select node_id from devices) group by node_id""",
    "last_msg_id_update": _with("judged") + """select d.id, d.node_id, d.location, d.sensor_type, d.has_gas,
        greatest(d.last_msg_id, coalesce(h.m, 0)) as last_msg_id, d.created_at
      from devices d left join (select node_id, max(msg_id) as m from judged where fresh and status <> 'NOT_OPERATING'
        group by node_id) h on h.node_id = d.node_id""",
}

# The counters start from the raw messages, so the same steps run on the parsed readings.
ORACLE["pipeline_counters"] = (
    f"with {READINGS}, msgs as (select seq, node_id, {SENSOR} as sensor_type, temperature, humidity, gas, {STATUS} as status, "
    f'msg_id, "timestamp", received_at from valid),\n'
    + ",\n".join(STEPS[s] for s in ("devices", "judged", "accepted", "fresh", "offline"))
    + f"""
    select (select count(*) from parsed) as received, (select count(*) from accepted) as accepted,
      (select count(*) from parsed) - (select count(*) from accepted) as rejected,
      (select count(*) from judged where not known or replay or (fresh and status = 'NOT_OPERATING'))
        + (select count(*) from accepted where {IS_REGRESSION}) + (select count(*) from accepted where {IS_TEMP})
        + (select count(*) from accepted where {IS_HUMI}) + (select count(*) from fresh where recovered) as security_events,
      (select count(*) from offline) as offline_events, (select count(distinct node_id) from fresh) as nodes"""
)
