"""Security and fault events of traced messages, one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.text import duration, fixed6
from sensorwarden.operators.health import offline_at

# Position of an event among those of one message; also the last digit (base 8) of its id.
UNAUTHORIZED, REPLAY, NOT_OPERATING, TS_REGRESSION, TEMP_JUMP, HUMI_JUMP, RECOVERED, OFFLINE = range(8)

# Event names, severities and texts of the audit table.
NAMES = {
    UNAUTHORIZED: "unauthorized_device",
    REPLAY: "replay_attack",
    NOT_OPERATING: "device_not_operating",
    TS_REGRESSION: "timestamp_regression",
    TEMP_JUMP: "temp_jump",
    HUMI_JUMP: "humi_jump",
    RECOVERED: "device_recovered",
    OFFLINE: "device_offline",
}
SEVERITIES = {
    UNAUTHORIZED: "CRITICAL",
    REPLAY: "CRITICAL",
    NOT_OPERATING: "ERROR",
    TS_REGRESSION: "ERROR",
    TEMP_JUMP: "CRITICAL",
    HUMI_JUMP: "ERROR",
    RECOVERED: "WARNING",
    OFFLINE: "CRITICAL",
}
TEXTS = {
    UNAUTHORIZED: "unauthorized_device | node_id={node} | msg_id={msg_id} | sensor_type={sensor_type}"
    " | reported_status={status} | device_ts={ts} | gateway_ts={at}",
    REPLAY: "replay_attack | node={node} | rx_msg_id={msg_id} | last_msg_id={mark} | gap={gap} | device_ts={ts}",
    NOT_OPERATING: "device_not_operating: device reported NOT_OPERATING status. Marked FAULTY in cache. msg_id={msg_id}",
    TS_REGRESSION: "anomaly_detected [TIMESTAMP_REGRESSION] | node={node} | ts_new={ts} | ts_old={old_ts}"
    " | regression_s={regression} | msg_id_new={msg_id} | msg_id_old={old_msg_id}",
    TEMP_JUMP: "anomaly_detected [TEMP_JUMP] | node={node} | T_new={first}°C | T_old={second}°C | delta={delta}°C"
    " | threshold={limit}°C | wall_dt={wall_dt}s | device_dt={device_dt}s | msg_id={msg_id}",
    HUMI_JUMP: "anomaly_detected [HUMI_JUMP] | node={node} | H_new={first}% | H_old={second}% | delta={delta}%"
    " | threshold={limit}% | wall_dt={wall_dt}s | device_dt={device_dt}s | msg_id={msg_id}",
    RECOVERED: "device_recovered: Status restored to OPERATIONAL after {required} consecutive valid packets."
    " Device recovered - Status restored.",
    OFFLINE: "device_offline | node={node} | last_seen={silence_text} ago | silence_s={silence} | threshold_s={timeout}"
    " | last_msg_id={msg_id} | last_status={status} | last_temp={first} | last_humi={second} | device_ts={ts}"
    " | gateway_ts={at}",
}
MESSAGE_KINDS = (UNAUTHORIZED, REPLAY, NOT_OPERATING, TS_REGRESSION, TEMP_JUMP, HUMI_JUMP, RECOVERED)


def _float(value: float) -> Column:
    return F.lit(value).cast("float")


def device_gap() -> Column:
    """Wider than 64 bits: device clocks may be any 64-bit number."""
    wide = "decimal(20,0)"
    return F.col("timestamp").cast(wide) - F.col("prev.timestamp").cast(wide)


def wall_gap() -> Column:
    return F.col("received_at") - F.col("prev.received_at")


def is_ts_regression() -> Column:
    return F.col("accepted") & F.coalesce(F.col("timestamp") < F.col("prev.timestamp"), F.lit(False))


def _jump(column: str, threshold: Column, rules: Rules) -> Column:
    """Both values present, arrivals at most the window apart, difference strictly above the threshold."""
    delta = F.abs(F.col(column) - F.col(f"prev.{column}"))
    close = wall_gap().between(0, rules.jump_window_s)
    return F.col("accepted") & F.coalesce(close & (delta > threshold), F.lit(False))


def is_temp_jump(rules: Rules) -> Column:
    return _jump("temperature", _float(rules.temp_jump), rules)


def is_humi_jump(rules: Rules) -> Column:
    return _jump("humidity", _float(rules.humi_jump), rules)


def is_gas_jump(rules: Rules) -> Column:
    """Consecutive valid gas values; no time window."""
    gas, old = F.col("gas"), F.col("prev.gas")
    both = (gas >= 0) & (old >= 0)
    return F.col("accepted") & F.coalesce(both & (F.abs(gas - old) > rules.gas_jump), F.lit(False))


# --- events --------------------------------------------------------------------------------------------


def _condition(kind: int, rules: Rules) -> Column:
    if kind == UNAUTHORIZED:
        return ~F.col("known")
    if kind == TS_REGRESSION:
        return is_ts_regression()
    if kind == TEMP_JUMP:
        return is_temp_jump(rules)
    if kind == HUMI_JUMP:
        return is_humi_jump(rules)
    if kind == OFFLINE:
        return F.col("offline_at").isNotNull()
    return F.col({REPLAY: "replay", NOT_OPERATING: "fault", RECOVERED: "recovered"}[kind])


def _placeholders(kinds: Sequence[int], rules: Rules) -> dict[str, Column]:
    """What the texts of these kinds refer to; the two measured values depend on the kind of the event."""
    kind = F.col("kind")
    used = {name for k in kinds for _, name, _, _ in Formatter().parse(TEXTS[k]) if name}
    columns = {
        "node": lambda: F.col("node_id"),
        "msg_id": lambda: F.col("msg_id"),
        "sensor_type": lambda: F.col("sensor_type"),
        "status": lambda: F.col("status"),
        "ts": lambda: F.col("timestamp"),
        "at": lambda: F.col("at"),
        "mark": lambda: F.col("mark"),
        "gap": lambda: F.col("msg_id") - F.col("mark"),
        "old_ts": lambda: F.col("prev.timestamp"),
        "regression": lambda: -device_gap(),
        "old_msg_id": lambda: F.col("prev.msg_id"),
        "first": lambda: _measured(F.when(kind == HUMI_JUMP, F.col("humidity")).otherwise(F.col("temperature")), "°C"),
        "second": lambda: _measured(
            F.when(kind == OFFLINE, F.col("humidity"))
            .when(kind == HUMI_JUMP, F.col("prev.humidity"))
            .otherwise(F.col("prev.temperature")),
            "%",
        ),
        "delta": lambda: fixed6(
            F.when(kind == HUMI_JUMP, F.abs(F.col("humidity") - F.col("prev.humidity"))).otherwise(
                F.abs(F.col("temperature") - F.col("prev.temperature"))
            )
        ),
        "limit": lambda: F.when(kind == HUMI_JUMP, F.lit(f"{rules.humi_jump:.6f}")).otherwise(
            F.lit(f"{rules.temp_jump:.6f}")
        ),
        "wall_dt": wall_gap,
        "device_dt": device_gap,
        "required": lambda: F.lit(rules.recovery_count),
        "silence": lambda: F.col("at") - F.col("received_at"),
        "silence_text": lambda: duration(F.col("at") - F.col("received_at")),
        "timeout": lambda: F.lit(rules.offline_timeout_s),
    }
    return {name: make() for name, make in columns.items() if name in used}


def _measured(value: Column, unit: str) -> Column:
    """A measured value; an offline event prints its unit, and N/A when there is none."""
    text = fixed6(value)
    return F.when(F.col("kind") == OFFLINE, F.coalesce(F.concat(text, F.lit(unit)), F.lit("N/A"))).otherwise(text)


def _text(kinds: Sequence[int], rules: Rules) -> Column:
    """The text of each event: one printf whose pattern depends on the kind.

    One call for all kinds keeps the generated method short enough for the JIT, which matters for the
    many messages that raise no event and pass through the same method.
    """
    values = _placeholders(kinds, rules)
    position = {name: f"%{n}$s" for n, name in enumerate(values, start=1)}
    patterns = {kind: TEXTS[kind].replace("%", "%%").format_map(position) for kind in kinds}
    return F.printf(_by_kind(patterns), *values.values())


def _by_kind(values: dict[int, str]) -> Column:
    chain = None
    for kind, value in values.items():
        hit = F.col("kind") == kind
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return chain


def events_of(rows: DataFrame, *kinds: int, rules: Rules = Rules()) -> DataFrame:
    """One row per event of the given kinds, in one pass over the rows.

    Only the kind numbers are unrolled; names and texts are built for the rows that are events.
    """
    raised = [F.when(_condition(kind, rules), F.lit(kind)) for kind in kinds]
    at = F.col("received_at")
    if OFFLINE in kinds:
        at = F.when(F.col("kind") == OFFLINE, F.col("offline_at")).otherwise(at)
    return (
        rows.withColumn("kind", F.explode(F.array(*raised)))
        .filter(F.col("kind").isNotNull())
        .withColumn("at", at)
        .select(
            (F.col("seq") * 8 + F.col("kind")).alias("id"),
            "node_id",
            _by_kind({kind: NAMES[kind] for kind in kinds}).alias("event"),
            _by_kind({kind: SEVERITIES[kind] for kind in kinds}).alias("severity"),
            _text(kinds, rules).alias("description"),
            F.col("at").alias("timestamp"),
        )
    )


def unauthorized_events(screened: DataFrame) -> DataFrame:
    """Needs only the whitelist flag, so no shuffle."""
    return events_of(screened, UNAUTHORIZED)


def replay_events(marked: DataFrame) -> DataFrame:
    return events_of(marked, REPLAY)


def message_events(traced: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every event a message raises, in the order the checks run."""
    return events_of(traced, *MESSAGE_KINDS, rules=rules)


def offline_events(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """One event per silence of more than the timeout, at the scan that notices it."""
    return events_of(traced.withColumn("offline_at", offline_at(as_of, rules)), OFFLINE, rules=rules)


def security_events(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """All events, still one pass: the offline event of a silence hangs on the message before it."""
    return events_of(
        traced.withColumn("offline_at", offline_at(as_of, rules)), *MESSAGE_KINDS, OFFLINE, rules=rules
    )


def events_of_message(rules: Rules = Rules()) -> Column:
    """Number of events a message raises itself (offline events belong to the scan)."""
    total = F.lit(0)
    for kind in MESSAGE_KINDS:
        total = total + _condition(kind, rules).cast("int")
    return total


def gas_jumps(traced: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Gas spikes between consecutive accepted readings."""
    return traced.filter(is_gas_jump(rules)).select(
        "seq", "node_id", "gas", F.col("prev.gas").alias("prev_gas"),
        F.abs(F.col("gas") - F.col("prev.gas")).alias("delta"), "received_at",
    )
