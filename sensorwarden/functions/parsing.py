"""JSON text -> typed reading or reject reason, all in built-in VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.functions.enums import parse_sensor_type, parse_status
from sensorwarden.functions.staging import evaluated_once
from sensorwarden.functions.text import cut
from sensorwarden.functions.topics import node_from_topic

# Mandatory keys in the order they are checked.
REQUIRED = ("node_id", "sensor_type", "payload", "status", "msg_id", "timestamp")
# Optional measurements inside "payload".
MEASURES = ("temp", "humi", "gas", "light_level", "buzzer_active", "is_muted")

MAX_MSG_ID = 4294967295


def _variant_struct(names: tuple[str, ...]) -> str:
    return "struct<" + ",".join(f"{name} variant" for name in names) + ">"


def kind_of(value: Column) -> Column:
    """Exact JSON type: BIGINT for integers, DECIMAL(..)/DOUBLE for other numbers, VOID for null."""
    return F.schema_of_variant(value)


def is_number(kind: Column) -> Column:
    return F.coalesce(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), F.lit(False))


def with_document(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_document``: the text as one JSON document with nothing after it, or NULL.

    The text is parsed as the only element of an array, which makes trailing text an error unless it
    closes the array itself; that needs a ']' and is ruled out by parsing it as an object member too.
    """
    source = F.col(text)
    as_member = F.try_parse_json(F.concat(F.lit('{"d":'), source, F.lit("}")))
    alone = F.try_variant_get("_wrapped", "$[1]", "variant").isNull() & (
        ~F.contains(source, F.lit("]")) | as_member.isNotNull()
    )
    return (
        rows.withColumn(
            "_wrapped", F.when(F.is_valid_utf8(source), F.try_parse_json(F.concat(F.lit("["), source, F.lit("]"))))
        )
        .withColumn("_document", F.when(alone, F.try_variant_get("_wrapped", "$[0]", "variant")))
        .drop("_wrapped")
    )


def reject_reason() -> Column:
    """First rule a message breaks, NULL when it is a valid reading; over the columns of ``_members``."""
    msg_kind, msg_value = F.col("msg_id_kind"), F.col("msg_id")
    whole = (msg_kind == "BIGINT") & (msg_value >= 0)
    chain = F.when(~F.col("_is_json"), F.lit("not_json"))
    for key in REQUIRED:
        chain = chain.when(F.col(f"{key}_kind").isNull(), F.lit(f"missing_{key}"))
    return (
        chain.when((F.col("node_id_kind") != "STRING") | (F.col("node_id") == ""), F.lit("bad_node_id"))
        .when(~(whole | F.col("msg_id_beyond_long")), F.lit("bad_msg_id"))
        .when(~is_number(F.col("timestamp_kind")), F.lit("bad_timestamp"))
        .when(~F.col("payload_kind").startswith("OBJECT"), F.lit("bad_payload"))
        .when((F.col("sensor_type_kind") != "STRING") | (F.col("status_kind") != "STRING"), F.lit("bad_type"))
        .when(msg_value.isNull() | (msg_value > MAX_MSG_ID), F.lit("msg_id_range"))
        .when(F.col("timestamp").isNull(), F.lit("timestamp_range"))
    )


def _beyond_long(value: Column, kind: Column) -> Column:
    """Unsigned integers that only fit 64 bits without sign: integers all the same, but out of range."""
    wide = F.try_variant_get(value, "$", "decimal(20,0)").between(
        F.lit(str(2**63)).cast("decimal(20,0)"), F.lit(str(2**64 - 1)).cast("decimal(20,0)")
    )
    return F.when(kind.isin("DECIMAL(19,0)", "DECIMAL(20,0)"), F.coalesce(wide, F.lit(False))).otherwise(F.lit(False))


# Measurement -> (type it is read as, JSON types it may have; None stands for any number).
MEASURE_TYPES = {
    "temp": ("double", None),
    "humi": ("double", None),
    "gas": ("int", "BIGINT"),
    "light_level": ("int", "BIGINT"),
    "buzzer_active": ("boolean", "BOOLEAN"),
    "is_muted": ("boolean", "BOOLEAN"),
}
FIELD_TYPES = {
    "node_id": "string",
    "sensor_type": "string",
    "status": "string",
    "msg_id": "bigint",
    "timestamp": "bigint",
}


# --- well-formed messages ------------------------------------------------------------------------------

# What a typed read of the text gives. It is strict about JSON types (a number is not read from text, an
# integer not from 5.0), except that text columns take any value: those are read as VARIANT.
TYPED_MESSAGE = (
    "array<struct<node_id: variant, sensor_type: variant, status: variant, msg_id: bigint, timestamp: double, "
    "payload: struct<temp: double, humi: double, gas: int, light_level: int, buzzer_active: boolean, "
    "is_muted: boolean>>>"
)
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
TEXT_FIELDS = ("node_id", "sensor_type", "status")
EXACT_DOUBLE = float(2**53)


def _typed(raw: DataFrame) -> DataFrame:
    """Adds ``_typed``, the message as typed fields where it is well-formed beyond doubt, else NULL.

    A ']' in the text may close the array around it, and numbers of 2^53 and more may not fit a double. A key
    may be repeated, and the typed read keeps an earlier value when the last one has the wrong type: but every
    member needs a colon, so a text with just as many colons as values read has no further members. Messages
    beyond these bounds, like all that miss something, are left to the member-by-member reading.
    """
    payload = F.col("payload")
    wrapped = F.concat(F.lit("["), payload, F.lit("]"))
    certain = F.is_valid_utf8(payload) & ~F.contains(payload, F.lit("]"))
    rows = raw.withColumn("_list", F.when(certain, F.from_json(wrapped, TYPED_MESSAGE, STRICT_JSON)))
    message = F.get(F.col("_list"), F.lit(0))
    opened = evaluated_once(
        rows.withColumn("_message", F.when(F.size("_list") == 1, message)), F.col("_message"), keep=raw.columns
    )
    fields = F.col("_message")
    texts = {name: F.try_variant_get(fields[name], "$", "string") for name in TEXT_FIELDS}
    measured = sum((fields.payload[name].isNotNull().cast("int") for name in MEASURES), F.lit(len(REQUIRED)))
    colons = F.length("payload") - F.length(F.replace(F.col("payload"), F.lit(":"), F.lit("")))
    sound = (
        fields.payload.isNotNull()
        & (colons == measured)
        & fields.msg_id.between(0, MAX_MSG_ID)
        & (F.abs(fields.timestamp) < EXACT_DOUBLE)
    )
    sound = sound & (texts["node_id"] != "")
    for name in TEXT_FIELDS:
        sound = sound & (kind_of(fields[name]) == "STRING")
    typed = F.struct(
        *[text.alias(name) for name, text in texts.items()],
        fields.msg_id.alias("msg_id"),
        fields.timestamp.cast("bigint").alias("timestamp"),
        *[fields.payload[name].alias(name) for name in MEASURES],
    )
    return evaluated_once(opened, F.when(sound, typed).alias("_typed"), keep=raw.columns)


# --- all other messages --------------------------------------------------------------------------------


def _members(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Every member of the message taken out once: its JSON type and its typed value."""
    document, fields, measures = F.col("_document"), F.col("_fields"), F.col("_measures")
    opened = evaluated_once(
        with_document(rows, text).withColumn("_fields", F.try_variant_get(document, "$", _variant_struct(REQUIRED))),
        document.isNotNull().alias("_is_json"),
        fields,
        F.try_variant_get(fields.payload, "$", _variant_struct(MEASURES)).alias("_measures"),
        keep=keep,
    )
    kinds = [kind_of(fields[key]).alias(f"{key}_kind") for key in REQUIRED if key != "payload"]
    # an object of any content opens as a struct, so its full type need not be spelled out
    payload_kind = F.when(measures.isNotNull(), F.lit("OBJECT")).when(fields.payload.isNotNull(), F.lit("OTHER"))
    kinds.append(payload_kind.alias("payload_kind"))
    values = [F.try_variant_get(fields[key], "$", kind).alias(key) for key, kind in FIELD_TYPES.items()]
    measured = [kind_of(measures[key]).alias(f"{key}_kind") for key in MEASURES]
    measured += [F.try_variant_get(measures[key], "$", kind).alias(key) for key, (kind, _) in MEASURE_TYPES.items()]
    return evaluated_once(
        opened,
        "_is_json",
        *kinds,
        *values,
        _beyond_long(fields.msg_id, kind_of(fields.msg_id)).alias("msg_id_beyond_long"),
        *measured,
        keep=keep,
    )


def _measure(name: str) -> Column:
    wanted, kind = MEASURE_TYPES[name][1], F.col(f"{name}_kind")
    return F.when(is_number(kind) if wanted is None else kind == wanted, F.col(name))


def parse_messages(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Raw messages with their reading columns and ``reject_reason``; narrow projections, no shuffle.

    Well-formed messages are read with one typed read. The others (their text is ``_rest``) are taken apart
    member by member, which tells what is wrong with them, or that nothing is.
    """
    typed = F.col("_typed")
    rest = _typed(raw).withColumn("_rest", F.when(typed.isNull(), F.col("payload")))
    members = _members(rest, "_rest", [*raw.columns, "_typed"])

    def value(name: str, otherwise: Column | None = None) -> Column:
        return F.when(typed.isNotNull(), typed[name]).otherwise(F.col(name) if otherwise is None else otherwise)

    node_id = value("node_id")
    return members.select(
        *raw.columns,
        F.when(typed.isNull(), reject_reason()).alias("reject_reason"),
        node_id.alias("node_id"),
        parse_sensor_type(value("sensor_type")).alias("sensor_type"),
        # numbers are read as double first: the same two roundings as a float32 field of the message
        value("temp", _measure("temp")).cast("float").alias("temperature"),
        value("humi", _measure("humi")).cast("float").alias("humidity"),
        F.when(~node_id.isin(*rules.gasless_nodes), value("gas", _measure("gas"))).alias("gas"),
        value("light_level", _measure("light_level")).alias("light_level"),
        value("buzzer_active", _measure("buzzer_active")).alias("buzzer_active"),
        value("is_muted", _measure("is_muted")).alias("is_muted"),
        parse_status(value("status")).alias("status"),
        value("msg_id").alias("msg_id"),
        value("timestamp").alias("timestamp"),
        node_from_topic(F.col("topic")).alias("topic_node"),
    )


READING_COLUMNS = (
    "seq", "node_id", "sensor_type", "temperature", "humidity", "gas", "light_level", "buzzer_active",
    "is_muted", "status", "msg_id", "timestamp", "received_at", "topic_node",
)


def valid_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*READING_COLUMNS)


def rejects(parsed: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Quarantine rows: whole message, reason and a short preview."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "seq", "topic", "payload", "received_at", "reject_reason",
        cut(F.col("payload"), rules.preview_limit).alias("preview"),
    )
