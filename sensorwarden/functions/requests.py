"""Validation of operator requests and the commands they turn into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwarden.functions.enums import translate
from sensorwarden.functions.naming import CANONICAL_NAME, COMMAND_NODES
from sensorwarden.functions.parsing import is_number, kind_of, with_document
from sensorwarden.functions.staging import evaluated_once
from sensorwarden.functions.topics import command_topic

# Accepted threshold and buzzer types.
THRESHOLD_TYPES = ("gas_warn", "gas_crit", "temp_warn", "temp_crit")
BUZZER_TYPES = ("gas", "temp")

# Request error texts.
MISSING = "Missing required fields"
BAD_TYPE = "Invalid threshold type"
TEMP_RANGE = "Temperature threshold must be between 0 and 100°C"
GAS_RANGE = "Gas threshold must be between 0 and 10000 ppm"
BAD_VALUE = "Invalid threshold value"
UNKNOWN_NODE = "Unknown node"
BAD_BUZZER = "Invalid node or buzzer type"
BAD_BODY = "Invalid request body"

# numbers as text; single underscores between digits are allowed
DIGITS = r"\d+(_\d+)*"
FLOAT_TEXT = rf"^\s*[+-]?({DIGITS}(\.({DIGITS})?)?|\.{DIGITS})([eE][+-]?{DIGITS})?\s*$"
INT_TEXT = rf"^\s*[+-]?{DIGITS}\s*$"
INFINITE_TEXT = r"^\s*[+-]?(?i:inf|infinity)\s*$"


def _taken_apart(bodies: DataFrame, *names: str) -> DataFrame:
    """(seq, is_json) and kind, text and number of each member of the request body."""
    fields = F.col("_fields")
    opened = evaluated_once(
        with_document(bodies, "body"),
        F.try_variant_get(
            F.col("_document"), "$", "struct<" + ", ".join(f"{name} variant" for name in names) + ">"
        ).alias("_fields"),
        keep=["seq"],
    )
    members = []
    for name in names:
        member = fields[name]
        members += [
            kind_of(member).alias(f"{name}_kind"),
            F.try_variant_get(member, "$", "string").alias(f"{name}_text"),
            F.try_variant_get(member, "$", "double").alias(f"{name}_number"),
        ]
    return evaluated_once(opened, fields.isNotNull().alias("is_object"), *members, keep=["seq"])


def _falsy(name: str) -> Column:
    """Absent, null, false, zero, empty text or empty container."""
    kind, text = F.col(f"{name}_kind"), F.col(f"{name}_text")
    empty = (
        (kind == "VOID")
        | ((kind == "STRING") & (text == ""))
        | ((kind == "BOOLEAN") & (text == "false"))
        | ((kind.startswith("OBJECT") | kind.startswith("ARRAY")) & text.isin("{}", "[]"))
        | (is_number(kind) & (F.col(f"{name}_number") == 0))
    )
    return kind.isNull() | F.coalesce(empty, F.lit(False))


def _text(name: str) -> Column:
    return F.when(F.col(f"{name}_kind") == "STRING", F.col(f"{name}_text"))


def _number_of(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double")


def _as_float(name: str) -> Column:
    """Float reading of a JSON scalar, NULL where the conversion fails."""
    kind, text = F.col(f"{name}_kind"), F.col(f"{name}_text")
    infinite = F.when(text.contains("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(is_number(kind) | (kind == "BOOLEAN"), F.col(f"{name}_number")).when(
        kind == "STRING",
        F.when(text.rlike(FLOAT_TEXT), _number_of(text)).when(text.rlike(INFINITE_TEXT), infinite),
    )


def _as_int(name: str) -> Column:
    """Integer reading: a JSON number is truncated, text must be a whole number; kept as double to compare."""
    kind, text, value = F.col(f"{name}_kind"), F.col(f"{name}_text"), F.col(f"{name}_number")
    return F.when(is_number(kind) | (kind == "BOOLEAN"), F.signum(value) * F.floor(F.abs(value))).when(
        (kind == "STRING") & text.rlike(INT_TEXT), _number_of(text)
    )


def threshold_requests(bodies: DataFrame) -> DataFrame:
    """(seq, body) -> (seq, node_id, threshold_type, value, is_valid, error); the first broken rule wins."""
    kind, node, number = F.col("threshold_type"), F.col("node_id"), F.col("number")
    is_temp = kind.startswith("temp")
    typed = evaluated_once(
        _taken_apart(bodies, "node_id", "threshold_type", "value"),
        "is_object",
        (_falsy("node_id") | _falsy("threshold_type") | (F.coalesce("value_kind", F.lit("VOID")) == "VOID")).alias(
            "incomplete"
        ),
        _text("node_id").alias("node_id"),
        _text("threshold_type").alias("threshold_type"),
        F.when(_text("threshold_type").startswith("temp"), _as_float("value")).otherwise(_as_int("value")).alias(
            "number"
        ),
        keep=["seq"],
    )
    error = (
        F.when(~F.col("is_object"), F.lit(BAD_BODY))
        .when(F.col("incomplete"), F.lit(MISSING))
        .when(~F.coalesce(kind.isin(*THRESHOLD_TYPES), F.lit(False)), F.lit(BAD_TYPE))
        .when(number.isNull() | F.isnan(number), F.lit(BAD_VALUE))
        .when(is_temp & ~number.between(0, 100), F.lit(TEMP_RANGE))
        .when(~is_temp & ~number.between(0, 10000), F.lit(GAS_RANGE))
        .when(~F.coalesce(node.isin(*COMMAND_NODES), F.lit(False)), F.lit(UNKNOWN_NODE))
    )
    return typed.withColumn("error", error).select(
        "seq",
        "node_id",
        "threshold_type",
        F.when(F.col("error").isNull(), number).alias("value"),
        F.col("error").isNull().alias("is_valid"),
        "error",
    )


def mute_requests(bodies: DataFrame) -> DataFrame:
    """(seq, body) -> (seq, node_id, type, is_valid, error)."""
    typed = evaluated_once(
        _taken_apart(bodies, "node_id", "type"),
        "is_object",
        (_falsy("node_id") | _falsy("type")).alias("incomplete"),
        _text("node_id").alias("node_id"),
        _text("type").alias("type"),
        keep=["seq"],
    )
    fits = F.coalesce(F.col("node_id").isin(*COMMAND_NODES) & F.col("type").isin(*BUZZER_TYPES), F.lit(False))
    error = (
        F.when(~F.col("is_object"), F.lit(BAD_BODY))
        .when(F.col("incomplete"), F.lit(MISSING))
        .when(~fits, F.lit(BAD_BUZZER))
    )
    return typed.withColumn("error", error).select(
        "seq", "node_id", "type", F.col("error").isNull().alias("is_valid"), "error"
    )


def _decimal_text(value: Column) -> Column:
    """Shortest text of a number in [0, 100]: plain down to 0.0001, below that as 5e-05."""
    text = value.cast("string")
    parts = r"^(\d)\.(\d+)E-(\d+)$"
    first, rest, power = (F.regexp_extract(text, parts, k) for k in (1, 2, 3))
    rest = F.when(rest == "0", "").otherwise(rest)
    small = F.concat(first, F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e-"), F.lpad(power, 2, "0"))
    plain = F.concat(F.lit("0.000"), first, rest)
    return F.when(~text.rlike(parts), text).when(power == "4", plain).otherwise(small)


def _value_text(kind: Column, value: Column) -> Column:
    return F.when(kind.startswith("temp"), _decimal_text(value)).otherwise(value.cast("bigint").cast("string"))


def threshold_commands(requests: DataFrame) -> DataFrame:
    """Valid threshold requests -> (seq, topic, payload)."""
    kind = F.col("threshold_type")
    return requests.filter("is_valid").select(
        "seq",
        command_topic(translate(F.col("node_id"), CANONICAL_NAME, None)).alias("topic"),
        F.concat(
            F.lit('{"cmd": "set_threshold", "'), kind, F.lit('": '), _value_text(kind, F.col("value")), F.lit("}")
        ).alias("payload"),
    )


def mute_commands(requests: DataFrame) -> DataFrame:
    """Valid mute requests -> (seq, topic, payload)."""
    return requests.filter("is_valid").select(
        "seq",
        command_topic(translate(F.col("node_id"), CANONICAL_NAME, None)).alias("topic"),
        F.concat(F.lit('{"cmd": "mute_'), F.col("type"), F.lit('"}')).alias("payload"),
    )
