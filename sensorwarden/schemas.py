"""Schemas of the stored and exchanged tables."""

RAW_MESSAGE = "seq BIGINT, topic STRING, payload STRING, retain BOOLEAN, received_at BIGINT"

READING = (
    "seq BIGINT, node_id STRING, sensor_type STRING, temperature FLOAT, humidity FLOAT, gas INT, "
    "light_level INT, buzzer_active BOOLEAN, is_muted BOOLEAN, status STRING, msg_id BIGINT, "
    "timestamp BIGINT, received_at BIGINT, topic_node STRING"
)

DEVICE = (
    "id BIGINT, node_id STRING, location STRING, sensor_type STRING, has_gas BOOLEAN, "
    "last_msg_id BIGINT, created_at TIMESTAMP"
)

SENSOR_LOG = (
    "id BIGINT, device_id BIGINT, temp DOUBLE, humi DOUBLE, gas INT, light_level INT, buzzer_active INT, "
    "is_muted INT, status STRING, msg_id BIGINT, timestamp BIGINT, captured_at TIMESTAMP"
)

SYSTEM_EVENT = "id BIGINT, node_id STRING, severity STRING, description STRING, timestamp BIGINT, created_at TIMESTAMP"

THRESHOLD = (
    "node_id STRING, gas_warn INT, gas_crit INT, temp_warn DOUBLE, temp_crit DOUBLE, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)

# What is remembered of the last accepted reading of a node.
LAST_FIELDS = ("seq", "temperature", "humidity", "gas", "status", "msg_id", "timestamp", "received_at")

LAST_READING = (
    "seq: BIGINT, temperature: FLOAT, humidity: FLOAT, gas: INT, status: STRING, msg_id: BIGINT, "
    "timestamp: BIGINT, received_at: BIGINT"
)

# Per-node memory between two stretches of the message sequence (micro-batches or seq spans).
NODE_STATE = f"node_id STRING, mark BIGINT, streak INT, faulty BOOLEAN, last STRUCT<{LAST_READING}>"
