"""Rule values and sizing limits shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """Detection thresholds (fixed values of the data contract) and scale limits."""

    # sequence rules
    replay_detection: bool = True
    temp_jump: float = 20.0
    humi_jump: float = 40.0
    gas_jump: int = 200
    jump_window_s: int = 5
    recovery_count: int = 3

    # heartbeat
    offline_timeout_s: int = 30
    scan_interval_s: int = 5

    # static thresholds
    temp_warn: float = 45.0
    temp_crit: float = 50.0
    gas_warn: int = 400
    gas_crit: int = 600

    # per-node thresholds for nodes without a row of their own
    default_gas_warn: int = 350
    default_gas_crit: int = 400
    default_temp_warn: float = 35.0
    default_temp_crit: float = 45.0

    # storage and reports
    retention_days: int = 7
    event_limit: int = 50
    detail_limit: int = 255
    preview_limit: int = 120

    # export
    enterprise_oid: str = "1.3.6.1.4.1.9999"
    export_slots: int = 16
    no_data: int = 238

    # nodes whose gas field is ignored on arrival
    gasless_nodes: tuple[str, ...] = ("ESP32_SEC_01",)

    # scale: a node with more rows than hot_rows is cut into spans of chunk_rows
    # consecutive seq values; a keyed table is broadcast only up to broadcast_rows.
    hot_rows: int = 4_000_000
    chunk_rows: int = 1_000_000
    broadcast_rows: int = 100_000
