"""The message rules as a plain sequential program, to compare the DataFrame operators with."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Node:
    mark: int = 0
    last: dict | None = None
    run: int = 0
    faulty: bool = False
    armed_at: int | None = None


@dataclass
class Gateway:
    listed: dict[str, int]  # node -> stored mark
    required: int = 3
    nodes: dict[str, Node] = field(default_factory=dict)
    events: list[tuple[int, str, str]] = field(default_factory=list)
    accepted: list[int] = field(default_factory=list)
    offline: list[tuple[int, str, int]] = field(default_factory=list)

    def scan(self, now: int) -> None:
        """One watchdog pass over all nodes."""
        for name, node in self.nodes.items():
            if node.armed_at is not None and not node.faulty and now - node.armed_at > 30:
                self.offline.append((node.last["seq"], name, now))
                node.armed_at = None

    def message(self, m: dict) -> None:
        name, seq = m["node_id"], m["seq"]

        def event(kind: str) -> None:
            self.events.append((seq, name, kind))

        if name not in self.listed:
            event("unauthorized_device")
            return
        node = self.nodes.setdefault(name, Node(mark=self.listed[name]))
        if node.mark != 0 and m["msg_id"] <= node.mark:
            event("replay_attack")
            return
        node.mark = m["msg_id"]
        if m["status"] == "NOT_OPERATING":
            node.faulty, node.run, node.armed_at = True, 0, None
            event("device_not_operating")
            return
        old = node.last
        if old is not None:
            if m["timestamp"] < old["timestamp"]:
                event("timestamp_regression")
            if 0 <= m["received_at"] - old["received_at"] <= 5:
                for column, limit, kind in (("temperature", 20, "temp_jump"), ("humidity", 40, "humi_jump")):
                    if m[column] is not None and old[column] is not None:
                        if abs(np.float32(m[column]) - np.float32(old[column])) > np.float32(limit):
                            event(kind)
        if m["status"] == "OPERATIONAL":
            node.run += 1
            if node.faulty and node.run >= self.required:
                node.faulty = False
                event("device_recovered")
        else:
            node.run = 0
        node.last, node.armed_at = m, m["received_at"]
        self.accepted.append(seq)

    def run_all(self, messages: list[dict], as_of: int) -> None:
        """Messages in arrival order with a scan at every multiple of five seconds, arrivals first."""
        if not messages:
            return
        now = (messages[0]["received_at"] // 5) * 5
        position = 0
        while now <= as_of:
            while position < len(messages) and messages[position]["received_at"] <= now:
                self.message(messages[position])
                position += 1
            self.scan(now)
            now += 5
        for m in messages[position:]:
            self.message(m)
