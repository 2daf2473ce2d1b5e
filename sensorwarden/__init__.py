"""Sensor telemetry security and fleet health as plain Spark DataFrame functions."""

from sensorwarden.config import Rules

__all__ = ["Rules"]
