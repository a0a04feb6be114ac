"""Settings for the jobs, with environment overrides.

Names and defaults of the environment variables are fixed values that existing
deployments already set.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from fieldgauge.contract import SUBJECT_PREFIX


class ConfigError(ValueError):
    """A setting that cannot be used, named by its key."""


@dataclass(frozen=True)
class Thresholds:
    """Alert limits. A value on a limit does not alert."""

    temperature: tuple[float, float] = (-10.0, 80.0)
    humidity: tuple[float, float] = (0.0, 100.0)
    pressure: tuple[float, float] = (900.0, 1100.0)
    light: tuple[float, float] = (0.0, 1000.0)
    acidity: tuple[float, float] = (4.0, 10.0)
    battery_low: int = 20

    @classmethod
    def from_json(cls, document: str) -> Thresholds:
        """Limits that differ from the defaults, as a JSON object."""
        try:
            given = json.loads(document)
            values = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items()}
            return cls(**values)
        except (TypeError, ValueError, AttributeError) as bad:
            raise ConfigError(f"thresholds: {bad}") from bad

    def __post_init__(self):
        for item in fields(self):
            limits = getattr(self, item.name)
            if item.name == "battery_low":
                if not isinstance(limits, int):
                    raise ConfigError(f"{item.name}: not a whole number: {limits!r}")
            elif not (isinstance(limits, tuple) and len(limits) == 2):
                raise ConfigError(f"{item.name}: not a pair of numbers: {limits!r}")
            elif not limits[0] <= limits[1]:
                raise ConfigError(f"{item.name}: {limits[0]} is above {limits[1]}")


def _text(key: str, default: str):
    return field(default=default, metadata={"env": key})


def _number(key: str, default: int):
    return field(default=default, metadata={"env": key, "cast": int})


@dataclass(frozen=True)
class Settings:
    kafka_servers: str = _text("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    kafka_topic: str = _text("KAFKA_TOPIC", "iot-sensor-data")
    kafka_group: str = _text("KAFKA_CONSUMER_GROUP_ID", "iot-alerting-consumer")
    starting_offsets: str = _text("KAFKA_STARTING_OFFSETS", "earliest")
    app_name: str = _text("SPARK_APP_NAME", "IoT-Kafka-Alerting-Pipeline")
    # empty: the caller must pass a folder all executors can reach
    checkpoint: str = _text("SPARK_CHECKPOINT_LOCATION", "")
    trigger_seconds: int = _number("SPARK_PROCESSING_TIME_SECONDS", 10)
    log_level: str = _text("SPARK_LOG_LEVEL", "WARN")
    recipient: str = _text("ALERT_RECIPIENT_EMAIL", "admin@company.com")
    sender: str = _text("EMAIL_FROM_ADDRESS", "iot-alerts@company.com")
    subject_prefix: str = _text("EMAIL_SUBJECT_PREFIX", SUBJECT_PREFIX)
    thresholds: Thresholds = Thresholds()

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> Settings:
        env = os.environ if env is None else env
        values = {}
        for item in fields(cls):
            key = item.metadata.get("env")
            if key is None or key not in env:
                continue
            cast = item.metadata.get("cast", str)
            try:
                values[item.name] = cast(env[key])
            except ValueError as bad:
                raise ConfigError(f"{key}: not a number: {env[key]!r}") from bad
        settings = cls(**{**values, **overrides})
        if settings.trigger_seconds <= 0:
            raise ConfigError("SPARK_PROCESSING_TIME_SECONDS: must be above zero")
        return settings
