r"""Streams from a Kafka topic, as one application.

    spark-submit --packages <spark-sql-kafka> --py-files fieldgauge.zip \
        fieldgauge/plans/stream_job.py --lake PATH --checkpoint PATH [--streams raw alerts]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldgauge import session
from fieldgauge.config import ConfigError, Settings, Thresholds
from fieldgauge.sources import broker
from fieldgauge.streaming import queries

STREAMS = ("raw", "windows", "alerts", "rejects", "flow")


def start(
    messages: DataFrame | Callable[[str], DataFrame],
    lake: str,
    checkpoint: str,
    settings: Settings,
    streams=STREAMS,
    trigger: dict | None = None,
    epoch_unit: str = "ms",
) -> list[StreamingQuery]:
    """Start the chosen streams, each with its own checkpoint.

    ``messages`` is one source, or gives each stream its own by the stream's name.
    """
    timing = {} if trigger is None else {"trigger": trigger}
    source = messages if callable(messages) else lambda name: messages
    timing_unit = {**timing, "epoch_unit": epoch_unit}
    starters = {
        "raw": lambda m, at: queries.raw_sink(m, f"{lake}/raw", at, **timing_unit),
        "windows": lambda m, at: queries.window_sink(m, f"{lake}/windows", at, **timing_unit),
        "alerts": lambda m, at: queries.alert_sink(m, f"{lake}/alerting", at, settings, **timing_unit),
        "rejects": lambda m, at: queries.reject_sink(m, f"{lake}/rejects", at, **timing_unit),
        "flow": lambda m, at: queries.flow_probe(m, at, f"{lake}/flow", **timing),
    }
    return [starters[name](source(name), f"{checkpoint.rstrip('/')}/{name}") for name in streams]


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("--lake", required=True)
    args.add_argument("--checkpoint")
    args.add_argument("--streams", nargs="+", choices=STREAMS, default=STREAMS)
    args.add_argument("--max-offsets-per-trigger", type=int)
    args.add_argument("--thresholds", type=Thresholds.from_json, default=Thresholds(),
                      help='JSON, such as {"temperature": [10, 30], "battery_low": 25}')
    args.add_argument("--epoch-unit", choices=("ms", "s"), default="ms")
    opts = args.parse_args(argv)
    settings = Settings.from_env(thresholds=opts.thresholds)
    checkpoint = opts.checkpoint or settings.checkpoint
    if not checkpoint:
        raise ConfigError("SPARK_CHECKPOINT_LOCATION: not set, and no --checkpoint given")
    spark: SparkSession = session.builder(settings.app_name).getOrCreate()
    spark.sparkContext.setLogLevel(settings.log_level)

    def messages(stream: str) -> DataFrame:
        """Streams read on their own, so each has a consumer group of its own."""
        return broker.kafka_stream(
            spark,
            broker.kafka_options(
                settings.kafka_servers,
                settings.kafka_topic,
                f"{settings.kafka_group}-{stream}",
                settings.starting_offsets,
                max_offsets_per_trigger=opts.max_offsets_per_trigger,
            ),
        )

    lake = opts.lake.rstrip("/")
    spark.streams.addListener(queries.ProgressLedger(spark, f"{lake}/rejects/progress"))
    start(messages, lake, checkpoint, settings, opts.streams, epoch_unit=opts.epoch_unit)
    queries.supervise(spark)


if __name__ == "__main__":
    main()
