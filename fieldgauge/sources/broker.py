"""Message sources for streams: a Kafka topic, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldgauge import contract as C

# Client settings of the ingest stream
INGEST_GROUP = "iot-sensor-spark-consumer"
CLIENT = {
    "kafka.metadata.max.age.ms": "5000",
    "kafka.max.poll.interval.ms": "60000",
    "kafka.request.timeout.ms": "30000",
}
MIN_PARTITIONS = 3


def kafka_options(
    servers: str,
    topic: str,
    group: str = INGEST_GROUP,
    starting_offsets: str = "earliest",
    min_partitions: int | None = MIN_PARTITIONS,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    **more: str,
) -> dict[str, str]:
    """Options of the Kafka reader.

    ``min_partitions`` above the topic's own count lets several tasks share one
    hot partition. ``max_offsets_per_trigger`` bounds a batch when a stream
    starts far behind. ``fail_on_data_loss`` stops the stream if offsets are gone;
    without it they are skipped silently.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **CLIENT,
        **more,
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream. Needs the spark-sql-kafka package on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession, path: str, schema=C.ENVELOPE_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files that arrive in ``path``, in the shape of broker messages."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
