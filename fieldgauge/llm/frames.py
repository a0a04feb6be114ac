"""Small helpers shared by the operators: names, arrow functions, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.session import delete, scratch


#: Spark's setting to delete the shuffles of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def own(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def stored(spark: SparkSession, frame: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The rows written to the shared scratch folder and read again: a lost executor
    costs no more than what is in flight, and nothing before is computed twice.

    The shuffles that led to them are deleted with the write's end, as nothing reads them
    again; a frame that is run again all the same makes its shuffles anew."""
    path = scratch(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def freed(spark: SparkSession, *frames: DataFrame, only: str = "") -> None:
    """Delete the folders of stored frames, or only those named so, which a frame that is
    stored by a column has; for those whose readers are stored themselves."""
    for frame in frames:
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
            if folder.endswith(only):
                delete(spark, folder)


def by_batch(
    frame: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``work`` over each Arrow batch, in small pieces so that long texts fit."""

    def run(batches):
        for batch in batches:
            yield from work(batch)

    return frame.mapInArrow(run, schema)


#: The ASCII blanks between words, and the letters that are folded: fixed values.
BLANKS = " \\t\\n\\u000b\\f\\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column | str) -> Column:
    """A-Z in lower case and nothing else; plain ASCII takes the quicker function."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
