"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Calendar columns and message times are defined in UTC.
# Stages whose generated method would exceed 8000 bytes, which HotSpot never
# compiles, run operator by operator instead: wide silver rows three times faster.
RUNTIME = {"spark.sql.session.timeZone": "UTC", "spark.sql.codegen.hugeMethodLimit": "8000"}

DEFAULTS = {
    **RUNTIME,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep a few partition files open per task instead of sorting rows by partition;
    # enough for one day of silver, few enough for their Parquet buffers to fit
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # window state lives off-heap and on local disk, so it may outgrow the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # a commit uploads what changed in the batch, not the whole state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app_name: str) -> SparkSession.Builder:
    """A session builder with our defaults. The master comes from spark-submit."""
    build = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        build = build.config(key, value)
    return build


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings our results and plans rely on."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only when there is just this one
    machine, so that a cluster never writes where other executors cannot read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="fieldgauge-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, name: str) -> None:
    """Delete a file or folder in whatever file system it names; Spark has no call for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
