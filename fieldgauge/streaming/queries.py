"""The three streams: raw lake, device windows, alerts.

Each takes a streaming frame of broker messages, so a file stream can stand in
for the topic, and starts one query with its own checkpoint.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fieldgauge import contract as C
from fieldgauge.config import Settings
from fieldgauge.functions.sql import measures
from fieldgauge.operators import alerts, ingest, windows
from fieldgauge.sources import tables, versions

# Default triggers
RAW_TRIGGER = {"processingTime": "10 seconds"}
WINDOW_TRIGGER = {"processingTime": "1 minute"}

DRAIN = {"availableNow": True}

FLOW_COUNTS = {"received": "count(1)", "accepted": f"count_if({ingest.USABLE})"}
FLOW_SCHEMA = "received long, accepted long, run string, batch_id long"


def accepted(messages: DataFrame, epoch_unit: str = "ms") -> DataFrame:
    """Valid readings."""
    return ingest.accept(ingest.parse(messages, epoch_unit))


def stream_run(spark: SparkSession) -> str:
    """The id of the stream whose batch this thread runs: it lives as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "by-hand"


def raw_sink(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict = RAW_TRIGGER, epoch_unit: str = "ms"
) -> StreamingQuery:
    """Messages as sent, as JSON lines in the raw tier's day folders.

    A batch that is run again is not added again; another checkpoint adds its own.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        tables.append_raw(rows, path, f"{stream_run(rows.sparkSession)}/{batch_id}")

    return (
        ingest.raw_rows(ingest.accept(ingest.parse(messages, epoch_unit)))
        .writeStream.queryName("raw-lake")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


# -- every message accounted for ---------------------------------------------------

POSITION = ["topic", "partition", "offset"]
ARRIVED = "arrived"
COUNTS_SCHEMA = "run string, batch_id long, accepted long, rejected long, incomplete long"
PROGRESS_SCHEMA = "run string, batch_id long, received long, repeated long, too_late long"


def once_each(messages: DataFrame, delay: str = C.WATERMARK) -> DataFrame:
    """Messages without those that were delivered again within ``delay`` of event time.

    Told apart by their place in the topic. What is remembered is bounded by the delay;
    messages are counted as they arrive.
    """
    arrived = messages.observe(ARRIVED, F.count(F.lit(1)).alias("received"))
    return arrived.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(POSITION)


def reject_sink(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict = RAW_TRIGGER, epoch_unit: str = "ms",
    delay: str = C.WATERMARK,
) -> StreamingQuery:
    """Store messages that are rejected or incomplete, with the reason, and count all.

    ``path`` gets ``dead_letters`` by day of arrival, and ``counts`` by batch. A batch
    that is run again adds nothing.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        run = stream_run(spark)
        seen = Observation()
        judged = ingest.judge(rows, epoch_unit)
        counted = judged.observe(seen, *measures(REJECT_COUNTS))
        letters = tables.packed(counted.where("reason IS NOT NULL").drop("usable"))
        source, table = f"{run}/{batch_id}", f"{path}/dead_letters"
        if versions.append_once(spark, letters, table, ("event_date",), source):
            counts = seen.get
        else:  # a batch run again, whose letters are stored: its counts may not be
            counts = judged.agg(*measures(REJECT_COUNTS)).first()
        counted = spark.createDataFrame([(run, batch_id, *(counts[n] for n in REJECT_COUNTS))], COUNTS_SCHEMA)
        tables.write(counted, f"{path}/counts", ("run", "batch_id"))

    return (
        once_each(messages, delay)
        .writeStream.queryName("rejects")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


#: Accepted and rejected add up to the messages; the incomplete are among the accepted.
REJECT_COUNTS = {
    "accepted": "count_if(usable)",
    "rejected": "count_if(NOT usable)",
    "incomplete": "count_if(usable AND reason IS NOT NULL)",
}


class ProgressLedger(StreamingQueryListener):
    """Stores what a batch received, and dropped as repeated or as too late, when it ends.

    For streams of ``once_each``. Add it with ``spark.streams.addListener`` before the start.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._ended = spark, path, {}

    def onQueryStarted(self, event):  # noqa: N802 - names of the interface
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event):  # noqa: N802
        progress = event.progress
        arrived = progress.observedMetrics.get(ARRIVED)
        if arrived is None:
            return
        states = progress.stateOperators
        repeated = sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in states)
        late = sum(s.numRowsDroppedByWatermark for s in states)
        row = (str(progress.id), progress.batchId, arrived["received"], repeated, late)
        rows = self.spark.createDataFrame([row], PROGRESS_SCHEMA)
        tables.write(rows.coalesce(1), self.path, ("run", "batch_id"))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, timeout: float | None = None) -> None:
        """Until all progress of an ended query is stored."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(timeout):
            raise TimeoutError(f"{query.id}: its end was not reported")


def message_counts(spark: SparkSession, path: str, progress: str) -> DataFrame:
    """received, accepted, rejected, repeated and too_late of all batches of all runs."""
    counts = spark.read.schema(COUNTS_SCHEMA).parquet(f"{path}/counts")
    arrived = spark.read.schema(PROGRESS_SCHEMA).parquet(progress)
    return (
        counts.agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        .join(arrived.agg(*(F.sum(n).alias(n) for n in ("received", "repeated", "too_late"))))
        .select("received", "accepted", "rejected", "repeated", "too_late")
    )


def flow_probe(
    messages: DataFrame, checkpoint: str, path: str, trigger: dict = RAW_TRIGGER
) -> StreamingQuery:
    """Count what arrives and what is accepted, and store the counts by run and batch."""
    return (
        ingest.parse(messages)
        .writeStream.queryName("flow")
        .foreachBatch(lambda rows, batch_id: write_flow_batch(rows, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_flow_batch(parsed: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch's counts. A batch that is run again replaces its own."""
    spark = parsed.sparkSession
    counts = parsed.agg(*measures(FLOW_COUNTS))
    tables.write(
        counts.withColumns({"run": F.lit(stream_run(spark)), "batch_id": F.lit(batch_id)}), path, ("run", "batch_id")
    )


def flow_counts(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch_id, received, accepted) of every batch; no rows before the first."""
    return _read_or_none(spark, path, FLOW_SCHEMA).select("run", "batch_id", "received", "accepted")


def _read_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet: then it has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def window_stream(
    messages: DataFrame, watermark: str = C.WATERMARK, width: str = C.WINDOW, epoch_unit: str = "ms"
) -> DataFrame:
    """Device windows of a stream. Readings later than the watermark are dropped."""
    readings = accepted(messages, epoch_unit).withWatermark("sensor_timestamp", watermark)
    return windows.by_window(readings, width)


def window_sink(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = WINDOW_TRIGGER,
    partitions: tuple[str, ...] = ("window_date",),
    epoch_unit: str = "ms",
) -> StreamingQuery:
    """Closed windows as Parquet.

    Cut by day by default. ``("deviceId",)`` gives one folder per device, which
    suits a small fleet only: every batch writes a file per device.
    """
    return (
        window_stream(messages, epoch_unit=epoch_unit)
        .withColumn("window_date", F.to_date("window_start"))
        .writeStream.queryName("device-windows")
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partitions)
        .trigger(**trigger)
        .start(path)
    )


_WINDOW_KEY = ["deviceId", "window_start", "window_end"]


def window_update_sink(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict = WINDOW_TRIGGER, epoch_unit: str = "ms",
    watermark: str = C.WATERMARK,
) -> StreamingQuery:
    """Windows as they stand after every batch, open ones included.

    A batch adds the windows that it has changed, once; ``latest_windows`` reads them merged.
    So a dashboard need not wait for the watermark, and a late reading corrects its window.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        run = stream_run(spark)
        changed = rows.withColumns(
            {"window_date": F.to_date("window_start"), "run": F.lit(run), "batch_id": F.lit(batch_id)}
        )
        changed = changed.hint("rebalance", "window_date")
        versions.append_once(spark, changed, path, ("window_date",), f"{run}/{batch_id}", day="window_date")

    return (
        window_stream(messages, watermark, epoch_unit=epoch_unit)
        .writeStream.queryName("window-updates")
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest_windows(spark: SparkSession, path: str, first=None, last=None) -> DataFrame | None:
    """Each window of some days, or of all, as its last batch left it; None if there are none.

    A window only gains readings, so of several runs over one topic the fullest is the latest.
    """
    rows = versions.read(spark, path, first, last, day="window_date")
    if rows is None:
        return None
    values = [c for c in rows.columns if c not in (*_WINDOW_KEY, "run", "batch_id", "window_date")]
    newest = F.max_by(F.struct(*values), F.struct("record_count", "batch_id")).alias("newest")
    return rows.groupBy(*_WINDOW_KEY).agg(newest).select(*_WINDOW_KEY, "newest.*")


def late_counts(readings: DataFrame, held: DataFrame, width: str = C.WINDOW) -> DataFrame:
    """Windows that lack readings: accepted, in the stored window, and late.

    ``readings`` are all that were accepted, as the raw tier keeps them: its stream has no
    watermark. ``held`` is the window stream's table. What a window lacks came after the
    watermark had passed its end, or the window is not written yet; ``latest_windows`` of an
    update sink has every window that ever got a reading, so there it is lateness alone.
    The readings are reduced to a count for each window before they meet the table.
    """
    counted = readings.groupBy(F.window("sensor_timestamp", width), "deviceId").agg(
        F.count(F.lit(1)).alias("accepted")
    )
    counted = counted.select("deviceId", "window.start", "window.end", "accepted").toDF(*_WINDOW_KEY, "accepted")
    in_window = F.coalesce("record_count", F.lit(0).cast("long"))
    return (
        counted.join(held.select(*_WINDOW_KEY, "record_count"), _WINDOW_KEY, "left")
        .select(*_WINDOW_KEY, "accepted", in_window.alias("held"), (F.col("accepted") - in_window).alias("late"))
        .where("late > 0")
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a window stream still holds in its state store: windows that may get readings."""
    state = spark.read.format("statestore").load(checkpoint)
    # windows and device are the keys of the state, in whatever order they were grouped
    keys = {f.name: f.dataType for f in state.schema["key"].dataType}
    window = next(name for name, kind in keys.items() if kind.typeName() == "struct")
    device = next(name for name, kind in keys.items() if kind.typeName() == "string")
    return state.select(
        F.col(f"key.`{device}`").alias("deviceId"),
        F.col(f"key.`{window}`.start").alias("window_start"),
        F.col(f"key.`{window}`.end").alias("window_end"),
    )


_ALERT_KEY = ["record_id", "deviceId", "location", "sensor_timestamp"]


def alert_rows(readings: DataFrame, settings: Settings) -> DataFrame:
    """Alerting readings with their anomalies and an undelivered message."""
    found = alerts.types(alerts.alerting(readings, settings.thresholds))
    keep = [*_ALERT_KEY, "anomalies", "anomaly_types"]
    return alerts.outbox(
        alerts.messages(found, settings.recipient, settings.subject_prefix, keep)
    )


def write_alert_batch(
    readings: DataFrame, batch_id: int, path: str, settings: Settings, run: str | None = None
) -> None:
    """One micro-batch: alerts and counts, from a single pass over the readings.

    Both tables are cut by run and batch, and writing replaces the batch. A batch that
    is run again after a failure leaves no duplicates, and a stream that begins anew with
    another checkpoint is another run, which overwrites nothing.
    """
    spark = readings.sparkSession
    run = run or stream_run(spark)
    seen = Observation()
    counted = readings.observe(seen, *alerts.stat_columns(settings.thresholds))
    found = alert_rows(counted, settings).withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
    tables.write(found, f"{path}/alerts", ("run", "batch_id"))
    counts = seen.get
    row = (run, batch_id, counts["records"], counts["anomalies"], counts["alerts"])
    stats = spark.createDataFrame(
        [row], "run string, batch_id long, records long, anomalies long, alerts long"
    )
    tables.write(stats, f"{path}/batch_stats", ("run", "batch_id"))


def alert_sink(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    trigger: dict | None = None,
    epoch_unit: str = "ms",
) -> StreamingQuery:
    """Check every reading and write what alerts to the outbox under ``path``."""
    readings = ingest.accept(ingest.parse(messages, epoch_unit)).selectExpr(
        "*", f"{ingest.record_id('topic', 'partition', 'offset')} AS record_id"
    )
    return (
        readings.writeStream.queryName("alerts")
        .foreachBatch(lambda rows, batch_id: write_alert_batch(rows, batch_id, path, settings))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{settings.trigger_seconds} seconds"}))
        .start()
    )


def alert_table(spark: SparkSession, path: str) -> DataFrame:
    """The alerts of all runs. A message that several runs have read is in each of them."""
    return spark.read.parquet(f"{path}/alerts")


def outbox_state(spark: SparkSession, path: str) -> DataFrame:
    """Each alert message once, with the status, attempts and last error of its ledger."""
    return alerts.folded(alert_table(spark, path), _attempts(spark, path))


def deliver_due(
    spark: SparkSession, path: str, send, as_of, max_retries: int = 3, backoff: str = "1 minute"
) -> None:
    """One delivery round: try what is due, and append what came of it to the ledger.

    Neither alerts nor earlier attempts are rewritten. Rows that a run was trying when it
    ended are due again, so delivery is at-least-once.
    """
    due = alerts.due_rows(outbox_state(spark, path), as_of, max_retries, backoff)
    alerts.attempts(due, send, as_of).write.mode("append").partitionBy("attempt_date").parquet(
        f"{path}/attempts"
    )


def _attempts(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_none(spark, f"{path}/attempts", alerts.ATTEMPT_SCHEMA)


def anomaly_table(spark: SparkSession, path: str) -> DataFrame:
    """The written alerts, one row per anomaly."""
    return alerts.anomalies(alert_table(spark, path), ["batch_id", *_ALERT_KEY])


def drain(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query, without a limit unless one is given; its failure
    is raised here."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"{query.name}: not finished after {timeout} s")
    return query


def supervise(spark: SparkSession) -> None:
    """Wait until any query of the session ends; a failure is raised."""
    spark.streams.awaitAnyTermination()
