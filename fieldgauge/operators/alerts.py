"""Readings to anomalies, alert messages and the delivery outbox."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import Thresholds
from fieldgauge.functions import alert_rules
from fieldgauge.functions.sql import measures, named, text, timestamp

PENDING, SENT, FAILED = "pending", "sent", "failed"

_DEFAULT = Thresholds()


def alerting(
    readings: DataFrame, thresholds: Thresholds = _DEFAULT, battery: bool = True
) -> DataFrame:
    """Readings that break a rule, with ``anomalies`` as array<struct>.

    Filtered by plain comparisons first, so that text is formatted only for the
    few readings that alert.
    """
    found = readings.where(alert_rules.any_breach(thresholds, battery))
    return found.selectExpr("*", f"{alert_rules.anomaly_list(thresholds, battery)} AS anomalies")


def anomalies(alerts: DataFrame, keep: list[str]) -> DataFrame:
    """One row per anomaly, from ``alerting`` rows, whose arrays are never empty.

    Hence ``explode_outer``: a plain ``explode`` makes the optimizer filter on
    the size of the array, and build every array twice.
    """
    return alerts.selectExpr(*keep, "explode_outer(anomalies) AS anomaly").selectExpr(
        *keep,
        "anomaly.type AS anomaly_type",
        "anomaly.value",
        "anomaly.threshold",
        "anomaly.reading",
    )


def types(alerts: DataFrame, alert_time: str | None = None) -> DataFrame:
    """Add the joined anomaly types and, if given, the time of the alert."""
    added = {"anomaly_types": alert_rules.anomaly_types("anomalies")}
    if alert_time is not None:
        added["alert_timestamp"] = alert_time
    return alerts.selectExpr("*", *named(added))


def messages(
    alerts: DataFrame, recipient: str, subject_prefix: str, keep: list[str]
) -> DataFrame:
    """One message per alerting reading."""
    message = {
        "recipient": text(recipient),
        "subject": alert_rules.subject(subject_prefix),
        "body": alert_rules.body("anomalies", "sensor_timestamp"),
    }
    return alerts.selectExpr(*keep, *named(message))


def outbox(message_rows: DataFrame) -> DataFrame:
    """Messages awaiting delivery."""
    return message_rows.selectExpr(
        "*", f"{text(PENDING)} AS status", "0 AS attempts", "string(NULL) AS last_error"
    )


def due(max_retries: int) -> str:
    """Unsent, and tried at most ``max_retries`` times: one try plus the retries."""
    return f"status <> {text(SENT)} AND attempts <= {max_retries}"


def deliver(
    rows: DataFrame, send: Callable[[str, str, str], None], max_retries: int = 3
) -> DataFrame:
    """One delivery round over an outbox table; write the result as its next version.

    ``send(recipient, subject, body)`` runs on the executors, one Arrow batch at
    a time. What it raises is kept in ``last_error`` and does not stop the rest.
    A task that Spark repeats sends its messages again, so delivery is
    at-least-once.
    """
    marked = rows.selectExpr("*", f"{due(max_retries)} AS due_now")

    def attempt(mail) -> tuple[str, int, str | None]:
        if not mail.due_now:
            return mail.status, mail.attempts, mail.last_error
        try:
            send(mail.recipient, mail.subject, mail.body)
        except Exception as failure:  # the sender is foreign code
            return FAILED, mail.attempts + 1, f"{type(failure).__name__}: {failure}"
        return SENT, mail.attempts + 1, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            outcome = [attempt(mail) for mail in batch.itertuples(index=False)]
            status, attempts, error = zip(*outcome) if outcome else ((), (), ())
            yield batch.drop(columns="due_now").assign(
                status=list(status), attempts=list(attempts), last_error=list(error)
            )

    return marked.mapInPandas(run, rows.schema)


# -- delivery by an append-only ledger of attempts ----------------------------------

ATTEMPT_SCHEMA = (
    "record_id string, attempt int, status string, error string, attempted_at timestamp, attempt_date date"
)


def folded(alerts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each message once, by its record id, with what the latest of its attempts left."""
    last = ledger.groupBy("record_id").agg(
        F.max_by(F.struct("status", "error"), F.struct("attempt", "attempted_at")).alias("last"),
        F.max("attempt").alias("tried"),
        F.max("attempted_at").alias("last_attempt"),
    )
    # the same message read by several runs: any of its equal rows
    once = alerts.drop("status", "attempts", "last_error", "run", "batch_id").dropDuplicates(["record_id"])
    return once.join(last, "record_id", "left").selectExpr(
        *once.columns,
        f"coalesce(last.status, {text(PENDING)}) AS status",
        "coalesce(tried, 0) AS attempts",
        "last.error AS last_error",
        "last_attempt",
    )


def due_rows(state: DataFrame, as_of, max_retries: int = 3, backoff: str = "1 minute") -> DataFrame:
    """Messages to try now: never tried, or failed with retries left and ``backoff`` times a
    power of two since the last attempt over."""
    wait = f"make_dt_interval(0, 0, 0, int(pow(2, least(attempts, 20) - 1)) * {_seconds(backoff)})"
    rested = f"last_attempt IS NULL OR last_attempt + {wait} <= {timestamp(as_of)}"
    return state.where(f"{due(max_retries)} AND ({rested})")


def attempts(rows: DataFrame, send: Callable[[str, str, str], None], as_of) -> DataFrame:
    """Ledger rows of one try of each message. ``send`` runs on the executors, as in ``deliver``."""
    tried = deliver(rows.select("record_id", "recipient", "subject", "body", "status", "attempts", "last_error"), send, 1 << 30)
    return tried.selectExpr(
        "record_id", "attempts AS attempt", "status", "last_error AS error",
        f"{timestamp(as_of)} AS attempted_at", f"to_date({timestamp(as_of)}) AS attempt_date",
    )


def _seconds(interval: str) -> int:
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]


def batch_stats(readings: DataFrame, batch: str, thresholds: Thresholds = _DEFAULT) -> DataFrame:
    """Readings, anomalies and alerts per batch."""
    return readings.groupBy(batch).agg(*stat_columns(thresholds))


def stat_columns(thresholds: Thresholds = _DEFAULT) -> list[Column]:
    """The three counts of a batch, for ``agg`` or ``observe``."""
    return measures(
        {
            "records": "count(1)",
            "anomalies": f"coalesce(sum({alert_rules.breaches(thresholds)}), 0)",
            "alerts": f"count_if({alert_rules.any_breach(thresholds)})",
        }
    )


def simple_range(readings: DataFrame) -> DataFrame:
    """Readings outside one of three fixed ranges."""
    return readings.where(alert_rules.simple_breach())
